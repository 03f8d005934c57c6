"""Registers a query next to the SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines agree on: dates as text, decimals as doubles."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def check(key: str, sql: str) -> Callable[[Query], Query]:
    """Decorator: ``key`` is the operator's id in lower case."""

    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        ORACLES[key] = sql
        return fn

    return register
