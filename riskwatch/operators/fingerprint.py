"""Checksums of whole tables that do not depend on row order."""

from __future__ import annotations

import operator
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Name of the line that stands for whole rows.
WHOLE_ROW = "*"
# Hex digits of a hash that make a number of 60 bits.
DIGITS = 15
# Numbers are summed as integers in three parts, exactly up to 2^43 rows: decimals
# would take longer than the hashes.
PART_BITS = 20
PARTS = 3


def leaves(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    """Dotted names of all columns; structs give one for each field in them."""
    found: list[tuple[str, T.DataType]] = []
    for field in schema.fields:
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            found += leaves(field.dataType, f"{name}.")
        else:
            found.append((name, field.dataType))
    return found


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def as_text(value: Column, kind: T.DataType) -> Column:
    """One text for each value, the same in every engine: fixed digits, fixed
    date forms. NULL stays NULL."""
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(value.try_cast("decimal(38,9)").cast("string"), value.cast("string"))
    if isinstance(kind, (T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("bigint")


def _hashed(value: Column, text: Column, kind: T.DataType) -> Column:
    """The number of a value's text; a boolean has one of two, which Spark folds."""
    if isinstance(kind, T.BooleanType):
        return F.when(value, _number(F.lit("true"))).when(~value, _number(F.lit("false")))
    return _number(text)


def _measured(value: Column, text: Column, kind: T.DataType) -> Column:
    """A value's text behind its length, so that whole rows are told apart."""
    if isinstance(kind, T.BooleanType):
        return F.when(value, "4:true").when(~value, "5:false").otherwise("-")
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _part(number: Column, place: int) -> Column:
    return F.shiftright(number, PART_BITS * place).bitwiseAND(F.lit((1 << PART_BITS) - 1))


def _total(sums: list[Column]) -> Column:
    """The exact sum from those of its parts, lowest first."""
    scaled = [s.cast("decimal(20,0)") * F.lit(Decimal(1 << PART_BITS * place)) for place, s in enumerate(sums)]
    return F.coalesce(reduce(operator.add, scaled), F.lit(Decimal(0)))


def fingerprint(df: DataFrame) -> DataFrame:
    """Rows, NULLs and a sum of hashes for each column, and for whole rows.

    A changed, missing, repeated or moved value changes a sum: a column's line
    sees its values, the line ``*`` sees which values stand in one row. Sums are
    added up within each task first, so one row a task is shuffled. Each value is
    hashed once, and only its number goes on to the sums.
    """
    columns = [(name, F.col(_quoted(name)), kind) for name, kind in leaves(df.schema)]
    texts = [as_text(value, kind) for _, value, kind in columns]
    whole = F.concat(*[
        _measured(value, text, kind) for (_, value, kind), text in zip(columns, texts, strict=True)
    ])
    numbers = [_hashed(value, text, kind) for (_, value, kind), text in zip(columns, texts, strict=True)]
    names = [*[name for name, _, _ in columns], WHOLE_ROW]
    held = [f"t{k}" for k in range(len(names))]
    hashed = df.select(*[n.alias(t) for n, t in zip([*numbers, _number(whole)], held, strict=True)])
    sums = hashed.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(t)).alias(f"n_{t}") for t in held],
        *[F.sum(_part(F.col(t), place)).alias(f"s{place}_{t}") for t in held for place in range(PARTS)],
    )
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"n_{t}")).alias("null_count"),
            _total([F.col(f"s{place}_{t}") for place in range(PARTS)]).cast("string").alias("checksum"),
        )
        for name, t in zip(names, held, strict=True)
    ]
    return sums.select(F.inline(F.array(*lines)))
