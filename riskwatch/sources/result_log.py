"""Prior results, kept as JSON rows in a log table, and new ones for it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwatch.config import RESULT_LOGTYPE
from riskwatch.functions.scalars import json_value, to_json_text
from riskwatch.operators.fingerprint import fingerprint
from riskwatch.operators.staging import stage


def read_results(log: DataFrame, process: str, logtype: str = RESULT_LOGTYPE) -> DataFrame:
    """Log rows of one process; both filters reach the scan."""
    return log.where((F.col("logtype") == logtype) & (F.col("process_name") == process))


def log_field(key: str) -> Column:
    """One scalar of the JSON document in a log row."""
    return json_value(F.col("values"), key)


def emit(df: DataFrame, process: str, **actions: Column) -> DataFrame:
    """A pipeline's final table: all columns, the process name, the actions."""
    named = df.withColumn("process_name", F.lit(process))
    return named.withColumns(actions) if actions else named


def as_log_rows(
    result: DataFrame,
    runtime: datetime,
    metrics: tuple[str, ...],
    ticket_id: Column | None = None,
) -> DataFrame:
    """Emitted results in the log's own shape, ready to append.

    The ticket id exists only once a ticket was dispatched, so it is optional.
    """
    ticket = F.lit(None).cast("string") if ticket_id is None else ticket_id.cast("string")
    document = F.struct(
        F.col("creditor_id").cast("string").alias("creditor_id"),
        ticket.alias("ticket_id"),
        *[F.col(m).alias(m) for m in metrics],
    )
    return result.select(
        to_json_text(document).alias("values"),
        F.lit(runtime).cast("timestamp").alias("runtime"),
        F.lit(RESULT_LOGTYPE).alias("logtype"),
        F.col("process_name"),
    )


def log_fields(rows: DataFrame, *keys: str) -> DataFrame:
    """Adds scalars of the JSON document of log rows, one column for each key.

    The document is parsed once for all of them. Only a value that looks like an
    object or an array is looked at again, as it may be text.
    """
    names = [f"_{k}" for k in range(len(keys))]
    found = rows.select("*", F.json_tuple("values", *keys).alias(*names))
    nested = r"^\s*[\[{]"
    scalars = {
        key: F.when(F.col(name).rlike(nested), log_field(key)).otherwise(F.col(name))
        for key, name in zip(keys, names, strict=True)
    }
    return found.withColumns(scalars).drop(*names)


def _place(path: str, run_date: date, process: str) -> str:
    return f"{path.rstrip('/')}/run_date={run_date.isoformat()}/process_name={process}"


def read_written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Written results of all run dates and processes; ``schema`` is the emitted table's."""
    dated = T.StructType([*schema.fields, T.StructField("run_date", T.DateType())])
    return spark.read.schema(dated).parquet(path)


def write_results(
    result: DataFrame, path: str, run_date: date, process: str | None = None, verify: bool = False
) -> None:
    """Emitted rows as parquet, one directory per run date and process.

    A run that is repeated replaces its own directories and no other. With
    ``process``, the table is that process's, and a run that has no rows any more
    replaces the last one's too.

    With ``verify`` the files are read back and compared with the rows by
    checksums of every column and of whole rows. The rows are staged before, so
    that they are computed once; without a shared folder they are twice.
    """
    rows = stage(result) if verify else result
    if process is None:
        dated = rows.withColumn("run_date", F.lit(run_date))
        writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run_date", "process_name").parquet(path)
    else:
        rows.drop("process_name").write.mode("overwrite").parquet(_place(path, run_date, process))
    if not verify:
        return
    back = read_written(result.sparkSession, path, result.schema).where(F.col("run_date") == F.lit(run_date))
    names = rows.select("process_name").distinct() if process is None else None
    back = back.join(names, "process_name", "left_semi") if process is None else back.where(F.col("process_name") == process)
    back = back.select(*result.columns)
    wanted, found = (sorted(map(tuple, fingerprint(df).collect())) for df in (rows, back))
    if wanted != found:
        different = [a[0] for a, b in zip(wanted, found, strict=True) if a != b]
        raise ValueError(f"written results differ from the rows in {different}")
