"""Creditors that ever had a payment, kept between runs.

Whether an old merchant ever paid decides between a 0 and nothing, and whether
its category is idle or unknown. Looking that up in the payments reads a column
of their whole history in every run. Here it is a table that grows by each run's
new creditors: a directory for each run date, found in the payments of the last
year, which the run reads anyway.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwatch.sources.tables import Sources

#: Days before the last run whose charges are looked at again, for late rows;
#: a year is, if runs are daily.
LATE_DAYS = 30
YEAR_DAYS = 365

RUN_DATE = "run_date"


def _folder(path: str, day: date) -> str:
    return f"{path.rstrip('/')}/{RUN_DATE}={day.isoformat()}"


def run_dates(spark: SparkSession, path: str) -> list[date]:
    """Dates of the finished runs, oldest first."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    found = []
    for status in system.listStatus(place):
        key, _, value = status.getPath().getName().partition("=")
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if key == RUN_DATE and system.exists(done):
            found.append(date.fromisoformat(value))
    return sorted(found)


def _read(spark: SparkSession, path: str, days: list[date]) -> DataFrame:
    return spark.read.schema("creditor_id string").parquet(*[_folder(path, d) for d in days])


def _candidates(payments: DataFrame, as_of: date, last: date | None) -> DataFrame:
    """Creditors that may be new: of all payments at first, then of those with a
    recent, a coming or no charge date."""
    if last is not None:
        since = min(as_of - timedelta(days=YEAR_DAYS), last - timedelta(days=LATE_DAYS))
        charged = F.col("charge_date")
        payments = payments.where((charged >= F.lit(since)) | charged.isNull())
    return payments.select("creditor_id").distinct()


def refresh_seen(spark: SparkSession, sources: Sources, path: str, as_of: date, rebuild: bool = False) -> Sources:
    """Adds the run date's new creditors to the table; gives sources that use it.

    A repeated run replaces its own directory, found from the earlier ones, so
    it changes nothing. A row that arrives more than ``LATE_DAYS`` after its
    charge date and a year before the run is missed until ``rebuild``, which
    reads all payments into the run date's directory alone.
    """
    earlier = [] if rebuild else [d for d in run_dates(spark, path) if d < as_of]
    found = _candidates(sources.table("payment"), as_of, earlier[-1] if earlier else None)
    if earlier:
        known = _read(spark, path, earlier).withColumnRenamed("creditor_id", "_known")
        found = found.join(known, F.col("creditor_id").eqNullSafe(F.col("_known")), "left_anti")
    found.select(F.col("creditor_id").cast("string")).write.mode("overwrite").parquet(_folder(path, as_of))
    seen = _read(spark, path, [*earlier, as_of])
    return sources.replace(seen_creditor=seen)
