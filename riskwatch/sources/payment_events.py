"""Payments by event: a row for each event of a payment, stored by event date.

The trailing windows look at four dates of a payment, and a payment counts if
any of them lies in its window. Stored by one date, that disjunction can skip no
partition. Stored once for each event under the event's own date, each of the
four windows reads its own days. The job that writes the layout reads payments
once for all processes of a day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwatch.functions.scalars import as_of_date, day, within_days
from riskwatch.operators.metrics import Metric, any_window, widest_windows
from riskwatch.sources.tables import COLUMNS, Sources

EVENT, EVENT_DATE = "event", "event_date"

#: Dates of a payment that are events; the events are named like them.
EVENTS = ("charge_date", "charged_back_date", "failed_or_late_failure_date", "refund_created_at")


def payment_events(payments: DataFrame) -> DataFrame:
    """Each payment once for each of its dates, with all its columns."""
    dates = [F.struct(F.lit(name).alias(EVENT), day(F.col(name)).alias(EVENT_DATE)) for name in EVENTS]
    rows = payments.select(*COLUMNS["payment"], F.explode(F.array(*dates)).alias("_event"))
    return rows.select(*COLUMNS["payment"], f"_event.{EVENT}", f"_event.{EVENT_DATE}").where(
        F.col(EVENT_DATE).isNotNull()
    )


def write_payment_events(sources: Sources, path: str, as_of: date, days: int = 365) -> None:
    """Writes the events of the ``days`` before the run date, replacing those days.

    A payment changes while it is young (it may be charged back), so its earlier
    events are written again with it: one run writes all days that a window of
    the run date can see. Rows are dealt by day, and Spark splits large days.
    """
    recent = F.col(EVENT_DATE).between(as_of_date(as_of, -days), as_of_date(as_of, -1))
    rows = payment_events(sources.table("payment")).where(recent).hint("rebalance", EVENT, EVENT_DATE)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(EVENT, EVENT_DATE).parquet(path)


def _first_let_in(windows: dict[str, tuple[int, int]], as_of: date) -> Column:
    """The event that stands for a payment: the first that lies in its window."""
    inside = [F.when(within_days(F.col(name), as_of, *days), F.lit(name)) for name, days in windows.items()]
    return F.coalesce(*inside)


def payments_let_in(sources: Sources, metrics: Sequence[Metric], as_of: date) -> DataFrame:
    """Payments with an event in some window, each once.

    From the event layout where the sources have one: the windows are conditions
    on its partition columns, and a payment seen through several events is taken
    at the first, which the row itself tells. Else from the payments, by the
    disjunction of the four ranges.
    """
    if not sources.has("payment_event"):
        return sources.table("payment").where(any_window(metrics, as_of))
    windows = widest_windows(metrics)
    days = {
        name: F.col(EVENT_DATE).between(as_of_date(as_of, first), as_of_date(as_of, last))
        for name, (first, last) in windows.items()
    }
    seen = reduce(Column.__or__, [(F.col(EVENT) == name) & inside for name, inside in days.items()])
    rows = sources.table("payment_event").where(seen)
    return rows.where(F.col(EVENT) == _first_let_in(windows, as_of))
