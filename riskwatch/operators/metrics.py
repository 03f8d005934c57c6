"""Conditional aggregates over trailing windows, and field pivots."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwatch.functions.scalars import MONEY, money, within_days


@dataclass(frozen=True)
class Metric:
    """A count, or the sum of ``amount``, of flagged rows in a day window.

    ``first`` and ``last`` are days relative to the run date, both included.
    """

    name: str
    flag: str | None
    when: str
    first: int
    last: int = -1
    amount: str | None = None

    def matches(self, as_of: date) -> Column:
        inside = within_days(F.col(self.when), as_of, self.first, self.last)
        return inside if self.flag is None else F.col(self.flag) & inside

    def column(self, as_of: date, also: Column | None = None) -> Column:
        hit = self.matches(as_of) if also is None else self.matches(as_of) & also
        if self.amount is None:
            return F.sum(F.when(hit, F.lit(1)).otherwise(F.lit(0))).alias(self.name)
        nothing = F.lit(0).cast(MONEY)
        return F.sum(F.when(hit, money(F.col(self.amount))).otherwise(nothing)).alias(self.name)


def widest_windows(metrics: Iterable[Metric]) -> dict[str, tuple[int, int]]:
    """For each date column the days in which some trailing, flagged metric can count."""
    widest: dict[str, tuple[int, int]] = {}
    for m in metrics:
        if m.flag is not None and m.last < 0:
            widest[m.when] = (min(m.first, widest.get(m.when, (m.first, -1))[0]), -1)
    if not widest:
        raise ValueError("no trailing metric to filter by")
    return widest


def any_window(metrics: Iterable[Metric], as_of: date) -> Column:
    """Rows that can count in some trailing, flagged metric.

    One range per date column, as wide as its widest metric; Catalyst pushes
    the disjunction of ranges into the scan.
    """
    ranges = [within_days(F.col(when), as_of, *days) for when, days in widest_windows(metrics).items()]
    return reduce(Column.__or__, ranges)


def pivot_fields(
    df: DataFrame,
    key: str,
    title: str,
    fields: dict[str, Column],
) -> DataFrame:
    """Title/value rows to one row per key.

    ``fields`` maps a title to the aggregate (already aliased) over its values;
    use ``titled`` to build it. Other titles are filtered out before the
    shuffle, and values are pre-aggregated per task.
    """
    return df.where(F.col(title).isin(*fields)).groupBy(key).agg(*fields.values())


def titled(title_column: str, title: str, value: Column) -> Column:
    """The value where the row carries the title, else NULL."""
    return F.when(F.col(title_column) == title, value)
