"""Scalar expressions with the null and overflow rules the processes rely on.

All of them are Column in, Column out and stay inside Spark's code generation.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# Year, month and day with one or two digits each; nothing shorter or longer.
DATE_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"

TICKET_FIELDS = "array<struct<id:bigint,value:string>>"


def money(amount: Column) -> Column:
    """Amounts as exact decimals, so that sums do not depend on row order."""
    return amount.cast(MONEY)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Floating division; NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def safe_subtract(left: Column, right: Column) -> Column:
    """Difference; NULL instead of an overflow error."""
    return F.try_subtract(left, right)


def safe_long(text: Column) -> Column:
    """Text to integer; NULL when it is none."""
    return text.try_cast("bigint")


def safe_date(text: Column) -> Column:
    """Text to date; NULL unless it is a whole year-month-day."""
    return F.when(text.rlike(DATE_TEXT), text.try_cast("date"))


def strict_double(text: Column) -> Column:
    """Text to double; raises on bad text (ANSI mode)."""
    return text.cast("double")


def day(instant: Column) -> Column:
    """The (UTC) date of a timestamp."""
    return F.to_date(instant)


def compact_date(text: Column) -> Column:
    """Date of a ``yyyymmdd`` text."""
    return F.to_date(text, "yyyyMMdd")


def as_of_date(as_of: date, offset: int = 0) -> Column:
    """The run date shifted by whole days; folded to a literal by Catalyst."""
    return F.date_add(F.lit(as_of), offset)


def days_since(as_of: date, when: Column) -> Column:
    return F.datediff(F.lit(as_of), when)


def within_days(instant: Column, as_of: date, first: int, last: int) -> Column:
    """``first`` to ``last`` days relative to the run date, both included.

    On a timestamp column Catalyst turns this into a range on the raw column,
    which the scan can use.
    """
    return day(instant).between(as_of_date(as_of, first), as_of_date(as_of, last))


def is_true(flag: Column) -> Column:
    """True only for TRUE; NULL counts as false."""
    return flag.eqNullSafe(F.lit(True))


def in_set(value: Column, members: tuple) -> Column:
    """Membership as a boolean that is never NULL."""
    return F.coalesce(value.isin(*members), F.lit(False))


def negative_part(amount: Column) -> Column:
    """The amount when it is below zero, else 0 (also for NULL)."""
    return F.when(amount < 0, amount).otherwise(F.lit(0))


def json_value(document: Column, key: str) -> Column:
    """A scalar of a JSON text; NULL when absent, JSON null, malformed, an object
    or an array."""
    found = F.try_variant_get(F.try_parse_json(document), f"$.{key}", "variant")
    nested = F.schema_of_variant(found).rlike("^(OBJECT|ARRAY)")
    return F.when(~nested, F.get_json_object(document, f"$.{key}"))


def to_json_text(value: Column) -> Column:
    """JSON text that keeps NULL fields."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def ticket_fields(*entries: tuple[int, str]) -> Column:
    """Typed, possibly empty list of (field id, text)."""
    items = [F.struct(F.lit(i).cast("bigint").alias("id"), F.lit(v).alias("value")) for i, v in entries]
    return F.array(*items).cast(TICKET_FIELDS)
