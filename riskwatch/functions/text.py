"""Values as text, for ticket bodies and subjects."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "N/A"

# The formats of amounts and shares.
ONE_DECIMAL = "999,999,999.0"
TWO_DECIMALS = "999,999,999.00"

#: How a format is applied: text as long as the number, or as the format says.
TRIMMED, PADDED = "trimmed", "padded"


def joined(*parts: Column | str) -> Column:
    """Concatenation; NULL as soon as one part is NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def plain(value: Column) -> Column:
    """Text, whole number, boolean or date as text."""
    return value.cast("string")


def number(value: Column, digits: int = 2) -> Column:
    """A decimal number without exponent and without trailing zeros."""
    fixed = value.cast(f"decimal(38,{digits})").cast("string")
    return F.rtrim(F.rtrim(fixed, F.lit("0")), F.lit(".")) if digits else fixed


@dataclass(frozen=True)
class NumberFormat:
    """A format text: 9 is a digit, blank where it would lead with zeros, 0 a digit
    that is always written, a comma separates thousands, a point starts decimals."""

    text: str

    def __post_init__(self) -> None:
        if not re.fullmatch(r"(9{1,3}(,999)*|9*0*)(\.[09]*)?", self.text) or not self.text.strip("."):
            raise ValueError(f"not a number format: {self.text!r}")

    @property
    def whole(self) -> str:
        return self.text.partition(".")[0]

    @property
    def decimals(self) -> int:
        return len(self.text.partition(".")[2])

    @property
    def places(self) -> int:
        """Digits there is room for before the point."""
        return len(self.whole.replace(",", ""))

    def digits_of(self, number: Column) -> Column:
        """The digits of a number of the format's scale, not negative."""
        written = F.format_number(number, self.decimals)
        if "," not in self.text:
            written = F.translate(written, ",", "")
        least = self.whole.count("0")
        if least == 0:
            return F.regexp_replace(written, r"^0(?=\.)", "") if self.decimals else written
        return F.when(number < F.lit(10 ** (least - 1)), F.lpad(written, least + self.decimals + bool(self.decimals), "0")).otherwise(written)


def formatted(value: Column, form: str, style: str = TRIMMED) -> Column:
    """A number by a format text, rounded half away from zero to its decimals.

    ``trimmed`` writes all digits of the number, however many, and no blanks.
    ``padded`` keeps to the format: the text has one character for the sign and
    one for each of the format's, blanks lead, a minus stands before the first
    digit, and a number with too many digits shows as ``#`` in all places.
    """
    parsed = NumberFormat(form)
    number = value.cast(f"decimal(38,{parsed.decimals})")
    if style == TRIMMED:
        written = F.format_number(number, parsed.decimals)
        return written if "," in form else F.translate(written, ",", "")
    if style != PADDED:
        raise ValueError(f"no such style: {style!r}")
    sign = F.when(number < 0, F.lit("-")).when(number >= 0, F.lit(" "))
    fits = F.abs(number) < F.lit(10**parsed.places)
    digits = F.lpad(F.concat(sign, parsed.digits_of(F.abs(number))), len(form) + 1, " ")
    return F.when(fits, digits).otherwise(F.concat(sign, F.lit(re.sub("[09]", "#", form))))


def percent(rate: Column, form: str = TWO_DECIMALS, style: str = TRIMMED) -> Column:
    """A rate in percent, without the sign."""
    return formatted(rate * 100, form, style)


def or_missing(text: Column, default: str = MISSING) -> Column:
    return F.coalesce(text, F.lit(default))
