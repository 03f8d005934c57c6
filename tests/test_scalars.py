"""Scalar expressions at their edges."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskwatch.functions import scalars as s
from riskwatch.functions import text as t


def value(spark, column, **inputs):
    """The column over one row of typed inputs (value, type)."""
    literals = [F.lit(v).cast(kind).alias(k) for k, (v, kind) in inputs.items()]
    row = spark.range(1).select(*literals) if literals else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-11-07", date(2024, 11, 7)),
        ("2024-1-5", date(2024, 1, 5)),
        (" 2024-11-07 ", date(2024, 11, 7)),
        ("2024", None),
        ("2024-11", None),
        ("2024-13-01", None),
        ("2024-02-30", None),
        ("2024-11-07 10:00:00", None),
        ("soon", None),
        (None, None),
    ],
)
def test_safe_date_takes_whole_dates_only(spark, text, expected):
    assert value(spark, s.safe_date(F.col("v")), v=(text, "string")) == expected


@pytest.mark.parametrize("text, expected", [("7995", 7995), (" 5 ", 5), ("5.7", None), ("n/a", None), (None, None)])
def test_safe_long(spark, text, expected):
    assert value(spark, s.safe_long(F.col("v")), v=(text, "string")) == expected


def test_division_and_subtraction_give_null_instead_of_errors(spark):
    assert value(spark, s.safe_divide(F.lit(1), F.lit(0))) is None
    assert value(spark, s.safe_divide(F.lit(1), F.lit(4))) == 0.25
    assert value(spark, s.safe_subtract(F.lit(-(2**63) + 1), F.lit(5))) is None


def test_strict_cast_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, s.strict_double(F.col("v")), v=("lots", "string"))


@pytest.mark.parametrize(
    "number, digits, expected",
    [
        ("1234567.25", 1, "1,234,567.3"),
        ("-1234.5", 2, "-1,234.50"),
        ("0.25", 1, "0.3"),
        ("-0.25", 1, "-0.3"),
        ("0", 2, "0.00"),
        ("12345678901.5", 1, "12,345,678,901.5"),
        (None, 1, None),
    ],
)
def test_trimmed_amounts_round_half_away_and_keep_the_sign(spark, number, digits, expected):
    form = {1: t.ONE_DECIMAL, 2: t.TWO_DECIMALS}[digits]
    assert value(spark, t.formatted(F.col("v"), form), v=(number, "decimal(20,2)")) == expected


@pytest.mark.parametrize(
    "number, form, expected",
    [
        ("1234567.25", t.ONE_DECIMAL, "   1,234,567.3"),
        ("-1234.5", t.TWO_DECIMALS, "      -1,234.50"),
        ("0.25", t.ONE_DECIMAL, "            .3"),
        ("-0.25", t.ONE_DECIMAL, "           -.3"),
        ("-0.01", t.ONE_DECIMAL, "            .0"),
        ("0", t.TWO_DECIMALS, "            .00"),
        ("999999999.94", t.ONE_DECIMAL, " 999,999,999.9"),
        ("999999999.95", t.ONE_DECIMAL, " ###,###,###.#"),
        ("-12345678901.5", t.TWO_DECIMALS, "-###,###,###.##"),
        ("7", "999", "   7"),
        ("-7", "990.00", "  -7.00"),
        ("0.5", "990.00", "   0.50"),
        ("7", "0000", " 0007"),
        (None, t.ONE_DECIMAL, None),
    ],
)
def test_padded_amounts_follow_their_format(spark, number, form, expected):
    assert value(spark, t.formatted(F.col("v"), form, t.PADDED), v=(number, "decimal(20,2)")) == expected


@pytest.mark.parametrize("form", ["", "9,9", "abc", "9.9.9", "."])
def test_other_texts_are_no_formats(form):
    with pytest.raises(ValueError):
        t.NumberFormat(form)


@pytest.mark.parametrize(
    "number, expected", [("12000000.00", "12000000"), ("-5.50", "-5.5"), ("100", "100"), ("0", "0"), (None, None)]
)
def test_number_has_no_exponent_or_trailing_zeros(spark, number, expected):
    assert value(spark, t.number(F.col("v")), v=(number, "double")) == expected


def test_joined_propagates_null(spark):
    assert value(spark, t.joined("a", F.lit("b"))) == "ab"
    assert value(spark, t.joined("a", F.lit(None).cast("string"))) is None


def test_json_scalars(spark):
    document = ('{"a": "x", "b": null, "c": 1.5}', "string")
    assert value(spark, s.json_value(F.col("d"), "a"), d=document) == "x"
    assert value(spark, s.json_value(F.col("d"), "b"), d=document) is None
    assert value(spark, s.json_value(F.col("d"), "c"), d=document) == "1.5"
    assert value(spark, s.json_value(F.col("d"), "a"), d=("{oops", "string")) is None


def test_json_text_keeps_null_fields(spark):
    row = F.struct(F.lit(None).cast("string").alias("a"), s.ticket_fields().alias("b"))
    assert value(spark, s.to_json_text(row)) == '{"a":null,"b":[]}'


def test_three_valued_logic(spark):
    unknown = F.lit(None).cast("boolean")
    assert value(spark, s.is_true(unknown)) is False
    assert value(spark, s.in_set(F.lit(None).cast("string"), ("a",))) is False
    assert value(spark, s.negative_part(F.lit(None).cast("decimal(18,2)"))) == Decimal("0.00")
    assert value(spark, s.negative_part(F.lit(Decimal("-3.20")))) == Decimal("-3.20")


def test_compact_date(spark):
    assert value(spark, s.compact_date(F.lit("20241107"))) == date(2024, 11, 7)
