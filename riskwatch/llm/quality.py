"""Quality rules (7): a threshold table compiled into one Spark projection.

Every count is a built-in expression over the row's own text; no row meets
another one, so nothing is shuffled and a hot source is like any other.

Defined results: a null text has no words, and like an empty text it fails the
base rule (fewer than 50 words). A null ``doc_id`` stays null. Repeated rows are
judged one by one. ``passing`` carries all columns as one value, so they may have
any name. An empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
NOT_SYMBOL = r"[^#*$%&|<>]+"

# Frequent function words of the four languages.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with",
    "der", "die", "das", "und", "ist", "nicht", "von", "zu",
    "le", "la", "les", "des", "de", "et", "que", "est", "pas",
    "el", "los", "las", "en", "del", "y", "no", "con",
)


@dataclass(frozen=True)
class Rule:
    """Fails where ``100 * part > percent * whole``."""

    name: str
    part: str
    percent: int
    whole: str


#: The verdict beyond the base rule, in hundredths of the whole. Whole numbers
#: on both sides keep the comparison exact.
RULES = (
    Rule("symbols", "n_symbols", 10, "n_words"),
    Rule("shouting", "n_exclamations", 20, "n_words"),
    Rule("capitals", "n_capitals", 30, "word_chars"),
    Rule("repeated_lines", "n_dup_lines", 50, "n_lines"),
    Rule("long_words", "word_chars", 2000, "n_words"),
    Rule("short_words", "n_words", 60, "word_chars"),
    Rule("listing", "n_bullets", 90, "n_lines"),
    Rule("too_few_stop_words", "n_no_stop", 99, "n_words"),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
REPORT = ("n_lines", "n_exclamations", "n_capitals", "n_bullets", "n_no_stop")
MIN_WORDS = 50
REPEAT_PERCENT = 50


def _long(value: Column, name: str) -> Column:
    return value.cast("bigint").alias(name)


def _only(text: Column, not_wanted: str) -> Column:
    return F.char_length(F.regexp_replace(text, not_wanted, ""))


def _windows() -> Column:
    """The three-word windows with their places, ordered by their words.

    Built without a lambda from the words and the words shifted by one and two.
    The last two places have no third word and so equal nothing.
    """
    words, n = F.col("_words"), F.size("_words")
    shifted = [F.slice(words, 2, n).alias("b"), F.slice(words, 3, n).alias("c")]
    return F.sort_array(F.arrays_zip(words.alias("a"), *shifted, F.sequence(F.lit(0), n - 1).alias("at")))


def _like_neighbour(step: int) -> Column:
    """Places of windows that equal the next (1) or the last (-1) one in order."""
    windows = F.col("_windows")

    def same(x: Column, k: Column) -> Column:
        y = F.get(windows, k + step)
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    return F.filter(windows, same).getField("at")


def _repeated() -> Column:
    """Places of windows that occur twice or more, ascending."""
    later = F.col("_later")
    both = F.sort_array(F.array_union(later, _like_neighbour(1)))
    return F.when(F.size(later) > 0, both).otherwise(later)


def _covered() -> Column:
    """Words inside the repeated windows; overlapping windows count once."""
    places = F.col("_places")
    steps = F.transform(places, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - at, F.lit(3))))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def _judged(docs: DataFrame, carried: Column) -> DataFrame:
    """``carried`` as ``_row``, the counts and the verdict per row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    start = docs.select(carried.alias("_row"), text.alias("_text"))
    split = start.select(
        "_row",
        "_text",
        F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split("_text", "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "").alias("_lines"),
    )
    counted = split.select(
        "_row",
        _long(F.size("_words"), "n_words"),
        _long(F.char_length(F.array_join("_words", "")), "word_chars"),
        _long(_only(F.col("_text"), NOT_SYMBOL), "n_symbols"),
        _long(F.size("_lines") - F.size(F.array_distinct("_lines")), "n_dup_lines"),
        _long(F.size("_lines"), "n_lines"),
        _long(_only(F.col("_text"), "[^!]+"), "n_exclamations"),
        _long(_only(F.col("_text"), "[^A-Z]+"), "n_capitals"),
        _long(F.size(F.filter("_lines", lambda line: line.rlike(r"^\s*([-*•]|[0-9]+[.)])\s"))), "n_bullets"),
        _long(F.size(F.array_except(F.array(*map(F.lit, STOP_WORDS)), F.col("_words"))), "_missing"),
        _windows().alias("_windows"),
    )
    compared = counted.select("*", _like_neighbour(-1).alias("_later"))
    placed = compared.select(
        *[c for c in counted.columns if c != "_windows"], _repeated().alias("_places")
    )
    full = placed.select(
        *[c for c in placed.columns if c not in ("_places", "_missing")],
        _long(_covered(), "n_repeat_words"),
        # All words where fewer than two different stop words occur, else none.
        _long(F.when(F.col("_missing") > len(STOP_WORDS) - 2, F.col("n_words")).otherwise(0), "n_no_stop"),
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    broken = reduce(Column.__or__, [100 * F.col(r.part) > r.percent * F.col(r.whole) for r in RULES])
    return full.select(
        "_row", *COUNTS, base_failed.alias("base_failed"), (~base_failed & ~broken).alias("kept"), *REPORT
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, ``base_failed`` and ``kept`` per row of ``docs``."""
    return _judged(docs, F.col("doc_id")).withColumnRenamed("_row", "doc_id")


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that every rule lets pass, with all their columns.

    The row number keeps the optimizer from moving the filter below the steps
    that compute it, which would repeat them once for each use.
    """
    numbered = _judged(docs, F.struct("*")).select("_row", "kept", F.monotonically_increasing_id().alias("_number"))
    return numbered.where(F.col("kept") & (F.col("_number") >= 0)).select("_row.*")


def _sql_rule(rule: Rule) -> str:
    return f"100 * {rule.part} > {rule.percent} * {rule.whole}"


def oracle() -> str:
    """The same counts and the same threshold table in DuckDB's SQL."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), g AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3
), grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM g
), twice AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), c AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines,
    length(regexp_replace(t, '[^!]+', '', 'g'))::BIGINT AS n_exclamations,
    length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_capitals,
    len(list_filter(lines, lambda l: regexp_matches(l, '^\s*([-*•]|[0-9]+[.)])\s')))::BIGINT AS n_bullets,
    (CASE WHEN len(list_filter([{stop}], lambda s: list_contains(words, s))) < 2
          THEN len(words) ELSE 0 END)::BIGINT AS n_no_stop
  FROM w LEFT JOIN covered USING (doc_id)
), f AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM c
)
SELECT doc_id, {", ".join(COUNTS)}, base_failed,
  NOT base_failed AND NOT ({" OR ".join(map(_sql_rule, RULES))}) AS kept, {", ".join(REPORT)}
FROM f
"""
