"""Mixing (13): documents repeated so that sources reach target weights.

Words are summed per source, which Spark does partly in each task, so a source
with a third of all rows sends one row a task. A source's target over its words
is its repetition rate, and a document is emitted floor(rate) times plus one
Bernoulli copy, whose probability is the rate's fraction and whose number is a
hash of the row itself. Everything is a built-in expression.

Targets: sources weigh 1, 2, 3, repeating, in the order of their names' code
points, null last, and share all words. None gets more than ``MOST`` times its
own words; what it would get beyond is shared among the others by weight until
none is above. Each round of that is one sum over a row per source, and only the
sums come to the driver. All sums are whole numbers.

Texts are read once: a written table holds id, size, source and number of each
document, and is joined with the rates. Rates are one row per source. Documents
of a source are divided over ``SLOTS`` slots and the rates repeated for each, so
a hot source is several tasks where Spark measures the rates as too large to
broadcast. Places in the order of sources come from sorted parts and a prefix sum
over a row per part, so many sources are no single task either.

Defined results: a null text has size 0. Documents of size 0 are emitted like
others of their source. A source without words has target 0 and rate 0, as has
every source of an empty corpus. Rows equal in ``doc_id`` and text, repeated
ones among them, are emitted equally often. Extra columns may have any name; the
operator carries the row as one value. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskwatch.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: A source is taken at most so many times over.
MOST = 3
SLOTS = 16
#: Numbers drawn are whole and below this; the fraction is compared in the same units.
DRAWS = 2**32


def size() -> Column:
    """Words of the text."""
    return F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("bigint")


def _draw() -> Column:
    """A number of the row: the first 32 bits of a hash of its id and text."""
    identity = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(identity), 1, 8), 16, 10).cast("bigint")


def _in_order(sources: DataFrame) -> DataFrame:
    """Adds each source's place, counted from 0, null last."""
    order = F.col("source").asc_nulls_last()
    parted = sources.repartitionByRange(order).withColumn("part", F.spark_partition_id())
    parted = stage(parted, "sources")
    sizes = parted.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    placed = parted.withColumn("inside", inside).join(bases, "part")
    return placed.withColumn("place", F.col("base") + F.col("inside")).drop("part", "inside", "base")


def source_rates(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target and rate, a row per source of ``sizes``."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = F.array(*[F.lit(w) for w in weights])
    weight = F.get(listed, (F.col("place") % len(weights)).cast("int")).cast("bigint")
    weighed = stage(_in_order(totals).select("source", "source_size", weight.alias("weight")), "weights")

    # Products are decimals: words times weights may pass 64 bits.
    limit, whole = most * F.col("source_size"), "decimal(38,0)"

    def above(left: int, heavy: int) -> Column:
        return F.lit(left).cast("decimal(20,0)") * F.col("weight") > limit.cast("decimal(20,0)") * F.lit(heavy)

    # Words left to the sources below their limit, and those sources' weights.
    everything, heavy = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    left, full = everything or 0, 0
    while heavy:
        over = above(left, heavy)
        taken, weight_left, now_full = weighed.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.count(F.when(over, F.lit(1))),
        ).first()
        # A full source stays full: shares only grow from round to round.
        if now_full == full:
            break
        left, heavy, full = everything - taken, weight_left, now_full
    heavy = heavy or 1
    share = (F.lit(left).cast("decimal(20,0)") * F.col("weight")).cast(whole).cast("double") / F.lit(float(heavy))
    target = F.when(above(left, heavy), limit.cast("double")).otherwise(share)
    rate = F.when(above(left, heavy), F.lit(float(most))).otherwise(target / F.col("source_size"))
    return weighed.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, rate).otherwise(F.lit(0.0)).alias("rate"),
    )


def _with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """``rows`` with source and number joined with their source's rate; adds ``copies``."""
    slot = F.pmod(F.col("draw"), F.lit(SLOTS))
    spread = rates.withColumnRenamed("source", "_name").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))).alias("_slot")
    )
    same = F.col("source").eqNullSafe(F.col("_name")) & (slot == F.col("_slot"))
    whole = F.floor("rate")
    lucky = F.col("draw") < (F.col("rate") - whole) * F.lit(float(DRAWS))
    joined = rows.join(spread, same, "left")
    return joined.withColumn("copies", whole + lucky.cast("bigint")).drop("_name", "_slot")


def _numbered(docs: DataFrame, carried: Column) -> DataFrame:
    return docs.select(carried, F.col("source"), size().alias("size"), _draw().alias("draw"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies per row of ``docs``."""
    rows = stage(_numbered(docs, F.col("doc_id")), "sizes")
    mixed = _with_rates(rows, source_rates(rows, weights, most))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents themselves, all columns, each as often as the mix takes it."""
    sizes = stage(docs.select("source", size().alias("size")), "sizes")
    rows = docs.select(F.struct("*").alias("_row"), "source", _draw().alias("draw"))
    mixed = _with_rates(rows, source_rates(sizes, weights, most)).where(F.col("copies") > 0)
    again = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.select("_row", again.alias("_copy")).select("_row.*")


def oracle() -> str:
    """The same in DuckDB's SQL; sources fill up in the order of size by weight."""
    listed = f"[{', '.join(map(str, WEIGHTS))}]"
    return rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 8))::BIGINT AS draw
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), weighed AS (
  SELECT *, {listed}[1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(WEIGHTS)}] AS weight
  FROM totals
), filling AS (
  SELECT *, sum(source_size) OVER () AS everything,
    coalesce(sum({MOST} * source_size) OVER earlier, 0) AS taken,
    sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS heavy
  FROM weighed
  WINDOW earlier AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT *, (everything - taken) * weight > {MOST} * source_size * heavy AS capped FROM filling
), rest AS (
  SELECT max(everything)::BIGINT - coalesce(sum({MOST} * source_size) FILTER (WHERE capped), 0)::BIGINT AS room,
    sum(weight) FILTER (WHERE NOT capped)::BIGINT AS heavy
  FROM judged
), rates AS (
  SELECT source, source_size,
    CASE WHEN capped THEN ({MOST} * source_size)::DOUBLE
         ELSE (room * weight)::DOUBLE / rest.heavy::DOUBLE END AS target,
    CASE WHEN source_size = 0 THEN 0::DOUBLE WHEN capped THEN {MOST}::DOUBLE
         ELSE (room * weight)::DOUBLE / rest.heavy::DOUBLE / source_size::DOUBLE END AS rate
  FROM judged, rest
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies
FROM (
  SELECT d.*, source_size, target,
    floor(rate)::BIGINT + (draw < (rate - floor(rate)) * {float(DRAWS)!r})::BIGINT AS copies
  FROM d JOIN rates ON d.source IS NOT DISTINCT FROM rates.source
)
"""
