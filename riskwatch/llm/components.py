"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwatch.llm.common import stage


def _with_least(pairs: DataFrame) -> DataFrame:
    """Adds each ``u``'s least neighbour (or itself) as ``m``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links point from the larger id ``u`` to the smaller ``v``."""
    joined = _with_least(links)
    moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(joined.select("u", F.col("m").alias("v"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(doc, component) for every end of a link (a, b); component is the least id.

    A round shuffles the links a few times; a hub's links are joined, never
    gathered. The number of rounds grows with the logarithm of the longest
    chain. Each round's links are a written table.
    """
    now = stage(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    mark = _mark(now)
    while mark[0]:
        after = stage(_small_star(_large_star(now).where(F.col("u") != F.col("v")).distinct()), "links")
        seen, mark = mark, _mark(after)
        now = after
        if seen == mark:
            break
    ends = now.select(F.col("u").alias("doc"), F.col("v").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("doc"), "component")).distinct()
