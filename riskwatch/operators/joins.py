"""Join shapes: star merge, skewed lookup, one-row constants."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskwatch.operators.staging import stage

# Cells that one key is cut into: enough tasks for it, and few repeats of its rows.
MOST_CELLS = 1_024
# Rows of the right side in a cell, which the task that joins it holds in memory.
HELD_ROWS = 100_000
# Rows in a pack, and rows of the right side in a cell of packs. Spark holds all that a
# row of the left side makes until it has made it, which is one times the other here.
PACK_ROWS = 256
MET_ROWS = 1_000


def star_merge(base: DataFrame, features: Iterable[DataFrame], on: str) -> DataFrame:
    """Left-joins features of one key onto the base.

    Features come out of an aggregate or window on the same key, so the joins
    reuse that partitioning. No side is forced to broadcast: Spark does so only
    for sides it measured to be small.
    """
    for feature in features:
        base = base.join(feature, on, "left")
    return base


def spread_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    spread_by: str,
    spread: int = 16,
) -> DataFrame:
    """Left join of many rows to a short lookup when one lookup key is hot.

    Rows of a key are divided over ``spread`` partitions by a second column and
    the lookup (one row per key) is repeated that often, so a key holding a
    third of the rows is no single task. Meant for aggregates, which are short;
    if Spark knows the lookup to be small it is broadcast instead.
    """
    slot = F.pmod(F.hash(spread_by), F.lit(spread)).alias("_slot")
    left = rows.select("*", slot)
    right = lookup.select("*", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_slot"))
    return left.join(right, [on, "_slot"], "left").drop("_slot")


def _slices(count: Column, cell: int) -> Column:
    return F.ceil(count / F.lit(cell))


def hot_cells(
    left: DataFrame, right: DataFrame, on: str, cell: int, most: int = MOST_CELLS, held: int = HELD_ROWS
) -> DataFrame:
    """Keys with more than ``cell`` rows on a side, and into how many slices each
    side is cut. One row in ``cell`` at most, and counted partly in each task.

    A key that would have more than ``most`` cells gets about that many larger
    ones. Each row is repeated for the other side's slices, so their shape is the
    one with the fewest repeats: cells of as many rows of either side, as far as
    no slice is smaller than ``cell``. A slice of the right side has about
    ``held`` rows even then.
    """
    ours = left.groupBy(on).agg(F.count(F.lit(1)).alias("_ours"))
    theirs = right.groupBy(on).agg(F.count(F.lit(1)).alias("_theirs"))
    both = ours.join(theirs, on).where((F.col("_ours") > cell) | (F.col("_theirs") > cell))
    rows, columns = _slices(F.col("_ours"), cell), _slices(F.col("_theirs"), cell)
    even = F.ceil(F.sqrt(F.lit(most) * F.col("_ours") / F.col("_theirs")))
    fewer = F.least(rows, F.lit(most), F.greatest(even, F.ceil(F.lit(most) / columns)))
    across = F.greatest(F.least(columns, F.ceil(F.lit(most) / fewer)), _slices(F.col("_theirs"), held))
    many = rows.cast("double") * columns > most
    return both.select(
        on,
        F.when(many, fewer).otherwise(rows).cast("int").alias("_rows"),
        F.when(many, across).otherwise(columns).cast("int").alias("_columns"),
    )


def packed(rows: DataFrame, on: str, by: str, size: int = PACK_ROWS, spread: int = 16) -> DataFrame:
    """Rows of a key in arrays ``_packed`` of ``size`` rows at most, numbered by ``_pack``.

    For the left side of a join that makes all pairs: a pack meets each row of the
    other side, and ``inline("_packed")`` after the join makes the pairs. They are
    as many, but in runs: the other side's columns stay as they are for a pack, and
    the pack's come again for the next row. Column files store both in little space;
    pairs in another order take bytes each.

    ``by`` divides the rows of a key over ``spread`` tasks. They are numbered there,
    so that rows with the same ``by`` fill no pack over ``size``.
    """
    others = [c for c in rows.columns if c != on]
    order = Window.partitionBy(on, "_slot").orderBy(by, *[c for c in others if c != by])
    nth = F.floor((F.row_number().over(order) - 1) / F.lit(size)).alias("_nth")
    slotted = rows.select("*", F.pmod(F.hash(by), F.lit(spread)).alias("_slot"))
    packs = slotted.select("*", nth).groupBy(on, "_slot", "_nth").agg(F.collect_list(F.struct(*others)).alias("_packed"))
    return packs.select(on, (F.col("_nth") * spread + F.col("_slot")).alias("_pack"), "_packed")


def told_apart(rows: DataFrame, name: str) -> DataFrame:
    """Rows with a hash that differs between equal rows as well, to divide them by."""
    nth = F.row_number().over(Window.partitionBy(*rows.columns).orderBy(rows.columns[0]))
    return rows.select("*", nth.alias("_nth")).select("*", F.xxhash64(*rows.columns, "_nth").alias(name)).drop("_nth")


def many_to_many(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_by: str,
    right_by: str,
    how: str = "left",
    cell: int = 2_000,
    counted: DataFrame | None = None,
    most: int = MOST_CELLS,
    held: int = HELD_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """Left or inner join on a key that may be hot on both sides.

    All pairs of a key are wanted, so a key hot on both sides is a rectangle that
    one task cannot make. It is cut into cells: the left side into slices by
    ``left_by``, the right side by ``right_by``, each slice repeated for the other
    side's slices. A cell has about ``cell`` rows of each side and goes where its
    three keys hash to. Keys that are not hot are one cell and are not repeated;
    rows without a key are spread, as they match nothing.

    ``counted`` has the left side's keys as often as ``left`` does, where that is
    cheaper to count. ``most`` and ``held`` are those of ``hot_cells``. ``tasks``
    is how many tasks make the pairs; else Spark merges them by the bytes that are
    shuffled, which say little of the pairs.
    """
    hot = stage(hot_cells(left if counted is None else counted, right, on, cell, most, held))
    ours = spread_lookup(left, hot, on, left_by)
    theirs = spread_lookup(right.where(F.col(on).isNotNull()), hot, on, right_by)

    def slice_of(by: str, slices: str, without_key: int = 1) -> Column:
        n = F.when(F.col(on).isNull(), F.lit(without_key)).otherwise(F.coalesce(F.col(slices), F.lit(1)))
        return F.pmod(F.xxhash64(by), n).cast("int")

    def repeated(slices: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(slices), F.lit(1)) - 1))

    ours = ours.select("*", slice_of(left_by, "_rows", 64).alias("_row"), repeated("_columns").alias("_column"))
    ours = ours.withColumn("_hot", F.col("_rows").isNotNull()).drop("_rows", "_columns")
    theirs = theirs.select("*", slice_of(right_by, "_columns").alias("_column"), repeated("_rows").alias("_row"))
    theirs = theirs.withColumn("_there", F.lit(True)).drop("_rows", "_columns")
    if tasks is not None:
        ours, theirs = (side.repartition(tasks, on, "_row", "_column") for side in (ours, theirs))
    joined = ours.join(theirs, [on, "_row", "_column"], how)
    if how == "inner":
        return joined.drop("_row", "_column", "_hot", "_there")
    # A hot key has rows on both sides: a copy that met an empty slice is no row.
    found = F.coalesce(F.col("_there"), F.lit(False)) | ~F.col("_hot")
    return joined.where(found).drop("_row", "_column", "_hot", "_there")


def attach_one_row(rows: DataFrame, single: DataFrame, on: str) -> DataFrame:
    """Left join to a global aggregate through a constant key.

    ``single`` has exactly one row, which bounds the broadcast.
    """
    return rows.join(F.broadcast(single), on, "left")


def rows_of(facts: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Facts of the given keys.

    No side is forced to broadcast: from a staged table of keys Spark knows
    whether it is small enough to filter the scan with.
    """
    return facts.join(keys, on, "left_semi")
