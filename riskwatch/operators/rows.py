"""Picking rows inside a key: the newest one, the one before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_NUMBER = "rowno"


def _newest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def _oldest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def latest(
    df: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str],
    keep_number: bool = False,
) -> DataFrame:
    """The newest row per key; list tie-breaks after the ordering column.

    Spark limits each key to one row per map task before the shuffle
    (``WindowGroupLimit``), so a hot key sends one row per task, not its history.
    """
    order = Window.partitionBy(*keys).orderBy(*_newest_first(newest_by))
    first = df.withColumn(ROW_NUMBER, F.row_number().over(order)).where(F.col(ROW_NUMBER) == 1)
    return first if keep_number else first.drop(ROW_NUMBER)


def with_previous(
    df: DataFrame,
    key: str,
    oldest_by: Sequence[str],
    previous: dict[str, str],
    bucket: Column,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Adds the preceding row's values per key, falling back to the row's own.

    ``previous`` maps new column -> source column. A single window over the key
    would put a hot key's whole history into one task. Here rows are windowed
    per (key, time bucket). Only a bucket's first row looks further back, to the
    closing row of the key's last bucket before it: the first and last rows of
    all buckets, two at most each, are windowed once more by the key alone. All
    other rows are complete. Both parts read one shuffle of the rows, and as
    windows group NULL keys like any other, nothing is joined. Exact as long as
    ``bucket`` grows with the first ordering column. Rows equal in ``oldest_by``
    are ordered by their other columns.

    ``earlier`` holds at most one row per key from before all of ``df``, with the
    same columns. It serves as a predecessor only and is not part of the result.
    """
    sources = list(dict.fromkeys(previous.values()))
    values = F.struct(*[F.col(c) for c in sources])
    # Both parts number the rows for themselves: all columns decide, so that they
    # agree on which of two rows of one time comes first.
    unsorted = (T.MapType, T.VariantType)
    others = [f.name for f in df.schema.fields if f.name not in oldest_by and not isinstance(f.dataType, unsorted)]
    order = _oldest_first([*oldest_by, *others])

    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    stepped = df.withColumn("_bucket", bucket).select(
        *df.columns,
        F.lag(values).over(inside).alias("_before"),
        F.lead(F.lit(True), 1, False).over(inside).alias("_followed"),
        F.row_number().over(inside).alias("_place"),
    )
    first = F.col("_place") == 1
    edge = first | ~F.col("_followed")

    edges = stepped.where(edge).withColumns({"_values": values, "_late": F.lit(True)})
    if earlier is not None:
        closing = earlier.select(*df.columns, values.alias("_values"), F.lit(False).alias("_late"))
        edges = edges.unionByName(closing, allowMissingColumns=True)
    across = Window.partitionBy(key).orderBy("_late", *order)
    carried = edges.withColumn("_carried", F.lag("_values").over(across)).where(F.col("_late"))
    carried = carried.withColumn("_before", F.when(first, F.col("_carried")).otherwise(F.col("_before")))

    complete = stepped.where(~edge).select(*df.columns, "_before")
    stepped = complete.unionByName(carried.select(*df.columns, "_before"))
    return stepped.withColumns({new: F.coalesce(F.col("_before")[old], F.col(old)) for new, old in previous.items()}).drop(
        "_before"
    )
