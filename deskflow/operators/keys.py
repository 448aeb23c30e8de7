"""Dense surrogate keys without a one-partition window.

``row_number() over (order by k)`` with no partition moves every row into one
task.  Instead: range-partition and sort by the key, tag rows with
``monotonically_increasing_id`` (partition index in the high bits, position
in the low bits), count rows per partition (one small row per partition),
turn the counts into start offsets and add them back with a broadcast join of
that per-partition table, whose size is bounded by the partition count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from deskflow.session import checkpoint


def dense_ids(df: DataFrame, order: Sequence[str], id_col: str, base: int = 1,
              num_partitions: int | None = None, stable: bool = True) -> DataFrame:
    """Add ``id_col`` = base, base+1, ... in ``order``.

    Rows equal in ``order`` are ordered by their input position (a
    deterministic tag of the scan), which is also part of the range key, so
    a value shared by a large share of the rows is spread over many range
    partitions instead of one.  ``stable`` checkpoints the sorted rows first
    so both passes (count and numbering) see the same partitions, and
    lineage is cut.
    """
    keyed = df.withColumn("__tie", F.monotonically_increasing_id())
    sort_cols = [*order, "__tie"]
    ranged = (keyed.repartitionByRange(num_partitions, *sort_cols) if num_partitions
              else keyed.repartitionByRange(*sort_cols))
    ranged = ranged.sortWithinPartitions(*sort_cols).drop("__tie").withColumn("__mid", F.monotonically_increasing_id())
    if stable:
        ranged = checkpoint(ranged)
    part = F.shiftright(F.col("__mid"), 33)
    counts = ranged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # Cumulative offsets over one row per partition (bounded by the partition count).
    offsets = counts.select(
        "__part",
        (F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).alias("__start"))
    numbered = ranged.join(F.broadcast(offsets), part == F.col("__part"))
    local = F.col("__mid") - F.shiftleft(F.col("__part"), 33)
    return (numbered.withColumn(id_col, (F.lit(base) + F.coalesce(F.col("__start"), F.lit(0)) + local).cast("long"))
            .drop("__mid", "__part", "__start"))
