"""Consecutive row numbers within groups (E16), without gathering a group.

A ``row_number()`` window would put each group -- one request's sheet --
into one task.  Here the rows are range-partitioned and sorted on
(group, order) instead, so a large group spreads over several partitions.
Each row's position inside its partition comes from
``monotonically_increasing_id`` (partition index in the high bits, row index
in the low 33 bits, assigned after the sort); a small aggregate per (group,
partition) gives each group's offset in earlier partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adinsight.operators.snapshot import Scratch, snapshot

_LOW_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                name: str = "row_id", scratch: Scratch | None = None) -> DataFrame:
    """Add ``name`` = 1..n within each ``group_cols`` group following ``order``.

    ``order`` must be total within a group (ties would make numbers
    arbitrary).  The positioned rows are written once, so both uses below see
    the same positions.  The output has no particular order.
    """
    keys = [F.col(c) for c in group_cols] + list(order)
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    pos = ordered.withColumn("_mid", F.monotonically_increasing_id())
    pos = snapshot(pos.withColumn("_pid", F.shiftright("_mid", 33))
                   .withColumn("_idx", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))), scratch)
    spans = pos.groupBy(*group_cols, "_pid").agg(
        F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group_cols).orderBy("_pid") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    out = pos.join(spans, [*group_cols, "_pid"], "inner")
    return out.withColumn(name, (F.col("_before") + F.col("_idx") - F.col("_first") + 1)) \
              .drop("_mid", "_pid", "_idx", "_first", "_n", "_before")
