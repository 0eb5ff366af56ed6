"""Gapless numbers in a given order without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..scratch import Scratch

# `monotonically_increasing_id` holds the partition above this bit and the row within it below.
ROW_BITS = 33


def starts(sizes: DataFrame, *order: Column | str) -> DataFrame:
    """`sizes`, one short row per slice, with `start`: the sum of `size` of the slices before it."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")))


def dense_numbers(rows: DataFrame, order: list[Column | str], name: str, scratch: Scratch) -> DataFrame:
    """Adds `name`: 0, 1, 2, .. in the given order; a written table, its ties in the order they were written.

    The rows are written in sorted slices, each by one task; a slice's first
    number follows from the sizes of the slices before it. Rows equal in
    `order` may share one task, so it should tell most of them apart.
    """
    slot = F.monotonically_increasing_id().alias("slot")
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", slot)
    placed = scratch.keep(placed, "numbered", compression="zstd")
    slice_of = F.shiftright("slot", ROW_BITS)
    sizes = starts(placed.groupBy(slice_of.alias("slice")).agg(F.count("*").alias("size")), "slice")
    # one row per task: small at any size of the data
    told = placed.withColumn("slice", slice_of).join(F.broadcast(sizes), "slice")
    number = F.col("start") + F.col("slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return told.select(*[F.col(f"`{c}`") for c in rows.columns], number.alias(name))
