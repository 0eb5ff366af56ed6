"""Ranks and running totals without gathering all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..scratch import Scratch

def count_standings(groups: DataFrame, count: str, within: Sequence[str] = (), *more: str) -> DataFrame:
    """Per distinct count: its rank from the top, the running total down to it, and the grand total.

    All three depend on the counts alone, so equal counts are merged before any
    window runs. Counts that add up to n rows have fewer than sqrt(2n) distinct
    values: about a million for 10^12 rows, however many groups there are.
    Ties share the rank and, as in a RANGE frame, the running total. With
    `"tied"` as a further argument, the groups of each count are given as well.
    """
    merged = groups.groupBy(*within, count).agg(F.count("*").alias("tied"))
    down = Window.partitionBy(*within).orderBy(F.desc(count))
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    to_here = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = F.col(count) * F.col("tied")
    return merged.select(
        *within,
        count,
        *more,
        (F.coalesce(F.sum("tied").over(above), F.lit(0)) + 1).alias("rank"),
        F.sum(hits).over(to_here).alias("running_total"),
        F.sum(hits).over(Window.partitionBy(*within)).alias("grand_total"),
    )


def _numbered(rows: DataFrame, order: list[Column], scratch: Scratch) -> DataFrame:
    """Adds `position`, 1 for the first row of a total order, and `rows`, their number.

    The rows are written in range-partitioned slices; a slice's first position
    follows from the sizes of the slices before it, one row per slice.
    """
    slices = scratch.keep(
        rows.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "slices"
    )
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slices.groupBy("slice").agg(F.count("*").alias("size"))
    starts = sizes.select(
        "slice",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum("size").over(Window.partitionBy()).alias("rows"),
    )
    inside = F.row_number().over(Window.partitionBy("slice").orderBy(*order))
    # One row per shuffle partition: small enough to broadcast at any data size.
    return (
        slices.join(F.broadcast(starts), "slice")
        .withColumn("position", F.col("start") + inside)
        .drop("slice", "start")
    )


def rank_and_tile(
    rows: DataFrame,
    ranks: dict[str, str],
    tile_by: str,
    tiles: int,
    tile_name: str,
    unique: Sequence[str],
    scratch: Scratch,
) -> DataFrame:
    """Global ranks by several columns and equal tiles by one, all from the top, NULL first.

    `rows` is a kept table, `ranks` maps new columns to the columns ranked by,
    `unique` names columns that together tell rows apart and order ties.
    Rows are numbered slice by slice, so no task sorts all of them.
    """
    ties = [F.asc_nulls_last(c) for c in unique]
    result, numbered = rows, None
    # last the order that the tiles share, if a rank has it: it is numbered once
    for name in sorted(ranks, key=lambda name: ranks[name] == tile_by):
        value = ranks[name]
        numbered = _numbered(result.drop("position", "rows"), [F.desc_nulls_first(value), *ties], scratch)
        firsts = numbered.groupBy(F.col(value).alias("ranked_value")).agg(F.min("position").alias(name))
        result = numbered.join(firsts, F.col(value).eqNullSafe(F.col("ranked_value"))).drop("ranked_value")
    if tile_by not in ranks.values():
        result = _numbered(result.drop("position", "rows"), [F.desc_nulls_first(tile_by), *ties], scratch)
    tile = _tile(F.col("position"), F.col("rows"), tiles).alias(tile_name)
    return result.select(*rows.columns, *ranks, tile)


def _tile(position: Column, rows: Column, tiles: int) -> Column:
    """The tile of a 1-based position; the first `rows % tiles` tiles hold one row more."""
    small = F.floor(rows / tiles)
    larger = rows % tiles
    in_larger = larger * (small + 1)
    return (
        F.when(position <= in_larger, F.floor((position - 1) / (small + 1)) + 1)
        .otherwise(larger + F.floor((position - 1 - in_larger) / F.greatest(small, F.lit(1))) + 1)
        .cast("int")
    )
