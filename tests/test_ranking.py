from __future__ import annotations

import random

from pyspark.sql import Window, functions as F

from logloom.operators.ranking import count_standings, rank_and_tile


def test_standings_equal_plain_windows(spark):
    random.seed(5)
    rows = [(random.choice("ab"), f"e{i}", int(random.paretovariate(1)) % 40 + 1) for i in range(2000)]
    groups = spark.createDataFrame(rows, "day string, endpoint string, hits long")
    for within in ([], ["day"]):
        all_rows = Window.partitionBy(*within)
        down = all_rows.orderBy(F.desc("hits"))
        expected = groups.select(
            *within,
            "hits",
            F.rank().over(down).cast("long").alias("rank"),
            F.sum("hits").over(down).alias("running_total"),
            F.sum("hits").over(all_rows).alias("grand_total"),
        ).distinct()
        found = count_standings(groups, "hits", within)
        assert sorted(found.collect()) == sorted(expected.collect())


def _plain(rows):
    """The same by windows over all rows in one task."""
    down = {name: Window.orderBy(F.desc_nulls_first(value)) for name, value in (("by_p95", "p95"), ("by_mean", "mean"))}
    ties = Window.orderBy(F.desc_nulls_first("p95"), F.asc_nulls_last("name"), F.asc_nulls_last("method"))
    ranked = rows.withColumns({name: F.rank().over(window).cast("long") for name, window in down.items()})
    return ranked.withColumn("quartile", F.ntile(4).over(ties))


def _ranked(rows, scratch):
    return rank_and_tile(
        rows,
        ranks={"by_p95": "p95", "by_mean": "mean"},
        tile_by="p95",
        tiles=4,
        tile_name="quartile",
        unique=["name", "method"],
        scratch=scratch,
    )


def test_sliced_ranks_equal_plain_windows(spark, scratch):
    random.seed(7)
    for size in (0, 6, 203):
        rows = [
            (
                f"g{i}",
                random.choice(["GET", "POST"]),
                random.choice([None, 1.5, 2.0, 2.0, float(random.randrange(20))]),
                random.choice([3.0, float(random.randrange(9))]),
            )
            for i in range(size)
        ]
        frame = spark.createDataFrame(rows, "name string, method string, p95 double, mean double")
        kept = scratch.keep(frame)
        small, sliced = _plain(kept), _ranked(kept, scratch)
        assert sliced.columns == small.columns
        key = lambda row: row.name
        assert sorted(sliced.collect(), key=key) == sorted(small.collect(), key=key)


def test_a_tie_over_most_rows(spark, scratch):
    rows = spark.range(3000).selectExpr(
        "concat('g', id) AS name", "'GET' AS method", "double(if(id % 3 = 0, id, 7)) AS p95", "double(1) AS mean"
    )
    kept = scratch.keep(rows)
    found = _ranked(kept, scratch)
    assert found.exceptAll(_plain(kept)).count() == 0
    assert found.where("by_mean <> 1").count() == 0
    tiles = {row.quartile: row["count"] for row in found.groupBy("quartile").count().collect()}
    assert tiles == {1: 750, 2: 750, 3: 750, 4: 750}
