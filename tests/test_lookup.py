"""The lookup that splits hot keys."""

from __future__ import annotations

import datetime as dt

from conftest import request
from pyspark.sql import functions as F

from logloom.operators.aggregates import endpoint_stats
from logloom.operators.lookup import skew_lookup


def sizes_of_tasks(rows):
    return [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]


def test_a_hot_key_is_shared_by_tasks_without_adaptive_execution(spark, scratch):
    # 99 % of a day's endpoints have one hit
    hits = F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(1)
    large = scratch.keep(spark.range(100_000).select(F.lit(dt.date(2024, 3, 1)).alias("day"), hits.alias("hits"), "id"))
    small = scratch.keep(large.groupBy("day", "hits").agg(F.count("*").alias("tied")).withColumn("rank", F.col("hits") * 2))
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for key, value in zip(was, ("false", "-1")):
            spark.conf.set(key, value)
        found = skew_lookup(large, small, ["day", "hits"], "tied", ["id"])
        assert max(sizes_of_tasks(found)) < 1.5 * 100_000 / 8
        assert max(sizes_of_tasks(large.join(small, ["day", "hits"], "left"))) > 0.9 * 100_000
        assert found.where("rank = 2 * hits").count() == 100_000
        assert set(found.columns) == {"day", "hits", "id", "tied", "rank"}
    finally:
        for key, value in was.items():
            spark.conf.set(key, value)


def test_missing_keys_and_empty_tables(spark, scratch):
    large = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "key int, name string")
    small = scratch.keep(spark.createDataFrame([(1, 1, "x")], "key int, n long, value string"))
    left = skew_lookup(large, small, ["key"], "n", ["name"])
    assert sorted((r.name, r.value) for r in left.collect()) == [("a", "x"), ("b", None), ("c", None)]
    assert skew_lookup(large, small, ["key"], "n", ["name"], "inner").count() == 1
    assert skew_lookup(large, scratch.keep(small.limit(0)), ["key"], "n", ["name"]).where("value IS NULL").count() == 3
    assert skew_lookup(large.limit(0), small, ["key"], "n", ["name"]).count() == 0


def test_ranks_of_a_day_of_single_hits(staged, scratch):
    rows = [request(path=f"/{i}") for i in range(300)] + [request(path="/0"), request(path="/1")]
    ranks = {r.endpoint: r.hit_rank for r in endpoint_stats(staged(rows), scratch).collect()}
    assert ranks.pop("/0") == ranks.pop("/1") == 1
    assert len(ranks) == 298 and set(ranks.values()) == {3}
