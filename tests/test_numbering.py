"""Gapless numbers in order."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.operators.numbering import dense_numbers


def test_numbers_follow_the_order(spark, scratch):
    rows = spark.range(10_000).select(F.pmod(F.xxhash64("id"), F.lit(5000)).alias("value"), "id").repartition(7)
    found = dense_numbers(rows, [F.desc("value"), "id"], "number", scratch).collect()
    expected = sorted(((r.value, r.id) for r in rows.collect()), key=lambda r: (-r[0], r[1]))
    assert [(r.value, r.id) for r in sorted(found, key=lambda r: r.number)] == expected
    assert sorted(r.number for r in found) == list(range(10_000))


def test_nulls_ties_and_no_rows(spark, scratch):
    rows = spark.createDataFrame([(None,), (3,), (3,), (None,), (1,)], "v int")
    found = sorted((r.n, r.v) for r in dense_numbers(rows, ["v"], "n", scratch).collect())
    assert found == [(0, None), (1, None), (2, 1), (3, 3), (4, 3)]
    assert dense_numbers(rows.limit(0), ["v"], "n", scratch).count() == 0
