from __future__ import annotations

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.operators.quantiles import (
    double_of,
    merged_sketches,
    ordered_bits,
    percentiles,
    percentiles_of_doubles,
    sketched_percentiles,
    sketches,
)

FRACTIONS = {"low": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "top": 1.0}


def _found(spark, groups):
    rows = [(*key, value, 1) for key, values in groups.items() for value in values]
    frame = spark.createDataFrame(rows, "a string, b string, ms int, n long")
    counts = frame.groupBy("a", "b", "ms").count()
    return {(r.a, r.b): r for r in percentiles(counts, ["a", "b"], "ms", "count", FRACTIONS).collect()}


def test_percentiles_across_buckets(spark):
    random.seed(2)
    groups = {
        ("one", "x"): [5],
        ("two", "x"): [1, 100_000],
        ("same", "x"): [7] * 50,
        ("small", "x"): [random.randrange(300) for _ in range(500)],
        ("wide", "x"): [random.randrange(2**31 - 1) for _ in range(501)],
        ("edges", "x"): [65535, 65536, 131071, 131072, 0, 2**31 - 1],
        ("signed", "x"): [-70_000, -1, 0, 1, 70_000],
        (None, "x"): [3, 4],
        (None, None): [9, 10, 11],
    }
    found = _found(spark, groups)
    assert set(found) == set(groups)
    for key, values in groups.items():
        expected = np.percentile(values, [100 * f for f in FRACTIONS.values()])
        assert [found[key][name] for name in FRACTIONS] == pytest.approx(list(expected)), key


def test_null_values_do_not_count(spark):
    found = _found(spark, {("a", "x"): [1, None, 3, None], ("b", "x"): [None]})
    assert list(found) == [("a", "x")]
    assert found["a", "x"].p50 == 2.0


def test_bits_are_in_the_order_of_doubles_and_give_them_back(spark):
    random.seed(5)
    special = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, np.nextafter(1, 0), np.nextafter(1, 2), 1.7976931348623157e308, float("inf")]
    special += [np.nextafter(2.0**k, 0) for k in range(-1074, 1024, 37)] + [2.0**k for k in range(-1074, 1024, 41)]
    drawn = [struct.unpack("d", random.randbytes(8))[0] for _ in range(3000)]
    values = sorted({float(sign * v) for v in special + [v for v in drawn if v == v] for sign in (1, -1)} | {0.0})
    frame = spark.createDataFrame([(i, v) for i, v in enumerate([*values, float("nan"), None, -0.0])], "i int, v double")
    rows = frame.select("i", ordered_bits(F.col("v")).alias("bits")).select("*", double_of(F.col("bits")).alias("back")).orderBy("i").collect()
    assert [r.back for r in rows[: len(values)]] == values
    bits = [r.bits for r in rows[: len(values) + 1]]
    assert all(a < b for a, b in zip(bits, bits[1:])) and rows[len(values)].back != rows[len(values)].back
    assert rows[-2].bits is None and rows[-1].bits == 0


def test_percentiles_of_doubles(spark, scratch):
    rng = np.random.default_rng(3)
    groups = {
        ("one", "x"): [0.25],
        ("same", "x"): [0.1] * 50,
        ("near", "x"): [1 + i * 2.0**-52 for i in range(100)],
        ("signed", "x"): [-1.5, -0.0, 0.0, 2.5, -1e300, 1e-300],
        ("hot", "x"): list(rng.lognormal(3, 2, 20_000)),
        (None, "x"): [3.5, 4.25],
        (None, None): [-9.5, 10.0, 11.75, None],
        ("none", "x"): [None],
    }
    rows = [(*key, None if v is None else float(v)) for key, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "a string, b string, ms double")
    found = {(r.a, r.b): r for r in percentiles_of_doubles(frame, ["a", "b"], "ms", FRACTIONS, scratch).collect()}
    assert set(found) == set(groups) - {("none", "x")}
    for key, row in found.items():
        values = [v for v in groups[key] if v is not None]
        expected = np.percentile(values, [100 * f for f in FRACTIONS.values()])
        assert [row[name] for name in FRACTIONS] == pytest.approx(list(expected), rel=1e-12), key
    assert percentiles_of_doubles(frame.limit(0), ["a", "b"], "ms", FRACTIONS, scratch).count() == 0


def test_not_a_number_and_infinity_come_last(spark, scratch):
    frame = spark.createDataFrame([("a", v) for v in (1.0, float("nan"), float("inf"), 2.0, float("-inf"))], "a string, v double")
    (row,) = percentiles_of_doubles(frame, ["a"], "v", {"p0": 0.0, "p50": 0.5, "p75": 0.75, "p100": 1.0}, scratch).collect()
    assert (row.p0, row.p50, row.p75) == (float("-inf"), 2.0, float("inf")) and row.p100 != row.p100


def test_sketches_of_days_merge_within_their_bound(spark):
    rng = np.random.default_rng(4)
    values = rng.lognormal(3, 1, 60_000)
    frame = spark.createDataFrame([(i % 5, "a", float(v)) for i, v in enumerate(values)] + [(9, "b", None), (9, "c", 7.5)], "day int, a string, v double")
    days = sketches(frame, ["day", "a"], "v")
    merged = merged_sketches(days, ["a"])
    found = {r.a: r for r in sketched_percentiles(merged, ["a"], FRACTIONS).collect()}
    assert set(found) == {"a", "c"} and found["c"].p50 == 7.5
    for name, fraction in FRACTIONS.items():
        assert abs((values < found["a"][name]).mean() - fraction) < 0.012, name
