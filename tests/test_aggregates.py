from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from decimal import Decimal as D

import numpy as np
from conftest import request

from logloom.functions.numbers import mean, pct
from logloom.operators.aggregates import (
    data_quality_report,
    endpoint_stats,
    hourly_traffic,
    ip_anomalies,
    ip_days,
)
from pyspark.sql import functions as F

DAY = dt.date(2024, 3, 1)


def test_rates_round_half_up(spark):
    rows = [(8, 40, "20.00"), (10, 54, "18.52"), (6, 54, "11.11"), (8, 24, "33.33"), (1, 800, "0.13"),
            (-1, 800, "-0.13"), (3, 0, None), (0, 5, "0.00"), (401, 80000, "0.50"), (10**14, 10**14, "100.00")]
    frame = spark.createDataFrame([(a, b) for a, b, _ in rows], "a long, b long")
    found = frame.select(pct(F.col("a"), F.col("b")).alias("p")).collect()
    assert [row.p for row in found] == [None if p is None else D(p) for _, _, p in rows]
    means = spark.createDataFrame([(5, 2), (1, 8), (7, 3), (1, 0)], "a long, b long")
    found = means.select(mean(F.col("a"), F.col("b"), 0).alias("w"), mean(F.col("a"), F.col("b")).alias("m"))
    assert [tuple(row) for row in found.collect()] == [
        (D(3), D("2.50")), (D(0), D("0.13")), (D(2), D("2.33")), (None, None)
    ]


def test_hourly_traffic(staged):
    rows = [
        request(response_size=1),
        request(response_size=2, status_code=404, is_bot=True),
        request(ip_address="2", response_size=None, status_code=399),
        request(ip_address="3", is_valid=False),
        request(requested_at=dt.datetime(2024, 3, 1, 11), response_size=None),
    ]
    found = sorted(tuple(row) for row in hourly_traffic(staged(rows)).collect())
    assert found == [
        (DAY, 10, 3, 2, 1, D("33.33"), D("1.50"), 1),
        (DAY, 11, 1, 1, 0, D("0.00"), None, 0),
    ]


def test_endpoint_ranks_have_gaps(staged, scratch):
    hits = [70, 68, 62, 58, 56, 56, 54, 50, 50, 50, 50]
    rows = [request(path=f"/e{i}") for i, n in enumerate(hits) for _ in range(n)]
    rows += [request(path=None), request(path="/other", is_valid=False)]
    rows += [request(path="/late", requested_at=dt.datetime(2024, 3, 2), status_code=s) for s in (200, 404, 500)]
    found = {(r.report_date, r.endpoint): r for r in endpoint_stats(staged(rows), scratch).collect()}
    ranks = [found[DAY, f"/e{i}"].hit_rank for i in range(len(hits))]
    assert ranks == [1, 2, 3, 4, 5, 5, 7, 8, 8, 8, 8]
    assert len(found) == len(hits) + 1
    late = found[dt.date(2024, 3, 2), "/late"]
    assert tuple(late)[2:] == (3, 1, 2, 1, D("100.00"), 1)


def test_ip_anomalies_against_brute_force(staged, scratch):
    random.seed(3)
    rows = []
    for day in (1, 2, 3):
        for ip in range(60):
            busy = {7: 20 + day, 8: 9, 9: 9, 10: 9}
            for _ in range(busy.get(ip) or random.choice([1, 2, 2, 3, 4, 5])):
                rows.append(
                    request(
                        ip_address=f"10.{ip}",
                        path=random.choice(["/a", "/b", "/c?x", None]),
                        status_code=random.choice([200, 200, 301, 404, 500]),
                        requested_at=dt.datetime(2024, 3, day, random.randrange(24)),
                    )
                )
    total, errors, seen = Counter(), Counter(), {}
    for row in rows:
        key = (row["request_date"], row["ip_address"])
        total[key] += 1
        errors[key] += row["status_code"] >= 400
        seen.setdefault(key, set()).update({row["endpoint"]} - {None})
    watch, alarm = np.percentile(list(total.values()), [95, 99])
    expected = {}
    for key, n in total.items():
        rate = D(errors[key] * 100) / D(n)
        if n > watch or rate > 50:
            reason = "Volume > p99 threshold" if n > alarm else "Error rate > 50%" if rate > 50 else None
            expected[key] = (n, errors[key], round(rate, 2), len(seen[key]), reason is not None, reason)
    found = ip_anomalies(scratch.keep(ip_days(staged(rows)))).collect()
    assert {(r[0], r[1]): tuple(r)[2:] for r in found} == expected
    assert {row.anomaly_reason for row in found} == {"Volume > p99 threshold", "Error rate > 50%", None}


def test_no_requests_no_anomalies(staged, scratch):
    assert ip_anomalies(scratch.keep(ip_days(staged([])))).collect() == []


def test_quality_of_a_log_loaded_twice(staged):
    once = [request(requested_at=dt.datetime(2024, 3, 1, 10, i // 60, i % 60)) for i in range(530)]
    (row,) = data_quality_report(staged(once + once)).collect()
    assert tuple(row) == (DAY, 1060, 1060, 0, D("0.00"), 0, 0, 0, 530, D("75.00"))


def test_quality_counts(staged):
    bad = dict(is_valid=False)
    rows = [
        request(path="/1"),
        request(path=None),
        request(path=None),  # the same as the one before: NULL counts as a value
        request(ip_address=None, invalid_reason="Missing IP", **bad),
        request(ip_address="", invalid_reason="Missing IP", **bad),
        request(path="/2", invalid_reason="Invalid method: X", **bad),
        request(path="/3", invalid_reason="Invalid status: 0", **bad),
        request(path="/4", requested_at=None, invalid_reason="Missing timestamp", **bad),
    ]
    (row,) = data_quality_report(staged(rows)).collect()
    # 100 - 4/7 * 100 - 1/7 * 50
    assert tuple(row) == (DAY, 7, 3, 4, D("57.14"), 1, 1, 1, 1, D("35.71"))


def test_quality_is_not_negative(staged):
    rows = [request(is_valid=False, invalid_reason="Invalid status: 0")] * 3
    (row,) = data_quality_report(staged(rows)).collect()
    assert row.quality_score == 0 and row.duplicate_count == 2
