from __future__ import annotations

import datetime as dt
import random
import statistics
from decimal import ROUND_HALF_UP, Decimal as D

import numpy as np
import pytest
from conftest import request

from logloom.plans import latency

TODAY = dt.date(2024, 3, 10)


def at(day, hour=10):
    return dt.datetime(2024, 3, day, hour)


def test_traffic_rolling_3h(staged):
    counts = {(1, 22): 1, (1, 23): 3, (2, 0): 4, (2, 5): 1}
    rows = [request(requested_at=at(*when)) for when, n in counts.items() for _ in range(n)]
    found = latency.traffic_rolling_3h(staged(rows)).collect()
    assert [tuple(row)[1:] for row in found] == [
        (22, 1, D("1.00"), None),
        (23, 3, D("2.00"), 2),
        (0, 4, D("2.67"), 1),
        (5, 1, D("2.67"), -3),
    ]


def test_latency_percentiles(staged, scratch):
    random.seed(11)
    times = {("/a", "GET"): [random.randrange(500) for _ in range(301)], ("/b", "POST"): [7, 7, 9, 400]}
    rows = [
        request(path=path, method=method, response_ms=ms, requested_at=at(10))
        for (path, method), group in times.items()
        for ms in group
    ]
    rows += [request(path="/b", method="POST", response_ms=None, requested_at=at(10))]
    rows += [request(path="/none", response_ms=None, requested_at=at(10))]
    rows += [request(path="/old", requested_at=at(9)), request(path="/bad", requested_at=at(10), is_valid=False)]
    found = latency.latency_percentiles(staged(rows), scratch, TODAY).collect()
    assert found[0].endpoint_group == "/none" and tuple(found[0])[2:] == (1, None, None, None, None, None)
    assert len(found) == 3
    for row in found[1:]:
        group = times[row.endpoint_group, row.method]
        assert row.total_requests == len(group) + (row.endpoint_group == "/b")
        assert row.avg_ms == (D(sum(group)) / len(group)).quantize(D("0.01"), ROUND_HALF_UP)
        expected = np.percentile(group, [50, 95, 99])
        assert [row.p50_ms, row.p95_ms, row.p99_ms] == pytest.approx(expected)
        assert row.max_ms == max(group)


def test_ip_threat_level(staged):
    def client(ip, requests, errors):
        return [request(ip_address=ip, path=f"/{i % 3}", status_code=500 if i < errors else 200) for i in range(requests)]

    rows = client("high", 1001, 510) + client("many", 1001, 500) + client("half", 501, 0)
    rows += client("third", 10, 4) + client("some", 201, 0) + client("fifth", 10, 2) + client("few", 4, 1)
    found = latency.ip_threat_level(staged(rows)).collect()
    assert [(r.ip_address, r.threat_level) for r in found] == [
        ("high", "HIGH"), ("many", "MEDIUM"), ("half", "MEDIUM"), ("some", "LOW"), ("third", "MEDIUM"), ("few", "LOW"),
    ]
    assert tuple(found[0])[3:7] == (1001, 510, D("50.95"), 3)


def test_error_surge(staged):
    def hour(day, hour, errors, requests=20):
        return [
            request(requested_at=at(day, hour), status_code=500 if i < errors else 404) for i in range(requests)
        ]

    earlier = {5: [0, 1, 2, 1], 6: [0, 1, 2, 1], 7: [0, 1, 2, 1], 8: [1]}
    rows = [r for h, days in earlier.items() for day, n in enumerate(days, 1) for r in hour(day, h, n)]
    rows += hour(10, 5, 4) + hour(10, 6, 3) + hour(10, 7, 2) + hour(10, 8, 20) + hour(10, 9, 20) + hour(11, 5, 20)
    found = latency.error_surge(staged(rows), TODAY).collect()
    spread = D(str(round(statistics.stdev([0, 5, 10, 5]), 2)))
    assert [tuple(row)[1:] for row in found] == [
        (5, D("20.00"), D("5.00"), spread, D("15.00"), "ANOMALY"),
        (6, D("15.00"), D("5.00"), spread, D("10.00"), "WARNING"),
        (7, D("10.00"), D("5.00"), spread, D("5.00"), "NORMAL"),
        (8, D("100.00"), D("5.00"), None, D("95.00"), "NORMAL"),
    ]


def test_slowest_endpoints(staged, scratch):
    def group(path, ms, hits=51, day=5, **more):
        return [request(path=path, response_ms=ms, requested_at=at(day), **more) for _ in range(hits)]

    rows = group("/a", 10) + group("/b", 30) + group("/c", 20) + group("/d", 20, day=3) + group("/e", 5, day=12)
    rows += group("/untimed", None) + group("/few", 99, hits=50) + group("/old", 99, day=2)
    found = latency.slowest_endpoints(staged(rows), scratch, TODAY).collect()
    assert [(r.endpoint_group, r.p95_ms, r.rank_by_p95, r.rank_by_avg, r.quartile) for r in found] == [
        ("/untimed", None, 1, 1, 1),
        ("/b", 30.0, 2, 2, 1),
        ("/c", 20.0, 3, 3, 2),
        ("/d", 20.0, 3, 3, 2),
        ("/a", 10.0, 5, 5, 3),
        ("/e", 5.0, 6, 6, 4),
    ]


def test_funnel_groups(staged):
    paths = ["/page/1", "/page", "/api/x", "/checkout", "/purchase", "/other"]
    rows = [request(path=path) for path in paths] + [request(path="/api", status_code=400)]
    rows += [request(path="/purchase", requested_at=at(2))]
    found = latency.funnel_groups(staged(rows)).collect()
    assert [tuple(row)[1:] for row in found] == [
        (0, 0, 0, 1, None, None, None),
        (2, 1, 1, 1, D("50.00"), D("100.00"), D("100.00")),
    ]


def test_the_day_is_today_by_default(staged, scratch):
    noon = dt.datetime.combine(dt.datetime.now(dt.timezone.utc).date(), dt.time(12))
    rows = [request(path="/now", requested_at=noon - dt.timedelta(days=n)) for n in (0, 1, 2)] * 60
    assert latency.latency_percentiles(staged(rows), scratch).first().total_requests == 60
    assert latency.slowest_endpoints(staged(rows), scratch).first().hits == 180
    (row,) = latency.error_surge(staged(rows)).collect()
    assert row.log_date == noon.date() and row.baseline_rate == 0


def test_response_time_percentiles_and_sketches(staged, scratch):
    random.seed(12)
    times = {("/a", "GET"): [random.expovariate(0.02) for _ in range(900)], ("/b", "POST"): [0.125, 7.5], ("/c", "GET"): [None]}
    rows = [(request(path=path, method=method, requested_at=at(8 + i % 3)), ms) for (path, method), group in times.items() for i, ms in enumerate(group)]
    frame = staged([row for row, _ in rows] + [request(path="/a", is_valid=False)])
    took = frame.sparkSession.createDataFrame([(row["id"], ms) for row, ms in rows], "id long, took double")
    frame = scratch.keep(frame.join(took, "id", "left"), "timed")
    for day, of_day in ((None, slice(None)), (TODAY, slice(2, None, 3))):
        found = {(r.endpoint_group, r.method): r for r in latency.response_time_percentiles(frame, scratch, "took", day).collect()}
        for key, group in times.items():
            group = group[of_day]
            known = [ms for ms in group if ms is not None]
            assert (key in found) == bool(group)
            if known:
                expected = [*np.percentile(known, [50, 95, 99]), max(known)]
                assert list(found[key])[3:] == pytest.approx(expected, rel=1e-12) and found[key].total_requests == len(group)
            elif group:
                assert tuple(found[key])[2:] == (1, None, None, None, None)
    sketch = {r.endpoint_group: r for r in latency.sketched_response_times(latency.response_time_sketches(frame, "took")).collect()}
    known = np.array(times["/a", "GET"])
    for name, fraction in latency.FRACTIONS.items():
        assert abs((known < sketch["/a"][name]).mean() - fraction) < 0.02
