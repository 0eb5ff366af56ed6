from __future__ import annotations

import datetime as dt

import pytest

from logloom import schemas
from logloom.operators.ingest import classify_client, extended, id_bitmaps, not_yet_staged, stage_logs, validate_logs

AT = dt.datetime(2024, 3, 1, 10, 59, 59)


@pytest.fixture
def raw(spark):
    def frame(*rows):
        base = dict(
            id=1, ip_address="1.1.1.1", method="GET", path="/a", protocol="HTTP/1.1", status_code=200,
            response_size=1, referer=None, user_agent="x", requested_at=AT, ingested_at=None,
            response_ms=None, load_id=1,
        )
        rows = [{**base, **row} for row in rows]
        return spark.createDataFrame([tuple(row[n] for n in schemas.RAW.names) for row in rows], schemas.RAW)

    return frame


AGENTS = [
    ("Mozilla/5.0 (X11; Linux) Chrome/120", "browser"),
    ("SomeWebKit view", "browser"),
    ("Mozilla/5.0 (compatible; Googlebot/2.1)", "bot"),
    ("python-requests/2.31", "bot"),
    ("Go-http-client/1.1", "bot"),
    ("Java/17", "bot"),
    ("CURL/8", "bot"),
    ("Cubot phone", "bot"),
    ("Python-urllib/3.11", "api_client"),
    ("okhttp-java", "api_client"),
    ("Mozilla python", "browser"),
    ("Opera/9", "unknown"),
    ("-", "unknown"),
    ("", "unknown"),
    (None, "unknown"),
]


def test_classify_client(raw):
    rows = classify_client(raw(*[{"id": i, "user_agent": a} for i, (a, _) in enumerate(AGENTS)]))
    found = {row.id: (row.client_type, row.is_bot) for row in rows.collect()}
    assert found == {i: (kind, kind == "bot") for i, (_, kind) in enumerate(AGENTS)}


CHECKS = [
    ({}, None),
    ({"ip_address": None}, "Missing IP"),
    ({"ip_address": ""}, "Missing IP"),
    ({"ip_address": "", "method": "FOO"}, "Missing IP"),
    ({"method": "get"}, "Invalid method: get"),
    ({"method": None}, "Invalid method: None"),
    ({"method": "FOO", "status_code": 700}, "Invalid method: FOO"),
    ({"method": "OPTIONS"}, None),
    ({"status_code": 700}, "Invalid status: 700"),
    ({"status_code": 0}, "Invalid status: 0"),
    ({"status_code": None}, "Invalid status: None"),
    ({"status_code": 99, "requested_at": None}, "Invalid status: 99"),
    ({"status_code": 100}, None),
    ({"status_code": 599}, None),
    ({"status_code": 600}, "Invalid status: 600"),
    ({"requested_at": None}, "Missing timestamp"),
]


def test_validate_logs(raw):
    rows = validate_logs(raw(*[{"id": i, **change} for i, (change, _) in enumerate(CHECKS)]))
    found = {row.id: (row.invalid_reason, row.is_valid) for row in rows.collect()}
    assert found == {i: (reason, reason is None) for i, (_, reason) in enumerate(CHECKS)}


def test_derived_columns(raw):
    changes = [
        ({"path": "/a?x=1?y"}, "endpoint", "/a"),
        ({"path": "?x"}, "endpoint", ""),
        ({"path": ""}, "endpoint", None),
        ({"path": None}, "endpoint", None),
        ({"status_code": 404}, "status_class", "4xx"),
        ({"status_code": 700}, "status_class", "7xx"),
        ({"status_code": 0}, "status_class", None),
        ({"status_code": None}, "status_class", None),
        ({}, "request_date", AT.date()),
        ({}, "request_hour", 10),
        ({"requested_at": None}, "request_date", None),
        ({"requested_at": None}, "request_hour", None),
    ]
    rows = stage_logs(raw(*[{"id": i, **change} for i, (change, _, _) in enumerate(changes)]))
    assert sorted(rows.columns) == sorted(schemas.STAGED.names)
    for row in rows.collect():
        _, field, value = changes[row.id]
        assert row[field] == value, changes[row.id]


def test_endpoint_group(raw):
    paths = {"/products/3?k=1": "/products", "/": "/", "/index.html": "/index.html", "/a/b/c": "/a"}
    rows = extended(stage_logs(raw(*[{"path": path} for path in paths]))).collect()
    assert {row.path: row.endpoint_group for row in rows} == paths
    assert rows[0].log_date == AT.date() and rows[0].log_hour == 10


def test_not_yet_staged(raw):
    rows = raw({"id": 1}, {"id": 2}, {"id": 3})
    staged = stage_logs(rows.where("id = 2"))
    assert sorted(row.id for row in not_yet_staged(rows, staged).collect()) == [1, 3]
    assert not_yet_staged(rows, stage_logs(rows)).count() == 0


def test_not_yet_staged_by_bits(raw):
    ids = [None, -5, 0, 1, 2, 8, 9, 32_767, 32_768, 32_769, 65_536, 65_537, 8_589_934_592, 2**62]
    rows = raw(*[{"id": i} for i in ids])
    kept = [i for i in ids if i not in (-5, 2, 9, 32_768, 65_537, 2**62)]
    gone = stage_logs(raw(*[{"id": i} for i in (-5, 2, 9, 9, 32_768, 65_537, 2**62, 77, None)]))
    assert sorted(row.id or 0 for row in not_yet_staged(rows, gone).collect()) == sorted(i or 0 for i in kept)


def test_a_full_bitmap_and_what_is_shuffled(spark, raw):
    staged = spark.range(1, 100_001)
    rows = spark.range(131_073)
    left = not_yet_staged(rows, staged)
    assert sorted(row.id for row in left.collect()) == [0, *range(100_001, 131_073)]
    assert id_bitmaps(staged).count() == 4
