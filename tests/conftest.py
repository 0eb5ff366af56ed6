from __future__ import annotations

import datetime as dt
import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from logloom.scratch import Scratch  # noqa: E402
from logloom.session import build_session  # noqa: E402
from logloom.sources.tables import LogTables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return Scratch(spark)


@pytest.fixture
def tables(spark, scratch):
    return LogTables(spark, scratch.path("tables"), scratch)


STAGED = (
    "id long, ip_address string, method string, path string, endpoint string, status_code int, "
    "status_class string, response_size long, is_bot boolean, client_type string, "
    "requested_at timestamp_ntz, request_date date, request_hour int, is_valid boolean, "
    "invalid_reason string, response_ms long, endpoint_group string, log_date date, log_hour int"
)


def request(**given):
    """A valid staged request on 2024-03-01, 10 o'clock, with some fields changed."""
    row = {
        "id": uuid.uuid4().int % 10**12,
        "ip_address": "1.1.1.1",
        "method": "GET",
        "path": "/a",
        "status_code": 200,
        "response_size": 100,
        "is_bot": False,
        "client_type": "browser",
        "requested_at": dt.datetime(2024, 3, 1, 10, 0, 0),
        "is_valid": True,
        "invalid_reason": None,
        "response_ms": 5,
    }
    row.update(given)
    at = row["requested_at"]
    path = row["path"]
    row.setdefault("endpoint", path.split("?")[0] if path else None)
    row.setdefault("status_class", f"{str(row['status_code'])[:1]}xx" if row["status_code"] else None)
    row.setdefault("request_date", at.date() if at else None)
    row.setdefault("request_hour", at.hour if at else None)
    row.setdefault("endpoint_group", "/" + (row["endpoint"] or "").strip("/").split("/")[0])
    row.setdefault("log_date", row["request_date"])
    row.setdefault("log_hour", row["request_hour"])
    return row


@pytest.fixture
def staged(spark):
    """A function from request rows to a staged DataFrame."""
    names = [part.strip().split(" ")[0] for part in STAGED.split(", ")]

    def frame(rows):
        return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], STAGED)

    return frame
