from __future__ import annotations

import datetime as dt
import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from logloom.operators.ingest import parse_access_log, parse_lines, parse_rejects
from logloom.sources.logs import read_log

BASE = '1.2.3.4 - - [10/Oct/2023:13:55:36 +0700] "GET /a?x=1 HTTP/1.1" 200 123 "-" "curl/7"'


@pytest.fixture
def parse(spark):
    def run(*lines):
        frame = spark.createDataFrame([(line,) for line in lines], "value string")
        return parse_access_log(frame).collect()

    return run


def test_fields_of_a_line(parse):
    (row,) = parse(BASE)
    assert row.asDict() == {
        "ip_address": "1.2.3.4",
        "method": "GET",
        "path": "/a?x=1",
        "protocol": "HTTP/1.1",
        "status_code": 200,
        "response_size": 123,
        "referer": None,
        "user_agent": "curl/7",
        "requested_at": dt.datetime(2023, 10, 10, 13, 55, 36),
        "response_ms": None,
    }


ACCEPTED = [
    (BASE.replace(" 123 ", " - "), "response_size", 0),
    (BASE.replace(" 123 ", " +7 "), "response_size", 7),
    (BASE.replace(" 123 ", " -7 "), "response_size", -7),
    (BASE.replace('"curl/7"', '""'), "user_agent", ""),
    (BASE.replace('"curl/7"', '"-"'), "user_agent", "-"),
    (BASE.replace('"-"', '"http://x/"'), "referer", "http://x/"),
    (BASE.replace('"-"', '""'), "referer", ""),
    (BASE.replace("+0700", "+07:00"), "requested_at", dt.datetime(2023, 10, 10, 13, 55, 36)),
    (BASE.replace("+0700", "-23:59:59.123"), "requested_at", dt.datetime(2023, 10, 10, 13, 55, 36)),
    (BASE.replace("+0700", "Z"), "requested_at", dt.datetime(2023, 10, 10, 13, 55, 36)),
    (BASE.replace(" +0700", "   +0700"), "requested_at", dt.datetime(2023, 10, 10, 13, 55, 36)),
    (
        BASE.replace("10/Oct/2023:13:55:36", "1/oct/2023:3:5:6"),
        "requested_at",
        dt.datetime(2023, 10, 1, 3, 5, 6),
    ),
    (BASE.replace("10/Oct", " 1/Oct"), "requested_at", dt.datetime(2023, 10, 1, 13, 55, 36)),
    (BASE.replace("10/Oct/2023", "29/Feb/2024"), "requested_at", dt.datetime(2024, 2, 29, 13, 55, 36)),
    (BASE + " and more", "user_agent", "curl/7"),
    (BASE + ' "x"', "response_ms", None),
    (BASE + " 250", "response_ms", 250),
    (BASE + " 250 rest", "response_ms", 250),
    (BASE + " 0.250", "response_ms", None),
    (BASE + " 99999999999", "response_ms", 99999999999),
    ("\t" + BASE, "ip_address", "1.2.3.4"),
    ("\xa0 " + BASE, "ip_address", "1.2.3.4"),
    (BASE.replace('"curl/7"', '"a \\"q\\" b"'), "user_agent", "a \\"),
    (BASE.replace("/a?x=1", "/" + "x" * 600), "path", "/" + "x" * 600),
    (BASE.replace("/a?x=1", "/" + "é" * 600), "path", "/" + "é" * 600),
    (BASE.replace(" 123 ", " 99999999999 "), "response_size", 99999999999),
    (BASE.replace("/a?x=1", '/a"b'), "path", '/a"b'),
    (BASE.replace("HTTP/1.1", "HTTP/1.1 extra"), "protocol", "HTTP/1.1 extra"),
    (BASE.replace(" 200 ", " 000 "), "status_code", 0),
    (BASE.replace(" 200 ", " 700 "), "status_code", 700),
    (BASE.replace("curl/7", "агент"), "user_agent", "агент"),
]


def test_accepted_variants(parse):
    rows = parse(*[line for line, _, _ in ACCEPTED])
    assert len(rows) == len(ACCEPTED)
    for row, (line, field, value) in zip(rows, ACCEPTED):
        assert row[field] == value, line


REJECTED = [
    "",
    "garbage",
    BASE.replace(" 123 ", " x1 "),
    BASE.replace(" 123 ", " 1_0 "),
    BASE.replace(" 123 ", " 1.5 "),
    BASE.replace(" 123 ", " 99999999999999999999 "),
    BASE.replace(" 200 ", " 20 "),
    BASE.replace(" 200 ", " 2000 "),
    BASE.replace(" +0700", ""),
    BASE.replace("+0700", "+2400"),
    BASE.replace("+0700", "+0760"),
    BASE.replace("+0700", "+07:0030"),
    BASE.replace("+0700", "z"),
    BASE.replace("10/Oct", "31/Feb"),
    BASE.replace("10/Oct", "0/Oct"),
    BASE.replace("10/Oct", "10/Okt"),
    BASE.replace("10/Oct/2023", "29/Feb/2023"),
    BASE.replace("/2023", "/0000"),
    BASE.replace("/2023", "/23"),
    BASE.replace("13:55:36", "24:55:36"),
    BASE.replace("13:55:36", "13:55:60"),
    BASE.replace("- -", "- bob smith"),
    BASE.replace(" HTTP/1.1", ""),
    BASE.replace("GET /a?x=1", "GET\xa0/a?x=1"),
    BASE.replace("/a?x=1", "/a　b"),
    BASE.replace("/a?x=1", "/a\x1cb"),
    BASE.replace('"curl/7"', '"curl/7'),
    BASE.replace("1.2.3.4 -", "1.2.3.4  -"),
]


def test_rejected_variants(spark, parse):
    assert parse(*REJECTED) == []
    frame = spark.createDataFrame([(line,) for line in [*REJECTED, BASE]], "value string")
    assert sorted(row.value for row in parse_rejects(frame).collect()) == sorted(REJECTED)


def test_a_line_is_either_accepted_or_rejected(spark):
    lines = [line for line, _, _ in ACCEPTED] + REJECTED
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    parsed = parse_lines(frame)
    assert parsed.where("parse_ok").count() == parse_access_log(frame).count() == len(ACCEPTED)
    assert parsed.where("parse_ok IS NULL").count() == 0
    assert (
        parsed.where("parse_ok").drop("value", "parse_ok").exceptAll(parse_access_log(frame)).count() == 0
    )


def test_the_wall_clock_does_not_depend_on_the_session_zone(spark, parse):
    line = BASE.replace("10/Oct/2023:13:55:36", "10/Mar/2024:02:30:00")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        (row,) = parse(line)  # skipped by the clocks in New York
        assert row.requested_at == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_the_expression_runs_once_per_line(spark):
    lines = spark.range(1).select(F.col("id").cast("string").alias("value"))
    plan = parse_access_log(lines)._jdf.queryExecution().executedPlan().toString()
    # One for lines of ASCII only, one for the others.
    assert plan.count("regexp_replace") == 2


def test_files(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(f"{BASE}\r\n{BASE}\n".encode() + BASE.replace("curl", "\xff").encode("latin-1"))
    with gzip.open(tmp_path / "b.log.gz", "wt") as file:
        file.write(BASE)
    rows = parse_access_log(read_log(spark, str(tmp_path))).collect()
    assert sorted(row.user_agent for row in rows) == ["curl/7", "curl/7", "curl/7", "�/7"]
    assert read_log(spark, str(tmp_path / "*.gz")).count() == 1
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_log(spark, str(tmp_path / "absent.log"))


def test_very_long_lines(parse):
    long = 500_000
    lines = [
        BASE.replace("curl/7", "u" * long),
        BASE.replace("curl/7", "ü" * long),
        BASE.replace("/a?x=1", "/" + "é" * long),
        BASE + " " + "9 " * long,
        "x" * long,
        "a " * long,
        '" "' * long,
        BASE.replace("curl/7", "u" * long + "\n"),
    ]
    rows = parse(*lines)
    assert [(len(row.user_agent), len(row.path)) for row in rows] == [(long, 6), (long, 6), (6, long + 1), (6, 6)]


def test_paths_are_cut_on_request(spark):
    frame = spark.createDataFrame([(BASE.replace("/a?x=1", "/" + "é" * 600),)], "value string")
    assert [row.path for row in parse_access_log(frame, max_path=500).collect()] == ["/" + "é" * 499]
    assert len(parse_access_log(frame).first().path) == 601


def test_absent_lines_are_rejected(spark):
    frame = spark.createDataFrame([(None,), (BASE,)], "value string")
    assert parse_access_log(frame).count() == 1
    assert [row.value for row in parse_rejects(frame).collect()] == [None]
