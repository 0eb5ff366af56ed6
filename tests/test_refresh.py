"""What a load costs the tables: only what it adds is read, only what differs is written."""

from __future__ import annotations

import datetime as dt
import shutil

import pytest
from test_tables import _log, line

from logloom import schemas
from logloom.operators.aggregates import endpoint_stats, hourly_traffic, ip_anomalies, ip_days
from logloom.operators.merge import changes
from logloom.plans import build
from logloom.sources.tables import LogTables


def plain(frame):
    return sorted(map(repr, frame.collect()))


def refreshed(tables, *texts):
    """One more load, staged and added to the tables."""
    load = tables.load(tables.spark.createDataFrame([(t,) for t in texts], "value string"))
    tables.stage_new()
    build.refresh_tables(tables, [load.load_id])


def test_counts_are_exact_over_overlapping_loads_without_their_requests(spark, tables, scratch):
    loads = [
        [line(ip=f"1.1.1.{i % 5}", minute=i % 60, path=f"/{i % 3}", status=500 if i % 4 == 0 else 200) for i in range(first, first + 30)]
        + [line(ip="late", day=1 + n, hour=23)]
        for n, first in enumerate((0, 20, 10, 40, 0))
    ]
    everything = []
    for n, texts in enumerate(loads, 1):
        refreshed(tables, *texts)
        everything += tables.staged(tables.days_of([n]), [n]).collect()
        # the requests of this load are gone before the next one comes
        for folder in tables._listed(f"stg_logs/request_date=*/load_id={n}"):
            shutil.rmtree(folder.toUri().getPath())
    staged = spark.createDataFrame(everything, schemas.STAGED)
    assert plain(tables.table("agg_hourly_traffic")) == plain(hourly_traffic(staged).select(*schemas.HOURLY_TRAFFIC.names))
    stats = endpoint_stats(staged, scratch).select(*schemas.ENDPOINT_STATS.names)
    assert plain(tables.table("agg_endpoint_stats")) == plain(stats)
    assert plain(tables.table("ip_days")) == plain(ip_days(staged).select(*schemas.IP_DAYS.names))


def test_a_repeated_refresh_adds_nothing(tables):
    refreshed(tables, line(), line(minute=1))
    before = plain(tables.table("agg_hourly_traffic"))
    build.refresh_tables(tables, [1])
    assert plain(tables.table("agg_hourly_traffic")) == before


def test_an_upsert_of_unchanged_rows_writes_nothing(tables):
    refreshed(tables, line(day=1), line(day=2), line(day=3, ip="2.2.2.2"))
    for name in ("agg_hourly_traffic", "ip_days"):
        versions = tables._lists(name)
        assert tables.upsert(name, tables.table(name)) == 0
        assert tables._lists(name) == versions
    (row,) = tables.table("ip_days", [dt.date(2024, 3, 2)]).collect()
    other = tables.spark.createDataFrame([row], schemas.IP_DAYS).withColumnRenamed("x", "y").selectExpr("* EXCEPT (bot_signals)", "7L AS bot_signals")
    before = tables._folders("ip_days", tables._lists("ip_days")[0])
    assert tables.upsert("ip_days", tables.table("ip_days").where("request_date <> date '2024-03-02'").unionByName(other)) == 1
    after = tables._folders("ip_days", tables._lists("ip_days")[0])
    assert {day for day in after if after[day] != before[day]} == {"2024-03-02"}


def test_readers_keep_the_version_they_opened(tables):
    refreshed(tables, line(day=1), line(day=2))
    opened = tables.table("agg_endpoint_stats")
    before = plain(opened)
    refreshed(tables, line(day=1, path="/new"))
    assert plain(opened) == before
    assert len(plain(tables.table("agg_endpoint_stats"))) == len(before) + 1


def test_old_versions_go(tables):
    for minute in range(5):
        refreshed(tables, line(minute=minute))
    assert len(tables._lists("agg_endpoint_stats")) == 2
    assert len(tables._listed("agg_endpoint_stats/v=*/report_date=*")) == 2


def test_a_half_written_version_does_not_count(tables):
    refreshed(tables, line())
    before = plain(tables.table("ip_days"))
    tables.table("ip_days").write.partitionBy("request_date").parquet(f"{tables.path('ip_days')}/v=2")
    assert plain(tables.table("ip_days")) == before
    refreshed(tables, line(minute=1))
    assert [r.total_requests for r in tables.table("ip_days").collect()] == [2]


def test_anomalies_of_other_days_follow_the_limits(spark, tables):
    def day_of(day, counts):
        return [line(ip=f"c{i}", day=day, minute=m % 60, hour=m // 60) for i, n in enumerate(counts) for m in range(n)]

    refreshed(tables, *day_of(1, [1] * 30 + [9, 20]))
    folders = tables._folders("ip_days", tables._lists("ip_days")[0])
    first = {r.ip_address: r.is_suspicious for r in tables.table("agg_ip_anomalies").collect()}
    refreshed(tables, *day_of(2, [1] * 30 + [40, 50, 60]))
    # the limits rose: day 1 is not written again as client days, but what its rows say has changed
    assert tables._folders("ip_days", tables._lists("ip_days")[0])["2024-03-01"] == folders["2024-03-01"]
    expected = {(r.report_date, r.ip_address): r for r in ip_anomalies(tables.table("ip_days")).collect()}
    found = {(r.report_date, r.ip_address): r for r in tables.table("agg_ip_anomalies").collect()}
    assert {k: found[k].is_suspicious for k in expected} == {k: r.is_suspicious for k, r in expected.items()}
    kept = {k: r for k, r in found.items() if k not in expected}
    assert all(r.is_suspicious == first[ip] for (_, ip), r in kept.items())


def test_limits_that_stay_leave_other_days_unread(tables, monkeypatch):
    texts = [line(ip=f"c{i}", minute=m) for i in range(40) for m in range(3)]
    refreshed(tables, *texts)
    read = []
    plain_table = LogTables.table
    monkeypatch.setattr(LogTables, "table", lambda self, name, parts=None: read.append((name, parts)) or plain_table(self, name, parts))
    refreshed(tables, *[t.replace("01/Mar", "02/Mar") for t in texts])
    assert {str(parts) for name, parts in read if name == "ip_days"} == {str([dt.date(2024, 3, 2)])}


def test_changes(spark):
    target = spark.createDataFrame([(1, "a", None), (2, None, "x"), (3, None, None)], "k int, v string, w string")
    source = spark.createDataFrame([(1, "a", None), (2, "x", None), (3, None, None), (4, None, None)], "k int, v string, w string")
    assert sorted(r.k for r in changes(target, source, ["k"]).collect()) == [2, 4]


def test_a_request_of_a_far_day_changes_that_day_alone(tables):
    refreshed(tables, line(day=1), line(day=2))
    before = plain(tables.table("agg_hourly_traffic"))
    refreshed(tables, line().replace("2024", "2099"))
    after = tables.table("agg_hourly_traffic")
    assert plain(after.where("year(request_date) = 2024")) == before
    assert after.where("year(request_date) = 2099").count() == 1


def test_rejects_are_kept_by_load(spark, tables):
    lines = spark.createDataFrame([(line(),), ("garbage",), ("",), ("more",)], "value string")
    for _ in range(2):
        load = tables.load(lines)
        assert (load.accepted, load.rejected) == (1, 3)
    assert sorted(map(tuple, tables.rejects().collect())) == [(n, v) for n in (1, 2) for v in ("", "garbage", "more")]
    assert sorted(r.value for r in tables.rejects([2]).collect()) == ["", "garbage", "more"]
    assert tables.raw().count() == 2 and tables.raw().where("ip_address IS NULL").count() == 0
    # ids go on from the note of the load before, without reading its rows
    assert tables._first_free_id() > max(r.id for r in tables.raw().collect())


@pytest.mark.parametrize("stop", ["write", "note"])
def test_a_load_that_died_is_replaced(spark, tables, stop):
    tables.load(spark.createDataFrame([(line(),)], "value string"))
    dead = tables.load(spark.createDataFrame([(line(minute=1),), ("bad",)], "value string"))
    for mark in ["_SUCCESS", "_next_id=*"][: 2 if stop == "write" else 1]:
        for path in tables._listed(f"raw_pieces/load_id={dead.load_id}/{mark}"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    again = tables.load(spark.createDataFrame([(line(minute=2),)], "value string"))
    assert again.load_id == dead.load_id
    assert tables.raw([again.load_id]).count() == 1 and tables.rejects([again.load_id]).count() == 0
    assert tables.raw().select("id").distinct().count() == 2


def test_a_build_that_fails_drops_its_scratch(spark, scratch, monkeypatch):
    seen = []
    monkeypatch.setattr(build, "refresh_tables", lambda tables, loads: seen.append(tables.scratch) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build.build_tables(spark, _log(spark, scratch, line()), scratch.path("tables"))
    from logloom.scratch import path_exists

    assert not path_exists(spark, seen[0].folder)
