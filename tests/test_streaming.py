from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from logloom.operators.aggregates import hourly_traffic
from logloom.operators.ingest import parse_access_log, stage_logs
from logloom.sources.logs import read_log, stream_log
from logloom.streaming.hourly import windowed_hourly_traffic
from logloom.streaming.ingest import stream_hourly_traffic, stream_ingest


def line(ip, at, status=200, agent="x"):
    return f'{ip} - - [{at:%d/%b/%Y:%H:%M:%S} +0000] "GET /a HTTP/1.1" {status} 10 "-" "{agent}"'


START = dt.datetime(2024, 3, 1, 22, 30)


def _write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))


def _some(first, count=40):
    return [
        line(f"1.1.1.{i % 7}", START + dt.timedelta(minutes=7 * (first + i)), 500 if i % 5 == 0 else 200)
        for i in range(count)
    ]


def _batch(spark, folder):
    rows = parse_access_log(read_log(spark, str(folder))).withColumn("id", F.lit(0).cast("long"))
    return stage_logs(rows)


def _plain(frame):
    return sorted(map(tuple, frame.collect()))


def test_files_arriving_over_time(spark, tables, scratch, tmp_path):
    log, checkpoint = tmp_path / "log", scratch.path("checkpoint")

    def catch_up():
        stream_hourly_traffic(stream_log(spark, str(log), 1), tables, checkpoint, True).awaitTermination(300)

    _write(log, "a.log", *_some(0), "garbage")
    _write(log, "b.log", *_some(20))
    catch_up()
    assert tables.loads("raw_logs") == tables.loads("staged") == [1, 2]
    # A late file changes hours that were done before.
    _write(log, "c.log", *_some(-10, 5))
    catch_up()
    catch_up()
    expected = _batch(spark, log)
    compared = [c for c in expected.columns if c not in ("id", "load_id")]
    assert _plain(tables.staged().select(*compared)) == _plain(expected.select(*compared))
    assert tables.staged().select("id").distinct().count() == 85
    assert _plain(tables.table("agg_hourly_traffic")) == _plain(hourly_traffic(expected))


def test_a_replayed_batch_changes_nothing(spark, tables, scratch, tmp_path):
    log, checkpoint = tmp_path / "log", tmp_path / "checkpoint"
    _write(log, "a.log", *_some(0))
    stream_ingest(stream_log(spark, str(log)), tables, str(checkpoint), True).awaitTermination(300)
    before = _plain(tables.staged())
    # the batch is planned but not noted as done: it runs once more
    for done in (checkpoint / "commits").glob("*0*"):
        done.unlink()
    stream_ingest(stream_log(spark, str(log)), tables, str(checkpoint), True).awaitTermination(300)
    assert _plain(tables.staged()) == before and len(before) == 40


def test_a_stream_into_a_used_root_loses_nothing(spark, tables, scratch, tmp_path):
    tables.load(spark.createDataFrame([(x,) for x in _some(0)], "value string"))
    tables.stage_new()
    for name in ("one", "two"):
        log = tmp_path / name
        _write(log, "a.log", *_some(0, 3))
        stream_ingest(stream_log(spark, str(log)), tables, scratch.path(name), True).awaitTermination(300)
    assert tables.staged().count() == 40 + 2 * len(_some(0, 3))
    assert tables.staged().select("id").distinct().count() == tables.staged().count()
    tables.load(spark.createDataFrame([(x,) for x in _some(0)], "value string"))
    assert tables.loads("raw_logs") == [1, 2, 3, 4]


def test_closed_hours(spark, scratch, tmp_path):
    log = tmp_path / "log"
    _write(log, "a.log", *_some(0), *_some(0, 3))
    rows = parse_access_log(stream_log(spark, str(log))).withColumn("id", F.lit(0).cast("long"))
    hours = windowed_hourly_traffic(stage_logs(rows), "1 hour")
    path, checkpoint = scratch.path("hours"), scratch.path("checkpoint")

    def catch_up():
        writer = hours.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start(path).awaitTermination(300)
        return spark.read.schema(hours.schema).parquet(path)

    expected = hourly_traffic(_batch(spark, log))
    last = START + dt.timedelta(minutes=7 * 39)  # 03:03 the next day
    closing = F.expr("CAST(request_date AS timestamp_ntz) + make_dt_interval(0, request_hour + 2)")
    closed = expected.where(closing <= F.lit(last).cast("timestamp_ntz"))
    assert _plain(catch_up()) == _plain(closed) and closed.count() == 4
    # A much later request closes the rest; a request for a closed hour is too late.
    _write(log, "b.log", line("9.9.9.9", last + dt.timedelta(days=1)), line("9.9.9.9", START))
    assert _plain(catch_up()) == _plain(expected)
