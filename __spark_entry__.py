"""

The queries run over `events`, read as web requests (`logloom.sources.events`).
`comparable` brings results to types both engines print alike; the library
itself returns decimals and dates.
"""

from __future__ import annotations

import datetime as dt
import functools
import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T  # noqa: E402

from logloom.operators import aggregates, ingest  # noqa: E402
from logloom.plans import latency, reports, traffic  # noqa: E402
from logloom.plans.build import REPORTED, build_tables  # noqa: E402
from logloom.scratch import Scratch, shared_folder  # noqa: E402
from logloom.session import is_local, let_workers_import  # noqa: E402
from logloom.sources.events import GROUPED_PATHS, LOG_LINE, log_lines, read_events, requests  # noqa: E402
from logloom.sources.logs import read_log, stream_log  # noqa: E402
from logloom.sources.tables import LogTables  # noqa: E402
from logloom.streaming.hourly import windowed_hourly_traffic  # noqa: E402
from logloom.streaming.ingest import stream_hourly_traffic, stream_ingest  # noqa: E402
from oracle_queries import ORACLES  # noqa: E402

AS_OF = dt.date(2024, 1, 30)
MIDDLE = "requested_at < timestamp_ntz '2024-01-16 12:00:00'"


def comparable(rows: DataFrame, *, drop: tuple[str, ...] = ()) -> DataFrame:
    """Decimals as doubles, dates and times as text."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.TimestampNTZType):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        return column

    return rows.select(*[plain(f) for f in rows.schema.fields if f.name not in drop])


# -- inputs ------------------------------------------------------------------


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return requests(read_events(spark, folder))


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.stage_logs(raw(spark, folder))


def extended(spark: SparkSession, folder: str) -> DataFrame:
    grouped = requests(read_events(spark, folder), GROUPED_PATHS)
    return ingest.extended(ingest.stage_logs(grouped))


def repeated(spark: SparkSession, folder: str) -> DataFrame:
    """The staged requests, every tenth one twice."""
    rows = staged(spark, folder)
    return rows.unionByName(rows.where("id % 10 = 0"))


def damaged_lines(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    """The log with some lines cut, some on a day that does not exist, some with a bad size."""
    value = F.col("value")
    damaged = (
        F.when(F.expr("id % 50 = 7"), F.replace(value, F.lit(" HTTP/1.1"), F.lit("")))
        .when(F.expr("id % 53 = 5"), F.regexp_replace(value, r"\[\d+/\w+/", "[31/Feb/"))
        .when(F.expr("id % 59 = 3"), F.regexp_replace(value, r'(\d+) "-"', '1_0 "-"'))
        .otherwise(value)
    )
    return raw(spark, folder).selectExpr("id", f"{LOG_LINE} AS value").select(*keep, damaged.alias("value"))


def log_file(lines: DataFrame, scratch: Scratch) -> str:
    path = scratch.path("log")
    lines.write.text(path)
    return path


def tables_in(scratch: Scratch) -> LogTables:
    return LogTables(scratch.spark, scratch.path("tables"), scratch)


# -- queries over several steps ----------------------------------------------


def parse_access_log(spark: SparkSession, folder: str) -> DataFrame:
    path = log_file(log_lines(raw(spark, folder)), Scratch(spark))
    return comparable(ingest.parse_access_log(read_log(spark, path)))


def parse_rejects(spark: SparkSession, folder: str) -> DataFrame:
    path = log_file(damaged_lines(spark, folder), Scratch(spark))
    return ingest.parse_rejects(read_log(spark, path))


def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of a damaged log: lines kept and left out, ids, status and size totals."""
    scratch = Scratch(spark)
    tables = tables_in(scratch)
    path = log_file(damaged_lines(spark, folder), scratch)
    loads = [tables.load(read_log(spark, path)) for _ in range(2)]
    rejected = spark.createDataFrame([(x.load_id, x.rejected) for x in loads], "load_id long, rejected long")
    per_load = tables.raw().groupBy("load_id").agg(
        F.count("*").alias("accepted"),
        F.count_distinct("id").alias("ids"),
        F.sum("status_code").alias("status_total"),
        F.sum("response_size").alias("size_total"),
    )
    return per_load.join(F.broadcast(rejected), "load_id")


def load_ids(spark: SparkSession, folder: str) -> DataFrame:
    """A damaged log of several files, loaded twice: every request and its id, which follows the lines."""
    scratch = Scratch(spark)
    tables, path = tables_in(scratch), scratch.path("log")
    damaged_lines(spark, folder, "id").repartitionByRange(5, "id").sortWithinPartitions("id").select("value").write.text(path)
    for _ in range(2):
        tables.load(read_log(spark, path))
    columns = "id", "load_id", "ip_address", "method", "path", "status_code", "response_size", "user_agent", "requested_at", "response_ms"
    return comparable(tables.raw().select(*columns))


def stage_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Half the log loaded and staged, then all of it: every load staged once."""
    scratch = Scratch(spark)
    tables = tables_in(scratch)
    rows = raw(spark, folder)
    for part in (rows.where(MIDDLE), rows):
        tables.load(read_log(spark, log_file(log_lines(part), scratch)))
        tables.stage_new()
    return comparable(tables.staged(), drop=("id",))


def stage_by_id(spark: SparkSession, folder: str) -> DataFrame:
    """The raw requests not staged yet, found by id."""
    rows = staged(spark, folder)
    fresh = ingest.not_yet_staged(raw(spark, folder), rows.where(MIDDLE))
    return comparable(ingest.stage_logs(fresh))


def upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly traffic of all clients, then of bots only for the later days, merged twice."""
    scratch = Scratch(spark)
    tables = tables_in(scratch)
    rows = staged(spark, folder)
    tables.upsert("agg_hourly_traffic", aggregates.hourly_traffic(rows.where(MIDDLE)))
    later = aggregates.hourly_traffic(rows.where("is_bot AND request_date >= date '2024-01-10'"))
    for _ in range(2):
        tables.upsert("agg_hourly_traffic", later)
    return comparable(tables.table("agg_hourly_traffic"))


def _built(spark: SparkSession, folder: str, scratch: Scratch) -> LogTables:
    """Half the log built into tables, then all of it on top: the first half is there twice."""
    root = scratch.path("tables")
    rows = raw(spark, folder)
    for part in (rows.where(MIDDLE), rows):
        build_tables(spark, log_file(log_lines(part), scratch), root)
    return LogTables(spark, root, scratch)


def log_to_tables(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_built(spark, folder, Scratch(spark)).table("data_quality_report"))


def log_to_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_built(spark, folder, Scratch(spark)).table("agg_ip_anomalies"))


def log_to_all(spark: SparkSession, folder: str) -> DataFrame:
    """All four tables of one build as rows of text."""
    tables = _built(spark, folder, Scratch(spark))

    def texts(name: str) -> DataFrame:
        rows = tables.table(name)
        values = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in rows.columns]
        return rows.select(F.lit(name).alias("name"), F.concat_ws("|", *values).alias("row"))

    return functools.reduce(DataFrame.unionAll, [texts(name) for name in REPORTED])


def aggregate_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    scratch = Scratch(spark)
    rows = staged(spark, folder)
    return {
        "data_quality_report": aggregates.data_quality_report(repeated(spark, folder)),
        "agg_endpoint_stats": aggregates.endpoint_stats(rows, scratch),
        "agg_hourly_traffic": aggregates.hourly_traffic(rows),
        "agg_ip_anomalies": aggregates.ip_anomalies(scratch.keep(aggregates.ip_days(rows), "ip-days")),
    }


def ip_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    days = Scratch(spark).keep(aggregates.ip_days(staged(spark, folder)), "ip-days")
    return comparable(aggregates.ip_anomalies(days))


def endpoint_stats(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(aggregates.endpoint_stats(staged(spark, folder), Scratch(spark)))


def report_data_quality(spark: SparkSession, folder: str) -> DataFrame:
    quality = aggregates.data_quality_report(repeated(spark, folder))
    return comparable(reports.report_data_quality(quality))


def report_top_endpoints(spark: SparkSession, folder: str) -> DataFrame:
    stats = aggregates.endpoint_stats(staged(spark, folder), Scratch(spark))
    return comparable(reports.report_top_endpoints(stats))


def report_hourly_traffic(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(reports.report_hourly_traffic(aggregates.hourly_traffic(staged(spark, folder))))


def report_suspicious_ips(spark: SparkSession, folder: str) -> DataFrame:
    days = Scratch(spark).keep(aggregates.ip_days(staged(spark, folder)), "ip-days")
    return comparable(reports.report_suspicious_ips(aggregates.ip_anomalies(days)))


def export_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The suspicious clients written as CSV, read back as text."""
    scratch = Scratch(spark)
    days = scratch.keep(aggregates.ip_days(staged(spark, folder)), "ip-days")
    found = reports.report_suspicious_ips(aggregates.ip_anomalies(days))
    path = scratch.path("suspicious")
    reports.export_csv(found, path, single_file=True)
    columns = ", ".join(f"{name} string" for name in found.columns)
    return spark.read.schema(columns).option("header", True).option("escape", '"').csv(path)


def report_sections(spark: SparkSession, folder: str) -> DataFrame:
    sections = reports.report_sections(aggregate_tables(spark, folder))
    return sections.select("section", "row_no", F.concat_ws("|", "cells").alias("cells"))


def report_page(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the page."""
    tables = aggregate_tables(spark, folder)
    columns = {name: rows.columns for name, rows in reports.reports(tables).items()}
    page = reports.report_html(reports.report_sections(tables), columns, "Report")
    return page.where(F.col("value").startswith("<tr><td>"))


def parameterised_sql(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over the staged requests with bound parameters, exported and read back."""
    staged(spark, folder).createOrReplaceTempView("stg_logs")
    path = Scratch(spark).path("export")
    reports.export_query(
        spark,
        """SELECT request_date, endpoint, COUNT(*) AS hits,
                  COUNT(*) FILTER (WHERE status_code >= :error_from) AS errors
           FROM stg_logs WHERE is_valid = TRUE AND method = :method
           GROUP BY request_date, endpoint ORDER BY request_date, endpoint""",
        path,
        {"error_from": 400, "method": "GET"},
    )
    schema = "request_date string, endpoint string, hits long, errors long"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def exploratory_sql(spark: SparkSession, folder: str) -> DataFrame:
    """Free SQL over the registered view, with a window over aggregates and ordered-set percentiles."""
    staged(spark, folder).createOrReplaceTempView("stg_logs")
    return comparable(
        spark.sql(
            """WITH per_client AS (
                   SELECT client_type, request_hour, COUNT(*) AS n,
                          LAG(COUNT(*)) OVER (PARTITION BY client_type ORDER BY request_hour) AS before
                   FROM stg_logs WHERE is_valid GROUP BY client_type, request_hour)
               SELECT client_type, SUM(n) AS total, MAX(n - before) AS largest_rise,
                      ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY n), 4) AS median_hour
               FROM per_client GROUP BY client_type"""
        )
    )


def top_endpoints_running_total(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(traffic.top_endpoints_running_total(staged(spark, folder), Scratch(spark)))


def ip_anomaly_explore(spark: SparkSession, folder: str) -> DataFrame:
    found = traffic.ip_anomaly_explore(staged(spark, folder), Scratch(spark))
    return comparable(found.withColumn("p95_requests", F.round("p95_requests", 4)))


def latency_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    found = latency.latency_percentiles(extended(spark, folder), Scratch(spark), AS_OF)
    return comparable(found.withColumns({c: F.round(c, 4) for c in ("p50_ms", "p95_ms", "p99_ms")}))


def response_time_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Response times with fractions of a millisecond, per endpoint group and method."""
    times = read_events(spark, folder).select(F.col("event_id").alias("id"), (F.col("value") * 10).alias("took_ms"))
    rows = extended(spark, folder).join(times, "id")
    found = latency.response_time_percentiles(rows, Scratch(spark), "took_ms")
    return found.withColumns({c: F.round(c, 6) for c in ("p50_ms", "p95_ms", "p99_ms")})


def slowest_endpoints(spark: SparkSession, folder: str) -> DataFrame:
    found = latency.slowest_endpoints(extended(spark, folder), Scratch(spark), AS_OF)
    return comparable(found.withColumn("p95_ms", F.round("p95_ms", 4)))


def _streamed(spark: SparkSession, folder: str, stream: Callable) -> LogTables:
    """The later half of the log arrives first, the earlier half after it: all of that is late."""
    scratch = Scratch(spark)
    tables, path, checkpoint = tables_in(scratch), scratch.path("log"), scratch.path("checkpoint")
    rows = raw(spark, folder)
    for part in (rows.where(f"NOT ({MIDDLE})"), rows.where(MIDDLE)):
        log_lines(part).write.mode("append").text(path)
        stream(stream_log(spark, path), tables, checkpoint, until_caught_up=True).awaitTermination()
    return tables


def streamed_staging(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_streamed(spark, folder, stream_ingest).staged(), drop=("id", "load_id"))


def streamed_hourly_traffic(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_streamed(spark, folder, stream_hourly_traffic).table("agg_hourly_traffic"))


def streamed_far_hours(spark: SparkSession, folder: str) -> DataFrame:
    """As `streamed_hourly_traffic`, with some requests stamped 75 years ahead in the first files."""
    scratch = Scratch(spark)
    tables, path, checkpoint = tables_in(scratch), scratch.path("log"), scratch.path("checkpoint")
    rows = raw(spark, folder)
    far = rows.where("id % 100 = 13").withColumn("requested_at", F.expr("requested_at + interval 75 years"))
    for part in (far.unionByName(rows.where(f"NOT ({MIDDLE})")), rows.where(MIDDLE)):
        log_lines(part).write.mode("append").text(path)
        stream_hourly_traffic(stream_log(spark, path), tables, checkpoint, until_caught_up=True).awaitTermination()
    return comparable(tables.table("agg_hourly_traffic"))


def streamed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The lines that a stream over a damaged log leaves out."""
    scratch = Scratch(spark)
    tables, path = tables_in(scratch), log_file(damaged_lines(spark, folder), scratch)
    stream_ingest(stream_log(spark, path), tables, scratch.path("checkpoint"), until_caught_up=True).awaitTermination()
    return tables.rejects().select("value")


def streamed_closed_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Hours closed by the watermark, two hours after the latest request."""
    scratch = Scratch(spark)
    lines = stream_log(spark, log_file(log_lines(raw(spark, folder)), scratch))
    parsed = ingest.stage_logs(ingest.parse_access_log(lines).withColumn("id", F.lit(None).cast("long")))
    hours, done = windowed_hourly_traffic(parsed), scratch.path("hours")
    writer = hours.writeStream.format("parquet").option("checkpointLocation", scratch.path("checkpoint"))
    writer.trigger(availableNow=True).start(done).awaitTermination()
    return comparable(spark.read.schema(hours.schema).parquet(done))


# -- the contract --------------------------------------------------------------

# Where intermediate tables go if the session names no folder (local runs and tests).
LOCAL_FOLDER = "/tmp/checkpoints/logloom"


def _with_folder(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """Let a local session without a shared folder run `query`; a set folder stays as it is, and a cluster must set one."""

    @functools.wraps(query)
    def run(spark: SparkSession, *folder: str) -> DataFrame:
        if not shared_folder(spark) and is_local(spark):
            spark.sparkContext.setCheckpointDir(LOCAL_FOLDER)
        let_workers_import(spark)
        return query(spark, *folder)

    return run


def _corpus_parts():
    """The modules of corpus queries, or None where that subpackage was removed."""
    if not all((found := importlib.util.find_spec(name)) and found.origin for name in ("logloom.llm", "corpus_pipeline")):
        return None
    import corpus_pipeline
    from logloom.llm import queries as corpus_queries

    return corpus_queries, corpus_pipeline



@_with_folder
def entry(spark: SparkSession) -> DataFrame:
    """Log lines parsed, staged and ranked by endpoint and day."""
    lines = log_lines(raw(spark, "/root/testdata/sf0.001"))
    parsed = ingest.with_ids(ingest.parse_access_log(lines), 1)
    return comparable(aggregates.endpoint_stats(ingest.stage_logs(parsed), Scratch(spark)))


def _over(rows: Callable, query: Callable, *args) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: comparable(query(rows(spark, folder), *args))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = log_queries()
    if parts := _corpus_parts():
        found |= parts[0].queries() | {"pipeline": parts[1].run}
    return {name: _with_folder(query) for name, query in found.items()}


def log_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "parse_access_log": parse_access_log,
        "parse_rejects": parse_rejects,
        "load_counts": load_counts,
        "load_ids": load_ids,
        "stage_logs": lambda spark, folder: comparable(staged(spark, folder)),
        "stage_incremental": stage_incremental,
        "stage_by_id": stage_by_id,
        "classify_client": lambda spark, folder: ingest.classify_client(raw(spark, folder)).select(
            "id", "user_agent", "is_bot", "client_type"
        ),
        "validate_logs": lambda spark, folder: ingest.validate_logs(raw(spark, folder)).select(
            "id", "method", "status_code", "is_valid", "invalid_reason"
        ),
        "hourly_traffic": _over(staged, aggregates.hourly_traffic),
        "endpoint_stats": endpoint_stats,
        "ip_anomalies": ip_anomalies,
        "data_quality_report": _over(repeated, aggregates.data_quality_report),
        "upsert": upsert,
        "log_to_tables": log_to_tables,
        "log_to_anomalies": log_to_anomalies,
        "log_to_all": log_to_all,
        "report_data_quality": report_data_quality,
        "report_top_endpoints": report_top_endpoints,
        "report_hourly_traffic": report_hourly_traffic,
        "report_suspicious_ips": report_suspicious_ips,
        "export_csv": export_csv,
        "report_sections": report_sections,
        "report_page": report_page,
        "parameterised_sql": parameterised_sql,
        "exploratory_sql": exploratory_sql,
        "top_endpoints_running_total": top_endpoints_running_total,
        "hourly_pattern": _over(staged, traffic.hourly_pattern),
        "ip_anomaly_explore": ip_anomaly_explore,
        "status_trend": _over(staged, traffic.status_trend),
        "funnel_paths": _over(staged, traffic.funnel_paths),
        "client_breakdown": _over(staged, traffic.client_breakdown),
        "traffic_rolling_3h": _over(extended, latency.traffic_rolling_3h),
        "latency_percentiles": latency_percentiles,
        "response_time_percentiles": response_time_percentiles,
        "ip_threat_level": _over(extended, latency.ip_threat_level),
        "error_surge": _over(extended, latency.error_surge, AS_OF),
        "slowest_endpoints": slowest_endpoints,
        "funnel_groups": _over(extended, latency.funnel_groups),
        "stream_ingest": streamed_staging,
        "stream_hourly_traffic": streamed_hourly_traffic,
        "stream_closed_hours": streamed_closed_hours,
        "stream_far_hours": streamed_far_hours,
        "stream_rejects": streamed_rejects,
    }


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLES)
    if parts := _corpus_parts():
        found |= parts[0].oracle_sql()
        if parts[1].ORACLE_SQL:
            found["pipeline"] = parts[1].ORACLE_SQL
    return found
