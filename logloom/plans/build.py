"""From log files to tables and reports."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import SparkSession, functions as F

from ..operators import partials
from ..operators.aggregates import anomalies_above, data_quality_report, thresholds_of, volumes
from ..scratch import side_by_side
from ..sources.logs import DEFAULT_LOG, read_log
from ..sources.tables import Load, LogTables
from .reports import export_reports

REPORTED = ["agg_hourly_traffic", "agg_endpoint_stats", "agg_ip_anomalies", "data_quality_report"]


def refresh_hourly(tables: LogTables, loads: list[int]) -> None:
    """Add some loads to the hourly traffic.

    The clients of every hour are kept with what each load adds, so clients
    are counted exactly, at any lateness, and the requests of earlier loads
    are not read. A request of a far day changes that day alone.
    """
    days = tables.days_of(loads)
    tables.add_partials("hour_clients", partials.hour_clients(tables.staged(days, loads)))
    _merge_hours(tables, days)


def _merge_hours(tables: LogTables, days: list[dt.date]) -> None:
    tables.upsert("agg_hourly_traffic", partials.hourly_traffic_of(tables.partials("hour_clients", days)))


def refresh_anomalies(tables: LogTables, days: list[dt.date], watch: float = 0.95, alarm: float = 0.99) -> None:
    """Bring the anomalies up to date after the client days of some days changed.

    The limits of volume come from histograms, one a day. An anomaly depends
    on its client day and the limits, so besides the changed days only client
    days whose volume lies between an old and a new limit can differ; if no
    limit moved, other days are not read. Anomalies that no longer qualify
    keep their rows.
    """
    tables.replace_days("volume_days", volumes(tables.table("ip_days", days)))
    found = thresholds_of(tables.table("volume_days"), (watch, alarm)).first()[0]
    if found is None:
        return
    before = tables.limits()
    rows = tables.table("ip_days", days)
    moved = [(min(a, b), max(a, b)) for a, b in zip(before or [], found) if a != b]
    if before is None:
        rows = tables.table("ip_days")
    elif moved:
        between = [(F.col("total_requests") > low) & (F.col("total_requests") <= high) for low, high in moved]
        others = tables.table("ip_days").where(reduce(or_, between) & ~F.col("request_date").isin(days))
        rows = rows.unionAll(others)
    tables.upsert("agg_ip_anomalies", anomalies_above(rows, *[F.lit(limit) for limit in found]))
    # last: until here a repeated refresh starts from the old limits
    tables.set_limits(found)


def refresh_tables(tables: LogTables, loads: list[int]) -> None:
    """Add some loads to the aggregate tables.

    What the loads add is kept as partial aggregates, and the days they fall
    on are summed up again from those of all loads; the requests of earlier
    loads are read for the quality report alone, whose duplicates may lie in
    any load of the day.
    """
    days = tables.days_of(loads)
    fresh = tables.staged(days, loads)

    def hours() -> None:
        tables.add_partials("hour_clients", partials.hour_clients(fresh))
        _merge_hours(tables, days)

    def endpoints() -> None:
        tables.add_partials("endpoint_days", partials.endpoint_days(fresh))
        stats = partials.endpoint_stats_of(tables.partials("endpoint_days", days), tables.scratch)
        tables.replace_days("agg_endpoint_stats", stats)

    def anomalies() -> None:
        tables.add_partials("client_endpoints", partials.client_endpoints(fresh))
        tables.replace_days("ip_days", partials.ip_days_of(tables.partials("client_endpoints", days)))
        refresh_anomalies(tables, days)

    side_by_side(
        hours,
        endpoints,
        lambda: tables.upsert("data_quality_report", data_quality_report(tables.staged(days))),
        anomalies,
    )


def build_tables(
    spark: SparkSession,
    log_path: str | list[str] = DEFAULT_LOG,
    root: str = "logloom-tables",
    rejects_path: str | None = None,
    report_title: str | None = None,
    spread_days: bool = False,
) -> Load:
    """Load a log, stage what is new, refresh the tables it touches, export the reports."""
    tables = LogTables(spark, root)
    try:
        return _build(tables, log_path, rejects_path, report_title, spread_days)
    finally:
        tables.scratch.drop()


def _build(
    tables: LogTables, log_path: str | list[str], rejects_path: str | None, report_title: str | None, spread_days: bool
) -> Load:
    spark = tables.spark
    load = tables.load(read_log(spark, log_path), rejects_path=rejects_path)
    tables.stage_new(spread_days)
    # Also catches up on loads whose refresh did not finish.
    loads = sorted(set(tables.loads("staged")) - set(tables.loads("refreshed")))
    if loads:
        refresh_tables(tables, loads)
    for load_id in loads:
        tables.mark("refreshed", load_id)
    title = report_title or f"Access report {dt.date.today()}"
    export_reports({name: tables.table(name) for name in REPORTED}, tables.path("reports"), title)
    return load
