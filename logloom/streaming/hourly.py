"""Hourly traffic as a windowed aggregate over a stream of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import mean, pct
from ..operators.aggregates import is_error, valid


def _instant(wall_clock: Column) -> Column:
    """A wall clock as an instant in UTC, whatever the session's zone: watermarks need one."""
    part = {p: F.date_part(F.lit(p), wall_clock) for p in ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND")}
    return F.make_timestamp(
        part["YEAR"], part["MONTH"], part["DAY"], part["HOUR"], part["MINUTE"], part["SECOND"], F.lit("UTC")
    )


def windowed_hourly_traffic(staged: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Hourly traffic, each hour once it is closed: `lateness` after the latest request seen.

    Two chained aggregations: per hour and client, then per hour. That counts
    clients exactly and spreads a busy hour over its clients, so the state of
    one hour is not held by one task. Requests later than `lateness` are not
    counted; `stream_hourly_traffic` counts them.
    """
    size = F.col("response_size")
    per_client = (
        valid(staged)
        .withColumn("at", _instant(F.col("requested_at")))
        .withWatermark("at", lateness)
        .groupBy(F.window("at", "1 hour"), "ip_address")
        .agg(
            F.count("*").alias("requests"),
            F.count_if(is_error()).alias("errors"),
            F.sum(size.cast("long")).alias("bytes"),
            F.count(size).alias("sized"),
            F.count_if(F.col("is_bot")).alias("bots"),
        )
    )
    requests, errors = F.sum("requests"), F.sum("errors")
    per_hour = per_client.groupBy(F.window(F.window_time("window"), "1 hour")).agg(
        requests.alias("total_requests"),
        F.count("*").alias("unique_ips"),
        errors.alias("error_count"),
        pct(errors, requests).alias("error_rate"),
        mean(F.sum("bytes"), F.sum("sized")).alias("avg_response_size"),
        F.sum("bots").alias("bot_requests"),
    )
    hours = F.floor(F.unix_seconds("window.start") / 3600)
    return per_hour.select(
        F.date_from_unix_date(F.floor(hours / 24).cast("int")).alias("request_date"),
        F.pmod(hours, F.lit(24)).cast("int").alias("request_hour"),
        "total_requests",
        "unique_ips",
        "error_count",
        "error_rate",
        "avg_response_size",
        "bot_requests",
    )
