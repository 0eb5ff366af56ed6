"""The four aggregate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import mean_of, pct, share
from ..scratch import Scratch
from .lookup import skew_lookup
from .ranking import count_standings


def is_error() -> Column:
    return F.col("status_code") >= 400


def valid(staged: DataFrame) -> DataFrame:
    return staged.where("is_valid")


def hourly_traffic(staged: DataFrame) -> DataFrame:
    """Per day and hour: requests, clients, errors, mean size, bot requests."""
    requests, errors = F.count("*"), F.count_if(is_error())
    return (
        valid(staged)
        .groupBy("request_date", "request_hour")
        .agg(
            requests.alias("total_requests"),
            F.count_distinct("ip_address").alias("unique_ips"),
            errors.alias("error_count"),
            pct(errors, requests).alias("error_rate"),
            mean_of(F.col("response_size")).alias("avg_response_size"),
            F.count_if(F.col("is_bot")).alias("bot_requests"),
        )
    )


def endpoint_stats(staged: DataFrame, scratch: Scratch) -> DataFrame:
    """Per day and endpoint: hits by outcome, mean size, rank by hits within the day.

    See `endpoint_ranks` for the ranks.
    """
    return endpoint_ranks(
        valid(staged)
        .where(F.col("endpoint").isNotNull())
        .groupBy(F.col("request_date").alias("report_date"), "endpoint")
        .agg(
            F.count("*").alias("total_hits"),
            F.count_if(F.col("status_code") < 400).alias("success_hits"),
            F.count_if(is_error()).alias("error_hits"),
            F.count_if(F.col("status_code") == 404).alias("not_found_hits"),
            mean_of(F.col("response_size")).alias("avg_size"),
        ),
        scratch,
    )


def endpoint_ranks(stats: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds hit_rank, the rank by total_hits within report_date.

    The rank is looked up from the day's distinct hit counts, so no task sorts
    all endpoints of a day. Most endpoints of a day may share one count, a hit
    each, so the lookup splits hot counts. The rows are kept for both.
    """
    stats = scratch.keep(stats, "endpoints")
    standings = count_standings(stats, "total_hits", ["report_date"], "tied")
    ranks = standings.select("report_date", "total_hits", F.col("rank").alias("hit_rank"), "tied")
    found = skew_lookup(stats, scratch.keep(ranks, "ranks"), ["report_date", "total_hits"], "tied", ["endpoint"], "inner")
    return found.select(*stats.columns, "hit_rank")


def ip_days(staged: DataFrame) -> DataFrame:
    """Per day and client: requests, errors, bot requests, endpoints, error rate."""
    requests, errors = F.count("*"), F.count_if(is_error())
    return (
        valid(staged)
        .groupBy("request_date", "ip_address")
        .agg(
            requests.alias("total_requests"),
            errors.alias("error_requests"),
            F.count_if(F.col("is_bot")).alias("bot_signals"),
            F.count_distinct("endpoint").alias("unique_endpoints"),
            pct(errors, requests).alias("error_rate"),
        )
    )


def volume_thresholds(days: DataFrame, fractions: tuple[float, ...]) -> DataFrame:
    """One row, one array: interpolated percentiles of `total_requests` over all days and clients."""
    return thresholds_of(volumes(days), fractions)


def thresholds_of(histograms: DataFrame, fractions: tuple[float, ...]) -> DataFrame:
    """`volume_thresholds` from `volumes`. Equal counts are merged first; see `count_standings` for how few remain."""
    merged = histograms.groupBy("total_requests").agg(F.sum("tied").alias("tied"))
    at = F.array(*[F.lit(f) for f in fractions])
    return merged.agg(F.percentile("total_requests", at, F.col("tied")).alias("thresholds"))


def volumes(days: DataFrame) -> DataFrame:
    """Per day the histogram of its clients' `total_requests`; histograms of days add up."""
    return days.groupBy("request_date", "total_requests").agg(F.count("*").alias("tied"))


def ip_anomalies(
    days: DataFrame, watch: float = 0.95, alarm: float = 0.99, error_limit: float = 50
) -> DataFrame:
    """Clients above the `watch` percentile of daily volume or the error limit.

    Suspicious are those above the `alarm` percentile or the error limit. The
    percentiles come from the same `ip_days` over all days, which should be a
    written table since it is read for both.
    """
    limits = volume_thresholds(days, (watch, alarm))
    return anomalies_above(days, limits.scalar()[0], limits.scalar()[1], error_limit)


def anomalies_above(days: DataFrame, watch: Column, alarm: Column, error_limit: float = 50) -> DataFrame:
    """`ip_anomalies` with given limits of volume; each row depends on itself and the limits alone."""
    above_watch = F.col("total_requests") > watch
    above_alarm = F.col("total_requests") > alarm
    failing = F.col("error_rate") > error_limit
    reason = F.when(above_alarm, "Volume > p99 threshold").when(failing, "Error rate > 50%")
    return (
        days.where(above_watch | failing)
        .withColumn("anomaly_reason", reason)
        .select(
            F.col("request_date").alias("report_date"),
            "ip_address",
            "total_requests",
            "error_requests",
            "error_rate",
            "unique_endpoints",
            F.col("anomaly_reason").isNotNull().alias("is_suspicious"),
            "anomaly_reason",
        )
    )


def data_quality_report(staged: DataFrame) -> DataFrame:
    """Per day, over valid and invalid requests: failed checks, duplicates, a score of 0 to 100.

    Duplicates agree in client, time and path, NULL being a value like any
    other. Requests without a date are left out.

    Finding duplicates shuffles nearly every request, so that shuffle carries
    nothing but what they agree in; the checks are counted in a second pass,
    over other columns, that shuffles one row per task and day.
    """
    dated = staged.where(F.col("request_date").isNotNull())
    copies = dated.groupBy("request_date", "ip_address", "requested_at", "path").agg(
        F.count("*").alias("copies")
    )
    duplicates = copies.groupBy("request_date").agg(F.sum(F.col("copies") - 1).alias("duplicate_count"))
    reason = F.col("invalid_reason")
    checks = dated.groupBy("request_date").agg(
        F.count("*").alias("total_raw"),
        F.count_if(F.col("is_valid")).alias("total_valid"),
        F.count_if(~F.col("is_valid")).alias("total_invalid"),
        F.count_if(F.col("ip_address").isNull()).alias("null_ip_count"),
        F.count_if(reason.startswith("Invalid method")).alias("invalid_method"),
        F.count_if(reason.startswith("Invalid status")).alias("invalid_status"),
    )
    requests, invalid = F.col("total_raw"), F.col("total_invalid")
    score = F.round(100 - share(invalid, requests) - share(F.col("duplicate_count"), requests) / 2, 2)
    return checks.join(duplicates, "request_date").select(
        F.col("request_date").alias("report_date"),
        "total_raw",
        "total_valid",
        "total_invalid",
        pct(invalid, requests).alias("invalid_rate"),
        "null_ip_count",
        "invalid_method",
        "invalid_status",
        "duplicate_count",
        F.greatest(F.lit(0), score).alias("quality_score"),
    )
