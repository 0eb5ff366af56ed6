"""Latency and surge exploration over the extended staged schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import mean, pct
from ..operators.aggregates import is_error, valid
from ..operators.quantiles import merged_sketches, percentiles, percentiles_of_doubles, sketched_percentiles, sketches
from ..operators.ranking import rank_and_tile
from ..scratch import Scratch

# Windows without partition below run over one row per hour or day of the
# calendar, after aggregation: their input does not grow with the traffic.


def _day(as_of: dt.date | None) -> Column:
    """The day a query is asked for, by default the current date."""
    return F.current_date() if as_of is None else F.lit(as_of)


def traffic_rolling_3h(extended: DataFrame, hours: int = 3) -> DataFrame:
    """Per day and hour: requests, rolling mean over `hours` rows, change from the row before."""
    by_hour = valid(extended).groupBy("log_date", "log_hour").agg(F.count("*").alias("requests"))
    in_time = Window.orderBy("log_date", "log_hour")
    rolling = in_time.rowsBetween(-(hours - 1), Window.currentRow)
    rolling_mean = mean(F.sum("requests").over(rolling), F.count("requests").over(rolling))
    return by_hour.select(
        "log_date",
        "log_hour",
        "requests",
        rolling_mean.alias("rolling_avg_3h"),
        (F.col("requests") - F.lag("requests").over(in_time)).alias("delta_from_prev_hour"),
    ).orderBy("log_date", "log_hour")


def _latency(requests: DataFrame, scratch: Scratch, min_hits: int, fractions: dict[str, float]) -> DataFrame:
    """Per endpoint group and method with more than `min_hits` requests: hits, mean, maximum, percentiles.

    Whole milliseconds repeat, so requests are counted by response time first,
    once, and everything is taken from the counts.
    """
    keys = ["endpoint_group", "method"]
    counts = scratch.keep(requests.groupBy(*keys, "response_ms").agg(F.count("*").alias("n")), "latencies")
    timed = F.when(F.col("response_ms").isNotNull(), F.col("n"))
    stats = counts.groupBy(*keys).agg(
        F.sum("n").alias("hits"),
        mean(F.sum(F.col("response_ms").cast("long") * F.col("n")), F.sum(timed)).alias("avg_ms"),
        F.max("response_ms").alias("max_ms"),
    )
    group = F.struct(*keys)
    found = percentiles(counts, keys, "response_ms", "n", fractions).select(group.alias("group"), *fractions)
    return (
        stats.where(F.col("hits") > min_hits)
        .withColumn("group", group)
        .join(found, "group", "left")
        .select(*keys, "hits", "avg_ms", "max_ms", *fractions)
    )


FRACTIONS = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}


def response_time_percentiles(
    extended: DataFrame, scratch: Scratch, column: str, as_of: dt.date | None = None
) -> DataFrame:
    """Per endpoint group and method: requests, p50, p95, p99 and maximum of a column of doubles, of one day or of all."""
    rows = valid(extended) if as_of is None else valid(extended).where(F.col("log_date") == F.lit(as_of))
    keys = ["endpoint_group", "method"]
    rows = scratch.keep(rows.select(*keys, F.col(column).cast("double").alias("value")), "response-times")
    stats = rows.groupBy(*keys).agg(F.count("*").alias("total_requests"), F.max("value").alias("max_ms"))
    found = percentiles_of_doubles(rows, keys, "value", FRACTIONS, scratch)
    found = found.select(*[F.col(c).alias(f"of_{c}") for c in keys], *FRACTIONS)
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in keys]
    return stats.join(found, same, "left").select(*keys, "total_requests", *FRACTIONS, "max_ms")


def response_time_sketches(extended: DataFrame, column: str) -> DataFrame:
    """Per day, endpoint group and method a sketch of a column: kept, it spares later queries the requests."""
    return sketches(valid(extended), ["log_date", "endpoint_group", "method"], column)


def sketched_response_times(days: DataFrame) -> DataFrame:
    """Per endpoint group and method p50, p95 and p99 of all days of `response_time_sketches`, within the sketch's bound."""
    keys = ["endpoint_group", "method"]
    return sketched_percentiles(merged_sketches(days, keys), keys, FRACTIONS)


def latency_percentiles(extended: DataFrame, scratch: Scratch, as_of: dt.date | None = None) -> DataFrame:
    """Per endpoint group and method on one day: requests, mean, p50, p95, p99 and maximal response time."""
    of_day = valid(extended).where(F.col("log_date") == _day(as_of))
    fractions = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
    return (
        _latency(of_day, scratch, 0, fractions)
        .select(
            "endpoint_group", "method", F.col("hits").alias("total_requests"), "avg_ms", *fractions, "max_ms"
        )
        .orderBy(F.desc_nulls_first("p95_ms"), "endpoint_group", "method")
    )


def ip_threat_level(
    extended: DataFrame,
    min_requests: int = 200,
    min_error_rate: float = 20,
    medium: tuple[int, float] = (500, 30),
    high: tuple[int, float] = (1000, 50),
) -> DataFrame:
    """Per client and hour with many requests or errors: counts, error rate, threat level.

    HIGH exceeds both limits of `high`, MEDIUM either limit of `medium`.
    """
    requests, errors = F.count("*"), F.count_if(is_error())
    by_hour = (
        valid(extended)
        .groupBy("ip_address", "log_date", "log_hour")
        .agg(
            requests.alias("total_req"),
            errors.alias("error_req"),
            pct(errors, requests).alias("error_rate"),
            F.count_distinct("endpoint").alias("unique_endpoints"),
        )
    )
    total, rate = F.col("total_req"), F.col("error_rate")
    level = (
        F.when((total > high[0]) & (rate > high[1]), "HIGH")
        .when((total > medium[0]) | (rate > medium[1]), "MEDIUM")
        .otherwise("LOW")
    )
    return (
        by_hour.where((total > min_requests) | (rate > min_error_rate))
        .withColumn("threat_level", level)
        .orderBy(F.desc("total_req"), F.desc("error_rate"), "ip_address", "log_date", "log_hour")
    )


def error_surge(
    extended: DataFrame, as_of: dt.date | None = None, warning: int = 2, anomaly: int = 3
) -> DataFrame:
    """Server error rate of each hour of a day against the same hour on all earlier days.

    The hourly rates, their mean and their deviation are rounded before they
    are compared. Without a deviation (one earlier day) the status is NORMAL;
    an hour without earlier days is left out.
    """
    requests = F.count("*")
    by_hour = (
        valid(extended)
        .where(F.col("log_date") <= _day(as_of))
        .groupBy("log_date", "log_hour")
        .agg(pct(F.count_if(F.col("status_code") >= 500), requests).alias("current_rate"))
    )
    deviation = F.stddev_samp("current_rate").cast("decimal(20,10)")
    baseline = (
        by_hour.where(F.col("log_date") < _day(as_of))
        .groupBy("log_hour")
        .agg(
            F.round(F.avg("current_rate"), 2).alias("baseline_rate"),
            F.round(deviation, 2).alias("stddev_error_rate"),
        )
    )
    rate, usual, spread = F.col("current_rate"), F.col("baseline_rate"), F.col("stddev_error_rate")
    status = (
        F.when(rate > usual + anomaly * spread, "ANOMALY")
        .when(rate > usual + warning * spread, "WARNING")
        .otherwise("NORMAL")
    )
    # One row per hour of the day, 24 at most.
    return (
        by_hour.where(F.col("log_date") == _day(as_of))
        .join(F.broadcast(baseline), "log_hour")
        .select(
            "log_date",
            "log_hour",
            "current_rate",
            "baseline_rate",
            "stddev_error_rate",
            F.round(rate - usual, 2).alias("deviation"),
            status.alias("status"),
        )
        .orderBy("log_hour")
    )


def slowest_endpoints(
    extended: DataFrame,
    scratch: Scratch,
    as_of: dt.date | None = None,
    days: int = 7,
    min_hits: int = 50,
) -> DataFrame:
    """Endpoint groups and methods since `days` before a day: mean and p95 with their ranks, quartile.

    Groups of `min_hits` requests or fewer are left out; days after `as_of`
    count. Quartile 1 holds the slowest by p95.
    """
    recent = valid(extended).where(F.col("log_date") >= F.date_sub(_day(as_of), days))
    groups = _latency(recent, scratch, min_hits, {"p95_ms": 0.95}).drop("max_ms")
    return rank_and_tile(
        scratch.keep(groups, "endpoint-groups"),
        ranks={"rank_by_p95": "p95_ms", "rank_by_avg": "avg_ms"},
        tile_by="p95_ms",
        tiles=4,
        tile_name="quartile",
        unique=["endpoint_group", "method"],
        scratch=scratch,
    ).orderBy(F.desc_nulls_first("p95_ms"), "endpoint_group", "method")


def funnel_groups(extended: DataFrame) -> DataFrame:
    """Per day: requests below status 400 by page, api, checkout, purchase and the step rates.

    Counts per day, not sequences per visitor: a rate may exceed 100.
    """
    group = F.col("endpoint_group")
    counts = (
        valid(extended)
        .where(F.col("status_code") < 400)
        .groupBy("log_date")
        .agg(
            F.count_if(group == "/page").alias("page_views"),
            F.count_if(group == "/api").alias("api_calls"),
            F.count_if(group == "/checkout").alias("checkouts"),
            F.count_if(group == "/purchase").alias("purchases"),
        )
    )
    return counts.withColumns(
        {
            "page_to_api_pct": pct(F.col("api_calls"), F.col("page_views")),
            "api_to_checkout_pct": pct(F.col("checkouts"), F.col("api_calls")),
            "checkout_to_purchase_pct": pct(F.col("purchases"), F.col("checkouts")),
        }
    ).orderBy(F.desc("log_date"))
