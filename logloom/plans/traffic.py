"""Traffic exploration: endpoints, hours, clients, status classes, funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numbers import mean_of, pct, share
from ..operators.aggregates import ip_days, is_error, valid, volume_thresholds
from ..operators.ranking import count_standings
from ..scratch import Scratch

# Windows without partition below run over one row per hour or day of the
# calendar, after aggregation: their input does not grow with the traffic.


def top_endpoints_running_total(staged: DataFrame, scratch: Scratch, top: int = 10) -> DataFrame:
    """The most requested endpoints with rank, share of all traffic and running total."""
    counts = scratch.keep(
        valid(staged)
        .groupBy("endpoint")
        .agg(
            F.count("*").alias("total_hits"),
            F.count_if(is_error()).alias("error_hits"),
            mean_of(F.col("response_size")).alias("avg_size"),
        ),
        "endpoint-counts",
    )
    order = [F.desc("total_hits"), F.asc_nulls_last("endpoint")]
    leaders = counts.orderBy(*order).limit(top)
    return (
        count_standings(counts, "total_hits")
        .join(leaders, "total_hits")
        .select(
            "endpoint",
            "total_hits",
            "error_hits",
            "avg_size",
            F.col("rank").alias("hit_rank"),
            "grand_total",
            pct(F.col("total_hits"), F.col("grand_total")).alias("traffic_pct"),
            "running_total",
        )
        .orderBy(*order)
    )


def hourly_pattern(staged: DataFrame) -> DataFrame:
    """Per hour of the day: requests, visitors, errors, mean size, change from the hour before."""
    by_hour = (
        valid(staged)
        .groupBy("request_hour")
        .agg(
            F.count("*").alias("total_requests"),
            F.count_distinct("ip_address").alias("unique_visitors"),
            F.count_if(is_error()).alias("errors"),
            mean_of(F.col("response_size"), 0).alias("avg_size"),
        )
    )
    previous = F.lag("total_requests").over(Window.orderBy("request_hour"))
    change = F.col("total_requests") - F.col("prev_hour_requests")
    return (
        by_hour.withColumn("prev_hour_requests", previous)
        .withColumn("pct_change_vs_prev_hour", pct(change, F.col("prev_hour_requests")))
        .orderBy("request_hour")
    )


def ip_anomaly_explore(
    staged: DataFrame,
    scratch: Scratch,
    top: int = 20,
    watch: float = 0.95,
    alarm: float = 0.99,
    error_limit: float = 50,
    busy_error_limit: float = 30,
) -> DataFrame:
    """The busiest client days that are above the `watch` percentile or the error limit, with a reason."""
    days = scratch.keep(ip_days(staged), "ip-days")
    limits = volume_thresholds(days, (watch, alarm))
    requests, error_rate = F.col("total_requests"), F.col("error_rate")
    busy, extreme = requests > limits.scalar()[0], requests > limits.scalar()[1]
    reason = (
        F.when(extreme, "Extremely high volume (>p99)")
        .when(error_rate > error_limit, "High error rate (>50%)")
        .when(busy & (error_rate > busy_error_limit), "High volume + errors")
    )
    return (
        days.where(busy | (error_rate > error_limit))
        .select(
            "ip_address",
            "request_date",
            requests.alias("total_req"),
            F.col("error_requests").alias("error_req"),
            "unique_endpoints",
            "bot_signals",
            "error_rate",
            limits.scalar()[0].alias("p95_requests"),
            reason.alias("anomaly_reason"),
        )
        .orderBy(F.desc("total_req"), "request_date", "ip_address")
        .limit(top)
    )


def status_trend(staged: DataFrame, days: int = 7) -> DataFrame:
    """Per day: requests by status class, server error rate, rolling mean error rate over `days` rows."""
    classes = {f"s_{c}": F.count_if(F.col("status_class") == c) for c in ("2xx", "3xx", "4xx", "5xx")}
    requests = F.count("*")
    by_day = (
        valid(staged)
        .groupBy("request_date")
        .agg(
            *[count.alias(name) for name, count in classes.items()],
            requests.alias("total"),
            pct(F.count_if(F.col("status_code") >= 500), requests).alias("server_error_rate"),
            share(F.count_if(is_error()), requests).alias("error_share"),
        )
    )
    rolling = Window.orderBy("request_date").rowsBetween(-(days - 1), Window.currentRow)
    return (
        by_day.withColumn("rolling_7d_error_rate", F.round(F.avg("error_share").over(rolling), 2))
        .drop("error_share")
        .orderBy("request_date")
    )


def funnel_paths(staged: DataFrame) -> DataFrame:
    """Per day: successful visits to home, products, cart, checkout and the step rates.

    Counts per day, not sequences per visitor: a rate may exceed 100.
    """
    path = F.col("path")
    counts = (
        valid(staged)
        .where(F.col("status_code") == 200)
        .groupBy("request_date")
        .agg(
            F.count_if(path.isin("/index.html", "/")).alias("home_visits"),
            F.count_if(path.startswith("/products")).alias("product_views"),
            F.count_if(path == "/cart").alias("cart_adds"),
            F.count_if(path == "/checkout").alias("checkouts"),
        )
    )
    return counts.withColumns(
        {
            "home_to_product_pct": pct(F.col("product_views"), F.col("home_visits")),
            "product_to_cart_pct": pct(F.col("cart_adds"), F.col("product_views")),
            "cart_to_checkout_pct": pct(F.col("checkouts"), F.col("cart_adds")),
        }
    ).orderBy("request_date")


def client_breakdown(staged: DataFrame) -> DataFrame:
    """Per day and client type: requests, clients, mean size, share of the day."""
    by_type = (
        valid(staged)
        .groupBy("request_date", "client_type")
        .agg(
            F.count("*").alias("total_requests"),
            F.count_distinct("ip_address").alias("unique_ips"),
            mean_of(F.col("response_size"), 0).alias("avg_response_size"),
        )
    )
    # Four client types per day.
    of_day = F.sum("total_requests").over(Window.partitionBy("request_date"))
    return by_type.withColumn("pct_of_day", pct(F.col("total_requests"), of_day)).orderBy(
        "request_date", F.desc("total_requests"), "client_type"
    )
