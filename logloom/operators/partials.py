"""Mergeable aggregates: what one load adds, kept, and the tables made of the sums of all loads.

A load's requests are read once. What later loads need of them, for exact
distinct counts as well, are these much shorter rows, which add up however
the loads overlap, however late they are and in whatever order they come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import mean, pct
from ..scratch import Scratch
from .aggregates import endpoint_ranks, is_error, valid


def _sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def _sizes() -> list[Column]:
    return [F.sum("response_size").alias("bytes"), F.count("response_size").alias("sized")]


def hour_clients(staged: DataFrame) -> DataFrame:
    """Per hour, client and load: requests, errors, sizes, bot requests."""
    return valid(staged).groupBy("request_date", "request_hour", "ip_address", "load_id").agg(
        F.count("*").alias("requests"), F.count_if(is_error()).alias("errors"), *_sizes(), F.count_if(F.col("is_bot")).alias("bots")
    )


def hourly_traffic_of(clients: DataFrame) -> DataFrame:
    """`hourly_traffic` from `hour_clients` of all loads: a client counts once an hour, whatever loads it is in."""
    once = clients.groupBy("request_date", "request_hour", "ip_address").agg(*_sums("requests", "errors", "bytes", "sized", "bots"))
    requests, errors = F.sum("requests"), F.sum("errors")
    return once.groupBy("request_date", "request_hour").agg(
        requests.alias("total_requests"),
        F.count("ip_address").alias("unique_ips"),
        errors.alias("error_count"),
        pct(errors, requests).alias("error_rate"),
        mean(F.sum("bytes"), F.sum("sized")).alias("avg_response_size"),
        F.sum("bots").alias("bot_requests"),
    )


def endpoint_days(staged: DataFrame) -> DataFrame:
    """Per day, endpoint and load: hits by outcome, sizes."""
    known = valid(staged).where(F.col("endpoint").isNotNull())
    return known.groupBy("request_date", "endpoint", "load_id").agg(
        F.count("*").alias("hits"),
        F.count_if(F.col("status_code") < 400).alias("successes"),
        F.count_if(is_error()).alias("errors"),
        F.count_if(F.col("status_code") == 404).alias("not_found"),
        *_sizes(),
    )


def endpoint_stats_of(days: DataFrame, scratch: Scratch) -> DataFrame:
    """`endpoint_stats` from `endpoint_days` of all loads."""
    sums = days.groupBy(F.col("request_date").alias("report_date"), "endpoint").agg(
        F.sum("hits").alias("total_hits"),
        F.sum("successes").alias("success_hits"),
        F.sum("errors").alias("error_hits"),
        F.sum("not_found").alias("not_found_hits"),
        mean(F.sum("bytes"), F.sum("sized")).alias("avg_size"),
    )
    return endpoint_ranks(sums, scratch)


def client_endpoints(staged: DataFrame) -> DataFrame:
    """Per day, client, endpoint and load: requests, errors, bot requests."""
    return valid(staged).groupBy("request_date", "ip_address", "endpoint", "load_id").agg(
        F.count("*").alias("requests"), F.count_if(is_error()).alias("errors"), F.count_if(F.col("is_bot")).alias("bots")
    )


def ip_days_of(clients: DataFrame) -> DataFrame:
    """`ip_days` from `client_endpoints` of all loads."""
    once = clients.groupBy("request_date", "ip_address", "endpoint").agg(*_sums("requests", "errors", "bots"))
    requests, errors = F.sum("requests"), F.sum("errors")
    return once.groupBy("request_date", "ip_address").agg(
        requests.alias("total_requests"),
        errors.alias("error_requests"),
        F.sum("bots").alias("bot_signals"),
        F.count("endpoint").alias("unique_endpoints"),
        pct(errors, requests).alias("error_rate"),
    )


PARTIALS = {"hour_clients": hour_clients, "endpoint_days": endpoint_days, "client_endpoints": client_endpoints}

