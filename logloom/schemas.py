"""Schemas of the table layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_RATE = T.DecimalType(5, 2)
_MEAN = T.DecimalType(20, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW = _schema(
    ("id", T.LongType()),
    ("ip_address", T.StringType()),
    ("method", T.StringType()),
    ("path", T.StringType()),
    ("protocol", T.StringType()),
    ("status_code", T.IntegerType()),
    ("response_size", T.LongType()),
    ("referer", T.StringType()),
    ("user_agent", T.StringType()),
    ("requested_at", T.TimestampNTZType()),
    ("ingested_at", T.TimestampType()),
    ("response_ms", T.LongType()),
    ("load_id", T.LongType()),
)

# Raw requests as they are stored: their ids follow from where they lie, see LogTables.raw.
STORED = T.StructType(
    [f for f in RAW.fields if f.name != "id"]
    + [T.StructField("task", T.IntegerType()), T.StructField("log_file", T.StringType()), T.StructField("log_block", T.LongType())]
)

# The requests that a task wrote out of one split of a log: the first one's row in its file and its id.
PIECES = _schema(
    ("load_id", T.LongType()),
    ("task", T.IntegerType()),
    ("place", T.LongType()),
    ("first_row", T.LongType()),
    ("first_id", T.LongType()),
    ("size", T.LongType()),
)

REJECTS = _schema(("load_id", T.LongType()), ("value", T.StringType()))

STAGED = _schema(
    ("id", T.LongType()),
    ("ip_address", T.StringType()),
    ("method", T.StringType()),
    ("path", T.StringType()),
    ("endpoint", T.StringType()),
    ("status_code", T.IntegerType()),
    ("status_class", T.StringType()),
    ("response_size", T.LongType()),
    ("referer", T.StringType()),
    ("user_agent", T.StringType()),
    ("is_bot", T.BooleanType()),
    ("client_type", T.StringType()),
    ("requested_at", T.TimestampNTZType()),
    ("request_date", T.DateType()),
    ("request_hour", T.IntegerType()),
    ("is_valid", T.BooleanType()),
    ("invalid_reason", T.StringType()),
    ("response_ms", T.LongType()),
    ("load_id", T.LongType()),
)

HOURLY_TRAFFIC = _schema(
    ("request_date", T.DateType()),
    ("request_hour", T.IntegerType()),
    ("total_requests", T.LongType()),
    ("unique_ips", T.LongType()),
    ("error_count", T.LongType()),
    ("error_rate", _RATE),
    ("avg_response_size", _MEAN),
    ("bot_requests", T.LongType()),
)

ENDPOINT_STATS = _schema(
    ("report_date", T.DateType()),
    ("endpoint", T.StringType()),
    ("total_hits", T.LongType()),
    ("success_hits", T.LongType()),
    ("error_hits", T.LongType()),
    ("not_found_hits", T.LongType()),
    ("avg_size", _MEAN),
    ("hit_rank", T.LongType()),
)

IP_ANOMALIES = _schema(
    ("report_date", T.DateType()),
    ("ip_address", T.StringType()),
    ("total_requests", T.LongType()),
    ("error_requests", T.LongType()),
    ("error_rate", _RATE),
    ("unique_endpoints", T.LongType()),
    ("is_suspicious", T.BooleanType()),
    ("anomaly_reason", T.StringType()),
)

DATA_QUALITY = _schema(
    ("report_date", T.DateType()),
    ("total_raw", T.LongType()),
    ("total_valid", T.LongType()),
    ("total_invalid", T.LongType()),
    ("invalid_rate", _RATE),
    ("null_ip_count", T.LongType()),
    ("invalid_method", T.LongType()),
    ("invalid_status", T.LongType()),
    ("duplicate_count", T.LongType()),
    ("quality_score", _RATE),
)

# Per day and client: what the anomaly rules are evaluated on.
IP_DAYS = _schema(
    ("request_date", T.DateType()),
    ("ip_address", T.StringType()),
    ("total_requests", T.LongType()),
    ("error_requests", T.LongType()),
    ("bot_signals", T.LongType()),
    ("unique_endpoints", T.LongType()),
    ("error_rate", _RATE),
)


# Per day: how many clients made so many requests.
VOLUME_DAYS = _schema(("request_date", T.DateType()), ("total_requests", T.LongType()), ("tied", T.LongType()))

# What a load adds; see operators.partials. Split by day and load.
_SIZES = (("bytes", T.LongType()), ("sized", T.LongType()))
PARTIALS = {
    "hour_clients": _schema(
        ("request_hour", T.IntegerType()), ("ip_address", T.StringType()), ("requests", T.LongType()), ("errors", T.LongType()),
        *_SIZES, ("bots", T.LongType()), ("request_date", T.DateType()), ("load_id", T.LongType()),
    ),
    "endpoint_days": _schema(
        ("endpoint", T.StringType()), ("hits", T.LongType()), ("successes", T.LongType()), ("errors", T.LongType()),
        ("not_found", T.LongType()), *_SIZES, ("request_date", T.DateType()), ("load_id", T.LongType()),
    ),
    "client_endpoints": _schema(
        ("ip_address", T.StringType()), ("endpoint", T.StringType()), ("requests", T.LongType()), ("errors", T.LongType()),
        ("bots", T.LongType()), ("request_date", T.DateType()), ("load_id", T.LongType()),
    ),
}


@dataclass(frozen=True)
class Table:
    """A keyed table: its files are split by day, or by month where a day holds few rows."""

    schema: T.StructType
    keys: tuple[str, ...]
    date_column: str
    by_month: bool = False


TABLES = {
    "agg_hourly_traffic": Table(
        HOURLY_TRAFFIC, ("request_date", "request_hour"), "request_date", by_month=True
    ),
    "agg_endpoint_stats": Table(ENDPOINT_STATS, ("report_date", "endpoint"), "report_date"),
    "agg_ip_anomalies": Table(IP_ANOMALIES, ("report_date", "ip_address"), "report_date"),
    "data_quality_report": Table(DATA_QUALITY, ("report_date",), "report_date", by_month=True),
    "ip_days": Table(IP_DAYS, ("request_date", "ip_address"), "request_date"),
    "volume_days": Table(VOLUME_DAYS, ("request_date", "total_requests"), "request_date"),
}
