"""Lines to raw requests, raw requests to staged requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import enrich
from ..functions.line_format import GROUPS, captured, fields_of

PARSED = [
    "ip_address", "method", "path", "protocol", "status_code",
    "response_size", "referer", "user_agent", "requested_at", "response_ms",
]


def _captured_once(lines: DataFrame, *keep: str) -> DataFrame:
    # `explode` of a single element keeps later filters above the expression:
    # pushed below a plain projection, they would take along copies of it.
    return lines.select(*keep, F.explode(F.array(captured(F.col("value")))).alias("found"))


def _convertible() -> Column:
    return F.col("requested_at").isNotNull() & F.col("response_size").isNotNull()


def parse_lines(lines: DataFrame, max_path: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every line with `parse_ok` and its fields, which only count where `parse_ok` holds, and the columns `keep`."""
    found = _captured_once(lines, "value", *keep)
    parts = found.select("value", *keep, F.when(F.size("found") == GROUPS, F.col("found")).alias("parts"))
    typed = parts.select(
        "value",
        *keep,
        F.col("parts").isNotNull().alias("matched"),
        *[column.alias(name) for name, column in fields_of(F.col("parts"), max_path).items()],
    )
    return typed.select("value", *keep, (F.col("matched") & _convertible()).alias("parse_ok"), *PARSED)


def parse_access_log(lines: DataFrame, max_path: int | None = None) -> DataFrame:
    """The accepted lines of a DataFrame with a `value` column, as typed requests; `max_path` cuts long paths."""
    parts = _captured_once(lines).where(F.size("found") == GROUPS).withColumnRenamed("found", "parts")
    typed = parts.select(*[column.alias(name) for name, column in fields_of(F.col("parts"), max_path).items()])
    return typed.where(_convertible())


def parse_rejects(lines: DataFrame) -> DataFrame:
    """The lines `parse_access_log` leaves out."""
    return parse_lines(lines).where(~F.col("parse_ok")).select("value")


def with_ids(requests: DataFrame, first_id: int) -> DataFrame:
    """Unique ids from `first_id` on. Write the result once: a second run may number otherwise."""
    return requests.withColumn("id", F.lit(first_id).cast("long") + F.monotonically_increasing_id())


def classify_client(requests: DataFrame) -> DataFrame:
    """Adds `client_type` and `is_bot`."""
    kind = requests.withColumn("client_type", enrich.client_type(F.col("user_agent")))
    return kind.withColumn("is_bot", F.col("client_type") == "bot")


def validate_logs(requests: DataFrame) -> DataFrame:
    """Adds `invalid_reason`, the first failed check, and `is_valid`."""
    reason = enrich.invalid_reason(
        F.col("ip_address"), F.col("method"), F.col("status_code"), F.col("requested_at")
    )
    return requests.withColumn("invalid_reason", reason).withColumn(
        "is_valid", F.col("invalid_reason").isNull()
    )


def stage_logs(raw: DataFrame) -> DataFrame:
    """Staged requests: enriched, checked, with date and hour. One narrow projection."""
    staged = validate_logs(classify_client(raw)).withColumns(
        {
            "endpoint": enrich.endpoint(F.col("path")),
            "status_class": enrich.status_class(F.col("status_code")),
            "request_date": F.to_date("requested_at"),
            "request_hour": F.hour("requested_at"),
        }
    )
    carried = [c for c in ("response_ms", "load_id") if c in raw.columns]
    return staged.select(
        "id", "ip_address", "method", "path", "endpoint", "status_code", "status_class",
        "response_size", "referer", "user_agent", "is_bot", "client_type", "requested_at",
        "request_date", "request_hour", "is_valid", "invalid_reason", *carried,
    )


def id_bitmaps(rows: DataFrame) -> DataFrame:
    """The ids of `rows` as (bucket, bits): one bit an id, 32,768 of them to a row; null ids are left out."""
    bucket = F.bitmap_bucket_number("id").alias("bucket")
    known = rows.where(F.col("id").isNotNull())
    return known.groupBy(bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def not_yet_staged(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Raw requests whose id is not among the staged ones; those without id are never staged.

    The staged ids are merged to bitmaps where they are read, so a bit of
    each is shuffled instead of the id, and a raw request meets one bitmap,
    whatever the number of loads, repeated ids or gaps between ids.
    """
    bits = F.col("staged_ids.bits")
    place = F.bitmap_bit_position("new.id").cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, place % 8).bitwiseAND(F.lit(1)) == 1
    same = (F.bitmap_bucket_number("new.id") == F.col("staged_ids.bucket")) & ((F.bitmap_count(bits) == 32_768) | is_set)
    return raw.alias("new").join(id_bitmaps(staged).alias("staged_ids"), same, "left_anti")


def extended(staged: DataFrame) -> DataFrame:
    """The names the latency suite uses for date and hour, and the endpoint group."""
    return staged.withColumns(
        {
            "log_date": F.col("request_date"),
            "log_hour": F.col("request_hour"),
            "endpoint_group": enrich.endpoint_group(F.col("endpoint")),
        }
    )
