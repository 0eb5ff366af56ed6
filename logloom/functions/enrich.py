"""Columns derived from a parsed request."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The words and ranges requests are classified and checked by.
BOT_KEYWORDS = [
    "bot", "crawler", "spider", "scraper", "curl", "wget",
    "python-requests", "java/", "go-http", "googlebot",
    "bingbot", "yandex", "baidu", "slurp", "duckduck",
]
BROWSER_KEYWORDS = ["mozilla", "webkit"]
API_KEYWORDS = ["python", "java", "go-http"]
VALID_METHODS = ["GET", "POST", "PUT", "DELETE", "PATCH", "HEAD", "OPTIONS"]
VALID_STATUS = (100, 599)


def _mentions(text: Column, keywords: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(k) for k in keywords])


def client_type(user_agent: Column) -> Column:
    agent = F.lower(F.coalesce(user_agent, F.lit("")))
    return (
        F.when(_mentions(agent, BOT_KEYWORDS), "bot")
        .when(_mentions(agent, BROWSER_KEYWORDS), "browser")
        .when(_mentions(agent, API_KEYWORDS), "api_client")
        .otherwise("unknown")
    )


def endpoint(path: Column) -> Column:
    """The path without its query string; NULL for a NULL or empty path."""
    return F.when(path != "", F.substring_index(path, "?", 1))


def endpoint_group(endpoint: Column) -> Column:
    """'/' and the first segment of the endpoint."""
    return F.concat(F.lit("/"), F.substring_index(F.ltrim(endpoint, F.lit("/")), "/", 1))


def status_class(status: Column) -> Column:
    return F.when(status != 0, F.concat(F.left(status.cast("string"), F.lit(1)), F.lit("xx")))


def _told(what: str, value: Column) -> Column:
    return F.concat(F.lit(f"Invalid {what}: "), F.coalesce(value.cast("string"), F.lit("None")))


def invalid_reason(ip: Column, method: Column, status: Column, requested_at: Column) -> Column:
    """The first failed check, or NULL for a valid request."""
    known_method = F.coalesce(method.isin(VALID_METHODS), F.lit(False))
    known_status = F.coalesce(status.between(*VALID_STATUS), F.lit(False))
    return (
        F.when(F.coalesce(ip, F.lit("")) == "", "Missing IP")
        .when(~known_method, _told("method", method))
        .when(~known_status, _told("status", status))
        .when(requested_at.isNull(), "Missing timestamp")
    )
