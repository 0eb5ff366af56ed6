"""Requests and log lines out of a table of user events.

For trying the engine on event data: every event becomes one request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SHOP_PATHS = """
    CASE event_type
        WHEN 'view' THEN '/index.html'
        WHEN 'click' THEN concat('/products/', event_id % 20, '?k=', event_id % 7)
        WHEN 'signup' THEN '/cart'
        WHEN 'purchase' THEN '/checkout'
        WHEN 'error' THEN concat('/api/', event_id % 5)
    END"""

# Paths whose first segment is a step of the group funnel.
GROUPED_PATHS = """
    CASE event_type
        WHEN 'view' THEN '/page'
        WHEN 'click' THEN concat('/api/products/', event_id % 20, '?k=', event_id % 7)
        WHEN 'signup' THEN '/checkout'
        WHEN 'purchase' THEN '/purchase/done'
        WHEN 'error' THEN concat('/api/', event_id % 5)
    END"""


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def requests(events: DataFrame, paths: str = SHOP_PATHS) -> DataFrame:
    """Raw requests: visits to a shop, some failing, some with a bad method or status."""
    return events.selectExpr(
        "event_id AS id",
        "concat('10.0.', user_id div 64, '.', user_id % 64) AS ip_address",
        """CASE WHEN event_id % 97 = 0 THEN 'FOO'
                WHEN event_type = 'purchase' THEN 'POST'
                ELSE 'GET' END AS method""",
        f"{paths} AS path",
        "'HTTP/1.1' AS protocol",
        """CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 3 = 0 THEN 500 ELSE 404 END
                WHEN event_id % 11 = 0 THEN 302
                WHEN event_id % 131 = 0 THEN 700
                ELSE 200 END AS status_code""",
        "bigint(round(value * 100)) AS response_size",
        "string(NULL) AS referer",
        """CASE event_id % 6
                WHEN 0 THEN 'Googlebot/2.1'
                WHEN 1 THEN 'curl/8.0'
                WHEN 2 THEN 'Python-urllib/3.11'
                WHEN 3 THEN ''
                WHEN 4 THEN 'Opera/9'
                ELSE 'Mozilla/5.0' END AS user_agent""",
        "ts AS requested_at",
        "bigint(floor(value * 10)) AS response_ms",
    )


# A request as a Combined log line in whole seconds, the response time at its end.
LOG_LINE = """
    concat(ip_address, ' - - [', date_format(requested_at, 'dd/MMM/yyyy:HH:mm:ss'), ' +0700] "',
           method, ' ', path, ' ', protocol, '" ', status_code, ' ', response_size, ' "',
           coalesce(referer, '-'), '" "', user_agent, '" ', response_ms)"""


def log_lines(requests: DataFrame) -> DataFrame:
    return requests.selectExpr(f"{LOG_LINE} AS value")
