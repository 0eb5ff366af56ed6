"""DuckDB SQL with the results expected of `__spark_entry__.queries()`.

Rates and means are rounded in integers, so that no binary fraction decides a tie.
"""

from __future__ import annotations

AS_OF = "DATE '2024-01-30'"
MIDDLE = "requested_at < TIMESTAMP '2024-01-16 12:00:00'"


def pct(part: str, total: str) -> str:
    """100 * part / total to two decimals, for part >= 0."""
    return f"CAST((({part}) * 20000 + ({total})) // NULLIF(2 * ({total}), 0) AS DOUBLE) / 100"


def signed_pct(part: str, total: str) -> str:
    return f"CASE WHEN {part} < 0 THEN -({pct(f'-({part})', total)}) ELSE {pct(part, total)} END"


def mean(total: str, count: str, digits: int = 2) -> str:
    scale = 10**digits
    return f"CAST((({total}) * {2 * scale} + ({count})) // NULLIF(2 * ({count}), 0) AS DOUBLE) / {scale}"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def day(value: str) -> str:
    return f"CAST({value} AS VARCHAR)"


def time(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S.%f')"


REQUESTS = """
    SELECT event_id AS id,
           '10.0.' || (user_id // 64) || '.' || (user_id % 64) AS ip_address,
           CASE WHEN event_id % 97 = 0 THEN 'FOO'
                WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
           CASE event_type WHEN 'view' THEN '/index.html'
                WHEN 'click' THEN '/products/' || (event_id % 20) || '?k=' || (event_id % 7)
                WHEN 'signup' THEN '/cart' WHEN 'purchase' THEN '/checkout'
                WHEN 'error' THEN '/api/' || (event_id % 5) END AS path,
           'HTTP/1.1' AS protocol,
           CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 3 = 0 THEN 500 ELSE 404 END
                WHEN event_id % 11 = 0 THEN 302
                WHEN event_id % 131 = 0 THEN 700 ELSE 200 END AS status_code,
           CAST(round(value * 100) AS BIGINT) AS response_size,
           CAST(NULL AS VARCHAR) AS referer,
           CASE event_id % 6 WHEN 0 THEN 'Googlebot/2.1' WHEN 1 THEN 'curl/8.0'
                WHEN 2 THEN 'Python-urllib/3.11' WHEN 3 THEN ''
                WHEN 4 THEN 'Opera/9' ELSE 'Mozilla/5.0' END AS user_agent,
           ts AS requested_at,
           CAST(floor(value * 10) AS BIGINT) AS response_ms,
           event_type
    FROM events"""

STAGED = f"""
    SELECT *,
           CASE WHEN path <> '' THEN split_part(path, '?', 1) END AS endpoint,
           CASE WHEN status_code <> 0 THEN left(CAST(status_code AS VARCHAR), 1) || 'xx' END AS status_class,
           client_type = 'bot' AS is_bot,
           CAST(requested_at AS DATE) AS request_date,
           CAST(hour(requested_at) AS INTEGER) AS request_hour,
           invalid_reason IS NULL AS is_valid
    FROM (
        SELECT *,
               CASE WHEN regexp_matches(lower(user_agent),
                        'bot|crawler|spider|scraper|curl|wget|python-requests|java/|go-http|yandex|baidu|slurp|duckduck')
                    THEN 'bot'
                    WHEN regexp_matches(lower(user_agent), 'mozilla|webkit') THEN 'browser'
                    WHEN regexp_matches(lower(user_agent), 'python|java') THEN 'api_client'
                    ELSE 'unknown' END AS client_type,
               CASE WHEN ip_address IS NULL THEN 'Missing IP'
                    WHEN method NOT IN ('GET', 'POST', 'PUT', 'DELETE', 'PATCH', 'HEAD', 'OPTIONS')
                    THEN 'Invalid method: ' || method
                    WHEN status_code NOT BETWEEN 100 AND 599 THEN 'Invalid status: ' || status_code
                    WHEN requested_at IS NULL THEN 'Missing timestamp' END AS invalid_reason
        FROM ({REQUESTS}))"""

# The groups the paths of the second path table start with.
EXTENDED = f"""
    SELECT *, request_date AS log_date, request_hour AS log_hour,
           CASE event_type WHEN 'view' THEN '/page' WHEN 'click' THEN '/api' WHEN 'error' THEN '/api'
                WHEN 'signup' THEN '/checkout' WHEN 'purchase' THEN '/purchase' END AS endpoint_group,
           CASE event_type WHEN 'view' THEN '/page' WHEN 'click' THEN '/api/products/' || (id % 20)
                WHEN 'error' THEN '/api/' || (id % 5)
                WHEN 'signup' THEN '/checkout' WHEN 'purchase' THEN '/purchase/done' END AS grouped_endpoint
    FROM ({STAGED})"""

STAGED_COLUMNS = f"""
    ip_address, method, path, endpoint, status_code, status_class, response_size, referer, user_agent,
    is_bot, client_type, {day("request_date")} AS request_date, request_hour, is_valid, invalid_reason"""

ERRORS = "count(*) FILTER (WHERE status_code >= 400)"


def hourly(rows: str) -> str:
    return f"""
    SELECT request_date, request_hour, count(*) AS total_requests,
           count(DISTINCT ip_address) AS unique_ips, {ERRORS} AS error_count,
           {pct(ERRORS, "count(*)")} AS error_rate,
           {mean("sum(response_size)", "count(response_size)")} AS avg_response_size,
           count(*) FILTER (WHERE is_bot) AS bot_requests
    FROM ({rows}) WHERE is_valid GROUP BY request_date, request_hour"""


HOURLY_COLUMNS = f"""
    {day("request_date")} AS request_date, request_hour, {big("total_requests")} AS total_requests,
    {big("unique_ips")} AS unique_ips, {big("error_count")} AS error_count, error_rate,
    avg_response_size, {big("bot_requests")} AS bot_requests"""


def endpoints(rows: str) -> str:
    return f"""
    SELECT *, rank() OVER (PARTITION BY report_date ORDER BY total_hits DESC) AS hit_rank
    FROM (SELECT request_date AS report_date, endpoint, count(*) AS total_hits,
                 count(*) FILTER (WHERE status_code < 400) AS success_hits, {ERRORS} AS error_hits,
                 count(*) FILTER (WHERE status_code = 404) AS not_found_hits,
                 {mean("sum(response_size)", "count(response_size)")} AS avg_size
          FROM ({rows}) WHERE is_valid AND endpoint IS NOT NULL GROUP BY request_date, endpoint)"""


ENDPOINT_COLUMNS = f"""
    {day("report_date")} AS report_date, endpoint, {big("total_hits")} AS total_hits,
    {big("success_hits")} AS success_hits, {big("error_hits")} AS error_hits,
    {big("not_found_hits")} AS not_found_hits, avg_size, {big("hit_rank")} AS hit_rank"""


def ip_days(rows: str) -> str:
    return f"""
    SELECT request_date, ip_address, count(*) AS total_requests, {ERRORS} AS error_requests,
           count(*) FILTER (WHERE is_bot) AS bot_signals,
           count(DISTINCT endpoint) AS unique_endpoints, {pct(ERRORS, "count(*)")} AS error_rate
    FROM ({rows}) WHERE is_valid GROUP BY request_date, ip_address"""


def anomalies(rows: str) -> str:
    return f"""
    SELECT request_date AS report_date, ip_address, total_requests, error_requests, error_rate,
           unique_endpoints, total_requests > p99 OR error_rate > 50 AS is_suspicious,
           CASE WHEN total_requests > p99 THEN 'Volume > p99 threshold'
                WHEN error_rate > 50 THEN 'Error rate > 50%' END AS anomaly_reason
    FROM (SELECT *, quantile_cont(total_requests, 0.95) OVER () AS p95,
                 quantile_cont(total_requests, 0.99) OVER () AS p99 FROM ({ip_days(rows)}))
    WHERE total_requests > p95 OR error_rate > 50"""


ANOMALY_COLUMNS = f"""
    {day("report_date")} AS report_date, ip_address, {big("total_requests")} AS total_requests,
    {big("error_requests")} AS error_requests, error_rate,
    {big("unique_endpoints")} AS unique_endpoints, is_suspicious, anomaly_reason"""


def quality(rows: str) -> str:
    invalid = "count(*) FILTER (WHERE NOT is_valid)"
    twice = "(count(*) - count(DISTINCT (ip_address, requested_at, path)))"
    # 100 - 100 * invalid / n - 50 * duplicates / n, never below zero, to two decimals.
    left = f"greatest(0, 10000 * count(*) - 10000 * {invalid} - 5000 * {twice})"
    return f"""
    SELECT request_date AS report_date, count(*) AS total_raw,
           count(*) FILTER (WHERE is_valid) AS total_valid, {invalid} AS total_invalid,
           {pct(invalid, "count(*)")} AS invalid_rate,
           count(*) FILTER (WHERE ip_address IS NULL) AS null_ip_count,
           count(*) FILTER (WHERE invalid_reason LIKE 'Invalid method%') AS invalid_method,
           count(*) FILTER (WHERE invalid_reason LIKE 'Invalid status%') AS invalid_status,
           {twice} AS duplicate_count,
           CAST((2 * {left} + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS quality_score
    FROM ({rows}) WHERE request_date IS NOT NULL GROUP BY request_date"""


QUALITY_COLUMNS = f"""
    {day("report_date")} AS report_date, {big("total_raw")} AS total_raw,
    {big("total_valid")} AS total_valid, {big("total_invalid")} AS total_invalid, invalid_rate,
    {big("null_ip_count")} AS null_ip_count, {big("invalid_method")} AS invalid_method,
    {big("invalid_status")} AS invalid_status, {big("duplicate_count")} AS duplicate_count, quality_score"""

REPEATED = f"SELECT * FROM ({STAGED}) UNION ALL SELECT * FROM ({STAGED}) WHERE id % 10 = 0"

# What log lines keep of a request: whole seconds.
LOGGED = f"SELECT * REPLACE (date_trunc('second', requested_at) AS requested_at) FROM ({STAGED})"
FIRST_HALF = f"SELECT * FROM ({STAGED}) WHERE {MIDDLE}"
HALF_TWICE = f"""
    SELECT * FROM ({LOGGED}) UNION ALL
    SELECT * REPLACE (date_trunc('second', requested_at) AS requested_at) FROM ({FIRST_HALF})"""
LOGGED_FIRST_HALF = (
    f"SELECT * REPLACE (date_trunc('second', requested_at) AS requested_at) FROM ({FIRST_HALF})"
)

DAMAGED = "(id % 50 = 7 OR id % 53 = 5 OR id % 59 = 3)"
DAMAGED_LINES = f"""
    SELECT ip_address || ' - - [' ||
           CASE WHEN id % 50 <> 7 AND id % 53 = 5 THEN '31/Feb/' || strftime(requested_at, '%Y')
                ELSE strftime(requested_at, '%d/%b/%Y') END ||
           strftime(requested_at, ':%H:%M:%S') || ' +0700] "' || method || ' ' || path ||
           CASE WHEN id % 50 = 7 THEN '' ELSE ' ' || protocol END || '" ' || status_code || ' ' ||
           CASE WHEN id % 50 <> 7 AND id % 53 <> 5 THEN '1_0' ELSE CAST(response_size AS VARCHAR) END ||
           ' "-" "' || user_agent || '" ' || response_ms AS value
    FROM ({REQUESTS}) WHERE {DAMAGED}"""

LOAD_TOTALS = f"""
    SELECT count(*) FILTER (WHERE NOT {DAMAGED}) AS accepted,
           count(*) FILTER (WHERE {DAMAGED}) AS rejected,
           sum(status_code) FILTER (WHERE NOT {DAMAGED}) AS status_total,
           sum(response_size) FILTER (WHERE NOT {DAMAGED}) AS size_total
    FROM ({REQUESTS})"""

BOTS_LATER = hourly(f"SELECT * FROM ({STAGED}) WHERE is_bot AND request_date >= DATE '2024-01-10'")
MERGED_HOURLY = f"""
    WITH later AS ({BOTS_LATER}), earlier AS ({hourly(FIRST_HALF)})
    SELECT {HOURLY_COLUMNS} FROM (
        SELECT * FROM later UNION ALL
        SELECT * FROM earlier e WHERE NOT EXISTS (
            SELECT 1 FROM later l
            WHERE l.request_date = e.request_date AND l.request_hour = e.request_hour))"""

ANOMALIES_KEPT = f"""
    WITH later AS ({anomalies(HALF_TWICE)}), earlier AS ({anomalies(LOGGED_FIRST_HALF)})
    SELECT {ANOMALY_COLUMNS} FROM (
        SELECT * FROM later UNION ALL
        SELECT * FROM earlier e WHERE NOT EXISTS (
            SELECT 1 FROM later l
            WHERE l.report_date = e.report_date AND l.ip_address = e.ip_address))"""

SUSPICIOUS = f"""
    SELECT * FROM ({anomalies(STAGED)}) WHERE is_suspicious
    ORDER BY total_requests DESC, report_date, ip_address LIMIT"""


def text(value: str) -> str:
    return f"CAST({value} AS VARCHAR)"


def two(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(10, 2)) AS VARCHAR)"


def truth(value: str) -> str:
    return f"CASE WHEN {value} THEN 'True' ELSE 'False' END"


def cells(*values: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce({v}, '-')" for v in values) + ")"


def section(name: str, rows: str, order: str, shown: str) -> str:
    return f"""
    SELECT '{name}' AS section, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS row_no,
           {shown} AS cells
    FROM ({rows}) QUALIFY row_number() OVER (ORDER BY {order}) <= 20"""


SECTIONS = " UNION ALL ".join(
    [
        section(
            "data_quality", quality(REPEATED), "report_date DESC",
            cells(
                text("report_date"), text("total_raw"), text("total_valid"), text("total_invalid"),
                two("invalid_rate"), text("null_ip_count"), text("invalid_method"),
                text("invalid_status"), text("duplicate_count"), two("quality_score"),
            ),
        ),
        section(
            "top_endpoints", f"SELECT * FROM ({endpoints(STAGED)}) WHERE hit_rank <= 10",
            "report_date DESC, hit_rank, endpoint",
            cells(
                text("report_date"), "endpoint", text("total_hits"), text("success_hits"),
                text("error_hits"), text("not_found_hits"), two("avg_size"), text("hit_rank"),
            ),
        ),
        section(
            "hourly_traffic", hourly(STAGED), "request_date DESC, request_hour",
            cells(
                text("request_date"), text("request_hour"), text("total_requests"), text("unique_ips"),
                text("error_count"), two("error_rate"), two("avg_response_size"), text("bot_requests"),
            ),
        ),
        section(
            "suspicious_ips", f"{SUSPICIOUS} 50", "total_requests DESC, report_date, ip_address",
            cells(
                text("report_date"), "ip_address", text("total_requests"), text("error_requests"),
                two("error_rate"), text("unique_endpoints"), truth("is_suspicious"), "anomaly_reason",
            ),
        ),
    ]
)

CLOSED_HOURS = f"""
    SELECT {HOURLY_COLUMNS} FROM ({hourly(LOGGED)})
    WHERE CAST(request_date AS TIMESTAMP) + to_hours(request_hour + 1)
          <= (SELECT max(requested_at) FROM ({LOGGED}) WHERE is_valid) - INTERVAL 2 HOUR"""

FAR = "requested_at + INTERVAL 75 YEAR"
WITH_FAR = f"""
    SELECT * FROM ({LOGGED}) UNION ALL
    SELECT * REPLACE ({FAR} AS requested_at, CAST({FAR} AS DATE) AS request_date) FROM ({LOGGED}) WHERE id % 100 = 13"""


def as_text(name: str, rows: str, *values: str) -> str:
    return f"SELECT '{name}' AS name, {cells(*values)} AS row FROM ({rows})"


ALL_TABLES = " UNION ALL ".join(
    [
        as_text(
            "agg_hourly_traffic", hourly(HALF_TWICE),
            text("request_date"), text("request_hour"), text("total_requests"), text("unique_ips"),
            text("error_count"), two("error_rate"), two("avg_response_size"), text("bot_requests"),
        ),
        as_text(
            "agg_endpoint_stats", endpoints(HALF_TWICE),
            text("report_date"), "endpoint", text("total_hits"), text("success_hits"),
            text("error_hits"), text("not_found_hits"), two("avg_size"), text("hit_rank"),
        ),
        as_text(
            "agg_ip_anomalies", ANOMALIES_KEPT,
            text("report_date"), "ip_address", text("total_requests"), text("error_requests"),
            two("error_rate"), text("unique_endpoints"), text("is_suspicious"), "coalesce(anomaly_reason, '-')",
        ),
        as_text(
            "data_quality_report", quality(HALF_TWICE),
            text("report_date"), text("total_raw"), text("total_valid"), text("total_invalid"), two("invalid_rate"),
            text("null_ip_count"), text("invalid_method"), text("invalid_status"), text("duplicate_count"), two("quality_score"),
        ),
    ]
)

FUNNEL_PATHS = f"""
    SELECT request_date, count(*) FILTER (WHERE path IN ('/index.html', '/')) AS home_visits,
           count(*) FILTER (WHERE path LIKE '/products%') AS product_views,
           count(*) FILTER (WHERE path = '/cart') AS cart_adds,
           count(*) FILTER (WHERE path = '/checkout') AS checkouts
    FROM ({STAGED}) WHERE is_valid AND status_code = 200 GROUP BY request_date"""

FUNNEL_GROUPS = f"""
    SELECT log_date, count(*) FILTER (WHERE endpoint_group = '/page') AS page_views,
           count(*) FILTER (WHERE endpoint_group = '/api') AS api_calls,
           count(*) FILTER (WHERE endpoint_group = '/checkout') AS checkouts,
           count(*) FILTER (WHERE endpoint_group = '/purchase') AS purchases
    FROM ({EXTENDED}) WHERE is_valid AND status_code < 400 GROUP BY log_date"""

SERVER_ERRORS = "count(*) FILTER (WHERE status_code >= 500)"

ORACLES = {
    "parse_access_log": f"""
        SELECT ip_address, method, path, protocol, status_code, response_size, referer, user_agent,
               {time("requested_at")} AS requested_at, response_ms
        FROM ({LOGGED})""",
    "parse_rejects": DAMAGED_LINES,
    "load_counts": f"""
        SELECT {big("load_id")} AS load_id, {big("accepted")} AS accepted, {big("accepted")} AS ids,
               {big("status_total")} AS status_total, {big("size_total")} AS size_total,
               {big("rejected")} AS rejected
        FROM ({LOAD_TOTALS}) CROSS JOIN (SELECT unnest([1, 2]) AS load_id)""",
    "load_ids": f"""
        WITH kept AS (
            SELECT *, row_number() OVER (ORDER BY id) AS line, count(*) OVER () AS n
            FROM ({REQUESTS}) WHERE NOT {DAMAGED})
        SELECT {big("(load_id - 1) * n + line")} AS id, {big("load_id")} AS load_id, ip_address, method, path, status_code,
               response_size, user_agent, {time("date_trunc('second', requested_at)")} AS requested_at, response_ms
        FROM kept CROSS JOIN (SELECT unnest([1, 2]) AS load_id)""",
    "stage_logs": f"""
        SELECT id, {STAGED_COLUMNS}, {time("requested_at")} AS requested_at, response_ms FROM ({STAGED})""",
    "stage_incremental": f"""
        SELECT {STAGED_COLUMNS}, {time("requested_at")} AS requested_at, response_ms,
               {big("load_id")} AS load_id
        FROM (SELECT *, 2 AS load_id FROM ({LOGGED}) UNION ALL SELECT *, 1 FROM ({LOGGED_FIRST_HALF}))""",
    "stage_by_id": f"""
        SELECT id, {STAGED_COLUMNS}, {time("requested_at")} AS requested_at, response_ms
        FROM ({STAGED}) WHERE NOT ({MIDDLE})""",
    "classify_client": f"SELECT id, user_agent, is_bot, client_type FROM ({STAGED})",
    "validate_logs": f"SELECT id, method, status_code, is_valid, invalid_reason FROM ({STAGED})",
    "hourly_traffic": f"SELECT {HOURLY_COLUMNS} FROM ({hourly(STAGED)})",
    "endpoint_stats": f"SELECT {ENDPOINT_COLUMNS} FROM ({endpoints(STAGED)})",
    "ip_anomalies": f"SELECT {ANOMALY_COLUMNS} FROM ({anomalies(STAGED)})",
    "data_quality_report": f"SELECT {QUALITY_COLUMNS} FROM ({quality(REPEATED)})",
    "upsert": MERGED_HOURLY,
    "log_to_tables": f"SELECT {QUALITY_COLUMNS} FROM ({quality(HALF_TWICE)})",
    "log_to_anomalies": ANOMALIES_KEPT,
    "log_to_all": ALL_TABLES,
    "report_data_quality": f"""
        SELECT {QUALITY_COLUMNS}
        FROM (SELECT * FROM ({quality(REPEATED)}) ORDER BY report_date DESC LIMIT 30)""",
    "report_top_endpoints": f"""
        SELECT {ENDPOINT_COLUMNS} FROM ({endpoints(STAGED)}) WHERE hit_rank <= 10""",
    "report_hourly_traffic": f"SELECT {HOURLY_COLUMNS} FROM ({hourly(STAGED)})",
    "report_suspicious_ips": f"SELECT {ANOMALY_COLUMNS} FROM ({SUSPICIOUS} 50)",
    "export_csv": f"""
        SELECT {text("report_date")} AS report_date, ip_address, {text("total_requests")} AS total_requests,
               {text("error_requests")} AS error_requests, {two("error_rate")} AS error_rate,
               {text("unique_endpoints")} AS unique_endpoints, {truth("is_suspicious")} AS is_suspicious,
               anomaly_reason
        FROM ({SUSPICIOUS} 50)""",
    "report_sections": SECTIONS,
    "report_page": f"""
        SELECT '<tr><td>' || replace(replace(cells, '>', '&gt;'), '|', '</td><td>') || '</td></tr>' AS value
        FROM ({SECTIONS})""",
    "parameterised_sql": f"""
        SELECT {day("request_date")} AS request_date, endpoint, count(*) AS hits, {ERRORS} AS errors
        FROM ({STAGED}) WHERE is_valid AND method = 'GET' GROUP BY request_date, endpoint""",
    "exploratory_sql": f"""
        WITH per_client AS (
            SELECT client_type, request_hour, count(*) AS n,
                   lag(count(*)) OVER (PARTITION BY client_type ORDER BY request_hour) AS before
            FROM ({STAGED}) WHERE is_valid GROUP BY client_type, request_hour)
        SELECT client_type, {big("sum(n)")} AS total, {big("max(n - before)")} AS largest_rise,
               round(quantile_cont(n, 0.5), 4) AS median_hour
        FROM per_client GROUP BY client_type""",
    "top_endpoints_running_total": f"""
        WITH counts AS (
            SELECT endpoint, count(*) AS total_hits, {ERRORS} AS error_hits,
                   {mean("sum(response_size)", "count(response_size)")} AS avg_size
            FROM ({STAGED}) WHERE is_valid GROUP BY endpoint),
        ranked AS (
            SELECT *, rank() OVER (ORDER BY total_hits DESC) AS hit_rank,
                   sum(total_hits) OVER () AS grand_total,
                   sum(total_hits) OVER (ORDER BY total_hits DESC) AS running_total
            FROM counts ORDER BY hit_rank, endpoint NULLS LAST LIMIT 10)
        SELECT endpoint, {big("total_hits")} AS total_hits, {big("error_hits")} AS error_hits, avg_size,
               {big("hit_rank")} AS hit_rank, {big("grand_total")} AS grand_total,
               {pct("total_hits", "grand_total")} AS traffic_pct, {big("running_total")} AS running_total
        FROM ranked""",
    "hourly_pattern": f"""
        WITH by_hour AS (
            SELECT request_hour, count(*) AS total_requests, count(DISTINCT ip_address) AS unique_visitors,
                   {ERRORS} AS errors, {mean("sum(response_size)", "count(response_size)", 0)} AS avg_size,
                   lag(count(*)) OVER (ORDER BY request_hour) AS prev_hour_requests
            FROM ({STAGED}) WHERE is_valid GROUP BY request_hour)
        SELECT *, {signed_pct("(total_requests - prev_hour_requests)", "prev_hour_requests")}
                  AS pct_change_vs_prev_hour
        FROM by_hour""",
    "ip_anomaly_explore": f"""
        SELECT ip_address, {day("request_date")} AS request_date, total_requests AS total_req,
               error_requests AS error_req, unique_endpoints, bot_signals, error_rate,
               round(p95, 4) AS p95_requests,
               CASE WHEN total_requests > p99 THEN 'Extremely high volume (>p99)'
                    WHEN error_rate > 50 THEN 'High error rate (>50%)'
                    WHEN total_requests > p95 AND error_rate > 30 THEN 'High volume + errors'
                    END AS anomaly_reason
        FROM (SELECT *, quantile_cont(total_requests, 0.95) OVER () AS p95,
                     quantile_cont(total_requests, 0.99) OVER () AS p99 FROM ({ip_days(STAGED)}) AS d) AS days
        WHERE total_requests > p95 OR error_rate > 50
        ORDER BY total_requests DESC, days.request_date, ip_address LIMIT 20""",
    "status_trend": f"""
        SELECT {day("request_date")} AS request_date, s_2xx, s_3xx, s_4xx, s_5xx, total, server_error_rate,
               round(avg(100.0 * errors / total) OVER (
                   ORDER BY by_day.request_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2)
                   AS rolling_7d_error_rate
        FROM (SELECT request_date, count(*) FILTER (WHERE status_class = '2xx') AS s_2xx,
                     count(*) FILTER (WHERE status_class = '3xx') AS s_3xx,
                     count(*) FILTER (WHERE status_class = '4xx') AS s_4xx,
                     count(*) FILTER (WHERE status_class = '5xx') AS s_5xx, count(*) AS total,
                     {pct(SERVER_ERRORS, "count(*)")} AS server_error_rate, {ERRORS} AS errors
              FROM ({STAGED}) WHERE is_valid GROUP BY request_date) AS by_day""",
    "funnel_paths": f"""
        SELECT {day("request_date")} AS request_date, home_visits, product_views, cart_adds, checkouts,
               {pct("product_views", "home_visits")} AS home_to_product_pct,
               {pct("cart_adds", "product_views")} AS product_to_cart_pct,
               {pct("checkouts", "cart_adds")} AS cart_to_checkout_pct
        FROM ({FUNNEL_PATHS})""",
    "client_breakdown": f"""
        SELECT {day("request_date")} AS request_date, client_type, total_requests, unique_ips,
               avg_response_size, {pct("total_requests", "of_day")} AS pct_of_day
        FROM (SELECT request_date, client_type, count(*) AS total_requests,
                     count(DISTINCT ip_address) AS unique_ips,
                     {mean("sum(response_size)", "count(response_size)", 0)} AS avg_response_size,
                     sum(count(*)) OVER (PARTITION BY request_date) AS of_day
              FROM ({STAGED}) WHERE is_valid GROUP BY request_date, client_type)""",
    "traffic_rolling_3h": f"""
        SELECT {day("log_date")} AS log_date, log_hour, requests,
               {mean("last_three", "hours")} AS rolling_avg_3h, delta_from_prev_hour
        FROM (SELECT *, sum(requests) OVER three AS last_three, count(*) OVER three AS hours,
                     requests - lag(requests) OVER (ORDER BY log_date, log_hour) AS delta_from_prev_hour
              FROM (SELECT log_date, log_hour, count(*) AS requests
                    FROM ({EXTENDED}) WHERE is_valid GROUP BY log_date, log_hour)
              WINDOW three AS (ORDER BY log_date, log_hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""",
    "latency_percentiles": f"""
        SELECT endpoint_group, method, count(*) AS total_requests,
               {mean("sum(response_ms)", "count(response_ms)")} AS avg_ms,
               round(quantile_cont(response_ms, 0.5), 4) AS p50_ms,
               round(quantile_cont(response_ms, 0.95), 4) AS p95_ms,
               round(quantile_cont(response_ms, 0.99), 4) AS p99_ms, max(response_ms) AS max_ms
        FROM ({EXTENDED}) WHERE is_valid AND log_date = {AS_OF} GROUP BY endpoint_group, method""",
    "response_time_percentiles": f"""
        SELECT endpoint_group, method, count(*) AS total_requests,
               round(quantile_cont(took_ms, 0.5), 6) AS p50_ms,
               round(quantile_cont(took_ms, 0.95), 6) AS p95_ms,
               round(quantile_cont(took_ms, 0.99), 6) AS p99_ms, max(took_ms) AS max_ms
        FROM (SELECT e.*, t.value * 10 AS took_ms FROM ({EXTENDED}) e JOIN events t ON t.event_id = e.id)
        WHERE is_valid GROUP BY endpoint_group, method""",
    "ip_threat_level": f"""
        SELECT ip_address, {day("log_date")} AS log_date, log_hour, total_req, error_req, error_rate,
               unique_endpoints,
               CASE WHEN total_req > 1000 AND error_rate > 50 THEN 'HIGH'
                    WHEN total_req > 500 OR error_rate > 30 THEN 'MEDIUM' ELSE 'LOW' END AS threat_level
        FROM (SELECT ip_address, log_date, log_hour, count(*) AS total_req, {ERRORS} AS error_req,
                     count(DISTINCT grouped_endpoint) AS unique_endpoints,
                     {pct(ERRORS, "count(*)")} AS error_rate
              FROM ({EXTENDED}) WHERE is_valid GROUP BY ip_address, log_date, log_hour)
        WHERE total_req > 200 OR error_rate > 20""",
    "error_surge": f"""
        WITH rates AS (
            SELECT log_date, log_hour, CAST({pct(SERVER_ERRORS, "count(*)")} AS DECIMAL(10, 2)) AS rate
            FROM ({EXTENDED}) WHERE is_valid GROUP BY log_date, log_hour),
        baseline AS (
            SELECT log_hour, CAST(round(avg(rate), 2) AS DECIMAL(10, 2)) AS usual,
                   CAST(round(stddev_samp(rate), 2) AS DECIMAL(10, 2)) AS spread
            FROM rates WHERE log_date < {AS_OF} GROUP BY log_hour)
        SELECT {day("log_date")} AS log_date, log_hour, CAST(rate AS DOUBLE) AS current_rate,
               CAST(usual AS DOUBLE) AS baseline_rate, CAST(spread AS DOUBLE) AS stddev_error_rate,
               CAST(rate - usual AS DOUBLE) AS deviation,
               CASE WHEN rate > usual + 3 * spread THEN 'ANOMALY'
                    WHEN rate > usual + 2 * spread THEN 'WARNING' ELSE 'NORMAL' END AS status
        FROM rates JOIN baseline USING (log_hour) WHERE log_date = {AS_OF}""",
    "slowest_endpoints": f"""
        SELECT *, rank() OVER (ORDER BY p95_ms DESC NULLS FIRST) AS rank_by_p95,
               rank() OVER (ORDER BY avg_ms DESC NULLS FIRST) AS rank_by_avg,
               CAST(ntile(4) OVER (ORDER BY p95_ms DESC NULLS FIRST, endpoint_group, method) AS INTEGER)
                   AS quartile
        FROM (SELECT endpoint_group, method, count(*) AS hits,
                     {mean("sum(response_ms)", "count(response_ms)")} AS avg_ms,
                     round(quantile_cont(response_ms, 0.95), 4) AS p95_ms
              FROM ({EXTENDED}) WHERE is_valid AND log_date >= {AS_OF} - INTERVAL 7 DAY
              GROUP BY endpoint_group, method HAVING count(*) > 50)""",
    "funnel_groups": f"""
        SELECT {day("log_date")} AS log_date, page_views, api_calls, checkouts, purchases,
               {pct("api_calls", "page_views")} AS page_to_api_pct,
               {pct("checkouts", "api_calls")} AS api_to_checkout_pct,
               {pct("purchases", "checkouts")} AS checkout_to_purchase_pct
        FROM ({FUNNEL_GROUPS})""",
    "stream_ingest": f"""
        SELECT {STAGED_COLUMNS}, {time("requested_at")} AS requested_at, response_ms FROM ({LOGGED})""",
    "stream_hourly_traffic": f"SELECT {HOURLY_COLUMNS} FROM ({hourly(LOGGED)})",
    "stream_closed_hours": CLOSED_HOURS,
    "stream_far_hours": f"SELECT {HOURLY_COLUMNS} FROM ({hourly(WITH_FAR)})",
    "stream_rejects": DAMAGED_LINES,
}
