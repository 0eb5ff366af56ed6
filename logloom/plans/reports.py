"""Reports over the aggregate tables, as DataFrames and as files."""

from __future__ import annotations

import html
from functools import partial, reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..scratch import side_by_side

# Rows and headings of the page.
SECTION_ROWS = 20
SECTION_TITLES = [
    ("data_quality", "Data Quality Summary"),
    ("top_endpoints", "Top Endpoints by Traffic"),
    ("hourly_traffic", "Hourly Traffic Pattern"),
    ("suspicious_ips", "Suspicious IPs (Anomaly Detection)"),
]


def report_data_quality(quality: DataFrame, days: int = 30) -> DataFrame:
    """The latest days of the quality table."""
    return quality.orderBy(F.desc("report_date")).limit(days)


def report_top_endpoints(endpoints: DataFrame, top: int = 10) -> DataFrame:
    """Every day's endpoints up to a rank, ties included."""
    return endpoints.where(F.col("hit_rank") <= top).orderBy(
        F.desc("report_date"), "hit_rank", "endpoint"
    )


def report_hourly_traffic(hourly: DataFrame) -> DataFrame:
    return hourly.orderBy(F.desc("request_date"), "request_hour")


def report_suspicious_ips(anomalies: DataFrame, top: int = 50) -> DataFrame:
    """The suspicious client days with the most requests."""
    return (
        anomalies.where("is_suspicious")
        .orderBy(F.desc("total_requests"), "report_date", "ip_address")
        .limit(top)
    )


def reports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four reports by name, from the aggregate tables by name."""
    return {
        "data_quality": report_data_quality(tables["data_quality_report"]),
        "top_endpoints": report_top_endpoints(tables["agg_endpoint_stats"]),
        "hourly_traffic": report_hourly_traffic(tables["agg_hourly_traffic"]),
        "suspicious_ips": report_suspicious_ips(tables["agg_ip_anomalies"]),
    }


def _shown(column: str, kind: T.DataType) -> Column:
    """A value as printed: truth values as True and False, NULL as NULL."""
    text = F.col(column).cast("string")
    return F.initcap(text) if isinstance(kind, T.BooleanType) else text


def export_csv(rows: DataFrame, folder: str, single_file: bool = False) -> None:
    """Header and rows as CSV; NULL and the empty text are both written as nothing.

    `single_file` is for results with a row limit.
    """
    shown = rows.select(*[_shown(f.name, f.dataType).alias(f.name) for f in rows.schema.fields])
    if single_file:
        shown = shown.coalesce(1)
    shown.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "emptyValue", ""
    ).csv(folder)


def export_query(
    spark: SparkSession,
    query: str,
    folder: str,
    params: dict[str, Any] | list[Any] | None = None,
    single_file: bool = False,
) -> DataFrame:
    """Run SQL over registered views, its `:name` or `?` markers bound to `params`, and export the rows."""
    rows = spark.sql(query, args=params)
    export_csv(rows, folder, single_file)
    return rows


def _section(name: str, report: DataFrame, order: list[Column], rows: int) -> DataFrame:
    cells = [F.coalesce(_shown(f.name, f.dataType), F.lit("-")) for f in report.schema.fields]
    first = report.orderBy(*order).limit(rows)
    # At most `rows` rows in this window.
    return first.select(
        F.lit(name).alias("section"),
        F.row_number().over(Window.orderBy(*order)).alias("row_no"),
        F.array(*cells).alias("cells"),
    )


def report_sections(tables: dict[str, DataFrame], rows: int = SECTION_ROWS) -> DataFrame:
    """The first rows of each report as texts, NULL shown as '-': section, row number, cells."""
    order = {
        "data_quality": [F.desc("report_date")],
        "top_endpoints": [F.desc("report_date"), F.asc("hit_rank"), F.asc("endpoint")],
        "hourly_traffic": [F.desc("request_date"), F.asc("request_hour")],
        "suspicious_ips": [F.desc("total_requests"), F.asc("report_date"), F.asc("ip_address")],
    }
    found = reports(tables)
    parts = [_section(name, found[name], order[name], rows) for name in order]
    return reduce(DataFrame.unionByName, parts)


# Where a line stands in its section.
HEAD, BODY, END = range(3)


def report_html(sections: DataFrame, columns: dict[str, list[str]], title: str) -> DataFrame:
    """The sections as the lines of one HTML page, in one `value` column.

    The input is `report_sections`: four times a fixed number of rows. Cells
    hold paths sent by clients, so they are escaped.
    """
    spark = sections.sparkSession

    def escaped(text: Column) -> Column:
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            text = F.replace(text, F.lit(char), F.lit(entity))
        return text

    cells = F.concat_ws("", F.transform("cells", lambda c: F.concat(F.lit("<td>"), escaped(c), F.lit("</td>"))))
    body = sections.select(
        "section", F.lit(BODY).alias("part"), "row_no", F.concat(F.lit("<tr>"), cells, F.lit("</tr>")).alias("value")
    )
    frame = [("", HEAD, 0, f"<!DOCTYPE html><html><head><meta charset='UTF-8'><title>{html.escape(title)}</title></head><body>")]
    for name, heading in SECTION_TITLES:
        header = "".join(f"<th>{c}</th>" for c in columns[name])
        frame.append((name, HEAD, 0, f"<h2>{heading}</h2><table><tr>{header}</tr>"))
        frame.append((name, END, 0, "</table>"))
    frame.append(("~", END, 0, "</body></html>"))
    lines = spark.createDataFrame(frame, body.schema)
    empty = lines.where((F.col("part") == END) & (F.col("section") != "~")).join(body, "section", "left_anti")
    remarks = empty.select("section", "part", "row_no", F.lit("<p>No data</p>").alias("value"))
    position = F.array_position(F.array(*[F.lit(name) for name, _ in SECTION_TITLES]), F.col("section"))
    place = F.when(F.col("section") == "~", len(SECTION_TITLES) + 1).otherwise(position)
    page = body.unionByName(lines).unionByName(remarks)
    # "</table>" comes before "<p>" where both close a section.
    return page.coalesce(1).sortWithinPartitions(place, "part", "row_no", "value").select("value")


def export_reports(tables: dict[str, DataFrame], folder: str, title: str) -> None:
    """All four reports as CSV folders and the page of their first rows."""
    found = reports(tables)
    columns = {name: rows.columns for name, rows in found.items()}
    limited = {"data_quality", "suspicious_ips"}

    def table(name: str) -> None:
        export_csv(found[name], f"{folder}/{name}.csv", single_file=name in limited)

    def page() -> None:
        lines = report_html(report_sections(tables), columns, title)
        lines.write.mode("overwrite").text(f"{folder}/report.html")

    side_by_side(*[partial(table, name) for name in found], page)
