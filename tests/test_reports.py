from __future__ import annotations

import csv
import datetime as dt
import glob
from decimal import Decimal as D

import pytest

from logloom import schemas
from logloom.plans import reports

DAYS = [dt.date(2024, 3, 1) + dt.timedelta(days=i) for i in range(40)]


@pytest.fixture
def tables(spark):
    def frame(name, rows):
        schema = schemas.TABLES[name].schema
        return spark.createDataFrame(rows, schema)

    return {
        "data_quality_report": frame(
            "data_quality_report", [(d, 2, 2, 0, D("0.00"), 0, 0, 0, 1, D("75.00")) for d in DAYS]
        ),
        "agg_endpoint_stats": frame(
            "agg_endpoint_stats",
            [(DAYS[0], f"/e{i:02}", 50, 50, 0, 0, None if i == 0 else D("1.50"), 8 if i < 30 else 31) for i in range(35)]
            + [(DAYS[1], '/"<&>', 1, 1, 0, 0, D("1.00"), 1)],
        ),
        "agg_hourly_traffic": frame(
            "agg_hourly_traffic", [(d, h, 1, 1, 0, D("0.00"), D("2.00"), 0) for d in DAYS[:2] for h in (0, 23)]
        ),
        "agg_ip_anomalies": frame(
            "agg_ip_anomalies",
            [(d, "1.1.1.1", 2 + (d == DAYS[5]), 2, D("100.00"), 1, True, "Error rate > 50%") for d in DAYS]
            + [(DAYS[0], f"2.2.2.{i}", 9, 0, D("0.00"), 1, False, None) for i in range(30)]
            + [(DAYS[0], f"3.3.3.{i}", 2, 2, D("100.00"), 1, True, "Error rate > 50%") for i in range(30)],
        ),
    }


def test_limits_and_orders(tables):
    found = {name: rows.collect() for name, rows in reports.reports(tables).items()}
    assert [row.report_date for row in found["data_quality"]] == DAYS[:9:-1]
    assert len(found["top_endpoints"]) == 31  # a rank shared by thirty
    assert found["top_endpoints"][0].report_date == DAYS[1]
    assert [(r.request_date, r.request_hour) for r in found["hourly_traffic"]] == [
        (DAYS[1], 0), (DAYS[1], 23), (DAYS[0], 0), (DAYS[0], 23)
    ]
    assert len(found["suspicious_ips"]) == 50 and found["suspicious_ips"][0].report_date == DAYS[5]
    assert all(row.is_suspicious for row in found["suspicious_ips"])


def _csv(folder):
    rows = []
    for path in sorted(glob.glob(f"{folder}/*.csv")):
        with open(path, newline="", encoding="utf-8") as file:
            rows.append(list(csv.reader(file)))
    return rows


def test_csv(tables, spark, tmp_path):
    found = reports.reports(tables)
    reports.export_csv(found["suspicious_ips"], str(tmp_path / "ips"), single_file=True)
    (rows,) = _csv(tmp_path / "ips")
    assert rows[0] == schemas.IP_ANOMALIES.names and len(rows) == 51
    assert rows[1] == ["2024-03-06", "1.1.1.1", "3", "2", "100.00", "1", "True", "Error rate > 50%"]
    odd = spark.createDataFrame([('a "b", c', None, "", False)], "a string, b string, c string, d boolean")
    reports.export_csv(odd, str(tmp_path / "odd"), single_file=True)
    (rows,) = _csv(tmp_path / "odd")
    assert rows == [["a", "b", "c", "d"], ['a "b", c', "", "", "False"]]


def test_query_with_parameters(tables, spark, tmp_path):
    tables["agg_ip_anomalies"].createOrReplaceTempView("agg_ip_anomalies")
    query = "SELECT ip_address, COUNT(*) AS n FROM agg_ip_anomalies WHERE is_suspicious = {} GROUP BY ip_address"
    reports.export_query(spark, query.format(":flag"), str(tmp_path / "a"), {"flag": False})
    reports.export_query(spark, query.format("?"), str(tmp_path / "b"), [False])
    for folder in ("a", "b"):
        rows = [row for part in _csv(tmp_path / folder) for row in part[1:]]
        assert sorted(rows) == sorted([f"2.2.2.{i}", "1"] for i in range(30))


def test_sections(tables):
    rows = reports.report_sections(tables).collect()
    assert {row.section: 0 for row in rows} == {name: 0 for name, _ in reports.SECTION_TITLES}
    by_section = {name: sorted((r.row_no, r.cells) for r in rows if r.section == name) for name, _ in reports.SECTION_TITLES}
    assert [len(by_section[name]) for name, _ in reports.SECTION_TITLES] == [20, 20, 4, 20]
    assert by_section["top_endpoints"][1][1] == ["2024-03-01", "/e00", "50", "50", "0", "0", "-", "8"]
    assert by_section["suspicious_ips"][0][1][6:] == ["True", "Error rate > 50%"]


def test_page(tables):
    columns = {name: rows.columns for name, rows in reports.reports(tables).items()}
    lines = [r.value for r in reports.report_html(reports.report_sections(tables), columns, "Title").collect()]
    assert lines[0].startswith("<!DOCTYPE html>") and lines[-1] == "</body></html>"
    headings = [line for line in lines if line.startswith("<h2>")]
    assert [h.split("</h2>")[0][4:] for h in headings] == [title for _, title in reports.SECTION_TITLES]
    assert sum(line.startswith("<tr>") for line in lines) == 64
    assert any("<td>/&quot;&lt;&amp;&gt;</td>" in line for line in lines)


def test_page_without_rows(tables):
    tables = {**tables, "agg_ip_anomalies": tables["agg_ip_anomalies"].where("false")}
    columns = {name: rows.columns for name, rows in reports.reports(tables).items()}
    lines = [r.value for r in reports.report_html(reports.report_sections(tables), columns, "Title").collect()]
    assert lines[-4:] == [lines[-4], "</table>", "<p>No data</p>", "</body></html>"]
    assert lines[-4].startswith("<h2>Suspicious") and lines.count("<p>No data</p>") == 1
