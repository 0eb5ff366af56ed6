"""Archives written and read back, and their index, against plain Python."""

from __future__ import annotations

import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from logloom.llm import warc
from logloom.llm.queries import op11_warc
from logloom.scratch import Scratch

SCHEMA = "page_id long, url string, html string, id string, digest string, archive long, refers_to int"


def brute_force(rows):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of rows (page_id, url, html)."""
    firsts: dict[bytes, int] = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if page is not None and len(payload) >= 100:
            firsts[payload] = min(firsts.get(payload, page), page)
    found = []
    for page, _, html in rows:
        payload = (html or "").encode()
        first = firsts.get(payload, page)
        kind = ("response", None) if first == page else ("revisit", first)
        found.append((page, len(payload), hashlib.sha256(payload).hexdigest(), *kind))
    return found


def by_text(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def pages():
    rng = random.Random(5)
    copied = ["<p>" + "ö" * 60 + "</p>", "x" * 100, "y" * 99, "z" * 3_000_000, "\r\n\r\nWARC/1.1\r\n" * 20]
    rows = [(i, f"http://h{rng.randrange(5)}.example.org/{rng.randrange(9)}", rng.choice([*copied[:2], f"page {i} " * 30])) for i in range(200)]
    rows += [(300 + i, f"https://www.a.org:8080/p?q={i % 2}#f", text) for i, text in enumerate(copied * 2)]
    rows += [(400, None, "no url " * 20), (401, "http://x/\r\nWARC-Type: y", "a" * 200), (402, "not a url %41 ü", None), (403, "http://[bad", "")]
    rows += [(404, "", ""), (None, "http://n/", "x" * 100), (None, None, None), (None, "http://n/", "only without id " * 20)]
    return rows + rows[:3] * 2  # repeated rows


def found_rows(index):
    return [(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index]


@pytest.fixture(scope="module")
def index(spark):
    frame = spark.createDataFrame([(*r, "a", "b", 1, 2) for r in pages()], SCHEMA).repartition(4)
    return warc.capture_index(frame, Scratch(spark), archive_bytes=3000).collect()


def test_awkward_rows(index):
    """Ids, urls and pages that are null, odd urls, pages that look like records, long ones, copies, repeated rows, further columns."""
    assert by_text(found_rows(index)) == by_text(brute_force(pages()))
    assert by_text((r.id, r.url) for r in index) == by_text((p, u) for p, u, _ in pages())


def test_the_index_is_ordered_over_all_archives(index):
    assert sorted(r.position for r in index) == list(range(len(index)))
    assert len({r.archive for r in index}) > 10
    in_order = sorted(index, key=lambda r: r.position)
    keys = [(r.url_key.encode(), r.timestamp, r.id is not None, r.id or 0, r.archive, r.offset) for r in in_order]
    assert keys == sorted(keys)


def test_records_are_found_by_the_index(index):
    texts = {(p, u, (h or "")) for p, u, h in pages()}
    for row in index:
        fields, block = warc.read_record(row.path, row.offset, row.length)
        assert fields["WARC-Type"] == row.record_type
        if row.record_type == "response":
            assert (row.id, row.url, block.partition(warc.END)[2].decode()) in texts


def test_archives_are_plain_gzip(index):
    path = index[0].path.removeprefix("file://")
    with gzip.open(path) as source:
        assert source.read().count(b"WARC-Type: warcinfo") == 1


def test_index_as_lines(spark, scratch):
    frame = spark.createDataFrame([(*r, "a", "b", 1, 2) for r in pages()[:200]], SCHEMA).repartition(4)
    captures = warc.capture_index(frame, scratch)
    path = scratch.path("lines")
    warc.write_index(captures, path)
    lines = [r.value for r in spark.read.text(path).orderBy(F.input_file_name(), F.monotonically_increasing_id()).collect()]
    assert [x.split(" ")[0] for x in lines] == [r.url_key for r in captures.orderBy("position").collect()]


def test_a_time_column_orders_the_history(spark, scratch):
    rows = [(i, "http://a.org/", f"text {i}", f"2024-01-{20 - i:02d}T00:00:00Z") for i in range(1, 9)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, at string")
    found = warc.capture_index(frame, scratch, captured_at=F.col("at")).orderBy("position").collect()
    assert [r.id for r in found] == list(range(8, 0, -1))


def test_no_rows(spark, scratch):
    assert warc.capture_index(spark.createDataFrame([], SCHEMA), scratch).count() == 0


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5, 8, 13])
def test_tree_of_losers(count):
    rng = random.Random(count)
    lists = [sorted(rng.randrange(20) for _ in range(rng.randrange(12))) for _ in range(count)]
    merged = [lists[i][k] for i, k in warc.LoserTree(lists)]
    assert merged == sorted(x for part in lists for x in part)


def test_damage_is_found():
    page = {"id": 1, "url": "http://a/", "payload": "text", "digest": hashlib.sha256(b"text").hexdigest(), "timestamp": "t", "refers_to": None}
    good = warc.capture(page)
    assert [r["payload_bytes"] for r in warc.captures_of(io.BytesIO(gzip.compress(good)))] == [4]
    for bad in (good.replace(b"\r\n\r\ntext", b"\r\n\r\ntexx"), good[:-2], good + b"x"):
        with pytest.raises(ValueError):
            list(warc.captures_of(io.BytesIO(gzip.compress(bad))))
    with pytest.raises(ValueError):
        list(warc.captures_of(io.BytesIO(gzip.compress(good)[:-9])))


def test_url_keys():
    assert warc.url_key("HTTPS://www.News.Example.com:443/A?b=1#c") == "com,example,news)/a?b=1"
    assert warc.url_key("http://a.org:8080") == "org,a:8080)/"
    assert warc.url_key(None) == "-"


def test_the_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert by_text(map(tuple, op11_warc(spark, folder).select(names).collect())) == by_text(brute_force(rows))
