from __future__ import annotations

import zlib
from collections import Counter

from corpus import documents, empty, frame

from logloom.llm import sharding


def rows_of(spark, scratch, rows, **options):
    return [tuple(r) for r in sharding.shard_rows(frame(spark, rows), scratch, **options).collect()]


def test_every_row_has_one_place(spark, scratch):
    rows = documents()
    found = rows_of(spark, scratch, rows)
    expected = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter(r[:3] for r in found) == expected
    assert {r[3] for r in found} == {"rows"} and {r[6] for r in found} == {None}
    counts = Counter(r[4] for r in found)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, count in counts.items():
        assert sorted(r[5] for r in found if r[4] == shard) == list(range(count))


def test_one_row_repeated_spreads(spark, scratch):
    rows = [(7, "the same", *[None] * 6)] * 3000
    shuffled = sharding.write_shuffled(frame(spark, rows).select("doc_id", "text"), scratch)
    counts = [r["count"] for r in shuffled.groupBy("bucket").count().collect()]
    assert len(counts) == 64 and max(counts) < 120


def test_the_order_is_shuffled_and_depends_on_the_seed(spark, scratch):
    rows = [(i, f"text {i}", *[None] * 6) for i in range(2000)]
    one, again, other = (rows_of(spark, scratch, rows, seed=s) for s in (1, 1, 2))
    order = [r[0] for r in sorted(one, key=lambda r: (r[4], r[5]))]
    rises = sum(a < b for a, b in zip(order, order[1:]))
    assert 900 < rises < 1100
    assert sorted(one) != sorted(other) and len(set(one)) == len(set(again)) == 2000


def test_fewer_rows_than_shards_and_none(spark, scratch):
    found = rows_of(spark, scratch, [(i, None, *[None] * 6) for i in range(5)])
    assert len({r[4] for r in found}) == 5 and {r[5] for r in found} == {0} and {r[2] for r in found} == {0}
    assert sharding.shard_rows(empty(spark), scratch).count() == 0


def test_the_main_path_is_native(spark, scratch):
    plan = sharding.shard_rows(frame(spark, documents()), scratch)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
