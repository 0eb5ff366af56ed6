from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from corpus import WORD, documents, empty, frame

from logloom.llm import mixing


def targets_by_hand(sizes: dict, weights=(5, 2, 1), times=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        left, share = total - sum(stopped.values()), sum(weight[s] for s in free)
        target = {s: left * weight[s] / share for s in free}
        over = [s for s in free if target[s] > times * sizes[s] + 1e-9]
        if not over:
            return target | stopped
        stopped |= {s: times * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": int(10 ** rng.uniform(0, 5)) for i in range(rng.randint(1, 30))} | ({None: 50, "": 0} if seed % 2 else {})
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(table).collect()}
    assert found == pytest.approx(targets_by_hand(sizes))


@pytest.mark.parametrize("bins", [1, 7, 4096])
def test_the_mix(spark, scratch, bins):
    rows = documents()
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    found = mixing.mix(frame(spark, rows), scratch, labels=labels, bins=bins).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    expected = targets_by_hand(dict(size))
    by_id = {(r[0], r[1]): r[3] for r in rows}
    taken, most = Counter(), defaultdict(int)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    for r in found:
        source = next(s for s in {by_id[k] for k in by_id if k[0] == r.doc_id} if size[s] == r.source_size)
        assert r.target == pytest.approx(expected[source])
        assert r.taken == r.size * r.times <= 3 * r.size
        taken[source] += r.taken
        most[source] = max(most[source], r.size)
    for source, target in expected.items():
        assert abs(taken[source] - target) <= most[source] / 2 + 1e-6


def test_reruns_and_bins_agree(spark, scratch):
    rows = documents()
    results = [sorted(map(repr, mixing.mix(frame(spark, rows), scratch, bins=b).collect())) for b in (4096, 4096, 3)]
    assert results[0] == results[1] == results[2]


def test_documents_are_taken_as_often_as_stated(spark, scratch):
    rows = [(i, "word " * (i % 9), "en", f"s{i % 4}", i, i, "k", "c") for i in range(300)]
    mixed = {r.doc_id: r.times for r in mixing.mix(frame(spark, rows), scratch).collect()}
    taken = mixing.take_mix(frame(spark, rows), scratch)
    assert taken.columns == frame(spark, rows).columns
    assert Counter(r.doc_id for r in taken.collect()) == Counter({i: t for i, t in mixed.items() if t})


def test_higher_weights_are_taken_more(spark, scratch):
    rows = [(i, "one two three", "en", f"s{i % 3}", 0, 0, "k", "c") for i in range(6000)]
    labels = spark.createDataFrame([(i, i // 3 % 2, 0) for i in range(6000)], "doc_id long, quality int, toxic int")
    found = mixing.mix(frame(spark, rows), scratch, labels=labels).collect()
    good = sum(r.taken for r in found if r.doc_id % 3 == 1 and r.doc_id // 3 % 2)
    bad = sum(r.taken for r in found if r.doc_id % 3 == 1 and not r.doc_id // 3 % 2)
    assert good > 1.5 * bad > 0


def test_empty_table(spark, scratch):
    assert mixing.mix(empty(spark), scratch).count() == 0
    assert mixing.take_mix(empty(spark), scratch).count() == 0


def test_columns_of_the_operator_s_own_names(spark, scratch):
    rows = frame(spark, documents()).selectExpr("*", "1 AS m_copy", "2 AS m_id", "3 AS m_digest", "4 AS m_times", "5 AS times")
    found = mixing.take_mix(rows, scratch)
    assert found.columns == rows.columns
    plain = mixing.take_mix(frame(spark, documents()), scratch)
    assert found.count() == plain.count() > 0
    assert found.where("m_copy <> 1 OR m_id <> 2 OR m_digest <> 3 OR m_times <> 4 OR times <> 5").count() == 0
