from __future__ import annotations

import random

import numpy as np
import pytest
from corpus import documents, empty, frame, sentence, shingles, smallest_reachable

from logloom.llm import minhash
from logloom.llm.text_hash import canonical_words, hashed_spans


def brute_force(rows):
    """(id, n_shingles, component, kept) of every row."""
    sets = [(r[0], shingles(r[1])) for r in rows]
    known = [(i, s) for i, s in sets if i is not None and s]
    links = [(i, j) for n, (i, a) in enumerate(known) for j, b in known[:n] if 100 * len(a & b) >= 75 * len(a | b)]
    groups = smallest_reachable({i for i, _ in sets if i is not None}, links)
    return sorted((repr(i), len(s), repr(groups.get(i)), i is None or groups[i] == i) for i, s in sets)


def test_against_all_pairs(spark, scratch):
    rows = documents()
    found = minhash.near_duplicates(frame(spark, rows), scratch)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((repr(r[0]), r[1], repr(r[2]), r[3]) for r in found.collect()) == brute_force(rows)


def test_a_chain_of_near_copies_is_one_group(spark, scratch):
    rng = random.Random(1)
    words = sentence(rng, 100).split(" ")
    rows = [(100 - i, " ".join(words[i * 3 :] + sentence(rng, i * 3).split(" ")), *[None] * 6) for i in range(12)]
    found = minhash.near_duplicates(frame(spark, rows), scratch)
    assert sorted((repr(r[0]), r[1], repr(r[2]), r[3]) for r in found.collect()) == brute_force(rows)


def test_empty_table(spark, scratch):
    assert minhash.near_duplicates(empty(spark), scratch).count() == 0
    assert minhash.drop_near_duplicates(empty(spark), scratch).count() == 0


def test_dropping_keeps_one_of_each_group(spark, scratch):
    rows = documents()
    kept = minhash.drop_near_duplicates(frame(spark, rows), scratch)
    groups = {r[0]: r[2] for r in brute_force(rows)}
    assert kept.columns == frame(spark, rows).columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r[0]) for r in rows if r[0] is None or groups[repr(r[0])] == repr(r[0]))


@pytest.mark.parametrize("size", [1, 3, 40, 600, 5000])
def test_every_coordinate_fills(size):
    bins = minhash.sketch(np.arange(1, size + 1, dtype=np.uint64), 128)
    assert bins.max() < np.iinfo(np.uint64).max


def test_the_sketch_estimates_likeness():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(40):
        values = rng.integers(1, 1 << 62, 1500, dtype=np.uint64)
        a, b = minhash.sketch(values[:1000], 512), minhash.sketch(values[500:], 512)
        errors.append((a == b).mean() - 1 / 3)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03


def test_spans_hash_alike_wherever_they_lie(monkeypatch):
    monkeypatch.setattr("logloom.llm.text_hash.SLAB", 64)
    data, starts, ends = canonical_words("alpha beta  Gamma\tdelta\n" * 50 + "x" * 300)
    hashes = hashed_spans(data, starts, ends)
    names = [bytes(data[s:e]) for s, e in zip(starts, ends)]
    assert len(names) == 201 and names[2] == b"gamma"
    assert len(set(hashes.tolist())) == len(set(names)) == 5


def test_columns_of_the_operator_s_own_names(spark, scratch):
    rows = frame(spark, documents()).selectExpr("*", "7 AS gone_id", "8 AS kept", "9 AS member")
    found = minhash.drop_near_duplicates(rows, scratch)
    assert found.columns == rows.columns
    assert 0 < found.count() < rows.count() and found.where("gone_id <> 7 OR kept <> 8 OR member <> 9").count() == 0
