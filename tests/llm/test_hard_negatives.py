"""Hard negatives against plain integer arithmetic."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import hard_negatives
from logloom.llm.hard_negatives import LONG, PackedBlock, whole_numbers
from logloom.llm.queries import op13_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id long, score long, slot string"


def brute_force(rows, is_anchor, relabel=lambda i, label: label):
    """Rows (vec_id, vector, label)."""
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fact = (relabel(i, label), v)
        kept[i] = min(kept.get(i, fact), fact)
    whole = {i: (label, [math.floor(256 * Fraction(x)) for x in v]) for i, (label, v) in kept.items()}
    found = set()
    for a, (label, v) in whole.items():
        if not is_anchor(a):
            continue
        scored = [
            (-min(max(sum(x * y for x, y in zip(v, w)), LONG.min), LONG.max), i, other)
            for i, (other, w) in whole.items() if i != a and len(w) == len(v)
        ]
        scored.sort(key=lambda r: r[:2])
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            near = [(n, i) for n, i, other in scored if other != label and 80 * -s <= 100 * -n <= 100 * -s][:5]
            found |= {(a, p, rank, i, -s, -n) for rank, (n, i) in enumerate(near, 1)}
    return found


def columns(found):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert found.columns == names
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def vectors(count=300, dims=6, seed=1):
    rng = random.Random(seed)
    heads = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [h + rng.gauss(0, 0.3) for h in rng.choice(heads)], rng.randrange(4)) for i in range(count)]


def awkward():
    rows = vectors()
    rows += rows[:4] * 2 + [(0, rows[9][1], 3), (7, rows[0][1], 0)]  # repeated rows, ids with several vectors
    rows += [(400, None, 1), (401, rows[0][1], None), (None, rows[0][1], 1), (402, [1.0, None] * 3, 1), (410, [math.nan] * 6, 1)]
    rows += [(420, [math.inf] * 6, 2), (430, [], 1), (431, [], 2), (432, [], 1), (440, [0.0] * 6, 1), (450, [1.0] * 3, 2)]
    rows += [(460 + i, [0.5] * 6, i % 3) for i in range(20)]  # ties
    return rows


@pytest.mark.parametrize("extra", [[], [(510, [1e200] * 6, 1), (511, [1e200] * 5 + [-1e200], 2), (512, [-1e300, 1e-300] * 3, 1)]])
def test_awkward_rows(spark, scratch, monkeypatch, extra):
    """Also vectors whose scores are beyond 64 bits, further columns of like names, small blocks and chunks of anchors."""
    monkeypatch.setattr(hard_negatives, "BLOCK", 64)
    monkeypatch.setattr(hard_negatives, "CHUNK_BYTES", 3000)
    rows = awkward() + extra
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(3)
    found = hard_negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0, scratch)
    expected = brute_force(rows, lambda i: i % 10 == 0)
    assert columns(found) == expected and len(expected) > 200


def test_no_rows(spark, scratch):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 10 == 0, scratch).count() == 0
    lone = spark.createDataFrame([(0, [1.0], 1, 1, 1, "")], SCHEMA)
    assert hard_negatives.hard_negatives(lone, F.col("vec_id") % 10 == 0, scratch).count() == 0


@pytest.mark.parametrize("size", [1, 300, 2**20, 2**31, 2**70])
def test_packed_products_are_exact(size):
    rng = random.Random(size)
    kind = object if size > 2**62 else np.int64
    values = np.array([[rng.randint(-size, size) for _ in range(9)] for _ in range(50)] + [[size] * 9, [-size] * 9], dtype=kind)
    for reach in (1, 256, size):
        block = PackedBlock(values, reach)
        for anchor in ([rng.randint(-reach, reach) for _ in range(9)], [reach] * 9, [-reach] * 9):
            exact = [sum(int(a) * int(x) for a, x in zip(anchor, v)) for v in values]
            assert block.scores(anchor).tolist() == [min(max(s, LONG.min), LONG.max) for s in exact]


def test_whole_numbers():
    values = np.array([[0.1, -0.1, 1e300, 2.0**60 + 2**20, -1e-300, 0.0]])
    assert [int(x) for x in whole_numbers(values, 256)[0]] == [math.floor(256 * Fraction(x)) for x in values[0].tolist()]


def test_the_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    expected = brute_force(rows, lambda i: i % 100 == 0, lambda i, label: (label + 1) % 10 if i % 7 == 0 else label)
    assert columns(op13_hard_negatives(spark, folder)) == expected and expected
