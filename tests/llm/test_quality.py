from __future__ import annotations

import os
import zlib

import numpy as np
import pytest
from compare import DATA
from corpus import documents, empty, frame

from logloom.llm import quality


def test_held_out_accuracy(spark):
    folder = f"{DATA}/sf0.1"
    if not os.path.exists(folder):
        pytest.skip("no test data")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.score_quality(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    good = [r for r in rows if r.quality == 1]
    assert np.mean([r.predicted for r in good]) > 0.97


def test_awkward_rows(spark):
    rows = documents()
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, 7, 0), (5, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality.score_quality(frame(spark, rows), labels).collect()
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert not any(r.held_out for r in found if r.doc_id is None)
    kept = quality.keep_good(frame(spark, rows), labels)
    assert kept.columns == frame(spark, rows).columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r.doc_id) for r in found if r.predicted)


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score_quality(frame(spark, documents()), none).collect()} == {0.5}
    assert quality.score_quality(empty(spark), none).count() == 0
    assert quality.keep_good(empty(spark), none).count() == 0


def test_held_out_labels_are_not_learned_from(spark):
    rows = [(i, "good words here. " * (i % 7 + 1) if i % 2 else "BAD!! " * 20, *[None] * 6) for i in range(200)]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    true = [(i, i % 2, 0) for i in range(200)]
    wrong = [(i, 1 - q if i in held else q, t) for i, q, t in true]
    scores = [
        sorted((r.doc_id, r.score) for r in quality.score_quality(frame(spark, rows), spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect())
        for x in (true, wrong)
    ]
    assert scores[0] == scores[1]


def test_flattened_trees_walk_like_nodes():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    model = quality.train(x, (x[:, 0] * x[:, 1] > 0).astype(float), trees=10, depth=3)
    for row, score in zip(x[:50], model.score(x[:50])):
        total = model.base
        for features, limits, leaves in zip(model.features, model.limits, model.leaves):
            node = 0
            while node < len(features):
                node = 2 * node + (2 if row[features[node]] > limits[node] else 1)
            total += leaves[node - len(features)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    assert np.mean((quality.train(x, (x[:, 0] > 0.1).astype(float)).score(x) > 0.5) == (x[:, 0] > 0.1)) > 0.97


def test_one_label_only():
    assert quality.train(np.zeros((4, 3)), np.ones(4)).score(np.zeros((1, 3)))[0] == pytest.approx(0.9)
