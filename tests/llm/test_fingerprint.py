from __future__ import annotations

import hashlib
import random

import pytest
from corpus import documents, edited, empty, frame, sentence

from logloom.llm import fingerprint


def brute_force(rows):
    """Documents in order of id, each with the next one."""
    out = []
    for (i, text, *_), (_, following, *_) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        marks = [fingerprint.digest(t) for t in (text, changed, following)]
        out.append(
            (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), marks[0], marks[1],
             fingerprint.likeness(marks[0], marks[1]), fingerprint.likeness(marks[0], marks[2]))
        )
    return out


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_against_the_sorted_list(spark, scratch, partitions):
    rows = sorted({r[0]: r for r in documents() if r[0] is not None}.values())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = fingerprint.fingerprints(frame(spark, rows), scratch)
        assert [tuple(r) for r in sorted(found.collect())] == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repeated_and_null_ids_have_a_row_each(spark, scratch):
    rows = documents()
    found = fingerprint.fingerprints(frame(spark, rows), scratch).collect()
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in rows)
    assert {(r.doc_id, r.fingerprint) for r in found} == {(r[0], fingerprint.digest(r[1])) for r in rows}


def test_one_document_follows_itself_and_none_has_no_rows(spark, scratch):
    (row,) = fingerprint.fingerprints(frame(spark, [(5, "abcdef", *[None] * 6)]), scratch).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert fingerprint.fingerprints(empty(spark), scratch).count() == 0


def test_likeness_falls_with_edits():
    rng = random.Random(2)
    text = sentence(rng, 500)
    scores = [fingerprint.likeness(fingerprint.digest(text), fingerprint.digest(edited(rng, text, s))) for s in (0, 0.02, 0.1, 0.4)]
    other = fingerprint.likeness(fingerprint.digest(text), fingerprint.digest("".join(rng.choices("qwxyz 0123", k=3000))))
    assert scores[0] == 1 and scores == sorted(scores, reverse=True) and scores[1] > 0.8 > scores[3] > other >= 0


@pytest.mark.parametrize("text", [None, "", "a", "abc", "abcde", "é"])
def test_short_texts(text):
    assert len(fingerprint.digest(text)) == 132 and fingerprint.likeness(fingerprint.digest(text), fingerprint.digest(text)) == 1


def test_slabs_do_not_matter(monkeypatch):
    text = sentence(random.Random(1), 900)
    whole = fingerprint.digest(text)
    monkeypatch.setattr(fingerprint, "SLAB", 100)
    assert fingerprint.digest(text) == whole
