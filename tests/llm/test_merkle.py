"""Merkle manifests against trees built in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from corpus import documents, empty, frame
from pyspark.sql import functions as F

from logloom.llm import merkle
from logloom.llm.merkle import merkle_manifest
from logloom.llm.queries import op12_merkle


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row) -> str:
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(hashes: list[str]) -> list[list[str]]:
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def climb(levels: list[list[str]], pos: int, now: str) -> tuple[str, str]:
    proof = ""
    for level in levels[:-1]:
        first = pos - pos % 3
        run = level[first : first + 3]
        proof += "".join(h for i, h in enumerate(run) if i != pos % 3)
        run[pos % 3] = now
        now, pos = digest("".join(run)), pos // 3
    return proof, now


def brute_force(rows: list[tuple], changed) -> list[tuple]:
    """Rows (doc_id, source, lang, n_chars, text)."""
    by_source: dict = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0], leaf_of(row), leaf_of((*row[:4], changed(row)))))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for held in by_source.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    trees = [tree_of([leaf for _, leaf, _ in by_source[s]]) for s in order]
    top = tree_of([t[-1][0] for t in trees])
    root, found = top[-1][0], []
    for number, source in enumerate(order):
        for pos, (doc_id, leaf, now) in enumerate(by_source[source]):
            low, reached = climb(trees[number], pos, now)
            high, reached = climb(top, number, reached)
            found.append((doc_id, leaf, trees[number][-1][0], root, digest(low + high), reached, reached == root))
    return found


def without_newlines(row):
    doc_id, text = row[0], row[4]
    even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
    return text.replace("\n", "") if even and text is not None else text


def now():
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return {"text": F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


def fields(row):
    return (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])


def check(found, rows):
    key = lambda r: tuple(str(x) for x in r)
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found.collect()]
    assert sorted(got, key=key) == sorted(brute_force(rows, without_newlines), key=key)
    return got


@pytest.mark.parametrize("wide", [4096, 4])
def test_awkward_rows(spark, scratch, monkeypatch, wide):
    """Null ids, sources and texts, repeated rows, long and empty texts, further columns; with and without nodes to broadcast."""
    monkeypatch.setattr(merkle, "WIDE", wide)
    docs = frame(spark, documents()).withColumns({"leaf": F.lit("x"), "tree": F.lit(1), "at": F.lit(2), "folded": F.lit(3)})
    got = check(merkle_manifest(docs, scratch, now=now()), [fields(r.asDict()) for r in docs.collect()])
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [1, 1], [27, 1, 28, 10], [1] * 10])
def test_sizes_of_trees(spark, scratch, sizes):
    rows, number = [], 0
    for source, size in enumerate(sizes):
        for _ in range(size):
            rows.append((number, f"s{source}", None, number, f"text\n{number}"))
            number += 1
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    check(merkle_manifest(docs, scratch, now=now()), rows)


def test_unchanged_rows_are_verified(spark, scratch):
    docs = frame(spark, documents())
    assert merkle_manifest(docs, scratch).where("NOT verified").count() == 0


def test_no_rows(spark, scratch):
    found = merkle_manifest(empty(spark), scratch)
    assert found.count() == 0
    assert found.dtypes == merkle_manifest(frame(spark, documents()), scratch).dtypes


def test_the_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [fields(r.asDict()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check(op12_merkle(spark, folder), rows)


@pytest.mark.parametrize("wide", [4096, 4])
def test_hashes_are_kept_where_they_arrive(spark, scratch, monkeypatch, wide):
    """A row per leaf and level with the siblings; the folded hash in the last of them alone."""
    monkeypatch.setattr(merkle, "WIDE", wide)
    climbed, climb_all = [], merkle._climb_all

    def seen(*args):
        climbed.append(climb_all(*args))
        return climbed[0]

    monkeypatch.setattr(merkle, "_climb_all", seen)
    rows = [(i, "s", None, i, f"text\n{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    check(merkle_manifest(docs, scratch, now=now()), rows)
    assert climbed[0].count() == 30 * 4 and climbed[0].where("folded IS NOT NULL").count() == 30
