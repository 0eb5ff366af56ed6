from __future__ import annotations

import importlib.util
import os
from collections import Counter

import pytest
import sentencepiece
from compare import DATA, differences, duck
from corpus import WORD, documents, empty, frame, shingles, smallest_reachable

from logloom.llm import queries
from logloom.llm.quality import keep_good

pipeline = importlib.import_module("corpus_pipeline") if importlib.util.find_spec("corpus_pipeline") else None
pytestmark = pytest.mark.skipif(pipeline is None or not os.path.exists(f"{DATA}/sf0.001"), reason="no pipeline or data")
FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What every stage got and gave, as written tables."""
    out, docs = [], spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, FOLDER).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return dict(zip([name for name, _ in pipeline.STAGES], out))


def test_stages(steps):
    assert list(steps) == ["quality", "lines", "near_duplicates", "mixing", "sentencepiece"]
    for before, after in list(steps.values())[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString()


def test_quality(spark, steps):
    before, after = steps["quality"]
    kept = keep_good(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert sorted(kept.collect()) == sorted(after.collect()) and 0 < after.count() < before.count()


def test_lines(steps):
    before, after = steps["lines"]
    texts = {r.doc_id: r.text.split("\n") for r in before.collect()}
    seen = set()
    for row in sorted(after.collect()):
        assert row.n_chars == len(row.text)
        left = row.text.split("\n") if row.text else []
        rest = iter(texts[row.doc_id])
        assert all(line in rest for line in left)  # in order
        for line in texts[row.doc_id]:
            if line.strip() and line.strip().lower() not in seen and line not in left:
                # gone though not seen before: like an earlier one
                assert any(abs(len(line) - len(x)) <= 0.1 * len(line) + 1 for x in seen)
            seen.add(line.strip().lower())


def test_near_duplicates(steps):
    before, after = steps["near_duplicates"]
    sets = {r.doc_id: shingles(r.text) for r in before.collect()}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    groups = smallest_reachable(sets, links)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i in sets if groups[i] == i)


def test_mixing(steps):
    before, after = steps["mixing"]
    rows = before.collect()
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in rows}
    times = Counter(r.doc_id for r in after.collect())
    assert max(times.values()) <= 3 and all(size[i] for i in times)
    total, taken = sum(size.values()), sum(size[i] * n for i, n in times.items())
    assert abs(total - taken) < 0.1 * total


def test_token_ids(steps):
    before, after = steps["sentencepiece"]
    library = sentencepiece.SentencePieceProcessor(model_file=pipeline.MODEL)
    expected = sorted((r.doc_id, library.encode(r.text or "")) for r in before.collect())
    assert sorted((r.doc_id, r.ids) for r in after.collect()) == expected


def test_run_applies_the_stages(spark, steps):
    expected = sorted(tuple(r) for r in steps["sentencepiece"][1].collect())
    assert sorted(tuple(r) for r in pipeline.run(spark, FOLDER).collect()) == expected


def test_stages_take_awkward_rows(spark, tmp_path):
    spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (frame(spark, documents()), empty(spark)):
        docs = rows
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        assert (docs.count() == 0) == (rows.count() == 0)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_queries_with_sql(spark, name):
    found = queries.queries()[name](spark, FOLDER)
    ours, theirs, rows = differences(duck(FOLDER), found, queries.oracle_sql()[name])
    assert not ours and not theirs and rows > 0, (ours[:3], theirs[:3])
