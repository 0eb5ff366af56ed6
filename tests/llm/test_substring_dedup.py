from __future__ import annotations

import random

import numpy as np
import pytest
from corpus import documents, empty, frame, sentence, shingles

from logloom.llm import substring_dedup
from logloom.llm.text_hash import canonical_words


def rows_with_passages(seed=1):
    """Documents of their own text; passages of over 50 words are planted in some, shorter ones and a common line in others."""
    rng = random.Random(seed)
    texts = [sentence(rng, rng.randint(80, 300)).split(" ") for _ in range(120)]
    passages = [sentence(rng, rng.randint(51, 90)).split(" ") for _ in range(12)] + [sentence(rng, 25).split(" ") for _ in range(4)]
    for passage in passages:
        for i in rng.sample(range(100), rng.randint(2, 5)):
            at = rng.randrange(len(texts[i]))
            texts[i][at:at] = passage
    line = sentence(rng, 13).split(" ")
    for i in range(80, 110):
        at = rng.randrange(len(texts[i]))
        texts[i][at:at] = line
    return [(i, " ".join(w), "en", "a", 0, 0, "k", "c") for i, w in enumerate(texts)]


def sharing(rows, words):
    """Ids of documents that share that many words in a row with another one."""
    where: dict[str, set] = {}
    for i, text, *_ in rows:
        for run in shingles(text, words):
            where.setdefault(run, set()).add(i)
    return set().union(*(ids for ids in where.values() if len(ids) > 1))


@pytest.mark.parametrize("seed", range(3))
def test_planted_passages(spark, scratch, seed):
    rows = rows_with_passages(seed)
    holders = sharing(rows, 50)
    found = substring_dedup.repeated_passages(frame(spark, rows), scratch)
    assert found.columns == ["doc_id", "start_word", "n_words", "other_doc_id", "kept"]
    got = found.collect()
    assert {r.doc_id for r in got} == holders and len(holders) > 20
    texts = {r[0]: r[1].split(" ") for r in rows}
    for r in got:
        mine, theirs = texts[r.doc_id][r.start_word : r.start_word + r.n_words], " ".join(texts[r.other_doc_id])
        assert any(" ".join(mine[i : i + 8]) in theirs for i in range(len(mine)))
    assert all(r.kept for r in got if r.doc_id == min(holders))


def test_the_first_holder_of_a_chain_has_less_than_the_passage(spark, scratch):
    rows, holders = [], set()
    for k in range(12):
        rng = random.Random(100 + k)
        passage = sentence(rng, 52).split(" ")
        for i, words in ((0, 49), (1, 52), (2, 52), (3, 49)):  # the lowest and the highest id have a part only
            text = " ".join([sentence(rng, 40), *passage[:words], sentence(rng, 40)])
            rows.append((1000 * i + k, text, "en", "a", 0, 0, "k", "c"))
        holders |= {1000 + k, 2000 + k}
    assert sharing(rows, 50) == holders
    found = substring_dedup.repeated_passages(frame(spark, rows), scratch).collect()
    assert {r.doc_id for r in found} == holders
    assert all(r.other_doc_id in (r.doc_id + 1000, r.doc_id - 1000) for r in found)


def check_decisions(rows, got):
    """Every passage keeps a holder; whatever is dropped is in a lower document; partners share 50 words at the run."""
    texts = {r[0]: r[1].split(" ") for r in rows}
    windows: dict[int, set] = {i: {" ".join(w[k : k + 50]) for k in range(len(w) - 49)} for i, w in texts.items()}
    holders: dict[str, list] = {}
    for i, own in windows.items():
        for w in own:
            holders.setdefault(w, []).append(i)
    for r in got:
        at = range(max(0, r.start_word - 49), min(r.start_word + r.n_words, len(texts[r.doc_id]) - 49))
        touching = {" ".join(texts[r.doc_id][k : k + 50]) for k in at}
        partners = {i for w in touching for i in holders[w]} - {r.doc_id}
        assert r.other_doc_id == min({min(holders[w]) if min(holders[w]) < r.doc_id else max(holders[w]) for w in touching if len(holders[w]) > 1})
        assert r.other_doc_id in partners
    left = {}
    for i, words in texts.items():
        gone = {k for r in got if r.doc_id == i and not r.kept for k in range(r.start_word, r.start_word + r.n_words)}
        left[i] = {" ".join(words[k : k + 50]) for k in range(len(words) - 49) if not gone & set(range(k, k + 50))}
    kept = set().union(*left.values())
    for w, ids in holders.items():
        if len(ids) > 1:
            assert w in kept, ids


def test_a_low_document_with_a_part_keeps_nothing_from_the_others(spark, scratch):
    rng = random.Random(12)
    rows = []
    for k in range(6):
        passage = sentence(rng, 70).split(" ")
        for i, words in ((0, 25), (1, 70), (2, 70)):
            rows.append((100 * i + k, " ".join([sentence(rng, 60), *passage[:words], sentence(rng, 60)]), "en", "a", 0, 0, "k", "c"))
    got = substring_dedup.repeated_passages(frame(spark, rows), scratch).collect()
    assert {(r.doc_id, r.other_doc_id, r.kept) for r in got} == {(100 + k, 200 + k, True) for k in range(6)} | {
        (200 + k, 100 + k, False) for k in range(6)
    }
    check_decisions(rows, got)


def test_passages_that_meet_in_one_document(spark, scratch):
    rng = random.Random(13)
    one, two = sentence(rng, 60), sentence(rng, 60)
    texts = [f"{sentence(rng, 40)} {one}", f"{two} {sentence(rng, 40)}", f"{sentence(rng, 30)} {one} {two} {sentence(rng, 30)}"]
    rows = [(i, t, "en", "a", 0, 0, "k", "c") for i, t in enumerate(texts)]
    got = substring_dedup.repeated_passages(frame(spark, rows), scratch).collect()
    assert {r.doc_id for r in got} == {0, 1, 2}
    check_decisions(rows, got)


@pytest.mark.parametrize("seed", range(2))
def test_nothing_is_dropped_everywhere(spark, scratch, seed):
    rows = rows_with_passages(seed + 10)
    got = substring_dedup.repeated_passages(frame(spark, rows), scratch).collect()
    assert {r.kept for r in got} == {True, False}
    check_decisions(rows, got)


def test_blanks_and_case_do_not_matter(spark, scratch):
    rng = random.Random(9)
    passage = sentence(rng, 80)
    rows = [
        (1, sentence(rng, 60) + " " + passage, *[None] * 6),
        (2, "".join(c.upper() if c.isascii() else c for c in passage).replace(" ", "\n\t") + " " + sentence(rng, 50), *[None] * 6),
        (3, sentence(rng, 200), *[None] * 6),
    ]
    found = substring_dedup.repeated_passages(frame(spark, rows), scratch).collect()
    assert {(r.doc_id, r.other_doc_id, r.kept) for r in found} == {(1, 2, True), (2, 1, False)}


def test_awkward_rows(spark, scratch):
    rows = documents()
    got = substring_dedup.repeated_passages(frame(spark, rows), scratch).collect()
    assert all(r.doc_id is not None and r.doc_id != r.other_doc_id for r in got)
    assert {0, 30, 54} & {r.doc_id for r in got}
    assert substring_dedup.repeated_passages(empty(spark), scratch).count() == 0


def test_chunks_fall_into_step_after_an_insertion():
    rng = random.Random(4)
    text = sentence(rng, 3000)
    data = canonical_words(text)[0]
    shifted = np.concatenate([data[:500], np.frombuffer(b"inserted words ", np.uint8), data[500:]])
    ends, moved = substring_dedup.chunk_ends(data), substring_dedup.chunk_ends(shifted)
    assert set(ends[ends > 600] + 15) == set(moved[moved > 615])
    gaps = np.diff(ends)
    assert substring_dedup.NEAR < gaps.min() and 40 < gaps.mean() < 60 and gaps.max() <= substring_dedup.LONGEST


def test_ends_by_the_definition():
    rng = random.Random(6)
    data = np.frombuffer("".join(rng.choices("ab ", k=400)).encode(), np.uint8)
    gear = [sum(int(substring_dedup._GEAR[data[i - k]]) << 2 * k for k in range(16) if i >= k) & 0xFFFFFFFF for i in range(400)]
    near = substring_dedup.NEAR
    expected = [
        i + 1 for i in range(near, 400 - near) if gear[i] < min(gear[i - near : i]) and gear[i] <= min(gear[i + 1 : i + near + 1])
    ]
    assert substring_dedup.chunk_ends(data).tolist() == expected


def test_one_letter_repeated_is_cut():
    data = np.frombuffer(sentence(random.Random(1), 60).encode() + b"z" * 50_000 + sentence(random.Random(2), 60).encode(), np.uint8)
    assert np.diff(substring_dedup.chunk_ends(data)).max() <= substring_dedup.LONGEST
