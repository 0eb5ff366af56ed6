from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from corpus import documents, empty, frame

from logloom.llm import token_files
from logloom.llm.token_files import Boundaries, WordEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(5))
def test_boundaries(seed):
    rng = np.random.default_rng(seed)
    steps = rng.integers(0, [1, 2, 50, 5000, 1 << 40][seed], 3000)
    values = np.cumsum(steps)
    bounds = Boundaries.of(values)
    again = Boundaries(bounds.count, bounds.low_bits, bounds.lows, bounds.highs)
    assert again.all().tolist() == values.tolist()
    assert [again.select(i) for i in range(0, 3000, 7)] == values[::7].tolist() and again.select(2999) == values[-1]
    with pytest.raises(IndexError):
        again.select(3000)
    bits = 8 * (len(bounds.lows) + len(bounds.highs)) / 3000
    assert bits <= 3 + max(0, np.log2(max(1, values[-1] / 3000)))
    assert Boundaries.of(values[:0]).all().tolist() == []


def test_words_sum_up_to_texts():
    with open(PATH, "rb") as source:
        data = source.read()
    encoder, library = WordEncoder(data, 2), tokenizers.Tokenizer.from_file(PATH)
    rng = random.Random(0)
    texts = ["".join(rng.choices(["a", " ", "b'll", "\n", "é", "  ", "1", ".", "\t", "　", "<|endoftext|>", "😀", "\x85"], k=rng.randint(0, 14))) for _ in range(4000)]
    texts += [r[1] or "" for r in documents()]
    expected = [np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u2").tobytes() for t in texts]
    assert encoder.encode(texts) == expected
    assert encoder.encode(texts) == expected  # from memory


def test_other_tokenizers_are_not_cut():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as source:
        encoder = WordEncoder(source.read(), 2)
    text = "Some  words, and more"
    assert encoder.encode([text]) == [np.array(tokenizers.Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids + [2], "<u2").tobytes()]


@pytest.mark.parametrize("file_bytes", [8 << 20, 5000])
def test_written_and_read_back(spark, scratch, file_bytes):
    rows = [r for r in documents() if r[0] is not None and r[0] != 4]
    library = tokenizers.Tokenizer.from_file(PATH)
    manifest = token_files.write_token_files(frame(spark, rows), scratch, tokenizer_path=PATH, end_id=2, file_bytes=file_bytes)
    found = sorted(token_files.read_token_files(manifest).collect(), key=lambda r: r.start)
    start, expected = 0, []
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in found] == expected
    first = manifest.orderBy("part").first()
    shard = token_files.ShardFile(first.path)
    assert zlib.crc32(shard.document(0).astype("<u4").tobytes()) == expected[0][3]


def test_null_ids_and_no_rows(spark, scratch):
    rows = documents()
    manifest = token_files.write_token_files(frame(spark, rows), scratch, tokenizer_path=PATH, end_id=2)
    found = sorted(token_files.read_token_files(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    none = token_files.write_token_files(empty(spark), scratch, tokenizer_path=PATH, end_id=2)
    assert token_files.read_token_files(none).count() == 0


def test_document_ids_stay_out_of_the_window(spark, scratch):
    manifest = token_files.write_token_files(frame(spark, documents()), scratch, tokenizer_path=PATH, end_id=2)
    plan = token_files.read_token_files(manifest)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if " Window " in line or "- Window" in line)
    below = [line for line in plan[at:] if "Relation" in line][0]
    window = plan[at : plan.index(below)]
    assert not any("doc_ids" in line for line in window)
