from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from corpus import documents, empty, frame

from logloom.llm.piece_fst import BLANK, PieceFst, encode_texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def fst():
    with open(MODEL, "rb") as source:
        return PieceFst(source.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def fuzz(pieces, seed=1):
    rng = random.Random(seed)
    letters = "ab eéth▁  \n\tインd😀龥zq0123.,!?\x00"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choices(pieces, k=rng.randint(1, 12))).replace(BLANK, " ") for _ in range(3000)]
    texts += [" " * n + "x" * (n % 3) for n in range(30)] + ["a" * n for n in range(0, 200, 7)] + ["=-" * n + " " * n for n in range(40)]
    return texts + [r[1] or "" for r in documents()]


def test_encodes_as_the_library(fst, library):
    texts = fuzz(fst.pieces[259:])
    expected = library.encode(texts)
    assert [ids.tolist() for ids in fst.encode(texts)] == expected
    assert [fst.decode(np.array(ids)) for ids in expected] == [library.decode(ids) for ids in expected]


def test_one_path_alone_is_the_same(fst, library):
    for text in fuzz(fst.pieces[259:], seed=2)[::40]:
        normal = fst.normalise(text)
        assert [i for segment in fst.segments(normal) for i in fst.path(segment)] == library.encode(text)
        if len(normal) < 300:
            assert fst.path(normal) == library.encode(text)  # whole, without cuts


def field(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, float):
        return varint(number << 3 | 5) + np.float32(value).tobytes()
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def model(pieces, kind, **normaliser):
    body = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + field(3, k)) for p, s, k in pieces)
    spec = b"".join(field({"prefix": 3, "squeeze": 4}[k], int(v)) for k, v in normaliser.items())
    return body + field(2, field(3, kind)) + field(3, field(1, b"identity") + spec)


PIECES = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [
    (p, -1.0 - i * 0.37 % 3, 1) for i, p in enumerate([BLANK, BLANK + "a", "a", "b", "ab", "ba", "aba", "bb", BLANK + "ab", "c" + BLANK, "c"])
]


@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_unigram_models(prefix, squeeze):
    """Every text's path costs as little as the library's."""
    data = model(PIECES, 1, prefix=prefix, squeeze=squeeze)
    fst, library = PieceFst(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choices("aab bc xé", k=rng.randint(0, 14)))
        ours, theirs = fst.encode([text])[0].tolist(), library.encode(text)
        cost = [sum(-PIECES[i][1] if i else 100 for i in ids) for ids in (ours, theirs)]
        assert cost[0] == pytest.approx(cost[1]) and ours.count(0) == theirs.count(0), (text, ours, theirs)


def test_unsupported_models_are_refused():
    with pytest.raises(ValueError, match="unigram"):
        PieceFst(model(PIECES, 3))
    with pytest.raises(ValueError, match="user-defined"):
        PieceFst(model([*PIECES, ("<x>", 0, 4)], 1))


def test_rows(spark, library):
    rows = documents()
    found = encode_texts(frame(spark, rows), model_path=MODEL, step=7)
    assert found.columns == ["doc_id", "ids", "n_tokens", "ids_crc32", "round_trip"]
    got = sorted((repr(r.doc_id), r.ids, r.n_tokens, r.ids_crc32, r.round_trip) for r in found.collect())
    expected = []
    for i, text, *_ in rows:
        ids = library.encode(text or "")
        expected.append((repr(i), ids, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), BLANK not in (text or "")))
    assert got == sorted(expected)
    assert encode_texts(empty(spark), model_path=MODEL).count() == 0
