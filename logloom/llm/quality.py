"""Quality scores: histogram gradient-boosted trees over statistics of the document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".?",
    "comma": b",;:",
    "bang": b"!",
    "bar": b"|",
    "money": b"$%&#*@^~",
    "bracket": b"()[]{}<>=/\\_+",
    "quote": b"'\"`-",
    "beyond": bytes(range(128, 256)),
    "control": bytes([*range(9), *range(14, 32), 127]),
}
FEATURES = (
    "log_chars", "log_words", "word_length", "distinct_words", "longest_word", "capital_words",
    "log_lines", "line_words", "distinct_lines", "repeated_line_share", "short_lines", "bullet_lines", "packed",
    *CLASSES,
)
_CLASS_OF = np.zeros((len(CLASSES), 256))
for _row, _bytes in enumerate(CLASSES.values()):
    _CLASS_OF[_row, list(_bytes)] = 1


def statistics(text: str | None) -> np.ndarray:
    """The FEATURES of a whole text; all zero for a null or empty one."""
    out = np.zeros(len(FEATURES), np.float32)
    if not text:
        return out
    data = text.encode("utf-8", "replace")
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    count, rows = max(1, len(words)), max(1, len(lines))
    distinct_lines = set(lines)
    counted = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    out[:13] = (
        np.log1p(len(text)),
        np.log1p(len(words)),
        sum(map(len, words)) / count,
        len(set(words)) / count,
        max(map(len, words), default=0),
        sum(w[0].isupper() for w in words) / count,
        np.log1p(len(lines)),
        len(words) / rows,
        len(distinct_lines) / rows,
        1 - sum(map(len, distinct_lines)) / max(1, sum(map(len, lines))),
        sum(len(x) < 30 for x in lines) / rows,
        sum(x.lstrip()[:1] in "-*•|#>" for x in lines) / rows,
        len(zlib.compress(data, 1)) / len(data),
    )
    out[13:] = _CLASS_OF @ counted / len(data)
    return out


@dataclass
class Trees:
    """Complete binary trees of one depth, flattened: node n of a tree has the children 2n + 1 and 2n + 2."""

    base: float
    features: np.ndarray  # trees x inner nodes
    limits: np.ndarray  # trees x inner nodes; larger values go right
    leaves: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for every row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.features.shape[1]
        depth = self.leaves.shape[1].bit_length() - 1
        for features, limits, leaves in zip(self.features, self.limits, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, features[node]] > limits[node])
            total += leaves[node - inner]
        return 1 / (1 + np.exp(-total))


def train(
    x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0
) -> Trees:
    """Trees fitted to the logistic loss; rows are counted in histograms of at most `bins` bins per feature.

    Without rows every score is 0.5; with rows of one label only, it is that
    label's smoothed share.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    inner, width = (1 << depth) - 1, x.shape[1]
    if not 0 < y.sum() < len(y):
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(width) * bins
    total = np.full(len(y), base)
    built = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, hessian = y - p, p * (1 - p)
        features, limits = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            place = ((node - first)[:, None] * (width * bins) + flat).ravel()
            size = nodes * width * bins
            g, h = (
                np.cumsum(np.bincount(place, np.repeat(v, width), size).reshape(nodes, width, bins), axis=2)
                for v in (gradient, hessian)
            )
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < 1e-3) | (all_h - h < 1e-3)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for n, place_of_best in enumerate(best):
                f, b = divmod(int(place_of_best), bins)
                if gain[n, f, b] > 1e-6 and b < len(edges[f]):
                    features[first + n], limits[first + n] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), features[node]] > limits[node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, hessian, inner + 1)
        leaves = rate * g / (h + ridge)
        total += leaves[leaf]
        built.append((features, limits, leaves))
    return Trees(base, *(np.stack(part) for part in zip(*built)))


def _held_out(id_column: str):
    left = F.crc32(F.col(id_column).cast("string").cast("binary")) % 5
    return F.coalesce(left == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    train_rows: int = 20_000,
) -> Trees:
    """A model of the labels 0 and 1, learned from `train_rows` labelled rows at most, chosen by a hash of the id.

    Rows whose crc32 of the id as text is divisible by 5 are not learned from.
    """
    label = F.col(label_column).cast("int")
    given = labels.where(F.col(id_column).isNotNull() & ~_held_out(id_column))
    given = given.select(F.col(id_column).alias("id"), label.alias("label")).where("label IN (0, 1)")
    given = given.orderBy(F.xxhash64("id"), "id", "label").limit(train_rows)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    known = rows.join(F.broadcast(given), "id")  # train_rows rows at most

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array([statistics(t.as_py()) for t in batch.column("text")], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([stats, batch.column("label"), batch.column("turn")], names=["stats", "label", "turn"])

    # rows of one id may be many more than labels
    known = known.withColumn("turn", F.xxhash64("id", "text")).mapInArrow(describe, "stats array<float>, label int, turn long")
    sample = known.orderBy("turn", "label").limit(train_rows).toArrow()
    x = np.array(sample.column("stats").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return train(x, sample.column("label").to_numpy().astype(np.float64))


def _scores(model: Trees, batch: pa.RecordBatch, text_column: str) -> np.ndarray:
    stats = [statistics(t.as_py()) for t in batch.column(text_column)]
    return model.score(np.array(stats, np.float64).reshape(-1, len(FEATURES)))


def score_quality(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.3, **options
) -> DataFrame:
    """One row per row of `docs`: id, held_out, score, predicted.

    The model is that of `fit`; only its training sample is bounded, every
    text is described and scored whole. Labels other than 0 and 1 and labels
    without document are left out; a document labelled twice counts twice.
    Without any label all scores are 0.5. Null and empty texts are scored like
    others, by statistics of zero. A row without id is never learned from and
    not held out. Rows of one id are scored one by one. An empty table gives
    no rows.
    """
    model = fit(docs, labels, id_column=id_column, text_column=text_column, **options)
    rows = docs.select(F.col(id_column).alias("id"), _held_out(id_column).alias("held_out"), F.col(text_column).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(_scores(model, batch, "text"), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), found], names=["id", "held_out", "score"])

    scored = rows.mapInArrow(score, f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, score double")
    return scored.select(
        F.col("id").alias(id_column), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.3, **options
) -> DataFrame:
    """The rows of `docs` whose score is at least `threshold`, with all their columns."""
    model = fit(docs, labels, id_column=id_column, text_column=text_column, **options)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch, text_column) >= threshold))

    return docs.mapInArrow(choose, docs.schema)
