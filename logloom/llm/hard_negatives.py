"""Hard negatives by exact integer products of packed vectors.

Vectors become whole numbers. A block of candidates is packed by Kronecker
substitution: per dimension one wide integer holds the components of all
candidates, made non-negative by a bias, in fields as wide as the largest
score. One multiplication by an anchor's component serves the whole block, and
the sum over the dimensions holds every candidate's score in its field, from
which the biases are taken again.

The anchors are a stated query set: they go to the tasks in chunks of bounded
size, and every chunk meets all rows, block by block, where those lie.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from logloom.operators.numbering import dense_numbers
from logloom.scratch import Scratch

BLOCK = 4096  # candidates in one wide integer
CHUNK_BYTES = 8 << 20  # of anchors that are broadcast at once
LONG = np.iinfo(np.int64)


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, as 64-bit or, where these don't hold them, Python integers."""
    if not vectors.size or np.abs(vectors).max() < 2.0**52 / scale:
        return np.floor(vectors * float(scale)).astype(np.int64)
    flat = [int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in vectors.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(vectors.shape)


class PackedBlock:
    """Candidates (rows of whole numbers) packed for anchors whose components are at most `reach` in size."""

    def __init__(self, values: np.ndarray, reach: int):
        self.count, self.dims = values.shape
        self.reach = reach
        self.bias = int(np.abs(values).max()) if values.size else 0
        bits = (4 * self.dims * reach * self.bias).bit_length()
        self.width = 4 if bits <= 32 else 8 * -(-bits // 64)  # bytes of a field
        self.exact = bits <= 62  # else scores are Python integers
        self.packed = [self._pack(values[:, i] + self.bias) for i in range(self.dims)]
        self.sums = values.sum(axis=1) if self.exact else np.array([sum(map(int, v)) for v in values], dtype=object)

    def _pack(self, column: np.ndarray) -> int:
        if self.width <= 8:
            return int.from_bytes(column.astype(f"<u{self.width}").tobytes(), "little")
        return int.from_bytes(b"".join(int(x).to_bytes(self.width, "little") for x in column), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner product of every candidate with the anchor."""
        total = sum((a + self.reach) * wide for a, wide in zip(anchor, self.packed))
        data = int(total).to_bytes(self.count * self.width, "little")
        biases = self.bias * sum(anchor) + self.dims * self.reach * self.bias
        if self.exact:
            return np.frombuffer(data, f"<u{self.width}").astype(np.int64) - (self.reach * self.sums + biases)
        fields = [int.from_bytes(data[i : i + self.width], "little") for i in range(0, len(data), self.width)]
        found = [min(max(f - self.reach * int(s) - biases, LONG.min), LONG.max) for f, s in zip(fields, self.sums)]
        return np.array(found, dtype=np.int64)


def blocks(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of the rows of a batch, split by the length of the vectors and into blocks."""
    vectors = batch.column("vector")
    lengths = np.diff(vectors.offsets.to_numpy())
    starts = vectors.offsets.to_numpy()[:-1]
    values = vectors.values.to_numpy()
    ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
    for dims in np.unique(lengths):
        rows = np.flatnonzero(lengths == dims)
        for first in range(0, len(rows), BLOCK):
            part = rows[first : first + BLOCK]
            yield ids[part], labels[part], whole_numbers(values[starts[part, None] + np.arange(dims)], scale)


def _first(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the highest scores, ties by smaller id."""
    # -1 - x turns the order of all longs round without overflow
    return np.lexsort((ids, ~scores))[:most]


class Best:
    """The first few candidates of every slot, over all blocks of a task."""

    def __init__(self, most: int):
        self.most = most
        self.held: dict[int, list[tuple[int, int]]] = {}

    def offer(self, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        held = self.held.get(slot, [])
        if len(held) == self.most:
            good = scores >= -held[-1][0]
            scores, ids = scores[good], ids[good]
        if len(scores):
            places = _first(scores, ids, self.most)
            new = [(-int(s), i) for s, i in zip(scores[places], ids[places].tolist())]
            self.held[slot] = sorted(held + new)[: self.most]

    def batch(self, id_type: pa.DataType) -> pa.RecordBatch:
        rows = [(slot, i, -s) for slot, held in self.held.items() for s, i in held]
        columns = list(zip(*rows)) or [(), (), ()]
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), id_type, pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names=["slot", "id", "score"])


def _search(rows: DataFrame, anchors: pa.Table, scale: int, most: int, wanted: Callable) -> DataFrame:
    """(slot, id, score): of each task the first `most` rows for each slot that `wanted` makes of an anchor.

    `wanted(number, id, label, ids, labels, scores)` gives (slot, mask) for the
    anchor of that number, which has no more than CHUNK_BYTES of company.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(anchors)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = []
        for part in shipped.value.to_batches():
            for ids, labels, vectors in blocks(part, scale):
                known.append((list(zip(ids.tolist(), labels.tolist(), [[int(x) for x in v] for v in vectors])), vectors))
        best, id_type = Best(most), None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for ids, labels, vectors in blocks(batch, scale):
                for facts, theirs in known:
                    if theirs.shape[1] != vectors.shape[1]:
                        continue
                    block = PackedBlock(vectors, int(np.abs(theirs).max()) if theirs.size else 0)
                    for anchor, label, numbers in facts:
                        scores = block.scores(numbers) if numbers else np.zeros(len(ids), np.int64)
                        for slot, mask in wanted(anchor, label, ids, labels, scores):
                            best.offer(slot, scores[mask], ids[mask])
        if best.held:
            yield best.batch(id_type)

    id_name = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(search, f"slot long, id {id_name}, score long")


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    work: Scratch,
    *,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
) -> DataFrame:
    """Per anchor and positive its hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components x count as floor(scale * x); a score is the exact inner product
    with the anchor, shown as the nearest long if it is beyond 64 bits. Higher
    scores come first, ties by smaller id. An anchor's positives are its first
    other rows of the same label; a positive's negatives are the first rows of
    other labels that score at most as much and at least `least_percent` of it.
    `anchors` is a condition over `rows`; ids are whole numbers.

    Rows without id, label or vector, or with a null or non-finite component,
    take no part; rows of one id count once, with their smallest label and
    vector; vectors meet those of their own length only, empty ones have score
    0. Anchors without positives, and positives without negatives, have no
    row. Further columns, whatever their names, say nothing. An empty table
    gives no rows.
    """
    spark = rows.sparkSession
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    usable = rows.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"), vector.alias("vector"), anchors.alias("is_anchor")
    )
    # a comparison with the largest double fails for nulls, infinities and not-a-numbers alike
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) <= F.lit(float(np.finfo(float).max)), F.lit(False)))
    usable = usable.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    usable = usable.groupBy("id").agg(F.min(F.struct("label", "vector", "is_anchor")).alias("kept")).select("id", "kept.*")
    usable = work.keep(usable, "vectors")
    asked = usable.where("is_anchor").select("id", "label", "vector")
    numbered = work.keep(dense_numbers(asked, ["id"], "number", work), "anchors")
    count, dims = numbered.agg(F.count("*"), F.max(F.size("vector"))).first()
    a_chunk = max(1, CHUNK_BYTES // (8 * (dims or 0) + 64))
    candidates = usable.select("id", "label", "vector")
    id_name = usable.schema["id"].dataType.simpleString()
    schema = f"anchor_id {id_name}, positive_id {id_name}, rank int, negative_id {id_name}, positive_score long, negative_score long"
    folder = work.path("negatives")
    for first in range(0, count, a_chunk):
        chunk = numbered.where(F.col("number").between(first, first + a_chunk - 1)).orderBy("number")
        table = chunk.select("id", "label", "vector").toArrow()
        numbers = {x: i for i, x in enumerate(table.column("id").to_pylist())}

        def same_label(anchor, label, ids, labels, scores):
            yield numbers[anchor], (labels == label) & (ids != anchor)

        liked = _ranked(_search(candidates, table, scale, positives, same_label), positives)
        liked = work.keep(liked, "positives")
        of_anchor: dict[int, dict[int, int]] = {}  # the distinct scores of an anchor's positives, each a slot of its own
        for slot, score in liked.select("slot", "score").distinct().collect():  # `positives` an anchor at most
            scores_of = of_anchor.setdefault(slot, {})
            scores_of[score] = slot * positives + len(scores_of)

        def in_reach(anchor, label, ids, labels, scores):
            others = labels != label
            for score, slot in of_anchor.get(numbers[anchor], {}).items():
                yield slot, others & (scores <= score) & (scores >= -(-least_percent * score // 100))

        slots = [(table.column("id")[a].as_py(), a, s, slot) for a, held in of_anchor.items() for s, slot in held.items()]
        of_slot = spark.createDataFrame(slots, f"anchor_id {id_name}, number long, positive_score long, slot long")
        found = _ranked(_search(candidates, table, scale, negatives, in_reach), negatives)
        found = found.select("slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(of_slot, "slot")
        pairs = liked.select(F.col("slot").alias("number"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
        told = found.join(pairs, ["number", "positive_score"])
        told.select(*[part.split(" ")[0] for part in schema.split(", ")]).write.parquet(f"{folder}/chunk-{first // a_chunk}")
    if not count:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/chunk-*")
