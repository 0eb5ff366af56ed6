"""Document fingerprints: a digest of quartiles of hashed byte triplets.

Every window of five bytes gives five triplets; each is hashed into one of 256
buckets. The digest holds a check byte of the length (its logarithm), the
ratios of the quartiles of the bucket counts, and two bits per bucket: the
quartile its count lies in. Two digests differ by a score that sums steps
between quartiles and between the head fields; it is bounded, and likeness is
what is left of the bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logloom.scratch import Scratch

BUCKETS = 256
SLAB = 1 << 20
# The places of the bytes of a triplet in its window.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 2, 4), (0, 1, 4))
# One permutation of byte values per triplet and place in it.
_MIX = np.random.default_rng(20240613).permuted(np.tile(np.arange(256, dtype=np.uint8), (len(TRIPLETS) * 3, 1)), axis=1)
_MIX = _MIX.reshape(len(TRIPLETS), 3, 256)
# Unrelated texts score about this much; differences above it are all the same.
MOST = 400


def _counts(data: bytes) -> np.ndarray:
    """How many triplets of the bytes fall into each bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    raw = np.frombuffer(data, np.uint8)
    for first in range(0, max(1, len(raw)), SLAB):
        part = raw[first : first + SLAB + 4]
        for (a, b, c), mix in zip(TRIPLETS, _MIX):
            # windows that start in this slab; a window may lack its last bytes at the end of the text
            size = min(len(part) - c, SLAB)
            if size > 0:
                hashed = mix[0][part[a : a + size]] ^ mix[1][part[b : b + size]] ^ mix[2][part[c : c + size]]
                counts += np.bincount(hashed, minlength=BUCKETS)
    return counts


def digest(text: str | None) -> str:
    """The fingerprint as hexadecimal digits: length, two quartile ratios, then the buckets."""
    data = (text or "").encode("utf-8", "replace")
    counts = _counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    length = min(255, int(np.log1p(len(data)) * 12))
    ratios = [int(15 * q / q3) if q3 else 0 for q in (q1, q2)]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    return bytes([length, ratios[0] << 4 | ratios[1]]).hex() + packed.tobytes().hex()


def difference(a: str, b: str) -> int:
    """The bounded score: 0 for equal fingerprints, MOST at most."""
    x, y = (np.frombuffer(bytes.fromhex(d), np.uint8).astype(np.int64) for d in (a, b))
    steps = np.abs((x[2:, None] >> [0, 2, 4, 6] & 3) - (y[2:, None] >> [0, 2, 4, 6] & 3))
    score = int(np.where(steps == 3, 6, steps).sum())
    score += max(0, abs(int(x[0] - y[0])) - 2)
    score += sum(max(0, abs(int((x[1] >> s & 15) - (y[1] >> s & 15))) - 1) for s in (0, 4))
    return min(MOST, score)


def likeness(a: str, b: str) -> float:
    return 1 - difference(a, b) / MOST


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(
    docs: DataFrame, work: Scratch, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of `docs`: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last half replaced by the start of
    the next document's, ascending by id; the first follows the last. Null
    texts are empty. Rows without id come first; rows of one id stand in a
    fixed order of their texts. A single document follows itself, an empty
    table gives no rows.

    Documents are sorted by ranges of id, and each text meets the next one of
    its range. The first and the last of each range are written beside the
    results; the last ones meet the first ones of the next range there.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select("id", F.xxhash64("text").alias("digest"), "row", "text")
    id_type = rows.schema["id"].dataType.simpleString()
    order = "id", "digest", "row"
    results = (
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    names = [part.split(" ")[0] for part in results.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def result(text: str, mark: str, following: str, next_mark: str) -> tuple:
        changed = _edited(text, following)
        changed_mark = digest(changed)
        sha = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
        return len(text), sha, mark, changed_mark, likeness(mark, changed_mark), likeness(mark, next_mark)

    def table(ids: list, id_arrow: pa.DataType, found: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * len(names)
        edge_columns = list(zip(*edges)) or [(), (), ()]
        arrays = [pa.array(ids, id_arrow), *(pa.array(c, t) for c, t in zip(columns, types))]
        arrays += [pa.array(c, t) for c, t in zip(edge_columns, (pa.int64(), pa.int32(), pa.string()))]
        return pa.RecordBatch.from_arrays(arrays, names=["id", *names, "part", "edge", "text"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        nothing = (None,) * len(names)
        held: tuple | None = None  # the document whose next one is still to come
        id_arrow = pa.int64()
        for batch in batches:
            id_arrow = batch.column("id").type
            ids, found, edges = [], [], []
            for number, text in zip(batch.column("id"), batch.column("text")):
                number, text = number.as_py(), text.as_py()
                mark = digest(text)
                if held is None:
                    ids.append(number)
                    found.append(nothing)
                    edges.append((part, 0, text))
                else:
                    ids.append(held[0])
                    found.append(result(held[1], held[2], text, mark))
                    edges.append((None, None, None))
                held = number, text, mark
            yield table(ids, id_arrow, found, edges)
        if held:
            yield table([held[0]], id_arrow, [nothing], [(part, 1, held[1])])

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"id {id_type}, {results}, part long, edge int, text string"
    made = work.keep(ordered.select("id", "text").mapInArrow(describe, schema), "fingerprints", compression="zstd")

    # Two rows per range: the last document of a range is followed by the first of the next range that has any.
    firsts = made.where("edge = 0").select("part", F.col("text").alias("following"))
    lasts = made.where("edge = 1").select("id", "part", "text")
    parts = firsts.select("part")
    after = F.lead("part").over(Window.orderBy("part"))
    steps = parts.select("part", F.coalesce(after, F.min("part").over(Window.partitionBy())).alias("next_part"))
    pairs = lasts.join(steps, "part").join(firsts.withColumnRenamed("part", "next_part"), "next_part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                result(text.as_py(), digest(text.as_py()), following.as_py(), digest(following.as_py()))
                for text, following in zip(batch.column("text"), batch.column("following"))
            ]
            columns = list(zip(*found)) or [()] * len(names)
            arrays = [batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, types))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", *names])

    closed = pairs.select("id", "text", "following").mapInArrow(close, f"id {id_type}, {results}")
    inner = made.where("edge IS NULL").select("id", *names)
    return inner.unionAll(closed).withColumnRenamed("id", id_column)
