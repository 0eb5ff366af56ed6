"""Near-duplicate documents by MinHash.

The sketch is Fast Similarity Sketching (Dahlgaard, Knudsen, Thorup, 2017):
in round i every shingle is thrown into one of the t bins and leaves i plus a
hashed fraction there, the smallest value stays; in rounds t..2t-1 all
shingles go to bin i - t, so every bin fills. Rounds end when none is empty.
Bands of the sketch are the buckets, whole shingle sets decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from logloom.llm.linking import components, link_buckets
from logloom.llm.text_hash import BASE, SEED, canonical_words, hashed_spans, scrambled, seeds
from logloom.scratch import Scratch

def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of `words` words of a text; of all its words if it has fewer."""
    data, starts, ends = canonical_words(text)
    if not len(starts):
        return np.empty(0, np.uint64)
    run = min(words, len(starts))
    return np.unique(hashed_spans(data, starts[: len(starts) - run + 1], ends[run - 1 :]))


def sketch(shingles: np.ndarray, size: int) -> np.ndarray:
    """The `size` coordinates of a non-empty set; a coordinate is round * 2^48 + hashed fraction."""
    bins = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    turns = seeds(2 * size, SEED + 1000)
    step = max(1, 1024 // len(shingles))
    done = 0
    while done < 2 * size and (bins == np.iinfo(np.uint64).max).any():
        rounds = np.arange(done, min(2 * size, done + step), dtype=np.uint64)
        thrown = scrambled(shingles[None, :] ^ turns[done : done + len(rounds), None])
        places = np.where(rounds[:, None] < size, (thrown >> np.uint64(48)) % np.uint64(size), rounds[:, None] - np.uint64(size))
        values = (rounds[:, None] << np.uint64(48)) | (thrown & np.uint64((1 << 48) - 1))
        np.minimum.at(bins, places.ravel().astype(np.int64), values.ravel())
        done += len(rounds)
    return bins


def _described(text: str | None, words: int, bands: int, rows: int, bits: int) -> tuple:
    """(number of shingles, two digests of the set, band keys, one bit of each coordinate as words of 64 bits)."""
    shingles = shingle_set(text, words)
    if not len(shingles):
        return 0, None, None, None, None
    with np.errstate(over="ignore"):
        digests = [int(scrambled(shingles ^ seed).sum(dtype=np.uint64).astype(np.int64)) for seed in seeds(2, 7)]
        bins = sketch(shingles, bits)
        keys = np.arange(1, bands + 1, dtype=np.uint64)
        for column in bins[: bands * rows].reshape(bands, rows).T:
            keys = scrambled(keys * np.uint64(BASE) + column)
    one_each = np.packbits((scrambled(bins) & np.uint64(1)).astype(np.uint8))
    return len(shingles), *digests, keys.view(np.int64), one_each.view(np.int64)


def near_duplicates(
    docs: DataFrame,
    work: Scratch,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = 75,
    words: int = 5,
    bands: int = 32,
    rows: int = 4,
    bits: int = 1024,
) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id, kept.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| for
    their sets of shingles; component_id is the smallest id that links reach,
    kept says that it is the row's own id. The sketch has `bits` coordinates, a
    multiple of 64. A pair of that likeness shares no band with probability
    (1 - (percent/100)^rows)^bands, 5e-6 by default; before whole sets are
    compared, one bit of each coordinate shows pairs that are clearly less
    alike.

    Null and empty texts and texts of blanks have no shingles and are linked
    with nothing. Equal sets are one class and never compared. Rows of one id
    are one document, linked by whatever any of its rows is linked by. A row
    without id is linked with nothing and kept; its component is null.
    Further columns are not looked at. An empty table gives no rows.
    """
    # every name is set here, so columns of the input cannot clash with those made below
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_described(t, words, bands, rows, bits) for t in batch.column("text").to_pylist()]
            columns = zip(*found) if found else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *arrays], names=["id", "n_shingles", "digest_1", "digest_2", "bands", "bits"]
            )

    id_type = docs.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n_shingles long, digest_1 long, digest_2 long, bands array<long>, bits array<long>"
    sketches = work.keep(docs.mapInArrow(describe, schema), "sketches", compression="zstd")

    known = sketches.where("n_shingles > 0 AND id IS NOT NULL")
    digest = ["digest_1", "digest_2"]
    classes = work.keep(known.groupBy(*digest).agg(F.min("id").alias("class_id")), "classes")
    classed = known.select("id", *digest).join(classes, digest)
    copies = classed.where("id <> class_id").select(F.col("id").alias("a"), F.col("class_id").alias("b"))

    # One row per class: digests and first id agree.
    firsts = known.join(classes.withColumnRenamed("class_id", "id"), [*digest, "id"], "left_semi")
    firsts = firsts.dropDuplicates([*digest, "id"])
    places = [f"bits_{i}" for i in range(bits // 64)]
    records = firsts.select("id", "n_shingles", *[F.col("bits")[i].alias(name) for i, name in enumerate(places)])
    buckets = firsts.select(F.explode("bands").alias("key"), "id")
    # Bits of unlike coordinates agree by half, so those of a pair of the wanted likeness agree in
    # (1 + percent/100)/2 of them; 4 standard deviations below that (3e-5) it is not such a pair.
    agree = (1 + percent / 100) / 2
    deviation = (bits * agree * (1 - agree)) ** 0.5

    def within(deviations: float):
        most_apart = int(bits * (1 - agree) + deviations * deviation)

        def near(left: str, right: str) -> Column:
            apart = sum((F.bit_count(F.col(f"{left}.{p}").bitwiseXOR(F.col(f"{right}.{p}"))) for p in places), F.lit(0))
            sizes = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
            return (100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (apart <= most_apart)

        return near

    part = work.part()

    def verifier(ids: DataFrame):
        packed = packed_texts(docs).join(ids, "id", "left_semi")
        packed = part.keep(packed, "packed-texts")
        return lambda pairs: _verified(part.keep(pairs, "pairs"), packed, percent, words)

    links = link_buckets(buckets, records, within(4.0), verifier, part, likely=within(0.5))
    groups = work.keep(components(links.unionAll(copies), part), "groups").withColumnRenamed("id", "member")
    part.drop()
    found = sketches.select("id", "n_shingles").join(groups, F.col("id") == F.col("member"), "left")
    component = F.coalesce("component", "id")
    return found.select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, work: Scratch, *, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns, whatever their names; rows of one id stay or go together."""
    part = work.part()
    found = near_duplicates(docs, part, id_column=id_column, **options)
    gone = work.keep(found.where("NOT kept").select(F.col(id_column).alias("gone_id")).distinct(), "gone")
    part.drop()
    return docs.alias("d").join(gone.alias("g"), F.col(f"d.`{id_column}`") == F.col("g.gone_id"), "left_anti")


def packed_texts(docs: DataFrame) -> DataFrame:
    """(id, text), each text compressed: they travel in shuffles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shrink = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [None if t is None else shrink.compress(t.encode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.binary())], names=["id", "text"])

    return docs.mapInArrow(pack, f"id {docs.schema['id'].dataType.simpleString()}, text binary")


def _verified(pairs: DataFrame, packed: DataFrame, percent: int, words: int) -> DataFrame:
    """Those of the pairs (a, b) whose whole shingle sets are alike enough."""
    left = packed.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = packed.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    ends = pairs.join(left, "a").join(right, "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor()

        def shingles(text: bytes | None) -> np.ndarray:
            return shingle_set(text and grow.decompress(text).decode("utf-8"), words)

        last: tuple[bytes | None, np.ndarray] = (None, shingles(None))
        for batch in batches:
            alike = []
            for text_a, text_b in zip(batch.column("text_a"), batch.column("text_b")):
                text_b = text_b.as_py()
                if text_b != last[0]:
                    last = (text_b, shingles(text_b))
                a, b = shingles(text_a.as_py()), last[1]
                both = len(np.intersect1d(a, b, assume_unique=True))
                alike.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
            pairs_of_batch = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield pairs_of_batch.filter(pa.array(alike, pa.bool_()))

    return ends.select("a", "b", "text_a", "text_b").mapInArrow(compare, pairs.schema).distinct()
