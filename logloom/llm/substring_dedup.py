"""Repeated passages by content-defined chunking.

A gear rolling hash runs over the bytes of a text; a byte whose hash is the
smallest among its neighbours ends a chunk, so chunks depend on the bytes
around their ends alone and fall into step again after an insertion. Chunks
are too short to tell: keys are chains of chunks that hold `chain_words` words
or more, one from each chunk on. Chains whose digest occurs in two documents
are repeated; where they overlap or touch they form a run. A run of
`least_words` words is a repeated passage. A passage may reach beyond the run
in it, but only so far that no other chain is wholly inside; where that could
make up for the missing words, windows of `least_words` words at the runs are
compared over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from logloom.llm.minhash import packed_texts
from logloom.llm.text_hash import canonical_words, hashed_spans, scrambled, seeds
from logloom.scratch import Scratch

SLICE = 256  # documents whose chains are Python objects at once
WINDOW = 16  # bytes in the gear hash; each is shifted by two bits more than the next
NEAR = 24  # bytes on either side among which the hash of a chunk's end is the smallest
LONGEST = 1024  # chunks of text without such a byte, like one letter repeated, are cut at this length
_GEAR = (seeds(256, 99) >> np.uint64(32)).astype(np.uint32)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` neighbouring values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Ascending ends of chunks, cut by the bytes around them; what lies before the first and behind the last is no chunk."""
    if len(data) < 2 * NEAR + 1:
        return np.empty(0, np.int64)
    gear = _GEAR[data]
    size = 1
    while size < WINDOW:
        wider = gear.copy()
        wider[size:] += gear[:-size] << np.uint32(2 * size)
        gear, size = wider, 2 * size
    around = _least(gear, NEAR)
    middle = gear[NEAR : len(gear) - NEAR]
    ends = np.flatnonzero((middle < around[: len(middle)]) & (middle <= around[NEAR + 1 :][: len(middle)])) + NEAR + 1
    gaps = np.diff(ends)
    if len(gaps) and gaps.max() > LONGEST:
        more = [np.arange(e, e + g, LONGEST) for e, g in zip(ends[:-1].tolist(), gaps.tolist())]
        ends = np.concatenate([*more, ends[-1:]])
    return ends


def chains(text: str | None, chain_words: int) -> tuple[np.ndarray, ...]:
    """Of a text's chains: digest, last chunk; of its chunks: first word, words, words a passage may reach before and behind."""
    data, starts, _ = canonical_words(text)
    ends = chunk_ends(data)
    if len(ends) < 2:
        return tuple(np.empty(0, t) for t in (np.int64, np.int32, np.int32, np.int32, np.int32, np.int32))
    before = np.searchsorted(starts, ends)  # words that start before each cut
    words = np.diff(before)
    count = len(words)
    last = np.searchsorted(before, before[:-1] + chain_words) - 1  # the chunk in which a chain has words enough
    # A cut is moved by nothing before the gear's window of its left neighbours, nor behind its right ones:
    # the cut before a chunk that isn't shared, or that behind the next chain, lies out of step.
    left = before[:-1] - np.searchsorted(starts, np.maximum(np.concatenate([[0], ends[:-2]]) - WINDOW - NEAR, 0))
    behind = np.append(np.append(ends, len(data))[np.minimum(last + 1, count + 1)], len(data))[1:]
    right = np.searchsorted(starts, behind + NEAR) - before[1:]
    digests = hashed_spans(data, ends[:-1], ends[1:])
    whole = last < count
    # a chain's digest: its chunks' digests, each turned by its place
    rolled = digests.copy()
    for step in range(1, int((last - np.arange(count))[whole].max(initial=0)) + 1):
        longer = np.flatnonzero(whole & (last >= np.arange(count) + step))
        with np.errstate(over="ignore"):
            rolled[longer] = scrambled(rolled[longer] * np.uint64(0x9E3779B97F4A7C15) + digests[longer + step])
    return rolled[whole].view(np.int64), np.minimum(last, count - 1).astype(np.int32), *(x.astype(np.int32) for x in (before[:-1], words, left, right))


def repeated_passages(
    docs: DataFrame,
    work: Scratch,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_words: int = 50,
    chain_words: int = 10,
) -> DataFrame:
    """One row per run of repeated text in a document: id, start_word, n_words, other_<id>, kept.

    Words are split at ASCII white space, A-Z count as a-z, and the kind and
    amount of white space doesn't matter. start_word (from 0) and n_words give
    the chunks of the run, which lie within the passage; a passage of
    `least_words` words has such a run if it has some 250 bytes or more.
    other_<id> is a document that has `least_words` words of the run as well.
    kept says that for some of these words, or for words inside the run that
    nobody else has, no document with a smaller id has them; so dropping the
    runs not kept loses no passage. Text that repeats within one document
    alone is not reported.

    Null and empty texts and texts without repeated passages have no rows, as
    have rows without id. Rows of one id are one document. An empty table
    gives no rows.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).where("id IS NOT NULL")
    id_type = rows.schema["id"].dataType.simpleString()
    parts = ("digests", pa.int64()), ("lasts", pa.int32()), ("firsts", pa.int32()), ("words", pa.int32()), ("left", pa.int32()), ("right", pa.int32())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            found = [chains(t.as_py(), chain_words) for t in batch.column("text")]
            columns = list(zip(*found)) or [()] * len(parts)
            arrays = [pa.array(list(c), pa.list_(kind)) for c, (_, kind) in zip(columns, parts)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], names=["id", *(name for name, _ in parts)])

    schema = f"id {id_type}, digests array<long>, " + ", ".join(f"{name} array<int>" for name, _ in parts[1:])
    # rows of one id are told apart by a number; their chains count for one document
    cuts = rows.mapInArrow(cut, schema).withColumn("row", F.monotonically_increasing_id())
    cuts = work.keep(cuts, "chains", compression="zstd")
    single = cuts.select("id", "row", F.posexplode("digests").alias("place", "digest"))
    shared = single.groupBy("digest").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("digest")
    met = single.join(work.keep(shared, "shared-chains"), "digest")
    per_row = met.groupBy("row").agg(F.collect_list("place").alias("hits"))
    hits = cuts.drop("digests").join(work.keep(per_row, "hits"), "row")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            ids, out = [], []
            names = ["lasts", "firsts", "words", "left", "right", "hits"]
            for number, row in enumerate(batch.select(names).to_pylist()):
                for found in _runs(row, least_words):
                    ids.append(number)
                    out.append(found)
            columns = list(zip(*out)) or [()] * 4
            mine = batch.column("id").take(pa.array(ids, pa.int64()))
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays([mine, *arrays], names=["id", "start_word", "n_words", "left", "right"])

    made = hits.select("id", "lasts", "firsts", "words", "left", "right", "hits")
    made = work.keep(made.mapInArrow(runs, f"id {id_type}, start_word long, n_words long, left long, right long"), "runs", compression="zstd")
    checked = _in_long_passages(made, rows, work, least_words)
    return checked.select(F.col("id").alias(id_column), "start_word", "n_words", F.col("other").alias(f"other_{id_column}"), "kept")


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE):
            yield batch.slice(first, SLICE)


def _in_long_passages(made: DataFrame, rows: DataFrame, work: Scratch, least_words: int) -> DataFrame:
    """(id, start_word, n_words, kept, other) of the runs at which `least_words` words in a row are in another document as well.

    Who has the words as well has their chains, too, and so a run that they
    touch: the windows at all runs are grouped by hash, whoever the partners
    of the chains are. Windows reach beyond a run as far as passages may, for
    one that reached further would hold another chain; those inside it that
    nobody shares are text of its own, as between two passages that meet there.
    """
    spans = made.groupBy("id").agg(F.collect_list(F.struct("start_word", "n_words", "left", "right")).alias("spans"))
    texts = packed_texts(rows).join(work.keep(spans, "run-spans"), "id")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in range(batch.num_rows):
                data, starts, stops = canonical_words(grow.decompress(batch.column("text")[row].as_py()).decode("utf-8"))
                for span in batch.column("spans")[row].as_py():
                    end = min(span["start_word"] + span["n_words"] + span["right"], len(starts))
                    first, last = max(0, span["start_word"] - span["left"]), end - least_words
                    if last < first:
                        continue
                    found = hashed_spans(data, starts[first : last + 1], stops[first + least_words - 1 : last + least_words])
                    found, where = np.unique(found, return_index=True)
                    inside = (where + first >= span["start_word"]) & (where + first + least_words <= span["start_word"] + span["n_words"])
                    mine = batch.column("id").take(pa.array(np.full(len(found), row)))
                    rest = [pa.repeat(pa.scalar(span[n], pa.int64()), len(found)) for n in ("start_word", "n_words")]
                    arrays = [mine, *rest, pa.array(inside), pa.array(found.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["id", "start_word", "n_words", "inside", "window"])

    kind = made.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start_word long, n_words long, inside boolean, window long"
    found = work.keep(texts.select("id", "text", "spans").mapInArrow(windows, schema), "windows", compression="zstd")
    holders = found.groupBy("window").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    met = found.join(work.keep(holders, "window-holders"), "window", "left")
    other = F.when(F.col("low") < F.col("id"), F.col("low")).otherwise(F.col("high"))
    first = F.when(F.col("low").isNull(), F.col("inside")).otherwise(F.col("low") == F.col("id"))
    told = met.groupBy("id", "start_word", "n_words").agg(F.min(other).alias("other"), F.max(first).alias("kept"))
    return told.where("other IS NOT NULL")


def _runs(row: dict, least_words: int) -> Iterator[tuple[int, int, int, int]]:
    """(first word, words, words a passage may reach before and behind) of the runs of one document that may lie in long enough passages."""
    places = sorted(row["hits"])
    at = 0
    while at < len(places):
        first = last = places[at]
        while at < len(places) and places[at] <= last + 1:
            last = max(last, row["lasts"][places[at]])
            at += 1
        words = row["firsts"][last] + row["words"][last] - row["firsts"][first]
        if row["left"][first] + words + row["right"][last] >= least_words:
            yield row["firsts"][first], words, row["left"][first], row["right"][last]
