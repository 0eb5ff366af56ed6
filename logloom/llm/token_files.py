"""Token ids in binary shard files.

A file is one header line of JSON, then the ids of all its documents one
after another as little-endian integers of 2 or 4 bytes, then the document
boundaries as an Elias-Fano list: the ends of the documents, counted in ids
from the file's start. The lower bits of each end are stored as they are, the
upper bits as gaps in unary; that takes about 2 + log2(ids per document) bits
a document. `Boundaries.select` gives any end without unpacking the others:
a sample of every 256th set bit says where to start counting.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from logloom.llm.text_hash import hashed_spans
from logloom.scratch import Scratch

MAGIC = "ids-with-ends-1"
SAMPLE = 256


class Boundaries:
    """A non-decreasing list of integers below 2^63 in Elias-Fano form."""

    def __init__(self, count: int, low_bits: int, lows: np.ndarray, highs: np.ndarray):
        self.count, self.low_bits, self.lows, self.highs = count, low_bits, lows, highs
        set_bits = np.bitwise_count(highs).astype(np.int64)
        self._before = np.concatenate([[0], np.cumsum(set_bits)])
        # the byte of every SAMPLE-th set bit: where a search starts
        self._sampled = np.searchsorted(self._before, np.arange(0, count, SAMPLE), side="right") - 1

    @classmethod
    def of(cls, values: np.ndarray) -> Boundaries:
        values = values.astype(np.uint64)
        count = len(values)
        last = int(values[-1]) if count else 0
        low_bits = max(0, (last // count).bit_length() - 1) if count else 0
        bits = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        lows = np.packbits(bits.ravel(), bitorder="little")
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        highs = np.zeros(int(places[-1]) // 8 + 1 if count else 0, np.uint8)
        np.bitwise_or.at(highs, places // 8, (1 << (places % 8)).astype(np.uint8))
        return cls(count, low_bits, lows, highs)

    def select(self, i: int) -> int:
        """The i-th value, from 0."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        start = self._sampled[i // SAMPLE]
        end = self._sampled[i // SAMPLE + 1] + 1 if i // SAMPLE + 1 < len(self._sampled) else len(self.highs)
        byte = int(start + np.searchsorted(self._before[start : end + 1], i, side="right") - 1)
        ones = np.flatnonzero(np.unpackbits(self.highs[byte : byte + 1], bitorder="little"))
        high = byte * 8 + int(ones[i - self._before[byte]]) - i
        return high << self.low_bits | self._low(i)

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        window = self.lows[first // 8 : (first + self.low_bits + 7) // 8].tobytes()
        return int.from_bytes(window, "little") >> first % 8 & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        bits = np.unpackbits(self.lows, count=self.count * self.low_bits, bitorder="little").reshape(self.count, self.low_bits)
        low = (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        high = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.count] - np.arange(self.count)
        return (high << self.low_bits) | low


class WordEncoder:
    """Encodes texts with a byte-level tokenizer of the tokenizers library, remembering runs of text it has met.

    The tokenizer cuts a text before every blank that follows a non-blank, so
    a text is the sum of its pieces " word". New pieces of a batch are encoded
    together as one text; each begins with the only token in it that starts
    with a blank. Texts with blanks in a row, and all texts of a tokenizer for
    which this does not hold, are encoded as they are.
    """

    KEPT = 1_500_000
    _shared: tuple = (None, None)

    @classmethod
    def shared(cls, tokenizer: bytes, end_id: int) -> WordEncoder:
        """One encoder for all tasks of a worker."""
        if cls._shared[0] != (tokenizer, end_id):
            cls._shared = (tokenizer, end_id), cls(tokenizer, end_id)
        return cls._shared[1]

    def __init__(self, tokenizer: bytes, end_id: int):
        import tokenizers

        self.library = tokenizers.Tokenizer.from_buffer(tokenizer)
        # the same model for text that is in its byte letters and has one blank between units
        self.units = tokenizers.Tokenizer(self.library.model)
        self.units.pre_tokenizer = tokenizers.pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.width = np.dtype("<u2" if max([end_id, *vocabulary.values()]) < 1 << 16 else "<u4")
        self.end = np.array([end_id], self.width).tobytes()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.opens[number] = token.startswith("Ġ")
        self._forget()
        split = json.loads(tokenizer)
        step = split.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in split.get("added_tokens", [])]
        self.by_word = (
            split.get("normalizer") is None
            and step.get("type") == "ByteLevel"
            and step.get("use_regex", True)
            and not step.get("add_prefix_space", True)
        )

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.width).tobytes()

    def _sums_up(self, text: str) -> bool:
        return self.by_word and "  " not in text and not text.endswith(" ") and not any(t in text for t in self.added)

    def _forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        # the ids of all remembered words one after another, and each word's part of them
        self.flat = np.zeros(1 << 16, self.width)
        self.begin, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.words = self.used = 0

    def _keep(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Append the ids of some words."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.words + len(sizes) > len(self.size):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        self.flat[self.used : self.used + len(ids)] = ids
        self.begin[self.words : self.words + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.size[self.words : self.words + len(sizes)] = sizes
        self.used += len(ids)
        self.words += len(sizes)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, with the end id, as bytes."""
        if self.words > self.KEPT:
            self._forget()
        summed = [t for t in texts if self._sums_up(t)]
        parts = iter(self._summed(summed) if summed else ())
        return [(next(parts) if self._sums_up(t) else self.whole(t)) + self.end for t in texts]

    def _summed(self, texts: list[str]) -> list[bytes]:
        joined = " ".join(texts).encode("utf-8", "replace")
        data = np.frombuffer(joined, np.uint8)
        gaps = np.flatnonzero(data == 32)
        starts, ends = np.append(0, gaps + 1), np.append(gaps, len(data))
        counts = np.array([t.count(" ") + 1 for t in texts])
        heads = np.cumsum(counts) - counts
        # words that occur again in these texts are looked up once
        _, one, where = np.unique(hashed_spans(data, starts, ends), return_index=True, return_inverse=True)
        words = [joined[s:e] for s, e in zip(starts[one].tolist(), ends[one].tolist())]
        self._learn([w for w in words if w not in self.slots])
        slots = np.array([self.slots[w] for w in words], np.int64)[where]
        # the first word of a text has no blank before it
        slots[heads] = self._head_slots([joined[s:e] for s, e in zip(starts[heads].tolist(), ends[heads].tolist())])
        begin, size = self.begin[slots], self.size[slots]
        stops = np.cumsum(size)
        flat = self.flat[np.repeat(begin - (stops - size), size) + np.arange(stops[-1])]
        bounds = np.append(0, stops[heads + counts - 1]).tolist()
        return [flat[s:e].tobytes() for s, e in zip(bounds, bounds[1:])]

    def _head_slots(self, words: list[bytes]) -> list[int]:
        # a key with a blank in it is no other word's
        keys = [b"first " + w for w in words]
        new = list({w: None for w, key in zip(words, keys) if key not in self.slots})
        found = [e.ids for e in self.library.encode_batch([w.decode() for w in new], add_special_tokens=False)]
        self.slots.update((b"first " + w, self.words + n) for n, w in enumerate(new))
        self._keep(np.array([i for ids in found for i in ids], self.width), np.array([len(ids) for ids in found], np.int64))
        return [self.slots[key] for key in keys]

    def _learn(self, words: list[bytes]) -> None:
        # a word of ASCII letters is one unit of the byte-level split, and its bytes are written as they are
        self._learn_with(self.units, [w for w in words if w.isalpha()], "Ġ", " Ġ")
        self._learn_with(self.library, [w for w in words if not w.isalpha()], " ", " ")

    def _learn_with(self, library, words: list[bytes], head: str, between: str) -> None:
        for first in range(0, len(words), 1000):
            part = words[first : first + 1000]
            text = head + between.join([w.decode() for w in part])
            ids = np.array(library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width)
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(part):
                sizes = np.diff(np.append(starts, len(ids)))
            else:  # some word has tokens that start with a blank of its own
                each = [self.library.encode(" " + w.decode(), add_special_tokens=False).ids for w in part]
                ids = np.array([i for one in each for i in one], self.width)
                sizes = np.array([len(one) for one in each], np.int64)
            self.slots.update(zip(part, range(self.words, self.words + len(part))))
            self._keep(ids, sizes)


def write_file(folder: str, name: str, ids: list[bytes], width: int) -> int:
    """Write one shard file; returns its number of ids. A file that a lost task left is replaced."""
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    bounds = Boundaries.of(ends)
    count = int(ends[-1]) if len(ends) else 0
    header = {
        "format": MAGIC, "width": width, "ids": count, "documents": len(ids),
        "low_bits": bounds.low_bits, "low_bytes": len(bounds.lows), "high_bytes": len(bounds.highs),
    }
    files, root = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    context = TaskContext.get()
    draft = f"{root}/.{name}.{context.taskAttemptId() if context else 0}"
    with files.open_output_stream(draft) as out:
        out.write(json.dumps(header).encode() + b"\n")
        for part in ids:
            out.write(part)
        out.write(bounds.lows.tobytes())
        out.write(bounds.highs.tobytes())
    files.move(draft, f"{root}/{name}")
    return count


class ShardFile:
    """A shard file read back: `document(i)` gives the ids of its i-th document."""

    def __init__(self, path: str):
        files, place = pyarrow.fs.FileSystem.from_uri(path)
        with files.open_input_file(place) as source:
            data = source.read()
        line = data.index(b"\n")
        header = json.loads(data[:line])
        if header["format"] != MAGIC:
            raise ValueError(f"{path} is not a file of token ids")
        size = header["ids"] * header["width"]
        body = memoryview(data)[line + 1 :]
        self.ids = np.frombuffer(body[:size], np.dtype(f"<u{header['width']}"))
        lows = np.frombuffer(body[size : size + header["low_bytes"]], np.uint8)
        highs = np.frombuffer(body[size + header["low_bytes"] :], np.uint8)
        self.bounds = Boundaries(header["documents"], header["low_bits"], lows, highs)

    def __len__(self) -> int:
        return self.bounds.count

    def span(self, i: int) -> tuple[int, int]:
        return (self.bounds.select(i - 1) if i else 0), self.bounds.select(i)

    def document(self, i: int) -> np.ndarray:
        start, end = self.span(i)
        return self.ids[start:end]


def write_token_files(
    docs: DataFrame,
    work: Scratch,
    *,
    tokenizer_path: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    file_bytes: int = 8 << 20,
) -> DataFrame:
    """Write the ids of all texts in ascending order of id; one row per file: part, path, first_id, documents, ids.

    Documents are dealt by ranges of id, so that `part` orders the files; one
    task sorts and writes the files of its range, each of about `file_bytes`
    of ids, and holds no more than one file at a time. Rows of one id stand in
    a fixed order of their texts, rows without id come first, null texts are
    empty: the end id alone. An empty table gives no file.
    """
    with open(tokenizer_path, "rb") as source:
        tokenizer = source.read()
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(tokenizer)  # one vocabulary file
    folder = work.path("token-files")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    id_type = docs.schema[id_column].dataType
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    # the last column parts rows of one id and text, however many
    rows = docs.select(F.col(id_column).alias("id"), text, F.monotonically_increasing_id().alias("row"))
    rows = rows.select("id", F.xxhash64("text").alias("digest"), "row", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(shipped.value, end_id)
        part, number = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        ids: list = []
        size = 0

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:05d}"
            count = write_file(folder, name, held, encoder.width.itemsize)
            columns = [part * 100_000 + number], [f"{folder}/{name}"], [ids], [count]
            types = pa.int64(), pa.string(), pa.list_(id_arrow), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "path", "doc_ids", "ids"])

        for batch in batches:
            numbers = batch.column("id").to_pylist()
            id_arrow = batch.column("id").type
            for first in range(0, batch.num_rows, 1024):
                texts = batch.column("text").slice(first, 1024).to_pylist()
                for number_of, encoded in zip(numbers[first : first + 1024], encoder.encode(texts)):
                    held.append(encoded)
                    ids.append(number_of)
                    size += len(encoded)
                    if size >= file_bytes:
                        yield flush()
                        held, ids, size, number = [], [], 0, number + 1
        if held:
            yield flush()

    order = "id", "digest", "row"
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"part long, path string, doc_ids array<{id_type.simpleString()}>, ids long"
    return work.keep(ordered.select("id", "text").mapInArrow(write, schema), "manifest", compression="zstd")


def read_token_files(manifest: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per document from the files of a manifest: id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it; the checksum is of the
    ids as little-endian 32-bit integers.
    """
    # one short row per file in this window: the documents' ids stay out of it
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    files = manifest.select("part", "path", "doc_ids").join(starts, "part").drop("part")
    item = manifest.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_arrow = batch.column("doc_ids").type.value_type
            for path, doc_ids, start in zip(*(batch.column(c).to_pylist() for c in ("path", "doc_ids", "start"))):
                shard = ShardFile(path)
                spans = [shard.span(i) for i in range(len(shard))]
                if len(spans) != len(doc_ids):
                    raise ValueError(f"{path} holds {len(spans)} documents, not {len(doc_ids)}")
                sums = [zlib.crc32(shard.ids[s:e].astype("<u4").tobytes()) for s, e in spans]
                columns = doc_ids, [start + s for s, _ in spans], [e - s for s, e in spans], sums
                arrays = [pa.array(columns[0], id_arrow), *(pa.array(c, pa.int64()) for c in columns[1:])]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_column, "start", "n_tokens", "ids_crc32"])

    spread = files.repartition(max(1, manifest.count()), "path")
    return spread.mapInArrow(read, f"`{id_column}` {item}, start long, n_tokens long, ids_crc32 long")
