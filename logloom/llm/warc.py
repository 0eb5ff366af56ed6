"""WARC archives and their index in order of URL and time.

Pages are written as archives: every record a gzip member of its own, equal
payloads stored once and revisited. Archives are read back one by one; the
captures found in one, sorted, are a run. The runs are merged outside memory:
the whole index is split into ranges of (URL key, timestamp, id), and the task
of a range merges the slices that all runs have there by a tree of losers. The
ranges one after the other are the global order, in which the captures of one
URL form its history.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import Any, BinaryIO
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from logloom.operators.lookup import skew_lookup
from logloom.operators.numbering import starts
from logloom.scratch import Scratch

END = b"\r\n\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PIECE = 1 << 20  # bytes read from an archive at a time
INDEX_ROWS = 8192  # of the index in one Arrow batch


def url_key(url: str | None) -> str:
    """The URL as a sort key: the labels of the host turned round, without scheme, `www.`, standard port and fragment; `-` if null."""
    if url is None:
        return "-"
    try:
        parts = urlsplit(url.strip().lower())
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:  # no URL at all: it orders as it is
        return url
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}"


def _escaped(text: str) -> str:
    """One line of printable ASCII; `unquote` brings back what `%` stands for."""
    return quote(text, safe="!#$&'()*+,/:;=?@[]~-._")


def record(kind: str, fields: dict[str, str | None], block: bytes) -> bytes:
    """A WARC record."""
    head = {"WARC-Type": kind, **fields, "Content-Length": str(len(block))}
    lines = [VERSION, *(f"{name}: {value}" for name, value in head.items() if value is not None)]
    return "\r\n".join(lines).encode() + END + block + END


def capture(page: dict[str, Any]) -> bytes:
    """The record of a page: id, url, payload, digest, timestamp and, for a revisit, refers_to."""

    def identity(of: Any) -> str:
        # a page without id is known by what it holds
        name = f"{page['url']} {page['digest']}" if of is None else f"page {of}"
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"

    payload = page["payload"].encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    revisit = page["refers_to"] is not None
    fields = {
        "WARC-Record-ID": identity(page["id"]),
        "WARC-Date": page["timestamp"],
        "WARC-Target-URI": None if page["url"] is None else _escaped(page["url"]),
        "WARC-Payload-Digest": f"sha256:{page['digest']}",
        "Content-Type": "application/http;msgtype=response",
        "Page-ID": None if page["id"] is None else _escaped(str(page["id"])),
    }
    if revisit:
        fields |= {
            "WARC-Profile": REVISIT_PROFILE,
            "WARC-Refers-To": identity(page["refers_to"]),
            "Refers-To-Page-ID": _escaped(str(page["refers_to"])),
        }
    return record("revisit" if revisit else "response", fields, http if revisit else http + payload)


class ArchiveWriter:
    """One archive file, a gzip member per record. Its name holds the attempt, so a repeated task replaces nothing."""

    def __init__(self, folder: str, name: str):
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        self.path, self.size, self.records = f"{folder}/{name}", 0, 0
        self.out = files.open_output_stream(f"{root}/{name}", compression=None)
        self._put(record("warcinfo", {"Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))

    def _put(self, data: bytes) -> None:
        packer = zlib.compressobj(wbits=31)
        member = packer.compress(data) + packer.flush()
        self.out.write(member)
        self.size += len(member)

    def add(self, data: bytes) -> None:
        self._put(data)
        self.records += 1


def members(source: BinaryIO) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of the gzip members of a file, one in memory at a time."""
    offset, rest = 0, b""
    while rest or (rest := source.read(PIECE)):
        unpacker, parts, length = zlib.decompressobj(wbits=31), [], 0
        while not unpacker.eof:
            if not rest and not (rest := source.read(PIECE)):
                raise ValueError(f"the member at {offset} has no end")
            parts.append(unpacker.decompress(rest))
            length, rest = length + len(rest) - len(unpacker.unused_data), unpacker.unused_data
        yield offset, length, b"".join(parts)
        offset += length


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record."""
    head, _, rest = data.partition(END)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if version != VERSION or rest[size:] != END:
        raise ValueError("not a whole WARC record")
    return fields, rest[:size]


def captures_of(source: BinaryIO) -> Iterator[dict[str, Any]]:
    """What an archive holds, record by record; payloads are held against their digests."""
    for offset, length, data in members(source):
        fields, block = parse_record(data)
        if fields["WARC-Type"] not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(END)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        size = int(http.decode().rsplit("Content-Length: ", 1)[1])
        if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"the payload at {offset} is not the one that was written")
        named = {k: unquote(fields[f]) if f in fields else None for k, f in (("id", "Page-ID"), ("refers_to", "Refers-To-Page-ID"))}
        uri = fields.get("WARC-Target-URI")
        url = None if uri is None else unquote(uri)
        yield named | {
            "url_key": url_key(url), "timestamp": fields["WARC-Date"], "url": url, "record_type": fields["WARC-Type"],
            "payload_bytes": size, "payload_digest": digest, "offset": offset, "length": length,
        }


class LoserTree:
    """Merges sorted lists of keys: every step gives the list whose next key is the smallest.

    An inner node holds the loser of the match between the winners below it,
    so a step replays one path only.
    """

    def __init__(self, lists: list[list]):
        self.lists, self.next = lists, [0] * len(lists)
        self.losers = [0] * len(lists)
        self.winner = self._play(1) if len(lists) > 1 else 0

    def _play(self, node: int) -> int:
        if node >= len(self.lists):
            return node - len(self.lists)
        left, right = self._play(2 * node), self._play(2 * node + 1)
        self.losers[node] = right if self._before(left, right) else left
        return left if self.losers[node] == right else right

    def _before(self, a: int, b: int) -> bool:
        if self.next[a] == len(self.lists[a]):
            return False
        return self.next[b] == len(self.lists[b]) or self.lists[a][self.next[a]] <= self.lists[b][self.next[b]]

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(list, place in it) of every key in order."""
        for _ in range(sum(map(len, self.lists))):
            won = self.winner
            yield won, self.next[won]
            self.next[won] += 1
            node = (won + len(self.lists)) // 2
            while node:
                if self._before(self.losers[node], won):
                    self.losers[node], won = won, self.losers[node]
                node //= 2
            self.winner = won


ORDER = ["url_key", "timestamp", "id"]


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def write_archives(
    pages: DataFrame,
    work: Scratch,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    captured_at: Column | str = "2024-01-01T00:00:00Z",
    least_revisit: int = 100,
    archive_bytes: int = 1 << 30,
) -> DataFrame:
    """Write a record per row; one row per archive: archive, path, records.

    Of rows with equal payloads of at least `least_revisit` bytes the one of
    the smallest id is a response and the others revisit it; all others are
    responses. Null payloads are empty. Rows that repeat the smallest id are
    responses all of them, and so are rows without id unless a row with an id
    has their payload. A url may be null. A record is held in memory whole. An
    empty table gives no archive; further columns say nothing.
    `captured_at` is the time of all captures or a column of strings. Archives
    are closed when they reach `archive_bytes`.
    """
    payload = F.coalesce(F.col(f"`{payload_column}`").cast("string"), F.lit(""))
    when = F.lit(captured_at) if isinstance(captured_at, str) else captured_at
    rows = pages.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"), when.alias("timestamp"),
    )
    equal = rows.where(F.octet_length("payload") >= least_revisit).groupBy("digest")
    equal = equal.agg(F.count("*").alias("copies"), F.min("id").alias("first")).where("copies > 1 AND first IS NOT NULL")
    equal = work.keep(equal, "equal-payloads", compression="zstd")
    rows = skew_lookup(rows, equal, ["digest"], "copies", ["id", "url"])
    rows = rows.withColumn("refers_to", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))).drop("copies", "first")
    folder = _uri(work.path("archives"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, number, archive = context.partitionId(), 0, None

        def closed() -> pa.RecordBatch:
            archive.out.close()
            row = {"archive": part * 100_000 + number, "path": archive.path, "records": archive.records}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for i in range(batch.num_rows):
                page = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                archive = archive or ArchiveWriter(folder, f"{part:06d}-{number:05d}-{context.taskAttemptId()}.warc.gz")
                archive.add(capture(page))
                if archive.size >= archive_bytes:
                    yield closed()
                    archive, number = None, number + 1
        if archive:
            yield closed()

    return work.keep(rows.mapInArrow(write, "archive long, path string, records long"), "archives")


def capture_runs(archives: DataFrame, work: Scratch, id_type: str = "long") -> DataFrame:
    """The captures of every archive, read back and sorted: the run of the archive, `seq` its order. A written table."""
    schema = (
        "id string, refers_to string, url_key string, timestamp string, url string, record_type string, "
        "payload_bytes long, payload_digest string, offset long, length long, archive long"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, place = pyarrow.fs.FileSystem.from_uri(row["path"])
                held, found = [], 0
                with files.open_input_stream(place, compression=None) as source:
                    for entry in captures_of(source):
                        held.append(entry | {"archive": row["archive"]})
                        found += 1
                        if len(held) == INDEX_ROWS:
                            yield pa.RecordBatch.from_pylist(held, arrow_schema)
                            held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, arrow_schema)
                if found != row["records"]:
                    raise ValueError(f"{row['path']} holds {found} captures, not {row['records']}")

    longs = ("payload_bytes", "offset", "length", "archive")
    names = [part.split(" ")[0] for part in schema.split(", ")]
    arrow_schema = pa.schema([(name, pa.int64() if name in longs else pa.string()) for name in names])
    spread = archives.repartition(max(1, archives.count()), "archive")
    found = spread.mapInArrow(read, schema).withColumns({c: F.col(c).cast(id_type) for c in ("id", "refers_to")})
    order = ["archive", *ORDER, "offset"]
    runs = found.sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id())
    return work.keep(runs, "runs", compression="zstd")


def merge_runs(runs: DataFrame, work: Scratch) -> DataFrame:
    """All captures in order of (url_key, timestamp, id, archive, offset), numbered from 0 by `position`; a written table."""
    ranged = runs.repartitionByRange(*ORDER, "archive", "offset").sortWithinPartitions("archive", "seq")
    names = runs.columns

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        firsts, keys, before = [], [], None
        columns = [table.column(c).to_pylist() for c in (*ORDER, "archive", "offset")]
        for i, (key, time, page, archive, offset) in enumerate(zip(*columns)):
            if archive != before:
                firsts.append(i)
                keys.append([])
                before = archive
            # as Spark orders them: strings by bytes, nulls first
            keys[-1].append((key.encode(), time.encode(), page is not None, page or 0, archive, offset))
        del columns
        places = [firsts[run] + place for run, place in LoserTree(keys)]
        slice_no = pa.array([TaskContext.get().partitionId()] * INDEX_ROWS, pa.int64())
        for first in range(0, len(places), INDEX_ROWS):
            part = table.take(places[first : first + INDEX_ROWS]).combine_chunks()
            place = pa.array(range(first, first + part.num_rows), pa.int64())
            part = part.append_column("slice", slice_no[: part.num_rows]).append_column("place", place)
            yield from part.to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema.fields)
    merged = work.keep(ranged.mapInArrow(merge, f"{fields}, slice long, place long"), "captures", compression="zstd")
    sizes = starts(merged.groupBy("slice").agg(F.count("*").alias("size")), "slice")
    # one row per range: small at any number of captures
    placed = merged.join(F.broadcast(sizes), "slice")
    return placed.select(*[n for n in names if n != "seq"], (F.col("start") + F.col("place")).alias("position"))


def capture_index(pages: DataFrame, work: Scratch, *, id_column: str = "page_id", **options) -> DataFrame:
    """Write `pages` to archives and read them back: one row per record, in the index's order by `position`.

    Columns: id, refers_to, url_key, timestamp, url (as in the archive),
    record_type, payload_bytes, payload_digest, offset, length, archive, path,
    position. See `write_archives` for rows that are null, repeated or empty.
    """
    archives = write_archives(pages, work, id_column=id_column, **options)
    runs = capture_runs(archives, work, pages.schema[id_column].dataType.simpleString())
    return merge_runs(runs, work).join(archives.select("archive", "path"), "archive")


def write_index(captures: DataFrame, path: str) -> None:
    """The index as lines `key timestamp {..}`, sorted within and from file to file."""
    facts = F.to_json(F.struct("url", "record_type", "payload_digest", "length", "offset", "path"))
    lines = captures.repartitionByRange("position").sortWithinPartitions("position")
    lines.select(F.concat_ws(" ", "url_key", "timestamp", facts).alias("value")).write.text(path)


def read_record(path: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Fields and block of the record at a place of an archive."""
    files, place = pyarrow.fs.FileSystem.from_uri(path)
    with files.open_input_file(place) as source:
        source.seek(offset)
        return parse_record(zlib.decompress(source.read(length), wbits=31))
