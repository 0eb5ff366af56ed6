"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled into three parts. The normaliser writes blanks as the
blank sign and puts one in front. The piece transducer is a trie of all
pieces: reading a piece's characters and writing its id leads back to the
start, at the piece's cost. The fallback spells a character without a piece
as byte pieces. Composed with a text these give a lattice; its path of least
total cost (tropical semiring) is the encoding.

For unigram models the cost is the negative score. A byte-pair model merges by
priority instead; as an automaton that is a rule on neighbours: two pieces may
follow each other only if merging their joined characters gives back just
these two, and exactly one path of a text keeps to the rule everywhere. Arcs
that break it cost infinity; others cost 1.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLANK = "▁"
# Fixed values of the file format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    place = 0

    def number() -> int:
        nonlocal place
        value = shift = 0
        while True:
            byte = data[place]
            place += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while place < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = number() if size is None else size
        yield tag >> 3, data[place : place + size]
        place += size


class PieceFst:
    """The compiled transducer of one model file."""

    KEPT = 250_000  # segments whose encoding a worker remembers, and pairs of pieces
    LONGEST = 64  # characters of a segment that is solved together with others
    _shared: tuple = (None, None)

    @classmethod
    def shared(cls, model: bytes) -> PieceFst:
        """One transducer for all tasks of a worker."""
        if cls._shared[0] != model:
            cls._shared = model, cls(model)
        return cls._shared[1]

    def __init__(self, model: bytes):
        pieces, trainer, normaliser = [], {}, {}
        for field, value in _fields(model):
            if field == 1:
                part = dict(_fields(value))
                score = struct.unpack("<f", part[2])[0] if 2 in part else 0.0
                pieces.append((part.get(1, b"").decode("utf-8"), score, part.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normaliser = dict(_fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models are supported")
        if normaliser.get(2) or trainer.get(24) or any(kind == USER_DEFINED for _, _, kind in pieces):
            raise ValueError("models with a character map, blanks as suffix or user-defined pieces are not supported")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.squeeze = bool(normaliser.get(4, 1))
        self.pieces = [p for p, _, _ in pieces]
        self.width = np.dtype("<u2" if len(pieces) < 1 << 16 else "<u4")
        self.unknown = next((i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN), 0)
        self.bytes_of = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        normal = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.ids = normal
        self.scores = [s for _, s, _ in pieces]
        lowest = min((self.scores[i] for i in normal.values()), default=0.0)
        self.unknown_cost = 10.0 - lowest if self.kind == UNIGRAM else 1.0
        self.cost = np.array([-s if self.kind == UNIGRAM else 1.0 for s in self.scores])
        self.longest = max(map(len, normal), default=1)
        self._compile_trie(normal)
        # a text may be cut before a blank sign if no piece reaches across
        self.cuts = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in normal)
        self.lacking = {"\n"} - normal.keys() if not any("\n" in p for p in normal) else set()
        self.known: dict[str, bytes] = {}
        self.allowed_pairs: dict[int, bool] = {}
        self.pair_keys = np.full(1 << 21, -1, np.int64)
        self.pair_values = np.zeros(1 << 21, bool)
        self.surface = [self._surface(p, kind) for p, _, kind in pieces]

    # -- compilation -------------------------------------------------------

    def _compile_trie(self, normal: dict[str, int]) -> None:
        """States of the trie, numbered from 0; arcs in an open hash table of (state, character) keys."""
        arcs: dict[tuple[int, str], int] = {}
        final = [-1]
        for piece, number in normal.items():
            state = 0
            for character in piece:
                after = arcs.get((state, character))
                if after is None:
                    after = arcs[state, character] = len(final)
                    final.append(-1)
                state = after
            final[state] = number
        self.arcs, self.final = arcs, np.array(final, np.int32)
        size = 1 << max(4, (4 * len(arcs)).bit_length())
        self.arc_keys = np.full(size, -1, np.int64)
        self.arc_states = np.full(size, -1, np.int32)
        for (state, character), after in arcs.items():
            key = state << 21 | ord(character)
            slot = self._slot(key, size)
            while self.arc_keys[slot] != -1:
                slot = slot + 1 & size - 1
            self.arc_keys[slot], self.arc_states[slot] = key, after

    @staticmethod
    def _slot(key, size: int):
        return (key * 0x9E3779B1 & (1 << 62) - 1) >> 20 & size - 1

    def _step(self, states: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The states after reading a character each; -1 where there is no arc."""
        keys = states << 21 | characters
        slots = self._slot(keys, len(self.arc_keys))
        found = self.arc_keys[slots]
        out = np.where(found == keys, self.arc_states[slots], -1)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slots[open_] = slots[open_] + 1 & len(self.arc_keys) - 1
            found = self.arc_keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.arc_states[slots[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def _surface(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == CONTROL else piece.replace(BLANK, " ").encode()

    # -- the rule on neighbours --------------------------------------------

    def merged(self, text: str) -> list[str]:
        """The symbols of a text after merging by priority: highest score first, then leftmost."""
        symbols: list[str | None] = list(text)
        before, after = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1))
        queue: list[tuple] = []

        def offer(left: int, right: int) -> None:
            number = self.ids.get(symbols[left] + symbols[right])
            if number is not None:
                heapq.heappush(queue, (-self.scores[number], left, right, symbols[left], symbols[right]))

        for i in range(len(text) - 1):
            offer(i, i + 1)
        while queue:
            _, left, right, a, b = heapq.heappop(queue)
            if symbols[left] != a or symbols[right] != b or after[left] != right:
                continue
            symbols[left], symbols[right] = a + b, None
            after[left] = after[right]
            if after[left] < len(text):
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [s for s in symbols if s is not None]

    def allowed(self, first: int, second: int) -> bool:
        """Whether the second piece may follow the first."""
        if self.kind == UNIGRAM:
            return True
        key = first * len(self.pieces) + second
        if key not in self.allowed_pairs:
            if len(self.allowed_pairs) > self.KEPT:
                self.allowed_pairs = {}
            a, b = self.pieces[first], self.pieces[second]
            self.allowed_pairs[key] = self.merged(a + b) == [a, b]
        return self.allowed_pairs[key]

    def _all_allowed(self, firsts: np.ndarray, seconds: np.ndarray) -> np.ndarray:
        """`allowed` for arrays; -1 as first piece is the start of a segment."""
        if self.kind == UNIGRAM:
            return np.ones(len(firsts), bool)
        keys = firsts.astype(np.int64) * len(self.pieces) + seconds
        slots = self._slot(keys, len(self.pair_keys))
        out = self.pair_values[slots]
        start = firsts < 0
        out[start] = True
        new = np.flatnonzero((self.pair_keys[slots] != keys) & ~start)
        if len(new):
            distinct, where = np.unique(keys[new], return_inverse=True)
            values = np.array([self.allowed(*divmod(k, len(self.pieces))) for k in distinct.tolist()])
            out[new] = values[where]
            slots = self._slot(distinct, len(self.pair_keys))
            self.pair_keys[slots], self.pair_values[slots] = distinct, values
        return out

    # -- shortest paths ----------------------------------------------------

    def path(self, segment: str) -> list[int]:
        """The ids on the shortest path of one segment of normalised text."""
        best: list[tuple[float, int, tuple[int, ...]]] = [(0.0, -1, ())] + [(np.inf, -1, ())] * len(segment)
        steps: list[int] = [0] * (len(segment) + 1)
        for start in range(len(segment)):
            cost, last, _ = best[start]
            state, end, alone = 0, start, False
            while end < len(segment) and (state := self.arcs.get((state, segment[end]), -1)) >= 0:
                end += 1
                piece = int(self.final[state])
                if piece < 0:
                    continue
                alone |= end == start + 1
                total = cost + self.cost[piece]
                if total < best[end][0] and (last < 0 or self.allowed(last, piece)):
                    best[end], steps[end] = (total, piece, (piece,)), start
            if not alone and cost + self.unknown_cost < best[start + 1][0]:
                # nothing merges across a character without piece: any piece may follow it
                spelled = [self.bytes_of.get(b) for b in segment[start].encode("utf-8", "replace")]
                ids = (self.unknown,) if None in spelled else tuple(spelled)
                best[start + 1], steps[start + 1] = (cost + self.unknown_cost, -1, ids), start
        out: list[tuple[int, ...]] = []
        end = len(segment)
        while end:
            out.append(best[end][2])
            end = steps[end]
        ids = [i for part in reversed(out) for i in part]
        # neighbouring unknown characters are one unknown piece
        return [x for n, x in enumerate(ids) if x != self.unknown or not n or ids[n - 1] != self.unknown]

    def paths(self, segments: list[str]) -> list[bytes]:
        """`path` for many segments at once, as bytes of ids."""
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        starts = np.cumsum(sizes) - sizes
        spelled = self._step(np.zeros(len(codes), np.int64), codes)
        lacking = np.where(spelled < 0, True, self.final[spelled] < 0)
        lacking_before = np.concatenate([[0], np.cumsum(lacking)])
        odd = (sizes > self.LONGEST) | (lacking_before[starts + sizes] > lacking_before[starts])
        out: list[bytes] = [b""] * len(segments)
        for i in np.flatnonzero(odd).tolist():
            out[i] = np.array(self.path(segments[i]), self.width).tobytes()
        order = np.flatnonzero(~odd & (sizes > 0))
        order = order[np.argsort(-sizes[order], kind="stable")]
        if len(order):
            for i, ids in zip(order.tolist(), self._solve(codes, starts[order], sizes[order])):
                out[i] = ids
        return out

    def _solve(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Shortest paths of segments ordered by falling size; all their characters have pieces."""
        rows, longest = len(starts), int(sizes[0])
        best = np.full((longest + 1, rows), np.inf)
        last = np.full((longest + 1, rows), -1, np.int64)
        back = np.zeros((longest + 1, rows), np.int64)
        best[0] = 0
        for start in range(longest):
            live = np.arange(np.searchsorted(-sizes, -start, side="left"))  # segments longer than `start`
            states = np.zeros(len(live), np.int64)
            for end in range(start, min(longest, start + self.longest)):
                more = sizes[live] > end
                live, states = live[more], states[more]
                states = self._step(states, codes[starts[live] + end]).astype(np.int64)
                more = states >= 0
                live, states = live[more], states[more]
                if not len(live):
                    break
                piece = self.final[states].astype(np.int64)
                at = np.flatnonzero(piece >= 0)
                row, piece = live[at], piece[at]
                total = best[start, row] + self.cost[piece]
                nearer = np.flatnonzero(total < best[end + 1, row])
                nearer = nearer[self._all_allowed(last[start, row[nearer]], piece[nearer])]
                row, piece = row[nearer], piece[nearer]
                best[end + 1, row], last[end + 1, row], back[end + 1, row] = total[nearer], piece, start
        found = np.zeros((longest, rows), self.width)
        counts = np.zeros(rows, np.int64)
        at = sizes.copy()
        while (open_ := np.flatnonzero(at > 0)).size:
            counts[open_] += 1
            found[longest - counts[open_], open_] = last[at[open_], open_]
            at[open_] = back[at[open_], open_]
        found = np.ascontiguousarray(found.T)
        size = self.width.itemsize
        raw, line = found.tobytes(), longest * size
        return [raw[(r + 1) * line - c * size : (r + 1) * line] for r, c in enumerate(counts.tolist())]

    # -- texts -------------------------------------------------------------

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = " ".join(part for part in text.split(" ") if part)
        if not text:
            return ""
        return (BLANK if self.dummy_prefix else "") + text.replace(" ", BLANK)

    def segments(self, normal: str) -> list[str]:
        """Parts of normalised text that are encoded on their own."""
        if not self.cuts:
            return [normal]
        out: list[str] = []
        # a line end that has no piece of its own stands apart as well
        for number, line in enumerate(normal.split("\n") if "\n" in self.lacking else [normal]):
            if number:
                out.append("\n")
            if BLANK * 2 in line:
                out += re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", line)
                continue
            head, *words = line.split(BLANK)
            if head:
                out.append(head)
            out += [BLANK + word for word in words]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        cut = [self.segments(self.normalise(t)) for t in texts]
        wanted = set().union(*cut)
        if len(self.known) > self.KEPT:
            self.known = {}
        new = list(wanted - self.known.keys())
        for first in range(0, len(new), 100_000):
            part = new[first : first + 100_000]
            self.known.update(zip(part, self.paths(part)))
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, parts)), self.width) for parts in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the inverse transducer, and the blank in front taken off."""
        raw = b"".join(map(self.surface.__getitem__, ids.tolist()))
        if self.dummy_prefix and raw.startswith(b" ") and self.pieces[ids[0]].startswith(BLANK):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def encode_texts(
    docs: DataFrame, *, model_path: str, id_column: str = "doc_id", text_column: str = "text", step: int = 500
) -> DataFrame:
    """One row per row of `docs`: id, ids, n_tokens, ids_crc32, round_trip.

    ids are those of the whole text, without markers of start or end;
    round_trip says that decoding them gives the text back, which holds unless
    the model squeezes blanks or the text contains the blank sign itself. The
    checksum is of the ids as little-endian 32-bit integers. Null and empty
    texts have no ids. The model file is read once and sent to all tasks;
    texts are encoded `step` at a time. Ids of rows, repeated or null, are
    passed on. An empty table gives no rows.
    """
    with open(model_path, "rb") as source:
        model = docs.sparkSession.sparkContext.broadcast(source.read())  # one vocabulary file
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = PieceFst.shared(model.value)
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = fst.encode(texts)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                flat = np.concatenate(found).astype(np.int32)
                back = [fst.decode(ids) == text for ids, text in zip(found, texts)]
                sums = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in found]
                arrays = [
                    part.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64()), pa.array(back, pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "ids", "n_tokens", "ids_crc32", "round_trip"])

    id_type = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(encode, f"id {id_type}, ids array<int>, n_tokens long, ids_crc32 long, round_trip boolean")
    return made.withColumnRenamed("id", id_column)
