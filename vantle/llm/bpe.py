"""Byte-level BPE by corpus-level merge replay.

Every distinct piece of text is held once as a chain of symbols. An inverted
index from pair rank to chain positions says where each merge applies; merges
are replayed over all pieces in rank order, and each application re-indexes only
the two neighbouring pairs it touches. Pieces repeat so often that the replay
sees a small part of the text; documents are then put together by lookup.

The corpus is replayed task by task: each replays the distinct pieces of its own rows,
slice by slice, and keeps frequent ones from slice to slice. To replay a piece once in
the whole corpus, all pieces of all documents would have to be shuffled and joined
back, many times the input; merges never look beyond a piece, so the ids are the same.
Memory is bounded by the slice and by the table's limit, and hot sources, copies and
lost executors change nothing.

Defined results: null text counts as empty; an empty text has no ids and decodes
to no bytes; equal rows give equal rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gc
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UnitTable, bound_arrow, file_bytes, released, text_arrays, texts_of


#: Fixed value: the usual pattern of byte-level encoders, which parts letters, digits, signs and white space.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text, and four times the ids, that a worker handles at a time: encoding and decoding
#: workers of one task run side by side.
SLICE = 2 << 20


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """The rank file's tokens: one base64 token and its rank per line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


class MergeReplay:
    """Encodes byte pieces by replaying all merges in rank order over an inverted index.

    A rank with many positions is applied by array operations, one with few by a
    plain loop; both work on the same chains.
    """

    #: positions from which array operations pay off
    MANY = 24
    #: bytes from which a piece is replayed by itself
    LONG = 256

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.singles = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        #: (left id << 32 | right id) -> id of the joined token; every way to cut a token in two known tokens
        self.joined = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.joined[left << 32 | right] = rank
        #: the same as a hash table for arrays: slots hold the pair or -1
        self.shift = 64 - 21
        self.slot_pair = np.full(1 << 21, -1, np.int64)
        self.slot_rank = np.full(1 << 21, -1, np.int32)
        pairs = np.fromiter(self.joined.keys(), np.int64, len(self.joined))
        joined = np.fromiter(self.joined.values(), np.int32, len(self.joined))
        slots = self._slots(pairs)
        self.probes = 0
        while len(pairs):
            self.probes += 1
            free = np.flatnonzero(self.slot_pair[slots] < 0)
            taken, which = np.unique(slots[free], return_index=True)
            won = free[which]
            self.slot_pair[taken], self.slot_rank[taken] = pairs[won], joined[won]
            left = np.ones(len(pairs), bool)
            left[won] = False
            pairs, joined, slots = pairs[left], joined[left], (slots[left] + 1) & ((1 << 21) - 1)
        #: rank of each pair of bytes, -1 if they don't join
        self.byte_pairs = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def ranks_of(self, left: np.ndarray | int, right: np.ndarray | int) -> np.ndarray:
        """Rank of each pair, -1 where the two don't join or one is missing (-1)."""
        pairs = np.asarray(left, np.int64) << 32 | np.asarray(right, np.int64)
        slots = self._slots(pairs)
        out = np.where(self.slot_pair[slots] == pairs, self.slot_rank[slots], -1)
        todo = np.flatnonzero((out < 0) & (self.slot_pair[slots] >= 0))
        for step in range(1, self.probes):
            if not len(todo):
                break
            next_slots = (slots[todo] + step) & ((1 << 21) - 1)
            found = self.slot_pair[next_slots]
            hit = found == pairs[todo]
            out[todo[hit]] = self.slot_rank[next_slots[hit]]
            todo = todo[~hit & (found >= 0)]
        return out

    def encode_long(self, piece: bytes) -> np.ndarray:
        """ids of one piece, by a heap of (rank, place): a piece of any length takes n log n steps.

        Together with others, a long piece would have to hand in its many places of one rank one by one.
        """
        joined = self.joined.get
        raw = np.frombuffer(piece, np.uint8)
        n = len(raw)
        sym = array("i", self.singles[raw].tobytes())
        aft = array("q", np.arange(1, n + 1).tobytes())
        bef = array("q", np.arange(-1, n - 1).tobytes())
        first = self.byte_pairs[raw[:-1], raw[1:]]
        at = np.flatnonzero(first >= 0)
        due = (first[at] << 40 | at).tolist()
        heapq.heapify(due)
        while due:
            x = heapq.heappop(due)
            rank, p = x >> 40, x & 0xFFFFFFFFFF
            left, q = sym[p], aft[p]
            if left < 0 or q == n or joined(left << 32 | sym[q]) != rank:
                continue
            sym[p], sym[q] = rank, -1
            follower = aft[p] = aft[q]
            if follower < n:
                bef[follower] = p
                new = joined(rank << 32 | sym[follower])
                if new is not None:
                    heapq.heappush(due, new << 40 | p)
            leader = bef[p]
            if leader >= 0:
                new = joined(sym[leader] << 32 | rank)
                if new is not None:
                    heapq.heappush(due, new << 40 | leader)
        out = np.frombuffer(sym, np.int32)
        return out[out >= 0]

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """ids of each piece, as lowest-rank-first, leftmost-first merging gives them."""
        ranks, joined = self.ranks, self.joined.get
        out: list[np.ndarray | None] = [None] * len(pieces)
        cut = []
        for k, piece in enumerate(pieces):
            whole = ranks.get(piece)
            if whole is not None:
                out[k] = np.array([whole], np.int32)
            elif len(piece) >= self.LONG:
                out[k] = self.encode_long(piece)
            elif piece:
                cut.append(k)
            else:
                out[k] = np.empty(0, np.int32)
        if not cut:
            return out
        size = np.array([len(pieces[k]) for k in cut])
        ends = np.cumsum(size)
        raw = np.frombuffer(b"".join([pieces[k] for k in cut]), np.uint8)
        n = len(raw)  # slot n stands for "none"
        word = np.repeat(np.arange(len(cut), dtype=np.int32), size)
        symbols = np.append(self.singles[raw], np.int32(-1))
        after = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        after[ends - 1] = before[ends - size] = n
        first = np.full(n, -1, np.int64)
        first[:-1] = self.byte_pairs[raw[:-1], raw[1:]]
        first[ends - 1] = -1
        index: dict[int, list[np.ndarray]] = {}  # arrays of positions by rank
        few: dict[int, list[int]] = {}  # single positions by rank
        due: list[int] = []

        def file(positions: np.ndarray, by: np.ndarray) -> None:
            """Enter the positions under their ranks."""
            order = np.argsort(by, kind="stable")
            by, positions = by[order], positions[order]
            at = np.flatnonzero(by[1:] != by[:-1]) + 1
            starts = [0, *at.tolist(), len(by)]
            for i, j in zip(starts[:-1], starts[1:], strict=True):
                rank = int(by[i])
                if rank not in index:
                    index[rank] = []
                    if rank not in few:
                        heapq.heappush(due, rank)
                index[rank].append(positions[i:j])

        if len(start := np.flatnonzero(first >= 0)):
            file(start.astype(np.int32), first[start])
        sym, aft, bef, of = memoryview(symbols), memoryview(after), memoryview(before), memoryview(word)
        while due:
            rank = heapq.heappop(due)
            arrays, positions = index.pop(rank, []), few.pop(rank, [])
            if sum(map(len, arrays)) + len(positions) >= self.MANY:
                p = np.sort(np.concatenate([*arrays, np.array(positions, np.int32)]))
                p = p[(symbols[p] >= 0) & (self.ranks_of(symbols[p], symbols[after[p]]) == rank)]
                lead = np.ones(len(p), bool)
                lead[1:] = word[p[1:]] != word[p[:-1]]
                later, p = p[~lead], p[lead]  # a piece's further places wait: a lower rank may come first there
                if len(later):
                    file(later, np.full(len(later), rank))
                q = after[p]
                follower = after[q]
                symbols[p], symbols[q] = rank, -1
                after[p], before[follower] = follower, p
                leader = before[p]
                by_right, by_left = self.ranks_of(rank, symbols[follower]), self.ranks_of(symbols[leader], rank)
                right, left = by_right >= 0, by_left >= 0
                places = np.concatenate([p[right], leader[left]])
                if len(places):
                    file(places, np.concatenate([by_right[right], by_left[left]]))
                continue
            for x in arrays:
                positions.extend(x.tolist())
            if len(positions) > 1:
                positions.sort()
            put_off: list[int] = []  # a lower rank arose in the same piece and comes first there
            halted = -1
            for p in positions:
                left = sym[p]
                q = aft[p]
                if left < 0 or q == n or joined(left << 32 | sym[q]) != rank:
                    continue
                if of[p] == halted:
                    put_off.append(p)
                    continue
                sym[p], sym[q] = rank, -1
                follower = aft[p] = aft[q]
                if follower != n:
                    bef[follower] = p
                    new = joined(rank << 32 | sym[follower])
                    if new is not None:
                        if new in few:
                            few[new].append(p)
                        else:
                            few[new] = [p]
                            if new not in index:
                                heapq.heappush(due, new)
                        if new < rank:
                            halted = of[p]
                leader = bef[p]
                if leader != n:
                    new = joined(sym[leader] << 32 | rank)
                    if new is not None:
                        if new in few:
                            few[new].append(leader)
                        else:
                            few[new] = [leader]
                            if new not in index:
                                heapq.heappush(due, new)
                        if new < rank:
                            halted = of[p]
            if put_off:
                if rank not in few and rank not in index:
                    heapq.heappush(due, rank)
                few.setdefault(rank, []).extend(put_off)
        alive = symbols[:n] >= 0
        flat = symbols[:n][alive]
        at = np.concatenate([[0], np.cumsum(alive)])
        for k, start, end in zip(cut, at[ends - size].tolist(), at[ends].tolist(), strict=True):
            out[k] = flat[start:end]
        return out


class PieceEncoder:
    """Whole texts to little-endian 32-bit ids, by pieces of ``pattern``, each replayed once."""

    def __init__(self, content: bytes, pattern: str):
        self.replay = MergeReplay(parse_ranks(content))
        self.split = regex.compile(pattern).findall
        # only for this pattern are a unit's borders known to be borders of pieces
        self.table = UnitTable(self._units, self._whole, 600_000) if pattern == KNOWN_PATTERN else None

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        return [x.tobytes() for x in self.replay.encode([p.encode("utf-8", "surrogatepass") for p in pieces])]

    def _units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = list(map(self.split, units))
        distinct = list(dict.fromkeys(p for pieces in cut for p in pieces))
        of = dict(zip(distinct, self._pieces(distinct), strict=True))
        got = [b"".join([of[p] for p in pieces]) for pieces in cut]
        return np.frombuffer(b"".join(got), "<u4"), np.fromiter(map(len, got), np.int64, len(got)) // 4

    def _whole(self, text: str) -> bytes:
        pieces = self.split(text)
        distinct = list(dict.fromkeys(pieces))
        of = dict(zip(distinct, self._pieces(distinct), strict=True))
        return b"".join([of[p] for p in pieces])

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        if self.table is None:
            return [self._whole(t) for t in (texts.to_pylist() if isinstance(texts, pa.Array) else texts)]
        return self.table.encode(texts)


_ENCODERS: dict[tuple[int, int], PieceEncoder] = {}


def _encoder(content: bytes, pattern: str) -> PieceEncoder:
    """One encoder per worker process and vocabulary, kept between tasks."""
    key = hash(content), hash(pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(content, pattern)
    gc.disable()  # until the task's end: the tables hold no cycles, and walking them costs more than it frees
    return _ENCODERS[key]


def encode(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; null text counts as empty."""
    content = df.sparkSession.sparkContext.broadcast(file_bytes(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value, pattern)
        for part, texts in text_arrays(batches, most=SLICE):
            got = encoder.encode(texts)
            offsets = np.zeros(len(got) + 1, "<i4")
            np.cumsum([len(x) // 4 for x in got], out=offsets[1:])
            ids = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(got))])
            lists = pa.ListArray.from_arrays(pa.array(offsets), ids)
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "ids"])

    rows = texts_of(df, id_col, text_col)
    bound_arrow(df.sparkSession, 2 * SLICE)
    return rows.mapInArrow(released(run), "doc_id long, ids array<int>")


def decode(df: DataFrame, rank_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded binary): the ids' bytes in order; null ids count as none."""
    content = df.sparkSession.sparkContext.broadcast(file_bytes(rank_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = parse_ranks(content.value)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        length = np.array([len(t) for t in tokens], np.int32)
        start = (np.cumsum(length) - length).astype(np.int32)
        data = np.frombuffer(b"".join(tokens), np.uint8)
        del ranks, tokens
        for batch in batches:
            sizes = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(1)).to_numpy())])
            at = 0
            while at < batch.num_rows:  # rows of about SLICE / 4 ids at a time
                to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + SLICE // 4, "right")) - 1)
                part = batch.slice(at, to - at)
                ids = part.column(1).flatten().to_numpy()
                size = length[ids]
                ends = np.concatenate([[0], np.cumsum(size)])
                flat = data[np.repeat(start[ids] - ends[:-1].astype(np.int32), size) + np.arange(ends[-1], dtype=np.int32)]
                reach = ends[sizes[at : to + 1] - sizes[at]].astype("<i4")
                decoded = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(reach.tobytes()), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), decoded], names=["doc_id", "ids", "decoded"])
                at = to

    bound_arrow(df.sparkSession, 2 * SLICE)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(released(run), "doc_id long, ids array<int>, decoded binary")


def digests(df: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of decoded rows."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return df.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
