"""Token ids in files of our own format: Re-Pair grammar compression per shard.

Documents are brought in ascending id order by a range exchange, encoded, and cut in
shards of bounded size. In a shard, frequent id pairs are replaced by nonterminals,
round after round: a round gives every pair that occurs often enough a nonterminal, and
where two replacements overlap lets the more frequent pair win. The first rounds count
all pairs of the sequence; the others keep a chain of symbols and count exactly the
places of frequent pairs and those next to a replacement. Rounds end when no pair
occurs LEAST times without overlap. A shard stores its rules, the expansion length of
each nonterminal and the documents' lengths, so one document can be decoded without
the rest.

A file is a Parquet file of the shared folder whose rows are shards, so Spark's
committer makes a retried task's output whole, wherever the folder lies.

Payload, little-endian: ``<8s5Q`` magic, n_ids, n_docs, first_free, n_rules, n_symbols;
then u4 left[n_rules], u4 right[n_rules], u4 expansion[n_rules], i8 doc_id[n_docs],
u1 doc_id_is_null[n_docs], u4 n_tokens[n_docs], and the symbols as u2 or u4,
whichever the largest symbol needs.

Defined results: null text counts as empty and has the end id alone; rows with the
same doc_id keep all their copies, in input order; null doc_id sorts first; an empty
table gives no shards; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_arrow, file_bytes, released, shared_folder, text_arrays, trim
from .vocabulary import encoder_of

MAGIC = b"VTLREP01"
HEAD = struct.Struct("<8s5Q")
#: ids in a shard; a longer document has a shard of its own
SHARD_IDS = 2 << 20
#: a pair that occurs so often without overlap becomes a rule
LEAST = 8
#: whole-sequence rounds hand over to incremental ones when a round shortens the sequence by less than this share
HAND_OVER = 0.02
#: pairs are counted in 2 ** BITS buckets a whole-sequence round
BITS = 18

SHARDS = "shard int, block int, n_ids long, n_docs long, payload binary"


def _winners(rank: np.ndarray, before: np.ndarray, after: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Which places are replaced: no neighbour ranks higher, and every second one of equal neighbours."""
    return (rank > 0) & (rank >= before) & (rank >= after) & ~odd


def _whole_rounds(current: np.ndarray, free: int, least: int, lefts: list[np.ndarray], rights: list[np.ndarray]) -> np.ndarray:
    """Rounds over the whole sequence, as long as one saves HAND_OVER of it; pairs that share a bucket wait."""
    turn = 0
    while len(current) > 2 * least:
        turn += 1
        # each pair's bucket; a bucket stands for its last pair, others in it have their turn later
        pair = current[:-1].astype(np.uint64) << np.uint64(32) | current[1:]
        salt = np.uint64((0x9E3779B97F4A7C15 * (2 * turn + 1)) & 0xFFFFFFFFFFFFFFFF)
        bucket = (pair * salt >> np.uint64(64 - BITS)).view(np.int64)
        stands = np.zeros(1 << BITS, np.uint64)
        stands[bucket] = pair
        same = stands[bucket] == pair
        count = np.bincount(bucket.take(np.flatnonzero(same)), minlength=1 << BITS).astype(np.int32)
        count[count < least] = 0
        weight = np.zeros(len(pair) + 2, np.int32)
        np.multiply(count[bucket], same, out=weight[1:-1])
        middle = weight[1:-1]
        at = np.flatnonzero((middle > weight[:-2]) & (middle >= weight[2:]))
        which = bucket[at]
        often = np.bincount(which, minlength=1 << BITS) >= least
        good = np.flatnonzero(often[which])
        at, which = at.take(good), which.take(good)
        if not len(at):
            break
        rules = np.flatnonzero(often)
        number = np.zeros(1 << BITS, np.uint32)
        number[rules] = np.arange(free, free + len(rules), dtype=np.uint32)
        lefts.append((stands[rules] >> np.uint64(32)).astype(np.uint32))
        rights.append(stands[rules].astype(np.uint32))
        free += len(rules)
        shorter = current.copy()
        shorter[at] = number[which]
        keep = np.ones(len(current), bool)
        keep[at + 1] = False
        saved, before = len(at) - 2 * len(rules), len(current)
        current = shorter.take(np.flatnonzero(keep))
        if saved < HAND_OVER * before:
            break
    return current


def _incremental_rounds(current: np.ndarray, free: int, least: int, lefts: list[np.ndarray], rights: list[np.ndarray]) -> np.ndarray:
    """Rounds over a chain of symbols that only look at places of frequent pairs, until no pair occurs ``least`` times.

    A round's nonterminals are new, so a pair that was rare in some round never becomes
    frequent again: later rounds need the frequent pairs' places and those next to a
    replacement, nothing else.
    """
    n = len(current)
    if n < 2:
        return current
    symbols = np.append(current, np.uint32(0)).astype(np.uint64)  # place n is the end
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    before[0] = n
    alive = np.ones(n + 1, bool)
    rank = np.zeros(n + 1, np.int32)
    pair = symbols[: n - 1] << np.uint64(32) | symbols[1:n]
    bucket = (pair * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).view(np.int64)
    places = np.flatnonzero((np.bincount(bucket, minlength=1 << 20) >= least)[bucket]).astype(np.int32)
    del pair, bucket
    while len(places):
        follower = after[places]
        pair = symbols[places] << np.uint64(32) | symbols[follower]
        order = np.argsort(pair)
        ranked = pair[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        of = np.empty(len(places), np.int32)
        of[order] = np.cumsum(new) - 1
        # in a run of one symbol every second place counts
        tied = np.concatenate([[False], (of[1:] == of[:-1]) & (follower[:-1] == places[1:])])
        index = np.arange(len(places))
        odd = (index - np.maximum.accumulate(np.where(tied, 0, index))) % 2 == 1
        count = np.bincount(of[~odd], minlength=int(new.sum()))
        often = count >= least
        if not often.any():
            break
        # frequent pairs by count and then by their symbols, from 1 on
        grade = np.zeros(len(count), np.int32)
        grade[np.flatnonzero(often)[np.argsort(count[often], kind="stable")]] = np.arange(1, int(often.sum()) + 1)
        keep = np.flatnonzero(often[of])
        places, follower, of, odd = places.take(keep), follower.take(keep), of.take(keep), odd.take(keep)
        rank[places] = grade[of]
        won = _winners(rank[places], rank[before[places]], rank[follower], odd)
        enough = np.bincount(of[won], minlength=len(count)) >= least
        won &= enough[of]
        rank[places] = 0
        rules = np.flatnonzero(enough)
        number = np.zeros(len(count), np.uint64)
        number[rules] = np.arange(free, free + len(rules), dtype=np.uint64)
        distinct = ranked[new][rules]
        lefts.append((distinct >> np.uint64(32)).astype(np.uint32))
        rights.append(distinct.astype(np.uint32))
        free += len(rules)
        at, gone = places[won], follower[won]
        symbols[at] = number[of[won]]
        alive[gone] = False
        beyond = after[gone]
        after[at], before[beyond] = beyond, at
        before[n] = n
        touched = np.concatenate([places[~won], at, before[at]])
        touched = touched.take(np.flatnonzero(alive[touched] & (touched < n) & (after[touched] < n)))
        places = np.unique(touched)
    return symbols.take(np.flatnonzero(alive[:n])).astype(np.uint32)


def compress(ids: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, left, right, first_free): nonterminal first_free + k stands for left[k], right[k].

    No pair of the symbols occurs ``least`` times or more without overlap.
    """
    current = np.asarray(ids, np.uint32)
    first_free = int(current.max()) + 1 if len(current) else 0
    lefts: list[np.ndarray] = []
    rights: list[np.ndarray] = []
    current = _whole_rounds(current, first_free, least, lefts, rights)
    current = _incremental_rounds(current, first_free + sum(map(len, lefts)), least, lefts, rights)
    none = np.empty(0, np.uint32)
    return current, np.concatenate([none, *lefts]), np.concatenate([none, *rights]), first_free


def expansions(left: np.ndarray, right: np.ndarray, first_free: int) -> np.ndarray:
    """Expansion length of each nonterminal; rules only refer to ids and earlier rules."""
    size = np.zeros(len(left), np.int64)
    todo = np.arange(len(left))
    known = np.concatenate([np.ones(first_free, np.int64), size])
    while len(todo):
        x = known[left[todo]], known[right[todo]]
        ready = (x[0] > 0) & (x[1] > 0)
        known[first_free + todo[ready]] = x[0][ready] + x[1][ready]
        todo = todo[~ready]
    return known[first_free:]


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, first_free: int) -> np.ndarray:
    """The ids that the symbols stand for: all nonterminals are opened at once, until none is left."""
    current = np.asarray(symbols, np.uint32)
    while len(left):
        rule = current >= first_free
        if not rule.any():
            break
        to = np.cumsum(rule) + np.arange(len(current))  # place of each symbol's last half
        wider = np.empty(int(to[-1]) + 1, np.uint32)
        which = current[rule].astype(np.int64) - first_free
        wider[to[~rule]] = current[~rule]
        wider[to[rule] - 1], wider[to[rule]] = left[which], right[which]
        current = wider
    return current


def payload(ids: np.ndarray, docs: list[tuple[int | None, int]]) -> bytes:
    """One shard's bytes; docs: (doc_id or None, ids) in order."""
    symbols, left, right, first_free = compress(ids)
    size = expansions(left, right, first_free)
    kind = "<u2" if not len(symbols) or int(symbols.max()) < 1 << 16 else "<u4"
    return b"".join([
        HEAD.pack(MAGIC, len(ids), len(docs), first_free, len(left), len(symbols)),
        left.astype("<u4").tobytes(), right.astype("<u4").tobytes(), size.astype("<u4").tobytes(),
        np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
        np.array([d is None for d, _ in docs], "u1").tobytes(),
        np.array([n for _, n in docs], "<u4").tobytes(),
        symbols.astype(kind).tobytes(),
    ])


class Shard:
    """A shard read back: all of it, or one document by random access."""

    def __init__(self, data: bytes):
        magic, self.n_ids, n_docs, self.first_free, n_rules, n_symbols = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard of this format")
        at = HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, n, at)
            at += got.nbytes
            return got

        self.left, self.right, self.size = take("<u4", n_rules), take("<u4", n_rules), take("<u4", n_rules)
        self.doc_id, self.is_null, self.n_tokens = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
        self.symbols = take("<u2" if len(data) - at == 2 * n_symbols else "<u4", n_symbols)
        self.ends = np.cumsum(self.n_tokens, dtype=np.int64)

    def ids(self) -> np.ndarray:
        """All ids: the rules are opened once, and every symbol's ids are gathered from them."""
        if not len(self.left):
            return self.symbols.astype(np.uint32)
        rules = np.arange(self.first_free, self.first_free + len(self.left), dtype=np.uint32)
        ids = np.concatenate([np.arange(self.first_free, dtype=np.uint32), expand(rules, self.left, self.right, self.first_free)])
        size = np.concatenate([np.ones(self.first_free, np.int32), self.size.astype(np.int32)])
        at = np.cumsum(size, dtype=np.int32) - size
        each = size[self.symbols]
        reach = np.cumsum(each, dtype=np.int32)
        return ids[np.repeat(at[self.symbols] - (reach - each), each) + np.arange(self.n_ids, dtype=np.int32)]

    def document(self, k: int) -> np.ndarray:
        """ids of the k-th document: only the symbols that reach into it are opened."""
        end = int(self.ends[k])
        start = end - int(self.n_tokens[k])
        if start == end:
            return np.empty(0, np.uint32)
        wide = np.where(self.symbols >= self.first_free, self.size[np.maximum(self.symbols.astype(np.int64) - self.first_free, 0)] if len(self.size) else 1, 1)
        reach = np.cumsum(wide, dtype=np.int64)
        a, b = np.searchsorted(reach, start, "right"), np.searchsorted(reach, end, "left")
        before = int(reach[a - 1]) if a else 0
        return expand(self.symbols[a : b + 1], self.left, self.right, self.first_free)[start - before : end - before]


def write_ids(df: DataFrame, path: str, tokenizer_file: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Encode all whole texts, append the end id, and write the shards in ascending doc_id order."""
    spark = df.sparkSession
    bound_arrow(spark)
    content = spark.sparkContext.broadcast(file_bytes(tokenizer_file))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard, block = encoder_of(content.value), TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        docs: list[tuple[int | None, int]] = []
        total = 0

        def row() -> pa.RecordBatch:
            data = payload(np.frombuffer(b"".join(held), "<u4"), docs)
            trim()  # compression takes many times a shard's size
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([total], pa.int64()), pa.array([len(docs)], pa.int64()), pa.array([data], pa.binary())], names=["shard", "block", "n_ids", "n_docs", "payload"])

        for part, texts in text_arrays(batches):
            for doc_id, got in zip(part.column(0).to_pylist(), encoder.encode(texts), strict=True):
                n = len(got) // 4 + 1
                if docs and total + n > shard_ids:
                    yield row()
                    held, docs, total, block = [], [], 0, block + 1
                held += [got, end]
                docs.append((doc_id, n))
                total += n
        if docs:
            yield row()

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_at"))
    ordered = rows.repartitionByRange("doc_id", "_at").sortWithinPartitions("doc_id", "_at").select("doc_id", "text")
    ordered.mapInArrow(released(run), SHARDS).write.parquet(path)


def _read(spark: SparkSession, path: str, columns: Callable[[bytes, list[int], list[int]], dict[str, pa.Array]], kinds: str) -> DataFrame:
    """(shard, block, position, doc_id, local_start) of every document and what ``columns`` makes of a shard's ids and some documents' starts and ends in bytes."""
    bound_arrow(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = Shard(data)
                raw = x.ids().astype("<u4").tobytes()
                ends = (x.ends * 4).tolist()
                n = len(ends)
                for i in range(0, n, 256):
                    j = min(n, i + 256)
                    first, last = [0, *ends][i:j], ends[i:j]
                    fixed = {
                        "shard": pa.array([shard] * (j - i), pa.int32()), "block": pa.array([block] * (j - i), pa.int32()), "position": pa.array(range(i, j), pa.int32()),
                        "doc_id": pa.array(x.doc_id[i:j], mask=x.is_null[i:j].astype(bool)), "local_start": pa.array([s // 4 for s in first], pa.int64()),
                    }
                    yield pa.RecordBatch.from_pydict(fixed | columns(raw, first, last))

    stored = spark.read.schema(SHARDS).parquet(path)
    return stored.select("shard", "block", "payload").mapInArrow(released(run), "shard int, block int, position int, doc_id long, local_start long, " + kinds)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, position, doc_id, local_start, ids binary) of every document, decoded from the files."""

    def ids(raw: bytes, first: list[int], last: list[int]) -> dict[str, pa.Array]:
        return {"ids": pa.array([raw[s:e] for s, e in zip(first, last, strict=True)], pa.binary())}

    return _read(spark, path, ids, "ids binary")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, position, doc_id, local_start, n_tokens, ids_crc32) of every document: the decoded ids stay in the workers."""

    def sums(raw: bytes, first: list[int], last: list[int]) -> dict[str, pa.Array]:
        view = memoryview(raw)
        spans = list(zip(first, last, strict=True))
        return {"n_tokens": pa.array([(e - s) // 4 for s, e in spans], pa.int64()), "ids_crc32": pa.array([zlib.crc32(view[s:e]) for s, e in spans], pa.int64())}

    return _read(spark, path, sums, "n_tokens long, ids_crc32 long")


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, base): ids before each shard, from the shards' counts alone.

    Sums run within a file's shard first, then over the files, so no window holds
    more rows than there are files or blocks of one file.
    """
    counts = spark.read.schema(SHARDS).parquet(path).select("shard", "block", "n_ids")
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    files = counts.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = files.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    return counts.select("shard", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("a")).join(before, "shard").select("shard", "block", (F.col("a") + F.col("b")).alias("base"))


def round_trip(df: DataFrame, tokenizer_file: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Write the ids, read the files back: (doc_id, start, n_tokens, ids_crc32) of every document."""
    spark = df.sparkSession
    path = path or shared_folder(spark, "ids")
    write_ids(df, path, tokenizer_file, end_id, id_col, text_col)
    return read_checksums(spark, path).join(starts(spark, path), ["shard", "block"]).select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def checksum(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
