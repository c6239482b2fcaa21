"""Exact top-k inner products by norm-sorted scanning with rotated partial sums.

Components become floor(scale * x), whole numbers, and so are the scores. All vectors
are stored once in descending order of length: range partitions hold that order
piecewise. A d x d moment matrix of all vectors gives an orthogonal rotation that
gathers most of their length in the first coordinates. Queries are taken in blocks of
bounded size, one job a block:

* the longest HEAD vectors give every query of the block a first k-th best score;
* by Cauchy-Schwarz no vector shorter than the least of these scores divided by the
  query's length can matter, so ranges of shorter vectors aren't even read;
* a task reads the others in slabs and strips of descending length. A query is done
  once |q||x| is below its k-th best score so far; for the rest, the partial sum over
  the leading rotated coordinates plus the product of the two residual lengths bounds
  the score, and only vectors whose bound reaches the k-th best are scored exactly.

Every task returns at most k rows a query; a second step keeps each query's best k.
Bounds are widened by a margin above rounding error, and candidates at the k-th score
stay, so ties go to the smaller vec_id exactly. Scores are computed in float64 where
they and their partial sums stay below 2^53, else in 64-bit or in unbounded integers.

Defined results: vectors that are null or hold null, NaN or infinite components take
no part; vectors of different length are compared over the components both have; a
score beyond 64 bits counts as the nearest 64-bit number, and a component whose
multiple is beyond the double range as the largest double;
repeated rows count as often as they occur, but a query never meets rows with its own
vec_id, and repeated query rows are asked once; fewer candidates than k give fewer
rows; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import released, shared_folder, written

#: Queries that travel to every task at once: with 64 components, 4 MB.
QUERY_BLOCK = 8192
#: Longest vectors that give first scores: with 64 components, 1 MB.
HEAD = 2048
SLAB, STRIP = 16_384, 1024
#: Bounds are widened by this share of |q||x|.
MARGIN = 1e-9
OUT = "query_id long, vec_id long, score long"


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, x array<double>, length): vectors that hold only finite components, multiplied and rounded down to whole numbers."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = F.lit(float(np.finfo(np.float64).max))
    times = lambda x: F.least(F.greatest(x * F.lit(float(scale)), -most), most)
    # from 2^53 on every double is whole, and floor() would leave the range of its long
    whole = lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)
    rows = df.filter(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: whole(times(x))).alias("x"))
    return rows.withColumn("length", F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, x: a + x * x)))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """The lists as rows of float64, filled with zeros up to ``width``."""
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(ends)
    out = np.zeros((len(column), width))
    if len(column) and (size == width).all():
        return flat[ends[0] : ends[-1]].reshape(len(column), width)
    for k in range(len(column)):
        out[k, : size[k]] = flat[ends[k] : ends[k + 1]]
    return out


def moments(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of x x^T over all vectors: each task sends one width x width matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width)
            with np.errstate(over="ignore", invalid="ignore"):
                total += m.T @ m
        total = np.nan_to_num(total)  # any rotation will do, the best one only prunes most
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width), width), pa.int32()), pa.array(np.tile(np.arange(width), width), pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

    rows = vectors.select("x").mapInArrow(released(run), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((width, width))
    for i, j, v in rows:
        out[i, j] = v
    return out


def rotation_of(moment: np.ndarray) -> np.ndarray:
    """An orthogonal matrix whose first columns hold most of the vectors' length."""
    top = np.abs(moment).max()
    if not 0 < top < 1e300:
        return np.eye(len(moment))
    return np.linalg.eigh(moment / top)[1][:, ::-1].copy()


def exact_scores(q: np.ndarray, x: np.ndarray, most: float) -> np.ndarray:
    """Whole-number inner products of the rows of q and x, which hold whole numbers; no product of lengths exceeds ``most``."""
    out = np.empty(len(q), np.int64)
    for i in range(0, len(q), 1 << 16):
        a, b = q[i : i + (1 << 16)], x[i : i + (1 << 16)]
        if most < 1 << 53:
            out[i : i + len(a)] = np.einsum("ij,ij->i", a, b)
        elif most < 1 << 62 and max(np.abs(a).max(), np.abs(b).max()) < 1 << 62:
            out[i : i + len(a)] = np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
        else:
            least, greatest = np.iinfo(np.int64).min, np.iinfo(np.int64).max
            for k, (u, v) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
                out[i + k] = min(max(sum(int(s) * int(t) for s, t in zip(u, v, strict=True) if s and t), least), greatest)
    return out


def _best(rows: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query row, ties to the smaller id; raises the lower bounds of the k-th scores."""
    by = np.lexsort((ids, -score.astype(np.float64), rows)) if len(score) and score.min() == np.iinfo(np.int64).min else np.lexsort((ids, -score, rows))
    rows, ids, score = rows[by], ids[by], score[by]
    first = np.r_[0, np.flatnonzero(np.diff(rows)) + 1] if len(rows) else np.empty(0, np.int64)
    place = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
    kth = place == k - 1
    best[rows[kth]] = np.maximum(best[rows[kth]], score[kth])
    keep = place < k
    return rows[keep], ids[keep], score[keep]


class Scan:
    """One block of queries against slabs of vectors: the best k so far of every query."""

    def __init__(self, q_id: np.ndarray, q: np.ndarray, rotation: np.ndarray, k: int, best: np.ndarray | None = None):
        self.q_id, self.q, self.rotation, self.k = q_id, q, rotation, k
        self.lead = max(1, len(rotation) // 4)
        with np.errstate(over="ignore", invalid="ignore"):
            self.rotated = q @ rotation
            self.length = np.sqrt((q * q).sum(1))
            self.rest = np.sqrt((self.rotated[:, self.lead :] ** 2).sum(1))
        #: lower bounds of the k-th scores
        self.best = np.full(len(q_id), -np.inf) if best is None else best.copy()
        none = np.empty(0, np.int64)
        self.top = none, none, none  # query row, vec_id, score

    def slab(self, ids: np.ndarray, x: np.ndarray) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            turned = x @ self.rotation
            length, rest = np.sqrt((x * x).sum(1)), np.sqrt((turned[:, self.lead :] ** 2).sum(1))
            order = np.argsort(-length, kind="stable")
            for at in range(0, len(order), STRIP):
                strip = order[at : at + STRIP]
                # written so that what overflowed to NaN is compared
                live = np.flatnonzero(~(self.length * length[strip[0]] * (1 + MARGIN) + 1e-6 < self.best))
                if not len(live):
                    break
                bound = self.rotated[live, : self.lead] @ turned[strip, : self.lead].T + np.outer(self.rest[live], rest[strip])
                bound += MARGIN * np.outer(self.length[live], length[strip]) + 1e-6
                a, b = np.nonzero(~(bound < self.best[live, None]))
                del bound
                rows, cands = live[a], strip[b]
                other = self.q_id[rows] != ids[cands]
                self._take(rows[other], ids, x, cands[other], float(np.nan_to_num((self.length[live].max() * length[strip[0]]), nan=np.inf)))

    def _take(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, cands: np.ndarray, most: float) -> None:
        score = np.concatenate([np.empty(0, np.int64), *(exact_scores(self.q[rows[i : i + (1 << 18)]], x[cands[i : i + (1 << 18)]], most) for i in range(0, len(rows), 1 << 18))])
        keep = score >= self.best[rows]
        rows, found, score = rows[keep], ids[cands[keep]], score[keep]
        if len(rows):
            self.top = _best(np.concatenate([self.top[0], rows]), np.concatenate([self.top[1], found]), np.concatenate([self.top[2], score]), self.k, self.best)


def top_k(candidates: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other rows. is_query is a condition on vec_id."""
    spark = candidates.sparkSession
    vectors = usable(candidates, id_col, vector_col, scale)
    vectors = written(vectors.repartitionByRange(F.desc("length"), "vec_id").sortWithinPartitions(F.desc("length"), "vec_id"), "vectors")
    width = max(1, vectors.agg(F.max(F.size("x"))).first()[0] or 1)
    rotation = rotation_of(moments(vectors, width))
    arrays = lambda got: (got.column("vec_id").to_numpy().astype(np.int64), _matrix(got.column("x").combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.float64())), width))
    head_id, head = arrays(vectors.orderBy(F.desc("length"), "vec_id").limit(HEAD).select("vec_id", "x").toArrow())
    queries = vectors.filter(is_query).groupBy("vec_id").agg(F.min("x").alias("x"))
    blocks = max(1, -(-queries.count() // query_block))
    queries = written(queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")), "queries") if blocks > 1 else queries.withColumn("block", F.lit(0))
    path = shared_folder(spark, "found")

    def scanned(block: int) -> DataFrame:
        q_id, q = arrays(queries.filter(F.col("block") == block).select("vec_id", "x").toArrow())
        first = Scan(q_id, q, rotation, k)
        for i in range(0, len(q_id), 1024):
            part = Scan(q_id[i : i + 1024], q[i : i + 1024], rotation, k)
            part.slab(head_id, head)
            first.best[i : i + 1024] = part.best
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            needed = np.nan_to_num(first.best * (1 - 1e-6) / first.length, nan=-np.inf, posinf=-np.inf, neginf=-np.inf)
        sent = spark.sparkContext.broadcast((q_id, q, rotation, first.best))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scan = Scan(*sent.value[:3], k, sent.value[3])

            def slab(parts: list[pa.RecordBatch]) -> None:
                scan.slab(np.concatenate([p.column(0).to_numpy() for p in parts]).astype(np.int64), np.concatenate([_matrix(p.column(1), width) for p in parts]))

            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= SLAB:
                    slab(held)
                    held = []
            if held:
                slab(held)
            rows, ids, score = scan.top
            for i in range(0, len(rows), 65_536):
                s = slice(i, i + 65_536)
                yield pa.RecordBatch.from_arrays([pa.array(scan.q_id[rows[s]]), pa.array(ids[s]), pa.array(score[s])], names=["query_id", "vec_id", "score"])

        least = float(needed.min()) if len(needed) else 0.0
        near = vectors.filter(F.col("length") >= least) if least > 0 else vectors
        return near.select("vec_id", "x").mapInArrow(released(run), OUT)

    if blocks == 1:
        found = scanned(0)
    else:  # one job a block, so neither plan nor driver grows with their number
        for block in range(blocks):
            scanned(block).write.mode("append").parquet(path)
        found = spark.read.schema(OUT).parquet(path)
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
