import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vantle.llm import topk


def brute(rows, every, k):
    keep = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in keep:
        if i % every == 0 and (i not in queries or v < queries[i]):
            queries[i] = v
    out = []
    for q, v in queries.items():
        got = sorted(((sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in keep if i != q), key=lambda x: (-x[0], x[1]))[:k]
        out += [(q, r, i, s) for r, (s, i) in enumerate(got, 1)]
    return sorted(out)


def run(spark, rows, every=50, k=5, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, k, **options).collect())


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(scale=0.2, size=d)]) for i in range(n)]


@pytest.mark.parametrize(("n", "d", "every"), [(700, 16, 50), (300, 64, 7), (40, 3, 2), (3, 4, 1)])
def test_exact(spark, n, d, every):
    rows = vectors(n, d, n)
    assert run(spark, rows, every) == brute(rows, every, 5)


def test_ties_copies_and_bad_rows(spark):
    rows = vectors(120, 8, 1)
    rows += [(1000 + i, rows[3][1]) for i in range(30)]  # equal vectors: ties
    rows += [(0, rows[5][1]), (7, rows[7][1]), (50, rows[50][1])]  # repeated ids
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 6), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (2004, []), (2005, [0.5] * 4), (None, [0.5] * 8)]
    assert run(spark, rows, 10) == brute(rows, 10, 5)


def test_query_blocks(spark):
    rows = vectors(200, 8, 2)
    assert run(spark, rows, 5, query_block=7) == brute(rows, 5, 5)


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(0, None)]) == [] and run(spark, [(50, [1.0])]) == []


def whole(rows, every, k=5):
    """Brute force in unbounded integers, scores beyond 64 bits as the nearest 64-bit number."""
    keep = [(i, [math.floor(256 * x) if abs(x) < 2**44 else int(x) * 256 for x in v]) for i, v in rows]
    out = []
    for q, v in keep:
        if q % every == 0:
            score = [(min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(2**63)), 2**63 - 1), i) for i, w in keep if i != q]
            out += [(q, r, i, s) for r, (s, i) in enumerate(sorted(score, key=lambda x: (-x[0], x[1]))[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [1e4, 3e5, 1e7, 1e12, 1e30, 1e200])
def test_whole_numbers_of_any_size(spark, size):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(scale=size, size=6)]) for i in range(60)]
    rows += [(60 + i, [float(x) for x in rng.normal(size=6)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 9 == 0, 5).collect()) == whole(rows, 9)


def test_short_vectors_are_not_read(spark):
    # lengths fall by far, so a query's best are among the longest
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8) * (40 / (1 + i))]) for i in range(3000)]
    assert run(spark, rows, 500, query_block=3) == brute(rows, 500, 5)


def test_scans_of_slabs(monkeypatch):
    monkeypatch.setattr(topk, "STRIP", 16)
    rng = np.random.default_rng(2)
    x, ids = np.floor(rng.normal(scale=50, size=(900, 12)) * rng.lognormal(size=(900, 1))), rng.permutation(900)
    scan = topk.Scan(ids[:40], x[:40], topk.rotation_of(x.T @ x), 5)
    for i in range(0, 900, 250):
        scan.slab(ids[i : i + 250], x[i : i + 250])
    rows, found, score = scan.top
    for k in range(40):
        want = sorted(((-int(s), i) for s, i in zip(x @ x[k], ids.tolist(), strict=True) if i != ids[k]))[:5]
        assert [(-int(s), int(i)) for s, i in zip(score[rows == k], found[rows == k], strict=True)] == want
