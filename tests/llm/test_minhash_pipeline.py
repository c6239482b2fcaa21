"""Near-duplicates and the whole pipeline against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vantle.llm import graph, knn, minhash, queries, rules
from vantle.session import written

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, size):
    words = WORDS.findall((text or "").translate(LOWER))
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(rows, size, percent=80):
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(n, seed, copies):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n):
        rows.append([rng.choice(vocabulary) for _ in range(rng.randint(1, 120))])
    for _ in range(copies):
        base = list(rng.choice(rows[:n]))
        for _ in range(rng.randint(0, max(1, len(base) // 12))):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        rows.append(base)
    hub = [f"h{i}" for i in range(60)]
    for k in range(60):  # a chain of near copies: each is like the next, far ones aren't
        rows.append([f"c{k}_{i}" if i < k % 20 else w for i, w in enumerate(hub)])
    rng.shuffle(rows)
    return list(enumerate(rng.choice([" ", "\n", "\t"]).join(w.upper() if rng.random() < 0.1 else w for w in r) for r in rows))


@pytest.mark.parametrize(("size", "seed"), [(2, 1), (5, 2)])
def test_groups_equal_brute_force(spark, size, seed):
    rows = corpus(150, seed, 150)
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1005, "One \n"), (1006, "x " * 30_000), (1007, "X " * 29_000)]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows] + [rows[0] + (2, "k"), (None, "one", 3, "k")], "doc_id long, text string, component_id int, id string")
    got = minhash.near_duplicates(df, size).collect()
    assert len(got) == df.count()
    want = brute(rows, size)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], rows[r["doc_id"]] if r["doc_id"] < 400 else r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    kept = minhash.one_of_each(df, size)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == sorted({c for _, c in want.values()})


def test_large_cluster_is_chunked(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 16)
    monkeypatch.setattr(minhash, "REGION", 8)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(80)] = f"r{rng.randrange(50)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, 2).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 2).items()}


def groups_of(n, links):
    parent = list(range(n))
    for a, b in links:
        x, y = parent[a], parent[b]
        parent = [min(x, y) if p in (x, y) else p for p in parent]
    return parent


def test_ties_make_the_groups_of_all_near_pairs():
    rng = np.random.default_rng(11)
    bases = rng.integers(0, 256, (12, minhash.SKETCH), np.uint8)
    sketches = bases[rng.integers(0, 12, 300)]
    sketches = np.where(rng.random(sketches.shape) < rng.choice([0.1, 0.3, 0.4], (300, 1)), rng.integers(0, 256, sketches.shape, np.uint8), sketches)
    every = [(i, j) for i in range(300) for j in range(i) if (sketches[i] == sketches[j]).sum() >= 40]
    links, group = minhash._ties(sketches, 40)
    found = [(int(a), int(b)) for x in links for a, b in x.T]
    assert {(max(x), min(x)) for x in found} <= set(every) and groups_of(300, found) == groups_of(300, every) and len(found) < 300
    assert [groups_of(300, every)[i] == groups_of(300, every)[j] for i, j in zip(range(299), range(1, 300), strict=True)] == (group[:-1] == group[1:]).tolist()
    assert minhash._ties(sketches[:0], 40)[0] == [] and minhash._ties(sketches[:1], 40)[0] == []


@pytest.mark.parametrize("region", [8, 2048])
def test_documents_of_a_crowded_region_all_meet(monkeypatch, region):
    monkeypatch.setattr(minhash, "REGION", region)
    n = 6000
    rng = np.random.default_rng(9)
    sketches = rng.integers(0, 256, (n, minhash.SKETCH), np.uint8)
    sketches[5000] = sketches[10]  # far apart in the order, in different pieces
    sketches[5000, :8] += 1
    keys = sorted(b"kkkk" * 4 + b"k" + bytes(x) for x in rng.integers(0, 3, (n, 12), np.uint8))
    links, _ = minhash._region(keys, sketches, 40, minhash.LEAST_DEPTH)
    assert {tuple(sorted(x)) for part in links for x in part.T.tolist()} == {(10, 5000)}


@pytest.mark.parametrize("names", [["my col", "a-b", "a.b", "row", "print", "_gone", "component", "least"]])
def test_stages_keep_odd_columns(spark, sf, names):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    wide = docs.selectExpr("*", *(f"struct(doc_id as `x y`, array(text) as `p-q`) as `{n}`" for n in names), "cast(null as int) as `n_words`")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, wide, sf)
        if k < 3:
            assert out.schema.simpleString() == wide.schema.simpleString()
            assert all(r["my col"]["x y"] == r["doc_id"] and r["my col"]["p-q"] == [r["text"]] for r in out.collect())
        assert out.select("doc_id").distinct().count() <= 60
    again = minhash.one_of_each(wide.unionByName(wide.withColumn("text", F.lit("other words than before"))), 2)
    assert again.columns == wide.columns and again.count() == minhash.one_of_each(docs, 2).count() + 1


def test_repeated_ids_with_different_texts(spark):
    text = lambda k, n=60: " ".join(f"{k}{i}" for i in range(n))
    # 5 has three unlike texts, one near to 3's, and one twice; 7 has two texts near each other; 9 a text and an empty one; 8 is near 5's second text
    rows = [(5, text("a")), (5, text("b")), (5, text("b")), (5, text("c")), (3, text("a") + " x"), (7, text("d")), (7, text("d") + " x"), (8, text("b") + " y"), (9, text("e")), (9, ""), (10, text("f")), (11, text("f") + " z"), (None, text("a"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r["doc_id"], r["text"]) for r in minhash.one_of_each(df, 2).collect()), key=str)
    one = [t for i, t in kept if i == 7]
    assert len(one) == 1 and one[0] in (text("d"), text("d") + " x")
    assert [x for x in kept if x[0] != 7] == sorted([(None, text("a")), (3, text("a") + " x"), (5, text("b")), (5, text("c")), (9, text("e")), (9, ""), (10, text("f"))], key=str)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, 2).collect()}
    assert (5, 59, 3, False) in got and (5, 59, 5, True) in got and (8, 60, 5, False) in got and (11, 60, 10, False) in got and (9, 0, 9, True) in got


def test_the_forest_is_stored_in_few_files(spark, monkeypatch):
    """What the tasks of all trees find is one small table, however many tasks there are; its groups are whole."""
    rows = corpus(200, 5, 60)
    stored = {}
    monkeypatch.setattr(minhash, "written", lambda df, name: stored.setdefault(name, written(df, name)))
    # partitions so small that the trees' rows fill all tasks, as those of a large table do
    small = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 2)
    assert len(stored["forest"].inputFiles()) <= 2


def test_links_are_whole():
    rng = np.random.default_rng(4)
    base = np.arange(100, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(100) < 0.08, rng.integers(1000, 9000, 100), base)).astype(np.uint64) for _ in range(40)] + [base + 5000, base + 5000]
    parent = list(range(len(sets)))

    def merge(links):
        group = list(parent)
        for a, b in links:
            x, y = group[a], group[b]
            group = [min(x, y) if g in (x, y) else g for g in group]
        return group

    every = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    links = minhash._links(list(range(len(sets))), sets, 80)
    assert set(map(frozenset, links)) <= set(map(frozenset, every)) and merge(links) == merge(every) and len(links) < len(sets)


def test_components_take_few_rounds(spark, monkeypatch):
    """A star is stored once and a long path takes rounds by its length's logarithm; vertices of many links and many components."""
    stored = []
    monkeypatch.setattr(graph, "written", lambda df, name: stored.append(name) or written(df, name))

    def found(pairs: list[tuple[int, int]]) -> tuple[dict[int, int], int]:
        stored.clear()
        rows = graph.components(spark.createDataFrame(pairs, "a long, b long").repartition(7)).collect()
        got = {r["id"]: r["component"] for r in rows}
        assert len(got) == len(rows)
        return got, len(stored)

    assert found([(0, k) for k in range(1, 3000)]) == ({k: 0 for k in range(3000)}, 1)
    hub, rounds = found([(k, 3000) for k in range(3000)])
    assert hub == {k: 0 for k in range(3001)} and rounds <= 4
    rng = random.Random(5)
    name = rng.sample(range(10_000), 2000)
    path, rounds = found([(name[k], name[k + 1]) for k in range(1999)])
    assert path == {k: min(name) for k in name} and rounds <= 14
    pairs = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(1700)]
    root = {k: k for p in pairs for k in p}

    def up(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for a, b in pairs:
        a, b = sorted((up(a), up(b)))
        root[b] = a
    alone = {a for a, b in pairs if a == b} - {k for p in pairs if p[0] != p[1] for k in p}
    assert found(pairs)[0] == {k: up(k) for k in root if k not in alone}


def test_stars_in_parts(monkeypatch):
    """Links joined a few at a time give what they give at once, and which vertices came as a u."""
    monkeypatch.setattr(graph, "AT_ONCE", 3)
    links = [(9, 4), (4, 2), (8, 7), (12, 9), (7, 2), (20, 15), (30, 20), (30, 1), (15, 2)]
    batches = [pa.RecordBatch.from_arrays([pa.array([a for a, _ in links[i : i + 2]]), pa.array([b for _, b in links[i : i + 2]])], names=["u", "v"]) for i in range(0, len(links), 2)]
    u, v, own = graph._joined(iter(batches))
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {k: 1 for k in (2, 4, 7, 8, 9, 12, 15, 20, 30)}
    assert u[~own].tolist() == [2]
    assert [len(x) for x in graph._joined(iter([]))] == [0, 0, 0]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        x, y = find(a), find(b)
        if a != b:
            parent[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark, sf, tmp_path):
    rows = queries.op2_minhash_dedup(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(list(texts.items()), 2)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op2_minhash_dedup(spark, str(tmp_path)).count() == 0


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = knn.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), "quality")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    scores = model.scores(np.stack([knn.term_shares(t) for _, t in rows]), knn.NEIGHBOURS)
    first = [r for r, s in zip(rows, scores, strict=True) if s >= 0.3]
    measured = spark.createDataFrame([(i, *rules.measure_text(t)) for i, t in first], "doc_id long, " + ", ".join(f"{m} long" for m in rules.MEASURES))
    passed = {r["doc_id"] for r in measured.withColumn("failures", rules.failures_of()).filter(rules.kept_by(rules.LATEST)).collect()}
    second = [r for r in first if r[0] in passed]
    want = {c for _, c in brute(second, 5).values()}
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} == want and len(want) > 0
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [4, None]


def test_pipeline_stages_keep_columns_and_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns and stage(spark, docs, sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 0
