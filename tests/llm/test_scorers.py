"""Classifiers on made-up texts with a held-out fifth, and their building blocks by brute force."""

import math
import random
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest

from vantle.llm import knn, labels, queries, toxicity


def made(n, seed):
    rng = random.Random(seed)
    words = ["the", "and", "of", "river", "stone", "valley", "morning", "quiet", "letter", "window", "garden", "over", "under", "bright"]
    bad = ["stupid", "idiot", "zorgle", "blimfa"]
    rows, marks = [], []
    for i in range(n):
        text = [rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(rng.randint(5, 120))]
        quality, toxic = rng.random() > 0.2, rng.random() < 0.2
        if toxic:
            for _ in range(2 + len(text) // 20):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        if not quality:
            text = [w + rng.choice(["***", "$$$", " |"]) for w in text]
        rows.append((i, " ".join(text), "s", 1.0, 1))
        marks.append((i, int(quality), int(toxic)))
    return rows, marks


DOCS, MARKS = "doc_id long, text string, source string, score double, label int", "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    rows, marks = made(900, 1)
    odd = [(10_000, None, "s", 0.0, 0), (10_001, "", "s", 0.0, 0), (10_002, "word " * 60_000, "s", 0.0, 0), (None, "the river", "s", 0.0, 0), (5, rows[5][1], "s", 0.0, 0)]
    return spark.createDataFrame(rows + odd, DOCS).cache(), spark.createDataFrame(marks + [marks[0], (None, 1, 1), (77, None, None)], MARKS).cache(), marks


def accuracy(scores, truth, threshold):
    held = {i: y for i, y in truth.items() if zlib.crc32(str(i).encode()) % 5 == 0}
    return np.mean([(scores[i] >= threshold) == y for i, y in held.items()])


def test_held_out_is_crc(spark):
    got = {r["doc_id"]: r["h"] for r in spark.range(200).withColumnRenamed("id", "doc_id").withColumn("h", labels.held_out()).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


def test_training_rows(spark, tables):
    docs, marks, _ = tables
    rows = labels.labelled_texts(docs, marks, "quality", 50).collect()
    assert len(rows) == 50 and len({r["doc_id"] for r in rows}) == 50 and not any(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)


def test_quality(spark, tables):
    docs, marks, truth = tables
    model = knn.fit(docs, marks, "quality")
    rows = knn.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert accuracy({r["doc_id"]: r["score"] for r in rows}, {i: q for i, q, _ in truth}, 0.3) > 0.95
    kept = knn.accept(docs, model, 0.3)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] >= 0.3 for r in rows)


def test_votes_are_exact():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 6)).astype(np.float32)
    v = rng.normal(size=(30, 6)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    y = rng.integers(0, 2, 30).astype(float)
    got = knn.Neighbourhood(np.zeros(6, np.float32), np.eye(6, dtype=np.float32), v, y).scores(x, 5, block=7)
    for row, score in zip(x, got, strict=True):
        c = v @ (row / np.linalg.norm(row))
        near = np.argsort(-c)[:5]
        w = np.maximum(c[near], 1e-6).astype(float) ** 4
        assert score == pytest.approx((w * y[near]).sum() / w.sum(), rel=1e-4)


def test_toxicity(spark, tables):
    docs, marks, truth = tables
    model = toxicity.fit(docs, marks, "toxic")
    assert model.lexicon.get("zorgle", 0) > 1.5 and "river" not in model.lexicon
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert accuracy({r["doc_id"]: r["score"] for r in rows}, {i: t for i, _, t in truth}, 0.5) > 0.95


def test_hidden_words():
    assert toxicity.plain_forms("St*pid!") == ("st*pid", "stpid", True)
    assert toxicity.plain_forms("1d10t")[1] == "1d10t" or toxicity.plain_forms("i d")[2] is False
    assert toxicity.plain_forms("id1ot,")[1:] == ("idiot", True)
    assert toxicity.plain_forms("stuuupid") == ("stuuupid", "stupid", True)
    assert toxicity.plain_forms("Word.") == ("word", "word", False)
    table = toxicity.WordTable({"idiot": 2.0, "lowe*": 1.0})
    x = dict(zip(toxicity.FEATURES, table.matrix(["you id1ot river", "", "loweischaft"])[0], strict=True))
    assert x["hidden_lexicon"] > 0 and x["near_second_person"] == pytest.approx(1 / 3)
    assert table.matrix(["loweischaft"])[0][0] == 1


def slow_features(lexicon, text):
    """The features of one text, word by word."""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return [0.0] * len(toxicity.FEATURES)
    strength = lambda w: max(lexicon.get(w, 0.0), *(lexicon.get(w[:n] + "*", 0.0) for n in toxicity.PREFIXES))
    rows = []
    for w in words:
        bare, restored, hidden = toxicity.plain_forms(w)
        plain, found = strength(bare), strength(restored) if hidden else 0.0
        rows.append((max(plain, found), bare in toxicity.SECOND_PERSON, len(bare) > 1 and w.isupper(), hidden, found > plain))
    n, size = len(words), len(text.encode())
    hits = [k for k, r in enumerate(rows) if r[0] > 0]
    near = sum(any(r[1] for r in rows[max(0, k - toxicity.NEAR) : k + toxicity.NEAR + 1]) for k in hits)
    strengths = [r[0] for r in rows]
    return [
        len(hits) / n, math.log1p(len(hits)), max(strengths), sum(strengths) / n, math.log1p(len({words[k] for k in hits})),
        sum(r[1] for r in rows) / n, near / n, sum(r[2] for r in rows) / n, sum(c in string.ascii_uppercase for c in text) / size, text.count("!") / n, text.count("?") / n,
        sum(c in "!\"#$%&'()*+,-./:;<=>?@" for c in text) / size, sum(r[3] for r in rows) / n, sum(r[4] for r in rows) / n, math.log1p(n), (size - n) / n,
    ]


def slow_score(model, text):
    """One text's score: every tree walked from its root, the calibration read by hand."""
    x, margin = slow_features(model.lexicon, text), model.trees.start
    for feature, threshold, leaf in zip(model.trees.feature, model.trees.threshold, model.trees.leaf, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if x[feature[node]] > threshold[node] else 1)
        margin += leaf[node - len(feature)]
    raw = 1 / (1 + math.exp(-min(max(margin, -30), 30)))
    k = int(np.searchsorted(model.at, margin))
    if k == 0 or k == len(model.at):
        fitted = model.share[max(0, k - 1)]
    else:
        a, b = model.at[k - 1], model.at[k]
        fitted = model.share[k - 1] + (model.share[k] - model.share[k - 1]) * (margin - a) / (b - a)
    return min(max(0.99 * fitted + 0.01 * raw, 0.0), 1.0)


def test_toxicity_query_equals_slow_scores(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), "toxic")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r for r in queries.op3_toxicity(spark, sf).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        want = slow_score(model, text)
        assert got[i]["score"] == pytest.approx(want, abs=1e-6) and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_features_equal_slow_ones():
    rng = random.Random(6)
    parts = ["you", "idiot", "id1ot", "IDIOT!", "stuuupid", "loweischaft", " ", "\n", "\t", "  ", "river,", "YOU", "é!", "日本", "\xa0", "?", "!!", "tu", "$tupid", "..."]
    texts = ["", " ", "\n\t", *("".join(rng.choice(parts) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(300))]
    lexicon = {"idiot": 2.0, "stupid": 1.5, "lowe*": 1.0, "rive*": 0.7}
    for limit in (400_000, 10):
        table = toxicity.WordTable(lexicon, limit)
        for part in (texts, texts[:7], texts[100:], []):
            got = table.matrix(part)
            assert got.shape == (len(part), len(toxicity.FEATURES))
            for row, text in zip(got, part, strict=True):
                assert row.tolist() == pytest.approx(slow_features(lexicon, text)), repr(text)
    assert (table.matrix(pa.array(texts).slice(40, 30)) == table.matrix(texts[40:70])).all()


def test_folds_do_not_choose_their_own_terms(spark):
    # a word of one fold's toxic texts alone is in the whole lexicon, but not in that fold's
    fold = {r["id"]: r["f"] for r in spark.range(4000).withColumn("f", toxicity._fold("id")).collect()}
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5]
    toxic = {i for i in ids if i % 3 == 0}
    rows = [(i, "river stone valley" + (" blimfa zorgle" if i in toxic and fold[i] == 2 else " blimfa" if i in toxic else "")) for i in ids[:900]]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i in toxic)) for i, _ in rows], "doc_id long, toxic int")
    seen = []
    real = toxicity._lexicon
    toxicity._lexicon = lambda found, skipped, *a: seen.append((skipped, real(found, skipped, *a))) or seen[-1][1]
    try:
        toxicity.fit(docs, marks)
    finally:
        toxicity._lexicon = real
    for skipped, lexicon in seen:
        assert "blimfa" in lexicon and ("zorgle" in lexicon) == (skipped != 2)


@pytest.mark.parametrize(("name", "label", "threshold", "least"), [("op3_toxicity", "toxic", 0.5, 0.97), ("op8_quality_classifier", "quality", 0.3, 0.97)])
def test_held_out_accuracy_of_the_tables(spark, sf, name, label, threshold, least):
    folder = sf.replace("sf0.001", "sf0.01")
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").filter(f"{label} is not null").collect()}
    rows = [r for r in queries.QUERIES[name](spark, folder).collect() if r["held_out"] and r["doc_id"] in truth]
    assert len(rows) > 50 and np.mean([(r["score"] >= threshold) == truth[r["doc_id"]] for r in rows]) >= least


def test_trees_and_isotonic():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = toxicity.grow(x[:400], y[:400])
    assert np.mean((model.margin(x[400:]) > 0) == y[400:]) > 0.9
    at, share = toxicity.isotonic(model.margin(x), y)
    assert (np.diff(share) >= -1e-9).all() and (np.diff(at) >= 0).all()


def test_without_labels(spark, tables):
    docs, marks, _ = tables
    assert {r["score"] for r in knn.score(docs, knn.fit(docs, marks.limit(0), "quality")).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, marks.limit(0), "toxic")).collect()} == {0.0}


@pytest.mark.parametrize("name", ["op3_toxicity", "op8_quality_classifier"])
def test_queries(spark, sf, tmp_path, name):
    rows = queries.QUERIES[name](spark, sf).collect()
    assert rows and all(r["predicted"] == (r["score"] >= (0.5 if name[2] == "3" else 0.3)) for r in rows)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], MARKS).write.parquet(f"{tmp_path}/labels.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0
