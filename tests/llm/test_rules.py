import random
import re
from collections import Counter

import pytest

from vantle.llm import queries, rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {p for i, w in enumerate(windows) if often[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines), len(re.findall("[A-Z]", text))


def texts():
    rng = random.Random(4)
    made = ["".join(rng.choice(["a", "b", " ", "\n", "#", "é", "A", "\t", "\x0b", "\xa0", "日"]) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    return [None, "", " \n ", "a", "a b", "a b c", "a a a a", "x y z x y z", "| " * 100, *made, "clean " * 5 + " ".join(f"w{i}" for i in range(80)), " ".join(f"w{i % 7}" for i in range(100_000))]


def test_measurements(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n_words int, failures int")
    got = {r["doc_id"]: tuple(r[m] for m in rules.MEASURES) for r in rules.measure(df).collect()}
    for i, t in rows:
        assert got[i] == brute(t), repr(t)[:80]


def test_policies_and_ablations(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    book = rules.stored_ledger(df)
    failures = {r["doc_id"]: r["failures"] for r in book.collect()}
    for policy, names in rules.POLICIES.items():
        mask = rules.mask_of(names)
        kept = {i for i, f in failures.items() if not f & mask}
        assert kept == {r["doc_id"] for r in book.filter(rules.kept_by(policy)).collect()}
        assert kept == {r["doc_id"] for r in rules.accept(df, policy).collect()} and 0 not in kept and len(texts()) - 2 in kept
        got = {r["rule"]: r for r in rules.ablations(book, policy).collect()}
        assert set(got) == set(names)
        for r in rules.RULES:
            if r.name in names:
                bit = 1 << r.bit
                assert got[r.name]["failed"] == sum(f & bit > 0 for f in failures.values())
                assert got[r.name]["failed_alone"] == sum(f & mask == bit for f in failures.values())
                assert got[r.name]["kept_without"] == sum(f & mask & ~bit == 0 for f in failures.values())


def test_versions_stay():
    # a published version keeps its rules and their conditions; a change is a new version
    conditions = {r.name: (r.bit, r.fails) for r in rules.RULES}
    assert [conditions[n] for n in rules.POLICIES["v1"]] == [
        (0, "n_words < 50"), (1, "100 * n_repeat_words > 50 * n_words"), (2, "100 * n_symbols > 25 * n_words"), (3, "100 * n_dup_lines > 30 * n_lines"),
        (4, "word_chars < 2 * n_words"), (5, "word_chars > 16 * n_words"), (6, "100 * n_capitals > 40 * word_chars"),
    ]
    assert conditions["many_duplicate_lines"] == (7, "n_dup_lines >= 4 and 100 * n_dup_lines > 30 * n_lines")
    assert rules.mask_of(rules.POLICIES["v2"]) == 247 and rules.LATEST == "v2"


def test_base(spark):
    assert rules.mask_of(rules.POLICIES["base"]) == 3


def test_accept_keeps_all_columns(spark):
    good = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, good, "x", None), (2, None, "y", 3), (None, good, "z", 4)], "doc_id long, text string, n_words string, row int")
    assert sorted((tuple(r) for r in rules.accept(df).collect()), key=str) == sorted([(1, good, "x", None), (None, good, "z", 4)], key=str)


def test_query(spark, sf, tmp_path):
    rows = queries.op4_quality_rules(spark, sf).collect()
    assert rows and not any(r["kept"] and r["base_failed"] for r in rows)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op4_quality_rules(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op4_quality_rules", "quality_rule_ablations", "op10_top_k_search"])
def test_against_sql(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    other = con.execute(queries.ORACLES[name])
    names = [d[0] for d in other.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(other.fetchall())
