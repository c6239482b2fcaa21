"""The registered queries of this subpackage: each applies its operator to whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import bpe, html, knn, lengths, minhash, packing, rules, tokenio, topk, toxicity
from .labels import held_out

BYTE_JSON, WORD_JSON, BYTE_RANKS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scored(scores: DataFrame, threshold: float) -> DataFrame:
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scores.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum-of-squares packing of all documents in sequences of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_JSON, 2048, 0)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on 2-word shingles at 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), 2, 80)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity of all documents, learnt outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic")
    return scored(toxicity.score(docs, model), 0.5)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rule ledger of all documents under the latest policy."""
    rows = rules.stored_ledger(table(spark, sf_dir, "documents"))
    base = rules.kept_by("base")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~base).alias("base_failed"), (base & rules.kept_by(rules.LATEST)).alias("kept"), "failures")


def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of every policy version does to all documents, from one stored ledger."""
    rows = rules.stored_ledger(table(spark, sf_dir, "documents"))
    parts = [rules.ablations(rows, policy).withColumn("policy", F.lit(policy)) for policy in rules.POLICIES]
    return functools.reduce(DataFrame.unionByName, parts)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge-replay encoding of all documents, decoded again, as digests."""
    ids = bpe.encode(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(ids, BYTE_RANKS))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact length histogram of all documents with its suffix sums."""
    return lengths.suffix_sums(lengths.histogram(table(spark, sf_dir, "documents"), BYTE_JSON))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html.extract(table(spark, sf_dir, "pages"), "html", ("page_id", "url"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality vote of all documents, learnt outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = knn.fit(docs, table(spark, sf_dir, "labels"), "quality")
    return scored(knn.score(docs, model), 0.3)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as Re-Pair shards and read back."""
    return tokenio.round_trip(table(spark, sf_dir, "documents"), WORD_JSON, 1)


def op10_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every 50th vector among all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "quality_rule_ablations": quality_rule_ablations,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_token_counts": op6_token_counts,
    "op7_html_extraction": op7_html_extraction,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_token_files": op9_token_files,
    "op10_top_k_search": op10_top_k_search,
}

LEDGER_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
),
g AS (
  SELECT doc_id, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM w
),
v AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM v WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(ls)::BIGINT AS n_lines,
         (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
  FROM w LEFT JOIN c USING (doc_id)
),
f AS (
  SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
    + 4 * (100 * n_symbols > 25 * n_words)::INT + 8 * (100 * n_dup_lines > 30 * n_lines)::INT
    + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 16 * n_words)::INT
    + 64 * (100 * n_capitals > 40 * word_chars)::INT + 128 * (n_dup_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)::INT)::BIGINT AS failures
  FROM m
)
"""

ORACLES: dict[str, str] = {
    "op2_minhash_dedup": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM d)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.doc_id),
g AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN g USING (doc_id) LEFT JOIN n USING (doc_id)
""",
    "op4_quality_rules": LEDGER_SQL
    + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failures & 3) <> 0 AS base_failed, (failures & 247) = 0 AS kept, failures
FROM f
""",
    "quality_rule_ablations": LEDGER_SQL
    + """,
p(policy, mask) AS (VALUES ('base', 3), ('v1', 127), ('v2', 247)),
r(rule, bit) AS (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('duplicate_lines', 8), ('short_words', 16), ('long_words', 32), ('capitals', 64), ('many_duplicate_lines', 128))
SELECT policy, rule, count(*) FILTER (failures & bit <> 0) AS failed, count(*) FILTER (failures & mask = bit) AS failed_alone, count(*) FILTER (failures & mask & ~bit = 0) AS kept_without
FROM f, p, r WHERE mask & bit <> 0 GROUP BY policy, rule
""",
    "op10_top_k_search": """
WITH u AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(c.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM u q JOIN u c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
}
