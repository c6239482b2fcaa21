"""Exact length histogram: one row a distinct encoded length, with suffix sums.

Documents are counted by length before anything is shuffled far, so a hot length
costs one row a task. The histogram has as many rows as there are distinct
lengths, which the longest document bounds; suffix sums over it answer totals,
quantiles and truncated totals for every context limit without the documents.

Defined results: null text has length 0; repeated rows count as often as they
occur; an empty table gives an empty histogram; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .vocabulary import token_counts


def histogram(df: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(n_tokens, n_docs): documents of each encoded length."""
    return token_counts(df, tokenizer_file, id_col, text_col).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """The histogram plus, for a context limit of n_tokens:

    docs_at_least, tokens_at_least: documents of that length or longer and their tokens;
    docs_total, tokens_total: all of them;
    truncated_tokens: all tokens left if every document is cut to the limit;
    fitting_share: share of documents that need no cut.
    """
    down = Window.orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n, d = F.col("n_tokens"), F.col("n_docs")
    sums = counts.select("n_tokens", "n_docs", F.sum(d).over(down).alias("docs_at_least"), F.sum(n * d).over(down).alias("tokens_at_least"), F.sum(d).over(whole).alias("docs_total"), F.sum(n * d).over(whole).alias("tokens_total"))
    cut = F.col("tokens_total") - F.col("tokens_at_least") + n * F.col("docs_at_least")
    fitting = F.col("docs_total") - F.col("docs_at_least") + d
    return sums.withColumn("truncated_tokens", cut).withColumn("fitting_share", F.round(fitting / F.col("docs_total"), 9))


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens left if every document is cut to ``limit`` ids."""
    row = sums.agg(
        F.coalesce(F.sum(F.when(F.col("n_tokens") <= limit, F.col("n_tokens") * F.col("n_docs"))), F.lit(0)).alias("short"),
        F.coalesce(F.sum(F.when(F.col("n_tokens") > limit, F.col("n_docs"))), F.lit(0)).alias("long"),
    ).first()
    return int(row["short"] + limit * row["long"])


def quantile(sums: DataFrame, share: float) -> int | None:
    """The smallest length that at least ``share`` of the documents don't exceed; None without documents."""
    upto = F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")
    return sums.filter(upto >= F.lit(share) * F.col("docs_total")).agg(F.min("n_tokens")).first()[0]
