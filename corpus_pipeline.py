"""From raw documents to packed training sequences: four stages, each one operator of vantle.llm.

Every stage reads what its predecessor kept, whole, and its decisions take effect;
all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vantle.llm import knn, minhash, packing, rules
from vantle.llm.common import written
from vantle.session import ship_package

CAPACITY, END_ID = 2048, 0


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled neighbours don't vote them bad."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return knn.accept(docs, knn.fit(docs, labels, "quality"), 0.3)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the latest rule policy."""
    ship_package(spark)
    return rules.accept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, on 5-word shingles at 0.8."""
    ship_package(spark)
    return minhash.one_of_each(docs, 5, 80)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), CAPACITY, END_ID)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("best-fit packing", best_fit_packing),
]

#: SQL can't express the classifier, so the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
