"""Corpus cleaning pipeline over the ``documents`` table.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's
docs. All stages but the last return the columns of ``documents``. ``run``
applies them in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from condoledger.llm import contamination, jaccard, packing, quality, templates
from condoledger.llm.common import stored, table, work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go, but for the first."""
    return templates.drop_recurring(docs, every=True)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words,
    a similarity of 0.8 or more."""
    return jaccard.keep_one(docs, size=5, threshold=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are taken out of the texts."""
    return contamination.remove(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("packing", packed),
]

# Components, tokens and packing are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = work_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{k}")
    return docs
