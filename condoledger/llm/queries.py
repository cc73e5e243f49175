"""The registered queries of the training-data operators: name -> job, SQL.

Each query applies its operator with production parameters to the whole
table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, contamination, huffman, jaccard, langid, negatives, packing, pii, quality, resampling, suffix, templates, topk
from .common import table, work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_line_template_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.digest(table(spark, sf_dir, "documents"))


SQL["op1_line_template_dedup"] = templates.SQL


@register
def op1_every_recurring_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.digest(table(spark, sf_dir, "documents"), every=True)


@register
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(chat.EXTRA_CONVERSATION), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"),
                                  F.lit(chat.EXTRA_TEXT))
    return chat.read_back(chat.format_chats(turns.unionAll(extra)))


SQL["op2_chat_formatting"] = chat.SQL


@register
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register
def op4_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@register
def op5_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@register
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.document_stats(table(spark, sf_dir, "documents"))


@register
def op7_prefix_tree_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@register
def op8_huffman_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "token-files")
    path = huffman.write_token_files(table(spark, sf_dir, "documents"), f"{folder}/files", folder)
    return huffman.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register
def op9_nearest_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.identify(docs, model)
    return found.select("doc_id", langid.held_out().alias("held_out"), F.col("lang").alias("lang_pred"), "score", "rejected")


@register
def op10_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register
def op11_shared_list_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
                                                     .otherwise(F.col("label")).alias("label"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


SQL["op11_shared_list_negatives"] = negatives.SQL


@register
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op12_importance_resampling"] = resampling.SQL


@register
def op13_term_at_a_time_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL["op13_term_at_a_time_top_k"] = topk.SQL
