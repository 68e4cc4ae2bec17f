"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import (
    bpe, bucket_pointers, conversation_repair, cover_tree, hypervectors, importance, kmeans_tree, packing, quality_rules, simhash, surrogates, templates, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: The rules that the url query judges by.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_simhash_deletion_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op2_segmented_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), RULES)


@_query
def op3_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[f"q.{c}" for c in counts], "base_failed", "kept", "distance")


@_query
def op4_template_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@_query
def op5_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query
def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_sample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op7_bpe_prefix_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = bpe.encode_and_decode(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op8_hyperdimensional_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hypervectors.identify(_table(spark, sf_dir, "documents"))


@_query
def op9_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


#: The key of the registered queries; a deployment passes its own secret.
SURROGATE_KEY = b"pitwall surrogates"


@_query
def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)
    return found.select("doc_id", "text", "n_surrogates")


@_query
def op11_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cover_tree.finite_vectors(_table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return cover_tree.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@_query
def op12_bucket_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = bucket_pointers.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"]).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op13_generalised_lr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return conversation_repair.repaired_report(conversation_repair.damage(turns), turns)
