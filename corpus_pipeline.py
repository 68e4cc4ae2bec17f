"""The corpus pipeline: five stages, each one of the operators over all rows that the stage before kept.

Each stage's result is written as Parquet to the session's shared folder and read
again, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import importance, packing, quality_rules, simhash, surrogates
from pitwall.llm.queries import SURROGATE_KEY
from pitwall.session import materialise


#: Rows of an Arrow batch in the stages: a megabyte or two of text, so that Python workers stay small.
BATCH_ROWS = 500


def _small_batches(spark: SparkSession) -> None:
    """Stages are lazy, so the setting stays; a smaller one of the session's own is kept."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws, by the labels of the table ``labels``."""
    _small_batches(spark)
    return importance.keep_sampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers."""
    _small_batches(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints of 3-word shingles within 3 bits."""
    _small_batches(spark)
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; n_chars follows the new text, NULL stays NULL."""
    _small_batches(spark)
    done = surrogates.pseudonymise(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return done.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    _small_batches(spark)
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("simhash_near_duplicates", near_duplicates),
    ("surrogates", personal_data),
    ("best_fit_packing", packed),
]

#: No stage can be said in SQL; tests/llm/test_pipeline.py checks each against its operator's rules.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs)
    return docs
