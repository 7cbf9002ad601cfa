"""Training-corpus pipeline: documents in, packed sequences out.

``STAGES`` lists (name, function) in order. Each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and reread as the next stage's ``docs``; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldline.llm import mixing, quality
from fieldline.llm.common import read_table, shared_dir
from fieldline.llm.packing import pack_documents
from fieldline.llm.simhash import keep_one
from fieldline.llm.substring import substring_dedup

#: The quality model is fitted and language-model tokens are packed, which SQL cannot express; the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention model rejects (score below 0.3) go."""
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model, "__score")
    return scored.where(F.col("__score") >= quality.THRESHOLD).drop("__score")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (3-word shingles, 3 bits)."""
    return keep_one(docs, shingle=3, radius=3)


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are deleted; n_chars follows the text."""
    out = substring_dedup(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def target_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic text is thinned to its target; rates are at most 1, so no document is repeated."""
    model = mixing.fit_domains(docs, mixing.toxicity_domains(read_table(spark, sf_dir, "labels")))
    rates = mixing.document_rates(docs, model, mixing.TARGET_WEIGHTS, anchor="clean", max_rate=1.0)
    return mixing.mix(docs, rates)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all remaining documents with their place in sequences of 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_removal),
    ("target_mixing", target_mixing),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's output goes through a table in the shared folder.

    The tables stay in a folder of their own (``pipeline-*``): the result reads the last of them lazily, so
    whoever uses it decides when the folder may go.
    """
    docs = read_table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
