"""Registered queries of the training-data operators, with the parameters used in production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldline.llm import chat, collocations, fim, mixing, quality, secrets, warc
from fieldline.llm.common import read_table
from fieldline.llm.html import extract_text
from fieldline.llm.nearest import nearest_neighbours
from fieldline.llm.packing import pack_documents
from fieldline.llm.simhash import simhash_dedup
from fieldline.llm.substring import substring_dedup
from fieldline.llm.vector_dedup import near_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op2_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id", F.expr(f"coalesce({quality.HELD_OUT}, false)").alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op3_flat_graph_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_table(spark, sf_dir, "embeddings"), threshold=0.95)


@query
def op4_transcript_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chat.transcript_lines(read_table(spark, sf_dir, "conversations"))
    model = chat.fit_roles(lines.where("crc32(cast(conv_id as string)) % 5 != 0"))
    return chat.format_chat(lines, model)


@query
def op5_adaptive_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), "pmod(vec_id, 100) = 0", k=10)


@query
def op6_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = mixing.fit_domains(docs, mixing.toxicity_domains(read_table(spark, sf_dir, "labels")))
    rates = mixing.document_rates(docs, model, mixing.TARGET_WEIGHTS, anchor="clean")
    toxic = F.col("posteriors")[model.domains.index("toxic")] if "toxic" in model.domains else F.lit(0.0)
    return rates.select("doc_id", "n_tokens", toxic.alias("p_toxic"), "rate", "copies")


@query
def op7_merkle_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    own, replica = (warc.manifest(warc.page_records(p)) for p in (pages, warc.damaged_replica(pages)))
    ids = own.select("file_id", "record_id", "copy", "page_id")
    return warc.fixity_audit(own, replica).join(ids, ["file_id", "record_id", "copy"], "left").select(
        "file_id", "page_id", F.col("offset").alias("offset_a"), F.col("length").alias("length_a"),
        F.col("replica_offset").alias("offset_b"), F.col("replica_length").alias("length_b"), "status",
    )


ORACLES["op7_merkle_fixity_audit"] = warc.ORACLE_SQL


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_dedup(read_table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return out.select("doc_id", "fingerprint", "component_id", "kept")


@query
def op11_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = secrets.vocabulary_words(public_tokenizers.path("byte_bpe_50k.json"))
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents"), words)
    spans = F.col("spans")
    return found.select(
        "doc_id", *[secrets.span_count(spans, k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(secrets.spans_text(spans, secrets.KINDS[:3]), 256).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"),
    )


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fim_transform(read_table(spark, sf_dir, "documents"), seed=7, rate=100, spm_rate=50)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.fim_restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op12_fill_in_middle"] = fim.ORACLE_SQL


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return collocations.collocations(docs, min_count=10, max_words=3, top=2000, contained_percent=50)


ORACLES["op13_phrase_collocations"] = collocations.ORACLE_SQL
