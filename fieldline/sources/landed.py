"""Landed JSON documents: folders of files, one document a file or one a line, bad ones set apart.

Files are read by Spark's text source, which packs small files into tasks by their size and reads
compressed ones; nothing is listed or opened on the driver beyond Spark's own file index. Every
document keeps the file it came from, its size and time, so a payload that can't be read is a row
with a reason instead of a failed job or a silent null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_document"


def read_documents(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, lines: bool = False,
                   pattern: str | None = None) -> DataFrame:
    """(file, file_size, modified_at, reason, doc): one row per document.

    With ``lines`` each line that is not blank is a document, else each file. ``reason`` is null for a good
    document, else ``empty``, ``malformed`` (no JSON object, cut off, or a value that is not of its
    declared type) or ``foreign`` (none of the declared fields at the top); ``doc`` is then null.
    ``pattern`` selects file names; folders are searched to any depth.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    meta = F.col("_metadata")
    text = reader.text([paths] if isinstance(paths, str) else list(paths), wholetext=not lines).select(
        meta["file_path"].alias("file"), meta["file_size"].alias("file_size"),
        meta["file_modification_time"].alias("modified_at"), F.col("value").alias("text"))
    if lines:
        text = text.where(F.trim("text") != "")
    declared = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = text.withColumn("doc", F.from_json("text", declared, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    some = F.lit(False)
    for f in schema.fields:
        some = some | F.col(f"doc.`{f.name}`").isNotNull()
    blank = F.regexp_replace("text", r"^\s+|\s+$", "") == ""
    reason = (F.when(blank, "empty").when(F.col("doc").isNull() | F.col(f"doc.{_CORRUPT}").isNotNull(), "malformed").when(~some, "foreign"))
    out = parsed.withColumn("reason", reason)
    doc = F.struct(*[F.col(f"doc.`{f.name}`").alias(f.name) for f in schema.fields])
    return out.select("file", "file_size", "modified_at", "reason", F.when(F.col("reason").isNull(), doc).alias("doc"))


def good_documents(docs: DataFrame) -> DataFrame:
    return docs.where("reason IS NULL").drop("reason")


def rejected_documents(docs: DataFrame) -> DataFrame:
    return docs.where("reason IS NOT NULL").drop("doc")


def document_counts(docs: DataFrame) -> DataFrame:
    """Per file: documents read and kept, and how many were set apart by reason."""
    return docs.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("reason").isNull()).alias("n_kept"),
        *[F.count_if(F.col("reason") == r).alias(f"n_{r}") for r in ("empty", "malformed", "foreign")])
