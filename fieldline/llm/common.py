"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldline.session import ensure_checkpoint_dir

#: Ids at or above this value stand for rows whose own id is null (see ``row_id``).
SURROGATE = 1 << 62
#: Bytes of text that a task works on at once (or one longer text).
SLICE_BYTES = 32 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only where that setting is missing (tests, local sessions) is a folder chosen here: a temporary
    one for a local master, the warehouse otherwise.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
        fallback = None
        if not spark.conf.get("spark.checkpoint.dir", None):
            warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
            fallback = tempfile.mkdtemp(prefix="fl-ckpt-") if local else f"{warehouse}/_checkpoints"
        ensure_checkpoint_dir(spark, fallback)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_slices(texts: pa.Array, size: int):
    """(first row, number of rows) of slices of about ``size`` bytes, at least one row each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low, base = 0, 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(ends, base + size, "right")))
        yield low, high - low
        low, base = high, int(ends[high - 1])


def row_id(id_col: str, *content: str) -> Column:
    """The row's id, or for a null id a surrogate drawn from its content.

    Surrogates are larger than any real id, so a real id always wins a "smallest id" rule; equal
    content under null ids is one row.
    """
    mix = F.xxhash64(*[F.col(c) for c in content])
    return F.coalesce(F.col(id_col).cast("long"), F.lit(SURROGATE) + mix.bitwiseAND(F.lit(SURROGATE - 1)))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Components of an undirected graph: one row (node, component = smallest node) per linked node.

    Alternates large-star and small-star steps (each node hands the smallest neighbour to its other
    neighbours). Every step is an aggregation and an equi-join on shuffled rows, the state is cut by
    a reliable checkpoint each round, and only two numbers per round reach the driver. Self links,
    repeated links and nulls are ignored.
    """
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    edges = checkpoint(
        links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"), u.alias("x"), v.alias("y"))
        .where("x != y").select("u", "v").distinct()
    )
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        edges = checkpoint(small.where("u != v").distinct())
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())
