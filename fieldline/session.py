"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

# Settings every job relies on. AQE re-plans joins from runtime sizes, coalesces tiny
# shuffle partitions and splits skewed join partitions; broadcast decisions stay size-checked
# by Spark (autoBroadcastJoinThreshold), never forced on tables that grow with the data.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "fieldline",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session. Only when it is unset is ``fallback`` used, or without one
    a folder chosen here: a temporary one for a local master, else one in the warehouse, which is
    shared; on a cluster it is never a machine-local temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    target = configured or fallback
    if not target:
        local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        target = tempfile.mkdtemp(prefix="fl-ckpt-") if local else f"{warehouse}/_checkpoints"
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss, unlike localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Shuffle files go when the action that wrote them ends, instead of when the driver collects its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Frames made inside drop their shuffle files at the end of each action.

    For jobs in steps that store what they make: the files of a finished step are not read again, and without
    this they all lie on the executors' disks until the job has ended.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def store(*batches: DataFrame) -> DataFrame:
    """The rows of all batches, written one batch after the other to the shared folder as Parquet, and read from there.

    Unlike a checkpoint the files are compressed, a reader takes the columns it needs, and the planner knows
    their size. Counts that are never NULL stay so.
    """
    spark, schema = batches[0].sparkSession, batches[0].schema
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    for rows in batches:
        rows.write.mode("append").parquet(path)
    whole = {f.name for f in schema.fields if not f.nullable and isinstance(f.dataType, LongType)}
    rows = spark.read.schema(schema).parquet(path)
    return rows.select(*[F.coalesce(c, F.lit(0)).alias(c) if c in whole else F.col(c) for c in rows.columns])


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
