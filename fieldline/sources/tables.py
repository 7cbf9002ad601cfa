"""Parquet tables: reads under one declared schema and lossless writes for the maintenance operators.

A table is a Parquet directory, optionally partitioned (e.g. by ``game_date``), with a small file
``_table-N.json`` that declares its columns and its partition layout; the highest N counts, so a new
declaration is there before the old one goes. Reads go through that schema, so a column added later
is NULL in older files and a truncated table keeps its layout. Every writer first normalises nulls,
declares new columns, projects the rows to the declared schema, and then writes.

A layout column is a column's name, or ``"column/width"`` for ranges of a number: rows whose
``floor(column / width)`` agrees share a partition. A table keyed by ids that rise with time
(``game_pk``) then rewrites only the ranges that a day's rows fall into. Range columns are the
table's own; readers never see them.

Rewrites that read the table they replace are first materialised with a reliable ``checkpoint()``, so
the lineage no longer points at the files being replaced. Partitioned tables rewrite only the
partitions that change (dynamic partition overwrite, which Spark commits at the end); other tables
are written to a folder beside the table that then takes its place. ``recover`` puts the old
folder back if a crash fell between the two renames; reads and writes call it first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldline.operators import merge
from fieldline.operators.quality import normalize_nulls
from fieldline.session import materialize

DECLARATION = "_table-{:06d}.json"


def _range_column(part: str) -> str:
    """The physical partition column of a layout column."""
    return f"_range_{part.split('/')[0]}" if "/" in part else part


def _physical(parts: Sequence[str]) -> list[str]:
    return [_range_column(p) for p in parts]


def _with_ranges(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    ranges = [(p.split("/")[0], int(p.split("/")[1])) for p in parts if "/" in p]
    return df.withColumns({f"_range_{c}": F.floor(F.col(c) / F.lit(w)).cast("long") for c, w in ranges}) if ranges else df


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # the path's own file system, as Spark resolves it
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def recover(spark: SparkSession, path: str) -> None:
    """Put the former table back if a rewrite was cut off between its two renames."""
    old = f"{path.rstrip('/')}._former"
    if _exists(spark, old):
        fs, p = _fs(spark, path)
        if fs.exists(p):
            fs.delete(_fs(spark, old)[1], True)
        else:
            fs.rename(_fs(spark, old)[1], p)


def table_exists(spark: SparkSession, path: str) -> bool:
    recover(spark, path)
    return _exists(spark, path)


def _declarations(spark: SparkSession, path: str) -> list[str]:
    """Names of the table's declarations, the one that counts last."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
    return sorted(n for n in names if n.startswith("_table-") and n.endswith(".json"))


def declaration(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]]:
    """Schema and layout columns of a table; read from its files where none are declared."""
    known = _declarations(spark, path)
    if known:
        fs, p = _fs(spark, f"{path}/{known[-1]}")
        stream = fs.open(p)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        found = json.loads(text)
        return T.StructType.fromJson(found["schema"]), list(found["partition_by"])
    schema, parts, level = spark.read.option("mergeSchema", "true").parquet(path).schema, [], path
    while True:
        fs, p = _fs(spark, level)
        names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName())
        if not names:
            return schema, parts
        parts.append(names[0].split("=")[0])
        level = f"{level}/{names[0]}"


def _declare(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    """Write the next declaration under a name of its own, then drop the older ones."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields if f.name not in _own(partition_by)])
    text = json.dumps({"schema": nullable.jsonValue(), "partition_by": list(partition_by)})
    known = _declarations(spark, path)
    number = int(known[-1].removeprefix("_table-").removesuffix(".json")) + 1 if known else 1
    fs, p = _fs(spark, f"{path}/{DECLARATION.format(number)}")
    tmp = _fs(spark, f"{path}/_{uuid.uuid4().hex}.json")[1]
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(tmp, p)
    for name in known:
        fs.delete(_fs(spark, f"{path}/{name}")[1], False)


def _own(parts: Sequence[str]) -> set[str]:
    """Range columns, which only the table itself knows."""
    return {_range_column(p) for p in parts if "/" in p}


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows with its range columns."""
    recover(spark, path)
    schema, parts = declaration(spark, path)
    ranges = [T.StructField(c, T.LongType()) for c in sorted(_own(parts))]
    return spark.read.schema(T.StructType([*schema.fields, *ranges])).parquet(path)


def read_table(spark: SparkSession, path: str, where: Column | str | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    df = _stored(spark, path).select(*[f.name for f in declaration(spark, path)[0].fields])
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def max_loaded(df: DataFrame, date_col: str) -> DataFrame:
    """High-water mark as a one-row frame; NULL when the table is empty."""
    return df.agg(F.max(date_col).alias("max_loaded"))


def high_water_mark(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    """``max_loaded`` of a table. Where the table is partitioned by the column, folder names tell it and no file is opened."""
    if not table_exists(spark, path):
        raise ValueError(f"no table at {path}")
    schema, parts = declaration(spark, path)
    kind = schema[date_col].dataType
    if parts[:1] != [date_col]:
        return max_loaded(read_table(spark, path), date_col)
    fs, p = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{date_col}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")]
    marks = spark.createDataFrame([(v,) for v in values], "v string")
    return marks.agg(F.max(F.url_decode(F.col("v")).cast(kind)).alias("max_loaded"))


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


def with_load_columns(df: DataFrame, source: str, loaded_at) -> DataFrame:
    """Lineage columns of a load: where the rows come from and when they were loaded."""
    return df.withColumn("_source", F.lit(source)).withColumn("_loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows under the declared schema: columns missing in ``df`` are NULL."""
    by = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{by[f.name.lower()]}`") if f.name.lower() in by else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def _prepared(spark: SparkSession, df: DataFrame, path: str) -> tuple[DataFrame, list[str]]:
    """``df`` ready for an existing table, whose declaration gains the columns that are new in ``df``, and its partition columns."""
    schema, parts = declaration(spark, path)
    df = normalize_nulls(df)
    known = {f.name.lower() for f in schema.fields}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new or not _declarations(spark, path):
        schema = T.StructType([*schema.fields, *new])
        _declare(spark, path, schema, parts)
    return _with_ranges(_aligned(df, schema), parts), _physical(parts)


def _dealt(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows dealt by partition before a partitioned write, so that a partition becomes few files.

    The hint lets Spark split a partition that is too large for one task and join small ones.
    """
    return rows.hint("rebalance", *parts) if parts else rows


def _create(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Write a table beside ``path`` and let it take the path's place. Returns the rows written."""
    staged, old = f"{path.rstrip('/')}._staged-{uuid.uuid4().hex}", f"{path.rstrip('/')}._former"
    seen = Observation()
    rows = _dealt(_with_ranges(df.drop(*_own(partition_by)), partition_by), _physical(partition_by))
    w = rows.observe(seen, F.count(F.lit(1)).alias("n")).write
    (w.partitionBy(*_physical(partition_by)) if partition_by else w).parquet(staged)
    _declare(spark, staged, df.schema, partition_by)
    recover(spark, path)
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.rename(p, _fs(spark, old)[1])
    fs.mkdirs(p.getParent())
    fs.rename(_fs(spark, staged)[1], p)
    recover(spark, path)  # drops the former table
    return seen.get.get("n", 0)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Append rows; an empty frame is a no-op. Returns the number of rows that were written.

    ``partition_by`` counts for a new table; an existing one keeps its own layout.
    """
    spark = df.sparkSession
    if df.isEmpty():
        return 0
    if not table_exists(spark, path):
        return _create(spark, normalize_nulls(df), path, partition_by)
    rows, parts = _prepared(spark, df, path)
    seen = Observation()
    w = _dealt(rows, parts).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append")
    (w.partitionBy(*parts) if parts else w).parquet(path)
    return seen.get.get("n", 0)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), dynamic: bool = False) -> None:
    """Replace the table, or with ``dynamic`` only the partitions that ``df`` has rows for."""
    spark = df.sparkSession
    if not dynamic or not table_exists(spark, path):
        _create(spark, normalize_nulls(df), path, partition_by)
        return
    rows, parts = _prepared(spark, df, path)
    if not parts:
        raise ValueError(f"{path} is not partitioned: single partitions can't be overwritten")
    _dealt(rows, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def truncate(spark: SparkSession, path: str) -> None:
    """Empty the table, keeping its schema and layout."""
    recover(spark, path)
    schema, parts = declaration(spark, path)
    _create(spark, spark.createDataFrame([], schema), path, parts)


def _rewrite(spark: SparkSession, source: DataFrame, path: str, build) -> None:
    """Replace the table, or those of its partitions that ``source`` has rows for, by build(target, source)."""
    source, parts = _prepared(spark, source, path)
    target = _stored(spark, path)
    if parts:
        target = merge.matching(target, source, parts, "left_semi")
    declared = [f.name for f in declaration(spark, path)[0].fields]
    new = materialize(build(target.select(*declared), source.select(*declared)))
    if parts:
        overwrite(new, path, dynamic=True)
    else:
        _create(spark, new, path, parts)


def _new_table(spark: SparkSession, source: DataFrame, path: str, partition_by: Sequence[str]) -> bool:
    if table_exists(spark, path):
        return False
    _create(spark, normalize_nulls(source), path, partition_by)
    return True


def _check_layout(spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    parts = declaration(spark, path)[1] if table_exists(spark, path) else partition_by
    if not {p.split("/")[0] for p in parts} <= set(keys):
        raise ValueError("partition columns must be key columns")  # else a key could move between partitions


def upsert_table(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                 partition_by: Sequence[str] = ()) -> None:
    """Delete rows whose key is in ``source`` and insert ``source`` (exact keys, null equals null).

    ``partition_by`` counts for a new table and must be part of ``keys`` (columns or ranges of them). With it
    only the partitions that ``source`` has rows for are rewritten.
    """
    _check_layout(spark, path, keys, partition_by)
    if not _new_table(spark, source, path, partition_by):
        _rewrite(spark, source, path, lambda t, s: merge.upsert(t, s, keys))


def merge_latest_table(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                       newest: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """One row per key: the newest of the stored and the new rows.

    Rows are newer by ``newest`` (columns missing in ``source`` don't count); with equal marks the new row wins.
    Rows under other keys stay, so a slice may arrive in any number of parts and in any order, and a
    part may arrive again.
    """
    _check_layout(spark, path, keys, partition_by)
    newest = [c for c in newest if c in source.columns]
    if not table_exists(spark, path):
        _create(spark, normalize_nulls(merge.dedup_latest(source, keys, newest)), path, partition_by)
        return

    def build(target, new):
        both = target.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        return merge.dedup_latest(both, keys, [*newest, "_new"]).drop("_new")

    _rewrite(spark, source, path, build)


def replace_slice_table(spark: SparkSession, source: DataFrame, path: str,
                        slice_cols: Sequence[str]) -> None:
    """Replace whole slices (e.g. one date): a dynamic partition overwrite of those slices.

    ``source`` must hold the whole of each slice; for parts of a slice use ``merge_latest_table``.
    """
    if not _new_table(spark, source, path, slice_cols):
        overwrite(source, path, dynamic=True)


def merge_insert_only_table(spark: SparkSession, source: DataFrame, path: str,
                            keys: Sequence[str]) -> int:
    """Append only source rows with new keys; re-running adds nothing. Returns rows added."""
    if not table_exists(spark, path):
        return append(source, path)
    source = materialize(source)  # read three times: for its key ranges and on both sides of the lookup
    return append(materialize(merge.new_rows_only(read_table(spark, path), source, keys)), path)


def merge_update_insert_table(spark: SparkSession, source: DataFrame, path: str,
                              keys: Sequence[str], update_cols: Sequence[str] | None = None,
                              partition_by: Sequence[str] = ()) -> None:
    _check_layout(spark, path, keys, partition_by)
    if not _new_table(spark, source, path, partition_by):
        given = set(source.columns)
        keep = [c for c in update_cols if c in given] if update_cols is not None else [c for c in source.columns if c not in keys]
        _rewrite(spark, source, path, lambda t, s: merge.merge_update_insert(t, s, keys, keep))


def widen_table(spark: SparkSession, source: DataFrame, path: str) -> None:
    """Append with new columns declared for the table (old rows read them as NULL; no file is rewritten)."""
    append(source, path)


def co_located(spark: SparkSession, df: DataFrame, name: str, path: str, keys: Sequence[str], order: Sequence[str],
               buckets: int) -> DataFrame:
    """Write ``df`` bucketed by ``keys`` and sorted by ``keys`` and ``order``; returns the table.

    Windows, aggregations and joins on ``keys`` then need no shuffle: a game table bucketed by player
    feeds the rolling features where it lies. Rows are dealt into the buckets before the write, so each
    is one file. One key's rows are one bucket: a table with hot keys is better read with
    ``rows_per_segment``, which splits them.
    """
    rows = normalize_nulls(df).repartition(buckets, *keys)
    (rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, *order).option("path", path).saveAsTable(name))
    return spark.table(name)


def attach_co_located(spark: SparkSession, schema: T.StructType, name: str, path: str, keys: Sequence[str], order: Sequence[str],
                      buckets: int) -> DataFrame:
    """A table that ``co_located`` wrote in another session, under the same layout."""
    columns = lambda cs: ", ".join(f"`{c}`" for c in cs)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet CLUSTERED BY ({columns(keys)}) "
              f"SORTED BY ({columns([*keys, *order])}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
