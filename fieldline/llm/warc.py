"""Merkle fixity audit of WARC replicas.

Records are hashed where they lie. Per file, ordered offset ranges of ``RANGE_BYTES`` are hashed over
their records' (offset, length, digest), ``FAN_OUT`` ranges at a time into wider ranges, up to the
file's root; file roots are hashed in groups of ``GROUP_FILES``, and these into the archive's root.
An audit compares the roots of two replicas and goes down only into branches that differ, to the
records of differing ranges. Only digests are shuffled, never record bytes, and all of it is
DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldline.llm.common import checkpoint, row_id

RANGE_BYTES = 1 << 16
FAN_OUT = 16
#: Range levels: 64 KiB, 1 MiB, 16 MiB; the file's root stands over the last.
LEVELS = 3
FILE_LEVEL, GROUP_LEVEL, ROOT_LEVEL = LEVELS, LEVELS + 1, LEVELS + 2
GROUP_FILES = 1024
FILE_RECORDS = 1000
CRLF = "\r\n"


def record_text(url: Column, html: Column, record_id: Column, date: str = "2024-01-01T00:00:00Z") -> Column:
    """A WARC/1.0 resource record of a page."""
    return F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: resource{CRLF}WARC-Record-ID: <urn:uuid:"), record_id,
        F.lit(f">{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit(f"{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(html).cast("string"),
        F.lit(CRLF * 2), html, F.lit(CRLF * 2),
    )


def page_record_id(page_id: Column, url: Column) -> Column:
    h = F.md5(F.concat_ws("|", page_id.cast("string"), url))
    parts = [F.substring(h, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *parts)


def page_records(pages: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """``pages`` as records: file_id, record_id, record (text). A null html is an empty payload.

    Files hold the pages of ``file_records`` consecutive ids; a page without id goes by its content.
    """
    key = row_id("page_id", "url", "html")
    rid = page_record_id(F.col("page_id").cast("long"), F.col("url"))
    return pages.select(
        F.floor(key / F.lit(file_records)).cast("long").alias("file_id"), F.col("page_id").cast("long").alias("page_id"), rid.alias("record_id"),
        record_text(F.col("url"), F.coalesce("html", F.lit("")), rid).alias("record"), key.alias("seq"),
    )


def manifest(records: DataFrame, seq: str = "seq") -> DataFrame:
    """file_id, record_id, copy, offset, length, digest of records, in ``seq`` order within a file.

    ``copy`` numbers records of one id in a file. Only lengths and digests are shuffled.
    """
    keep = [c for c in ("page_id",) if c in records.columns]
    thin = records.select("file_id", "record_id", *keep, F.col(seq).alias("seq"), F.octet_length("record").cast("long").alias("length"),
                          F.sha2("record", 256).alias("digest"))
    order = Window.partitionBy("file_id").orderBy("seq", "record_id", "digest")
    copies = Window.partitionBy("file_id", "record_id").orderBy("seq", "digest")
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return thin.withColumn("offset", F.coalesce(before, F.lit(0))).withColumn("copy", F.row_number().over(copies)).drop("seq")


def _joined(*entry: str) -> Column:
    """SHA-256 over the sorted entries of a group."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(*entry))), lambda s: F.concat_ws(":", *[s[e].cast("string") for e in entry]))
    return F.sha2(F.concat_ws("\n", lines), 256)


def merkle_tree(records: DataFrame) -> DataFrame:
    """Nodes (level, file_id, node, hash) over a manifest. Level 0 nodes are offset ranges.

    Above the ranges, FILE_LEVEL holds a file's root, GROUP_LEVEL a group of files (file_id is the
    group's number) and ROOT_LEVEL the archive's root. An empty manifest has no nodes.
    """
    node = F.floor(F.col("offset") / F.lit(RANGE_BYTES)).cast("long")
    layer = records.groupBy("file_id", node.alias("node")).agg(_joined("offset", "length", "digest").alias("hash"))
    layers = [layer]
    for _ in range(1, LEVELS):
        up = F.floor(F.col("node") / F.lit(FAN_OUT)).cast("long")
        layer = layer.groupBy("file_id", up.alias("up")).agg(_joined("node", "hash").alias("hash")).withColumnRenamed("up", "node")
        layers.append(layer)
    roots = layer.groupBy("file_id").agg(_joined("node", "hash").alias("hash")).withColumn("node", F.lit(0).cast("long"))
    group = F.floor(F.col("file_id") / F.lit(GROUP_FILES)).cast("long")
    groups = roots.groupBy(group.alias("g")).agg(_joined("file_id", "hash").alias("hash"))
    groups = groups.select(F.col("g").alias("file_id"), F.lit(0).cast("long").alias("node"), "hash")
    # One row per GROUP_FILES files meets here.
    root = groups.groupBy().agg(_joined("file_id", "hash").alias("hash"), F.count("*").alias("n")).where("n > 0")
    root = root.select(F.lit(0).cast("long").alias("file_id"), F.lit(0).cast("long").alias("node"), "hash")
    named = [x.select(F.lit(i).alias("level"), "file_id", "node", "hash") for i, x in enumerate([*layers, roots, groups, root])]
    return reduce(DataFrame.unionByName, named)


def stored_tree(records: DataFrame) -> DataFrame:
    """``merkle_tree`` of a manifest, stored: an audit reads each level of it."""
    return checkpoint(merkle_tree(records))


def _differing(nodes: DataFrame, level: int, parents: DataFrame | None = None, up: tuple[Column, Column] | None = None) -> DataFrame:
    """Keys (file_id, node) of a level whose hashes differ or that one tree lacks, under differing parents."""
    layer = nodes.where(F.col("level") == level)
    if parents is not None:
        layer = layer.withColumn("up_file", up[0]).withColumn("up_node", up[1]).join(
            parents.select(F.col("file_id").alias("up_file"), F.col("node").alias("up_node")), ["up_file", "up_node"], "left_semi")
    pairs = layer.groupBy("file_id", "node").agg(F.count("*").alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high"))
    return pairs.where("n < 2 or low != high").select("file_id", "node")


def differing_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """(file_id, node) of the level 0 ranges in which two trees differ, found from the roots down."""
    nodes, zero = a.unionByName(b), F.lit(0).cast("long")
    found = _differing(nodes, ROOT_LEVEL)
    found = _differing(nodes, GROUP_LEVEL, found, (zero, zero))
    found = _differing(nodes, FILE_LEVEL, found, (F.floor(F.col("file_id") / F.lit(GROUP_FILES)).cast("long"), zero))
    found = _differing(nodes, LEVELS - 1, found, (F.col("file_id"), zero))
    for level in range(LEVELS - 2, -1, -1):
        found = _differing(nodes, level, found, (F.col("file_id"), F.floor(F.col("node") / F.lit(FAN_OUT)).cast("long")))
    return found


def fixity_audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Records of two replicas' manifests that differ.

    Returns file_id, record_id, copy, offset, length, replica_offset, replica_length, status: "damaged"
    (other bytes), "missing" (not in the replica), "extra" (only there) or "moved" (the same bytes at
    another offset, behind a change of length). Records that repeat an id in a file are matched in their
order (by content where nothing else orders them). Further manifest columns are ignored. Equal replicas,
    empty ones too, give an empty result.
    """
    a, b = checkpoint(a), checkpoint(b)
    ranges = checkpoint(differing_ranges(*(stored_tree(x) for x in (a, b))))
    node = F.floor(F.col("offset") / F.lit(RANGE_BYTES)).cast("long")
    keys = ["file_id", "record_id", "copy"]
    # A moved record's places may lie in different ranges, both of which differ.
    sides = [x.select(*keys, "offset", "length", "digest").withColumn("node", node).join(ranges, ["file_id", "node"], "left_semi").drop("node")
             for x in (a, b)]
    both = sides[0].join(
        sides[1].select(*keys, F.col("offset").alias("replica_offset"), F.col("length").alias("replica_length"),
                        F.col("digest").alias("replica_digest")), keys, "full_outer")
    status = (F.when(F.col("replica_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra")
              .when(F.col("digest") != F.col("replica_digest"), "damaged").when(F.col("offset") != F.col("replica_offset"), "moved"))
    return both.withColumn("status", status).where("status is not null").drop("digest", "replica_digest")


def damaged_replica(pages: DataFrame) -> DataFrame:
    """A replica of ``pages`` with known damage, for the registered query: by page_id, some payloads have a
    byte changed (remainder 5 mod 997), some are cut in half (11 mod 2003), some are gone (7 mod 1499)."""
    half = F.floor(F.length("html") / 2).cast("int")
    at = F.substring(F.col("html"), half + 1, F.lit(1))
    changed = F.concat(F.substring(F.col("html"), F.lit(1), half), F.when(at == "~", "#").otherwise("~"),
                       F.substring(F.col("html"), half + 2, F.length("html")))
    html = (F.when(F.pmod("page_id", F.lit(997)) == 5, changed)
            .when(F.pmod("page_id", F.lit(2003)) == 11, F.substring(F.col("html"), F.lit(1), half)).otherwise(F.col("html")))
    return pages.withColumn("html", html).where("page_id is null or pmod(page_id, 1499) != 7")


#: The same records compared one by one, without trees.
ORACLE_SQL = r"""
WITH base AS (
  SELECT page_id, url, coalesce(html, '') AS html FROM pages
), damaged AS (
  SELECT page_id, url, CASE
    WHEN page_id % 997 = 5 THEN substr(html, 1, length(html) // 2)
      || CASE WHEN substr(html, length(html) // 2 + 1, 1) = '~' THEN '#' ELSE '~' END || substr(html, length(html) // 2 + 2)
    WHEN page_id % 2003 = 11 THEN substr(html, 1, length(html) // 2)
    ELSE html END AS html
  FROM base WHERE page_id % 1499 <> 7
), records AS (
  SELECT side, page_id, url, html, page_id // 1000 AS file_id,
    'WARC/1.0' || n || 'WARC-Type: resource' || n || 'WARC-Record-ID: <urn:uuid:00000000-0000-0000-0000-000000000000>' || n
      || 'WARC-Date: 2024-01-01T00:00:00Z' || n || 'WARC-Target-URI: ' || url || n || 'Content-Type: text/html; charset=utf-8' || n
      || 'Content-Length: ' || strlen(html) || n || n || html || n || n AS record
  FROM (SELECT 'a' AS side, * FROM base UNION ALL SELECT 'b' AS side, * FROM damaged), (SELECT chr(13) || chr(10) AS n)
), placed AS (
  SELECT side, page_id, file_id, html, strlen(record) AS length,
    sum(strlen(record)) OVER (PARTITION BY side, file_id ORDER BY page_id) - strlen(record) AS offset_
  FROM records
)
SELECT coalesce(a.file_id, b.file_id) AS file_id, coalesce(a.page_id, b.page_id) AS page_id,
  CAST(a.offset_ AS BIGINT) AS offset_a, CAST(a.length AS BIGINT) AS length_a,
  CAST(b.offset_ AS BIGINT) AS offset_b, CAST(b.length AS BIGINT) AS length_b,
  CASE WHEN b.page_id IS NULL THEN 'missing' WHEN a.html <> b.html THEN 'damaged' ELSE 'moved' END AS status
FROM (SELECT * FROM placed WHERE side = 'a') a LEFT JOIN (SELECT * FROM placed WHERE side = 'b') b ON a.page_id = b.page_id
WHERE b.page_id IS NULL OR a.html <> b.html OR a.offset_ <> b.offset_
"""
