"""Approximate nearest neighbours by adaptive dimension scan over inverted lists.

Every row is dealt to the list of its nearest centre (centres are fitted on a bounded sample). A query
probes its nearest lists; within each, vectors are rotated by a fixed random rotation and read in
blocks of columns. After t of d columns the partial squared distance, scaled by d / t, estimates
the whole; a candidate is abandoned as soon as the hypothesis "its distance is below the k-th best so
far" is rejected, that is if partial > best * t / d * (1 + EPSILON / sqrt(t)) ** 2. Survivors of all
blocks are measured on the original vectors.

How many lists to probe is set by the data: the fewest with which the true neighbours of a sample of
queries (found by brute force in each run) are in probed lists at a rate of ``TARGET``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldline.llm.common import checkpoint, row_id
from fieldline.llm.vectors import as_doubles, common_size, kmeans, matrix, nearest, sample_rows

LIST_AIM = 1500
MAX_LISTS = 1024
LIST_CAP = 8192
QUERY_BLOCK = 16_384
SAMPLE = 16_384
COLUMNS = 16
EPSILON = 2.1
CALIBRATION = 64
TARGET = 0.97


def rotation(d: int, seed: int = 9) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def adaptive_scan(x: np.ndarray, q: np.ndarray, k: int, skip: np.ndarray | None = None, columns: int = COLUMNS,
                  epsilon: float = EPSILON, step: int = 1024) -> tuple[np.ndarray, int]:
    """Rows of ``x`` (rotated) that may be among the k nearest of ``q`` (rotated), and the columns read.

    ``skip`` are rows that take no part. With fewer than k rows all are returned.
    """
    n, d = x.shape
    rows = np.arange(n) if skip is None else np.setdiff1d(np.arange(n), skip)
    kept, best, read = np.zeros(0, np.int64), np.zeros(0), 0
    low, size = 0, max(4 * k, 32)  # the first few are measured whole, for a first threshold
    while low < len(rows):
        alive = rows[low:low + size]
        low, size = low + size, step
        limit = best[k - 1] if len(best) >= k else np.inf
        partial = np.zeros(len(alive))
        for c in range(0, d, columns):
            end = min(d, c + columns)
            diff = x[alive, c:end] - q[c:end]
            partial += np.einsum("ij,ij->i", diff, diff)
            read += len(alive) * (end - c)
            bound = limit * (end / d) * (1 + epsilon / end ** 0.5) ** 2 if end < d else limit * (1 + 1e-9)
            ok = partial <= bound
            if not ok.all():
                alive, partial = alive[ok], partial[ok]
        best = np.concatenate([best, partial])
        kept = np.concatenate([kept, alive])
        if len(best) > k:
            kth = np.partition(best, k - 1)[k - 1]
            ok = best <= kth * (1 + 1e-9)
            kept, best = kept[ok], best[ok]
            order = np.argsort(best, kind="stable")
            kept, best = kept[order], best[order]
    return kept, read


def _assign(centres: np.ndarray, size: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                own = nearest(matrix(batch.column("v"), size), centres, 1)[:, 0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], [*batch.schema.names, "list"])

    return run


def probes(q: np.ndarray, centres: np.ndarray, counts: np.ndarray, n: int, least: int) -> list[np.ndarray]:
    """Per query its n nearest lists, and further ones until they hold ``least`` rows."""
    order = nearest(q, centres, len(centres))
    held = np.cumsum(counts[order], axis=1)
    need = np.maximum(n, (held < least).sum(axis=1) + 1)
    return [o[:m] for o, m in zip(order, need)]


def _probe_batches(centres: np.ndarray, counts: np.ndarray, n: int, least: int, size: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = probes(matrix(batch.column("v"), size), centres, counts, n, least)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))],
                                                 [*batch.schema.names, "lists"])

    return run


def _brute(q: np.ndarray, uid: np.ndarray, k: int, size: int):
    """Per sampled query the k nearest of a batch: (query place, distance, uid, list)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, own, lists = matrix(batch.column("v"), size), batch.column("uid").to_numpy(), batch.column("list").to_numpy()
            d = (q ** 2).sum(axis=1)[:, None] + (x ** 2).sum(axis=1) - 2 * q @ x.T
            d[uid[:, None] == own[None, :]] = np.inf
            m = min(k, len(x))
            top = np.argpartition(d, m - 1, axis=1)[:, :m]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(q)), m)), pa.array(np.take_along_axis(d, top, 1).ravel()),
                 pa.array(own[top.ravel()]), pa.array(lists[top.ravel()])], ["q", "d", "uid", "list"])

    return run


def _search(size: int, k: int):
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            rows = rows.sort_values(["vec_id", "uid"], ignore_index=True)
            turn = rotation(size)
            x, q = (np.array(p["v"].tolist(), float).reshape(-1, size) for p in (rows, queries))
            xr, qr = x @ turn, q @ turn
            uid, ids = rows["uid"].to_numpy(), rows["vec_id"].to_numpy()
            for i, own in enumerate(queries["uid"].to_numpy()):
                kept, _ = adaptive_scan(xr, qr[i], k, np.flatnonzero(uid == own))
                diff = x[kept] - q[i]
                score = np.sqrt(np.einsum("ij,ij->i", diff, diff))
                best = np.lexsort((kept, score))[:k]  # rows are in id order, so a tie goes to the smaller id
                out.append(pd.DataFrame({"quid": own, "uid": uid[kept[best]], "vec_id": ids[kept[best]], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"quid": [], "uid": [], "vec_id": [], "score": []})

    return run


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", column: str = "embedding",
                       target: float = TARGET) -> DataFrame:
    """The k nearest rows found for each query row: query_id, rank, vec_id, score (Euclidean distance).

    ``is_query``: SQL condition on vec_id that picks the queries among the rows. Candidates are all rows
    but the query's own row; fewer than k rows are all returned. Ties go to the smaller id, then to a
    fixed order of the rows. Vectors that are null, zero, hold null or non-finite components, or differ
    in length from the most common length take no part. A null id is larger than any other. Rows that
    repeat an id are rows of their own. Further columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    base = vectors.select(row_id(id_col, column).alias("vec_id"), F.col(id_col).cast("long").alias("own_id"), as_doubles(column).alias("v"))
    size = common_size(base, "v")
    # Scaling by a power of two is exact; it keeps squares of huge components finite.
    largest = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    top = base.where(F.size("v") == size).agg(F.max(largest), F.count("*")).first()
    if not top[1]:
        return spark.createDataFrame([], result)
    scale = 2.0 ** np.floor(np.log2(top[0])) if not 1e-100 < top[0] < 1e100 else 1.0
    base = base.where(F.size("v") == size).withColumn("v", F.transform("v", lambda x: x / F.lit(float(scale))))
    base = base.withColumn("uid", F.monotonically_increasing_id())
    lists = min(MAX_LISTS, max(1, round(top[1] / LIST_AIM)))
    base = checkpoint(base)  # stores the row numbers
    centres = kmeans(sample_rows(base, "uid", "v", SAMPLE), lists)
    indexed = checkpoint(base.mapInArrow(_assign(centres, size), "vec_id long, own_id long, v array<double>, uid long, list long"))
    counts = np.zeros(len(centres), np.int64)
    for r in indexed.groupBy("list").count().collect():  # at most MAX_LISTS rows
        counts[r.list] = r["count"]
    queries = indexed.where(F.expr(is_query.replace(id_col, "own_id"))).select("own_id", "uid", "v")
    sample = queries.orderBy(F.xxhash64("uid", F.lit(4)), "uid").limit(CALIBRATION).collect()
    if not sample:
        return spark.createDataFrame([], result)
    q, uid = np.array([r.v for r in sample], float), np.array([r.uid for r in sample])
    near = indexed.select("v", "uid", "list").mapInArrow(_brute(q, uid, k, size), "q long, d double, uid long, list long")
    order = F.row_number().over(Window.partitionBy("q").orderBy("d", "uid"))
    true = near.withColumn("n", order).where(f"n <= {k} and d < double('infinity')").select("q", "list").collect()
    place = np.argsort(nearest(q, centres, len(centres)), axis=1)  # place[i, list]: when query i would probe the list
    needed = np.sort([place[r.q, r.list] for r in true]) if true else np.zeros(1, int)
    n = int(needed[int(np.ceil(target * len(needed))) - 1]) + 1
    probed = queries.mapInArrow(_probe_batches(centres, counts, n, k + 1, size), "own_id long, uid long, v array<double>, lists array<long>")
    blocks = -(-queries.count() // QUERY_BLOCK)
    parts = F.create_map(*[F.lit(int(x)) for i, c in enumerate(counts) for x in (i, max(1, -(-c // LIST_CAP)))])
    every = lambda m: F.explode(F.sequence(F.lit(0), m.cast("int") - 1))
    rows = indexed.withColumn("part", F.pmod(F.xxhash64("uid"), parts[F.col("list")]).cast("int"))
    rows = rows.withColumn("block", every(F.lit(blocks))).select("list", "part", "block", "vec_id", "uid", "v")
    asked = probed.select("uid", "v", F.explode("lists").alias("list"))
    asked = asked.withColumn("part", every(parts[F.col("list")])).withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int"))
    key = ["list", "part", "block"]
    found = rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(
        _search(size, k), "quid long, uid long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("quid").orderBy("score", "vec_id", "uid"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    named = best.join(queries.select(F.col("uid").alias("quid"), F.col("own_id").alias("query_id")), "quid")
    return named.select("query_id", "rank", F.when(F.col("vec_id") < (1 << 62), F.col("vec_id")).alias("vec_id"),
                        (F.col("score") * F.lit(float(scale))).alias("score"))
