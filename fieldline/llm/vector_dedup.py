"""Embedding near-dedup on a robust-pruned flat graph.

1. Equal vectors are one node. Centres are fitted on a bounded sample; every node goes to its
   ``overlap`` nearest centres, so the cluster shards overlap. A shard beyond ``SHARD_CAP`` nodes is split
   at random into parts that share some pivot nodes.
2. Each part builds a graph: a node's candidates are its nearest in the part, pruned robustly (a
   candidate goes if one kept before is nearer to it by the factor ``ALPHA``), plus reverse edges.
3. The adjacency lists of all parts are united per node.
4. Each node is searched for in its shards on the united graph: a greedy best-first search from its
   own neighbours and the shard's medoids, then, from every node found near the range, on to all its
   neighbours until none is new. Similarities are in double precision, and only pairs at or above
   the threshold link.
5. The recall against brute force is audited on a sample of all nodes and on one of the nodes found
   linked; below ``RECALL`` in either the graph is built again with more overlap. If that does not
   help, the pairs are compared exactly: a shard's own nodes with each other and with all nodes that
   the triangle inequality does not keep beyond the threshold (``_exact_links``).

A pair is counted in one place (the first shard both have, in the cell of its two parts), which returns
counts per node and a spanning forest, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldline.llm.common import SURROGATE, checkpoint, connected_components, row_id
from fieldline.llm.simhash import _roots, join_sets
from fieldline.llm.vectors import as_doubles, common_size, kmeans, matrix, nearest, sample_rows, unit

SHARD_AIM = 1000
SHARD_CAP = 4000
MAX_SHARDS = 4096
SAMPLE = 16_384
PIVOTS = 48
CANDIDATES = 64
DEGREE = 24
ALPHA = 1.2
BEAM = 24
MEDOIDS = 8
#: Nodes this far below the threshold are still expanded.
SLACK = 0.05
AUDIT = 256
RECALL = 0.98
MAX_OVERLAP = 4


def robust_prune(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, candidates: int = CANDIDATES) -> list[np.ndarray]:
    """Neighbours of each row of x (unit vectors), reverse edges included."""
    n = len(x)
    c = min(candidates, n - 1)
    if c < 1:
        return [np.zeros(0, np.int64)] * n
    near = np.empty((n, c), np.int64)
    sims = np.empty((n, c))
    for low in range(0, n, 1024):
        s = x[low:low + 1024] @ x.T
        s[np.arange(len(s)), np.arange(low, low + len(s))] = -np.inf
        top = np.argpartition(-s, c - 1, axis=1)[:, :c]
        order = np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable")
        near[low:low + 1024] = np.take_along_axis(top, order, 1)
        sims[low:low + 1024] = np.take_along_axis(s, near[low:low + 1024], 1)
    chosen: list[list[np.ndarray]] = []
    for low in range(0, n, 512):
        pool, s = near[low:low + 512], sims[low:low + 512]
        rows, left = np.arange(len(pool)), np.ones(pool.shape, bool)
        vectors, picks = x[pool], []
        for _ in range(min(degree, c)):
            any_left = left.any(axis=1)
            if not any_left.any():
                break
            first = left.argmax(axis=1)  # the pools are sorted, so this is the nearest left
            picks.append(np.where(any_left, pool[rows, first], -1))
            to_pick = np.einsum("rcd,rd->rc", vectors, vectors[rows, first])
            # Squared distances of unit vectors are 2 - 2 cos.
            left &= alpha ** 2 * (1 - to_pick) > 1 - s
            left[rows, first] = False
        chosen.extend(row[row >= 0] for row in np.stack(picks, axis=1))
    back: list[list[int]] = [[] for _ in range(n)]
    for i, own in enumerate(chosen):
        for j in own.tolist():
            if len(back[j]) < degree:
                back[j].append(i)
    return [np.union1d(own, b).astype(np.int64) for own, b in zip(chosen, back)]


def _starts(x: np.ndarray, n: int = MEDOIDS) -> np.ndarray:
    """The medoid, and further starting points each farthest from those before."""
    found = [int((x @ x.mean(axis=0)).argmax())]
    closest = x @ x[found[0]]
    while len(found) < min(n, len(x)):
        found.append(int(closest.argmin()))
        closest = np.maximum(closest, x @ x[found[-1]])
    return np.unique(found)


def range_search(x: np.ndarray, table: np.ndarray, queries: np.ndarray, threshold: float, beam: int = BEAM,
                 slack: float = SLACK) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, found row) with cosine >= threshold, the query itself left out.

    ``table``: (rows, width) neighbours, -1 where a row has fewer. All queries of a call move together:
    from its own neighbours and the medoids, each step expands every query's best unexpanded node,
    then all its nodes near the range.
    """
    n, out = len(x), []
    starts = _starts(x)
    for low in range(0, len(queries), 512):
        q = queries[low:low + 512]
        s = np.full((len(q), n), -np.inf)
        done = np.zeros((len(q), n), bool)
        s[:, starts] = x[q] @ x[starts].T
        s[np.arange(len(q)), q] = -2  # a query is no answer to itself

        def expand(r, c):
            """Look at the neighbours of node c of query row r, for all such pairs."""
            done[r, c] = True
            to = table[c]
            r = np.repeat(r, to.shape[1])
            to = to.ravel()
            r, to = r[to >= 0], to[to >= 0]
            new = np.unique(r * n + to)
            r, to = np.divmod(new[s.ravel()[new] == -np.inf], n)
            for i in range(0, len(r), 1 << 16):
                a, b = r[i:i + (1 << 16)], to[i:i + (1 << 16)]
                s[a, b] = np.einsum("ij,ij->i", x[q[a]], x[b])

        expand(np.arange(len(q)), q)
        active = np.arange(len(q))
        kth = max(0, n - beam)
        while len(active):
            rest = np.where(done[active], -np.inf, s[active])
            best = rest.argmax(axis=1)
            value = rest[np.arange(len(active)), best]
            worth = (value > -np.inf) & (value >= np.partition(s[active], kth, axis=1)[:, kth])
            active, best = active[worth], best[worth]
            if len(active):
                expand(active, best)
        while True:
            r, c = np.nonzero((s >= threshold - slack) & ~done)
            if not len(r):
                break
            for i in range(0, len(r), 1 << 14):
                expand(r[i:i + (1 << 14)], c[i:i + (1 << 14)])
        r, c = np.nonzero(s >= threshold)
        out.append((q[r], c))
    return tuple(np.concatenate(p) for p in zip(*out)) if out else (np.zeros(0, np.int64),) * 2


def _assign(centres: np.ndarray, size: int, overlap: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            own = nearest(unit(matrix(batch.column("v"), size)), centres, overlap)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(own), pa.list_(pa.int64()))],
                                             [*batch.schema.names, "shards"])

    return run


def _build(size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        node = pdf["node"].to_numpy()
        lists = robust_prune(unit(np.array(pdf["v"].tolist(), float).reshape(-1, size)))
        return pd.DataFrame({"node": node, "near": [node[a].tolist() for a in lists]})

    return run


def _search(size: int, threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        shard, low, high = (int(pdf[c].iloc[0]) for c in ("shard", "i", "j"))
        x = unit(np.array(pdf["v"].tolist(), float).reshape(-1, size))
        node, part, copies = (pdf[c].to_numpy() for c in ("node", "part", "copies"))
        lists = []
        for ids in pdf["near"]:
            ids = np.asarray(ids, np.int64)
            at = np.searchsorted(node, ids).clip(max=len(node) - 1)
            lists.append(at[node[at] == ids])
        table = np.full((len(node), max(1, max(map(len, lists)))), -1, np.int64)
        for i, own in enumerate(lists):
            table[i, : len(own)] = own
        a, b = range_search(x, table, np.arange(len(node)), threshold)
        pairs = np.unique(np.minimum(a, b) * len(node) + np.maximum(a, b))  # found from either side
        a, b = np.divmod(pairs, len(node))
        shards = np.array(pdf["shards"].tolist(), np.int64).reshape(len(node), -1)
        first = np.full(len(a), np.iinfo(np.int64).max)
        for i in range(shards.shape[1]):
            shared = (shards[b] == shards[a, i][:, None]).any(axis=1)
            first = np.where(shared, np.minimum(first, shards[a, i]), first)
        here = (first == shard) & (np.minimum(part[a], part[b]) == low) & (np.maximum(part[a], part[b]) == high)
        a, b = a[here], b[here]
        links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
        parent = np.arange(len(node))
        join_sets(parent, a, b)
        root = _roots(parent, np.arange(len(node)))
        linked = links > 0
        return pd.DataFrame({"node": node[linked], "links": links[linked].astype(np.int64), "root": node[root[linked]]})

    return run


def _true_links(sample: np.ndarray, size: int, threshold: float):
    """Per sampled row, how many vectors of a batch link with it: the audit's brute force."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            copies = batch.column("copies").to_numpy()
            x = unit(matrix(batch.column("v"), size))
            total = ((sample @ x.T >= threshold) * copies).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.int64())], ["k", "links"])

    return run


def _graph_links(nodes: DataFrame, n: int, size: int, threshold: float, overlap: int) -> DataFrame:
    """(node, links, root) rows per node and cell where the node has links."""
    shards = min(MAX_SHARDS, max(1, round(n / SHARD_AIM)))
    centres = kmeans(unit(sample_rows(nodes, "node", "v", SAMPLE)), shards)
    owned = checkpoint(nodes.mapInArrow(_assign(centres, size, overlap),
                                        "node long, copies long, v array<double>, shards array<long>"))
    spread = owned.withColumn("shard", F.explode("shards"))
    counts = {r.shard: r["count"] for r in spread.groupBy("shard").count().collect()}  # at most MAX_SHARDS rows
    split = {s: -(-c // SHARD_CAP) for s, c in counts.items() if c > SHARD_CAP}
    every = {s: max(1, c // PIVOTS) for s, c in counts.items() if c > SHARD_CAP}
    value = lambda d: F.coalesce(F.create_map(*[F.lit(int(x)) for kv in d.items() for x in kv])[F.col("shard")], F.lit(1)) if d else F.lit(1)
    spread = spread.withColumn("parts", value(split).cast("int"))
    spread = spread.withColumn("part", F.pmod(F.xxhash64("node", F.lit(11)), F.col("parts")).cast("int"))
    pivot = (F.col("parts") > 1) & (F.pmod(F.xxhash64("node", F.lit(12)), value(every).cast("long")) == 0)
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    building = spread.withColumn("into", F.explode(F.when(pivot, everywhere).otherwise(F.array("part"))))
    edges = building.select("shard", "into", "node", "v").groupBy("shard", "into").applyInPandas(
        _build(size), "node long, near array<long>")
    # A node has at most (overlap x pivots' parts) lists of at most 2 DEGREE entries.
    united = edges.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    graph = spread.join(united, "node")
    # Cells of part pairs; pivots stand in every cell of their shard, but count only in that of their own part.
    other = F.explode(everywhere)
    cells = graph.withColumn("other", other).withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
    if split:
        guests = graph.where(pivot & (F.col("parts") > 1)).withColumn("i", F.explode(everywhere)).withColumn(
            "j", F.explode(F.sequence(F.col("i"), F.col("parts") - 1))).where("i != part and j != part")
        cells = cells.drop("other").unionByName(guests)
    cells = cells.select("shard", "i", "j", "node", "part", "copies", "v", "shards", "near")
    return cells.groupBy("shard", "i", "j").applyInPandas(_search(size, threshold), "node long, links long, root long")


def _home(centres: np.ndarray, size: int):
    """Adds the nearest centre and the angle to it."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(matrix(batch.column("v"), size))
            own = nearest(x, centres, 1).ravel()
            angle = np.arccos(np.clip(np.einsum("ij,ij->i", x, centres[own]), -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int64()), pa.array(angle)],
                                             [*batch.schema.names, "home", "angle"])

    return run


def _reach(centres: np.ndarray, radii: np.ndarray, size: int, threshold: float):
    """Adds the shards before a node's own that may hold a partner of it, and its own."""
    far = radii + np.arccos(np.clip(threshold, -1, 1)) + 1e-6

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, home = unit(matrix(batch.column("v"), size)), batch.column("home").to_numpy()
            near = np.arccos(np.clip(x @ centres.T, -1, 1)) <= far
            shards = [[*np.flatnonzero(row[:h]).tolist(), h] for row, h in zip(near, home.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.list_(pa.int64()))],
                                             [*batch.schema.names, "shards"])

    return run


def _compare_cell(size: int, threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        node, copies, left = (pdf[c].to_numpy() for c in ("node", "copies", "left"))
        x = unit(np.array(pdf["v"].tolist(), float).reshape(-1, size))
        links, parent = np.zeros(len(node), np.int64), np.arange(len(node))
        right = pdf["right"].to_numpy()
        rows, cols = np.flatnonzero(left), np.flatnonzero(right)
        for low in range(0, len(rows), 512):
            a, b = np.nonzero(x[rows[low:low + 512]] @ x[cols].T >= threshold)
            a, b = rows[low + a], cols[b]
            fresh = (a < b) | ~(left[b] & right[a])  # a pair inside one chunk is met from both sides
            a, b = a[fresh], b[fresh]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            join_sets(parent, a, b)
        root, linked = _roots(parent, np.arange(len(node))), links > 0
        return pd.DataFrame({"node": node[linked], "links": links[linked], "root": node[root[linked]]})

    return run


def _exact_links(nodes: DataFrame, n: int, size: int, threshold: float) -> DataFrame:
    """As ``_graph_links``, without a graph: no pair at or above the threshold is left out.

    A pair is met in the lower of its nodes' home shards. The other node is a guest there, as its angle to
    the centre is at most the shard's radius and the threshold's angle together. Chunks of home nodes are
    compared with chunks of home nodes and guests, at most about SHARD_CAP each.
    """
    shards = min(MAX_SHARDS, max(1, round(n / SHARD_AIM)))
    centres = kmeans(unit(sample_rows(nodes, "node", "v", SAMPLE)), shards)
    centres[~centres.any(axis=1), 0] = 1  # a mean may vanish; any direction will do
    centres = unit(centres)
    homed = checkpoint(nodes.mapInArrow(_home(centres, size), "node long, copies long, v array<double>, home long, angle double"))
    radii = np.zeros(len(centres))
    for r in homed.groupBy("home").agg(F.max("angle").alias("radius")).collect():  # at most MAX_SHARDS rows
        radii[r.home] = r.radius
    spread = homed.drop("angle").mapInArrow(_reach(centres, radii, size, threshold),
                                            "node long, copies long, v array<double>, home long, shards array<long>")
    spread = checkpoint(spread.withColumn("shard", F.explode("shards")).drop("shards").withColumn("guest", F.col("home") != F.col("shard")))
    counts = spread.groupBy("shard").agg(F.ceil(F.count_if(~F.col("guest")) / F.lit(float(SHARD_CAP))).cast("int").alias("own"),
                                         F.ceil(F.count_if("guest") / F.lit(float(SHARD_CAP))).cast("int").alias("guests"))
    dealt = spread.join(F.broadcast(counts), "shard").where("own > 0")
    chunk = lambda parts: F.pmod(F.xxhash64("node", F.lit(11)), parts).cast("int")
    upto = lambda low, high: F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    own, guests, c = F.col("own"), F.col("guests"), F.col("chunk")
    mine = dealt.where("!guest").withColumn("chunk", chunk(own))
    as_left = mine.withColumn("i", c).withColumn("j", F.explode(upto(c, own + guests - 1)))
    as_right = mine.withColumn("j", c).withColumn("i", F.explode(upto(F.lit(0), c - 1)))
    visiting = dealt.where("guest").withColumn("chunk", chunk(guests)).withColumn("j", own + c)
    visiting = visiting.withColumn("i", F.explode(upto(F.lit(0), own - 1)))
    cells = as_left.withColumn("left", F.lit(True)).withColumn("right", F.col("i") == F.col("j")).unionByName(
        as_right.unionByName(visiting).withColumn("left", F.lit(False)).withColumn("right", F.lit(True)))
    cells = cells.select("shard", "i", "j", "node", "copies", "v", "left", "right")
    return cells.groupBy("shard", "i", "j").applyInPandas(_compare_cell(size, threshold), "node long, links long, root long")


def _recall(plain: DataFrame, sample: list, found: DataFrame, size: int, threshold: float) -> float:
    """The smaller of the share of the sampled nodes' links that ``found`` has, and the mean share a node."""
    if not sample:
        return 1.0
    x = unit(np.array([r.v for r in sample], float))
    true = plain.mapInArrow(_true_links(x, size, threshold), "k int, links long").groupBy("k").agg(F.sum("links").alias("n"))
    true = {sample[r.k].node: r.n - sample[r.k].copies for r in true.collect()}  # a node's own copies are no links of the graph
    got = {r.node: r.n for r in found.where(F.col("node").isin(list(true))).groupBy("node").agg(F.sum("links").alias("n")).collect()}
    pairs = [(got.get(k, 0), n) for k, n in true.items() if n > 0]
    if not pairs:
        return 1.0
    return min(sum(g for g, _ in pairs) / sum(n for _, n in pairs), sum(g / n for g, n in pairs) / len(pairs))


def near_dedup(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", column: str = "embedding",
               overlap: int = 2) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors link at cosine >= threshold in double precision. n_links counts the other vectors linked
    directly, equal ones included; component_id is the smallest id reachable by links; kept marks the
    rows whose id that is. Vectors that are null, zero, hold null or non-finite components, or differ
    in length from the most common length link with nothing. Null ids count as larger than any id
    (their component_id is null only if no member has an id); rows that repeat an id are vectors of
    their own. Further columns are ignored; an empty table gives an empty result.
    """
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), row_id(id_col, column).alias("id"), as_doubles(column).alias("v"))
    size = common_size(base, "v")
    base = base.withColumn("v", F.when(F.size("v") == size, F.col("v")))
    base = checkpoint(base.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64("v", F.lit(1))))
    nodes = base.where("v is not null").groupBy("k1", "k2").agg(
        F.min("id").alias("node"), F.count("*").alias("copies"), F.first("v").alias("v"))
    keyed = checkpoint(nodes)
    # Rows of one id but other vectors are nodes of their own; their numbers must differ.
    twice = keyed.groupBy("node").count().where("count > 1").select("node")
    mixed = F.lit(SURROGATE) + F.xxhash64("k1", "k2").bitwiseAND(F.lit(SURROGATE - 1))
    keyed = keyed.join(twice.withColumn("again", F.lit(True)), "node", "left").withColumn("best", F.col("node"))
    keyed = checkpoint(keyed.withColumn("node", F.when(F.col("again"), mixed).otherwise(F.col("node"))).drop("again"))
    plain = keyed.select("node", "copies", "v")
    n = plain.count()
    drawn = lambda rows: rows.orderBy(F.xxhash64("node", F.lit(5)), "node").limit(AUDIT).select("node", "copies", "v").collect()
    sample, found = drawn(plain), None
    while n:
        exact = overlap > MAX_OVERLAP
        found = checkpoint(_exact_links(plain, n, size, threshold) if exact else _graph_links(plain, n, size, threshold, overlap))
        if exact or _recall(plain, sample, found, size, threshold) >= RECALL and _recall(
                plain, drawn(plain.join(found.select("node").distinct(), "node", "left_semi")), found, size, threshold) >= RECALL:
            break
        # In a single shard more overlap changes nothing.
        overlap = overlap + 1 if round(n / SHARD_AIM) > 1 else MAX_OVERLAP + 1
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "node long, links long, root long")
    total = found.groupBy("node").agg(F.sum("links").alias("links"))
    sets = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of_set = keyed.select("node", "best").join(sets, "node")
    smallest = of_set.groupBy("component").agg(F.min("best").alias("low"))
    linked = of_set.join(smallest, "component").select("node", "low")
    answer = keyed.join(total, "node", "left").join(linked, "node", "left").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("low", "best").alias("component"))
    rows = base.select("vec_id", "id", F.when(F.col("v").isNotNull(), F.col("k1")).alias("k1"), "k2").join(answer, ["k1", "k2"], "left")
    component = F.coalesce("component", "id")
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(component < SURROGATE, component).alias("component_id"), (F.col("id") == component).alias("kept"),
    )
