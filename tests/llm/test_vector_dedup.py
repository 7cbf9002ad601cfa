import numpy as np
import pytest
from pyspark.sql import Row

from fieldline.llm import vector_dedup as V
from fieldline.llm.common import read_table


def brute(rows, threshold=0.95):
    """(id, links, component, kept) by comparing all pairs."""
    ok = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.array([np.array(rows[i][1], float) / np.linalg.norm(rows[i][1]) for i in ok])
    link = x @ x.T >= threshold if len(ok) else np.zeros((0, 0), bool)
    comp = {i: {i} for i in range(len(rows))}
    links = [0] * len(rows)
    for a, i in enumerate(ok):
        links[i] = int(link[a].sum()) - 1
        for b in np.flatnonzero(link[a]).tolist():
            j = ok[b]
            if comp[i] is not comp[j]:
                comp[i] |= comp[j]
                for k in comp[j]:
                    comp[k] = comp[i]
    low = [min(rows[k][0] for k in comp[i]) for i in range(len(rows))]
    return sorted((d, links[i], low[i], d == low[i]) for i, (d, _) in enumerate(rows))


def vectors(n, seed=1, dim=24):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        v = rng.normal(size=dim)
        rows.append(v)
        for _ in range(rng.choice([0, 0, 0, 2, 40])):
            rows.append((v + rng.normal(size=dim) * rng.choice([0.05, 0.12, 0.3])) * rng.choice([1, 7.5]))
        if rng.random() < 0.1:
            rows.append(v)
    ids = rng.permutation(len(rows)).tolist()
    return [(i, v.tolist()) for i, v in zip(ids, rows)]


def test_robust_prune_keeps_nearest_and_drops_shadowed():
    x = V.unit(np.array([[1, 0], [1, 0.1], [1, 0.2], [-1, 0.01]], float))
    lists = V.robust_prune(x)
    assert 1 in lists[0] and 1 in lists[2]
    assert 2 not in lists[0] and 0 not in lists[2]  # 1 stands between 0 and 2
    assert [len(a) for a in V.robust_prune(x[:1])] == [0]


def test_links_match_brute_force(spark, monkeypatch):
    rows = vectors(1500)
    bad = [(10_000, None), (10_001, [0.0] * 24), (10_002, [float("nan")] + [1.0] * 23), (10_003, [None] + [1.0] * 23),
           (10_004, [float("inf")] + [0.0] * 23), (10_005, []), (10_006, [5e-324] * 24), (10_007, [1e300] * 24)]
    all_rows = rows + bad
    df = spark.createDataFrame([Row(vec_id=i, embedding=v, node="clash", shard=1, v=2) for i, v in all_rows],
                               "vec_id long, embedding array<double>, node string, shard int, v int")
    want = brute(rows + [(i, None) for i, _ in bad[:6]] + [(i, [1.0] * 24) for i, _ in bad[6:]])
    for aim, cap in ((1000, 4000), (150, 4000), (1000, 250)):  # one shard, overlapping shards, split shards
        monkeypatch.setattr(V, "SHARD_AIM", aim)
        monkeypatch.setattr(V, "SHARD_CAP", cap)
        got = sorted(tuple(r) for r in V.near_dedup(df).collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        missing = sum(w[1] - g[1] for g, w in zip(got, want))
        assert all(g[1] <= w[1] for g, w in zip(got, want))
        assert missing <= 0.005 * sum(w[1] for w in want)
        assert sum(g[2:] != w[2:] for g, w in zip(got, want)) <= 0.005 * len(want)


def test_given_table(spark):
    df = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(tuple(r) for r in V.near_dedup(df).collect()) == brute(rows)


def test_nulls_repeats_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.99, 0.1]
    df = spark.createDataFrame([(5, a), (5, a), (5, b), (7, c), (None, a), (None, None), (9, [1.0])], schema)
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in V.near_dedup(df).collect())
    assert got == sorted([("5", 2, "5", True), ("5", 2, "5", True), ("5", 1, "5", True), ("7", 1, "5", False),
                          ("None", 2, "5", False), ("None", 0, "None", True), ("9", 0, "9", True)])
    assert V.near_dedup(spark.createDataFrame([], schema)).count() == 0
    assert V.near_dedup(df.where("vec_id = 9").limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 700])
def test_range_search_finds_tight_balls(n):
    rng = np.random.default_rng(3)
    x = V.unit(rng.normal(size=(1, 64)) + rng.normal(size=(n, 64)) * 0.02)
    lists = V.robust_prune(x)
    table = np.full((n, max(1, max(map(len, lists)))), -1)
    for i, own in enumerate(lists):
        table[i, : len(own)] = own
    a, _ = V.range_search(x, table, np.arange(n), 0.9)
    assert len(a) == n * (n - 1)


def test_links_of_many_tight_groups_in_one_shard(spark):
    rng = np.random.default_rng(8)
    x = np.repeat(rng.normal(size=(12, 64)), 80, axis=0) + rng.normal(size=(960, 64)) * 0.02
    lists = V.robust_prune(V.unit(x))
    table = np.full((960, max(map(len, lists))), -1)
    for i, own in enumerate(lists):
        table[i, : len(own)] = own
    assert len(V.range_search(V.unit(x), table, np.arange(960), 0.95)[0]) == 12 * 80 * 79
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in V.near_dedup(df).collect()) == brute(rows)


def test_exact_comparison_when_the_graph_fails(spark, monkeypatch):
    rows = vectors(700)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    graph = V._graph_links
    monkeypatch.setattr(V, "_graph_links", lambda *a: graph(*a).where("node % 2 = 0"))
    for aim, cap in ((1000, 4000), (100, 4000), (300, 90)):
        monkeypatch.setattr(V, "SHARD_AIM", aim)
        monkeypatch.setattr(V, "SHARD_CAP", cap)
        assert sorted(tuple(r) for r in V.near_dedup(df).collect()) == brute(rows)
