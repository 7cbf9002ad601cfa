from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import Row

from fieldline.llm import nearest as N
from fieldline.llm.common import read_table

QUERIES = "pmod(vec_id, 100) = 0"


def brute(rows, k=10):
    ok = sorted((i, v) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v))
    x, ids = np.array([v for _, v in ok], float), np.array([i for i, _ in ok])
    out = {}
    for i in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == i][0]) ** 2).sum(axis=1))
        d[ids == i] = np.inf
        best = np.lexsort((ids, d))[: min(k, len(ids) - 1)]
        out[int(i)] = [(int(ids[b]), d[b]) for b in best]
    return out


def found(df, **kw):
    out = defaultdict(list)
    for r in N.nearest_neighbours(df, QUERIES, **kw).collect():
        out[r.query_id].append((r["rank"], r.vec_id, r.score))
    for q, rows in out.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert [(s, i) for _, i, s in rows] == sorted((s, i) for _, i, s in rows)
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    hit = total = 0
    for q, near in want.items():
        assert len(got[q]) == len(near)
        dist = dict(near)
        hit += len({i for _, i, _ in got[q]} & dist.keys())
        total += len(near)
        for _, i, s in got[q]:
            if i in dist:
                assert s == pytest.approx(dist[i], rel=1e-12, abs=1e-12)
    return hit / total


def test_scan_abandons_early_and_keeps_the_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20_000, 64)) @ N.rotation(64)
    hits = read = 0
    for _ in range(20):
        q = rng.normal(size=64)
        kept, cost = N.adaptive_scan(x, q, 10)
        true = np.argsort(((x - q) ** 2).sum(axis=1))[:10]
        hits += len(set(true) & set(kept[:10]))
        read += cost
    assert hits >= 197
    assert read < 0.8 * 20 * x.size
    few, _ = N.adaptive_scan(x[:5], x[0], 10, np.array([0]))
    assert sorted(few) == [1, 2, 3, 4]
    assert np.allclose(N.rotation(7) @ N.rotation(7).T, np.eye(7))


def test_recall_on_given_table(spark):
    df = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    assert recall(found(df), brute([(r.vec_id, r.embedding) for r in df.collect()])) >= 0.95


def test_many_lists_parts_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    spots = rng.normal(size=(30, 16)) * 3
    rows = [(i, (spots[i % 30 if i % 3 else 0] + rng.normal(size=16)).tolist()) for i in range(6000)]
    df = spark.createDataFrame([Row(vec_id=i, embedding=v, uid="clash", list=1, v=2) for i, v in rows])
    monkeypatch.setattr(N, "LIST_AIM", 200)
    monkeypatch.setattr(N, "LIST_CAP", 150)
    monkeypatch.setattr(N, "QUERY_BLOCK", 20)
    assert recall(found(df), brute(rows)) >= 0.93


def test_nulls_ties_repeats_extremes_and_empty_tables(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [1.0, 0.0]), (3, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [None, 1.0]),
            (7, [float("nan"), 1.0]), (8, [1.0]), (100, [1.0, 0.5])]
    got = found(spark.createDataFrame(rows, schema))
    assert [i for _, i, _ in got[0]] == [100, 1, 3, 2] and [i for _, i, _ in got[100]] == [0, 1, 2, 3]
    got = found(spark.createDataFrame([(0, [1e300, 0.0]), (1, [1e300, 1e299]), (2, [-1e300, 0.0])], schema))
    assert [(i, s) for _, i, s in got[0]] == [(1, pytest.approx(1e299)), (2, pytest.approx(2e300))]
    got = N.nearest_neighbours(spark.createDataFrame([(0, [1.0]), (0, [1.0]), (None, [3.0])], schema), QUERIES).collect()
    assert sorted((r.query_id, r["rank"], str(r.vec_id), r.score) for r in got) == [(0, 1, "0", 0.0)] * 2 + [(0, 2, "None", 2.0)] * 2
    empty = spark.createDataFrame([], schema)
    assert N.nearest_neighbours(empty, QUERIES).count() == 0
    assert N.nearest_neighbours(spark.createDataFrame([(1, [1.0])], schema), QUERIES).count() == 0
    assert N.nearest_neighbours(spark.createDataFrame([(0, [1.0])], schema), QUERIES).count() == 0
