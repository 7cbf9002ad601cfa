import hashlib
import random

import duckdb
from pyspark.sql import functions as F

from fieldline.llm import queries, warc as M

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, seq string, digest int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def audit(spark, a, b):
    sides = [M.manifest(M.page_records(pages(spark, x))) for x in (a, b)]
    return {(r.record_id, r["copy"]): r for r in M.fixity_audit(*sides).collect()}


def test_record_bytes_and_offsets(spark):
    rows = [(2, "http://b/", "héllo"), (1, None, None), (1001, "http://c/", "x" * 10)]
    got = M.page_records(pages(spark, rows)).orderBy("page_id").collect()
    head, body = got[1].record.split("\r\n\r\n", 1)
    assert body == "héllo\r\n\r\n" and "Content-Length: 6" in head and "WARC-Target-URI: http://b/" in head
    assert [r.file_id for r in got] == [0, 0, 1]
    m = M.manifest(M.page_records(pages(spark, rows))).orderBy("page_id").collect()
    sizes = [len(r.record.encode()) for r in got]
    assert [r.length for r in m] == sizes and [r.offset for r in m] == [0, sizes[0], 0]
    assert [r.digest for r in m] == [hashlib.sha256(r.record.encode()).hexdigest() for r in got]


def test_tree_equals_plain_hashing(spark):
    rng = random.Random(1)
    rows = [(i, f"http://a/{i}", "z" * rng.randint(0, 60_000)) for i in range(1200)]
    m = M.manifest(M.page_records(pages(spark, rows)))
    tree = {(r.level, r.file_id, r.node): r.hash for r in M.merkle_tree(m).collect()}
    sha = lambda lines: hashlib.sha256("\n".join(lines).encode()).hexdigest()
    ranges = {}
    for r in m.collect():
        ranges.setdefault((r.file_id, r.offset // M.RANGE_BYTES), []).append((r.offset, r.length, r.digest))
    level = {k: sha(f"{o}:{n}:{d}" for o, n, d in sorted(v)) for k, v in ranges.items()}
    for depth in range(M.LEVELS):
        assert level == {(f, n): h for (lv, f, n), h in tree.items() if lv == depth}
        up = {}
        for (f, n), h in level.items():
            up.setdefault((f, n // M.FAN_OUT if depth < M.LEVELS - 1 else 0), []).append((n, h))
        level = {k: sha(f"{n}:{h}" for n, h in sorted(v)) for k, v in up.items()}
    assert level == {(f, n): h for (lv, f, n), h in tree.items() if lv == M.FILE_LEVEL}
    assert sum(lv == M.ROOT_LEVEL for lv, _, _ in tree) == 1


def test_damage_is_located(spark):
    rng = random.Random(2)
    a = [(i, f"http://a/{i}", "".join(rng.choice("abc") for _ in range(rng.randint(0, 3000)))) for i in range(2500)]
    b = [list(r) for r in a]
    b[40][2] = "x" + b[40][2][1:] if b[40][2] else "x"
    b[1700][2] = b[1700][2] + "longer"
    gone = b.pop(2400)
    b.append([9999, "http://new/", "extra"])
    got = audit(spark, a, b)
    ids = {r.record_id: r.page_id for r in M.page_records(pages(spark, a + [tuple(b[-1])])).collect()}
    status = {}
    for (rid, _), r in got.items():
        status.setdefault(r.status, set()).add(ids[rid])
    assert status["damaged"] == {40, 1700} and status["missing"] == {gone[0]} and status["extra"] == {9999}
    assert status["moved"] == {*range(1701, 2000), *range(2401, 2500)}


def test_only_differing_branches_are_read(spark):
    a = [(i, f"http://a/{i}", "q" * 5000) for i in range(3000)]
    b = [(i, u, h if i != 1234 else "r" * 5000) for i, u, h in a]
    trees = [M.stored_tree(M.manifest(M.page_records(pages(spark, x)))) for x in (a, b)]
    assert M.differing_ranges(*trees).count() == 1
    assert M.differing_ranges(trees[0], trees[0]).count() == 0


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, None, None), (None, "http://n/", "x"), (5, "http://a/", "x"), (5, "http://a/", "x"), (5, "http://a/", "y")]
    assert audit(spark, rows, rows) == {}
    assert sorted(r.status for r in audit(spark, rows[:4], rows[:3]).values()) == ["missing"]
    assert sorted(r.status for r in audit(spark, [], rows).values()) == ["extra"] * 5
    assert audit(spark, [], []) == {}


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    got = queries.QUERIES["op7_merkle_fixity_audit"](spark, SF)
    res = con.execute(M.ORACLE_SQL)
    cols = [d[0] for d in res.description]
    assert sorted(got.columns) == sorted(cols)
    want = sorted(tuple(r) for r in res.fetchall())
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == want and want
    assert got.where(F.col("status") == "damaged").count() > 0
