"""The line-up job keeps little on disk: stored games, batches, shuffle files that go with their step."""

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldline import session
from fieldline.operators import rolling
from fieldline.plans import jobs, q_features, q_jobs

GAMES = "mlbam_id long, game_date date, game_pk long, gs int, hr long, bfp long"


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_lineups_read_stored_games(spark, tables, monkeypatch):
    seen, run = [], jobs.lineup_features

    def watched(session_, rows, games, *a, **kw):
        plans = [g._jdf.queryExecution().optimizedPlan().toString() for g in (rows, *games.values())]
        seen.append((plans, spark.conf.get(session.RELEASE)))
        return run(session_, rows, games, *a, **kw)

    monkeypatch.setattr(jobs, "lineup_features", watched)
    assert q_jobs.q_lineup_job_features(spark, tables).count() == 8
    (plans, released), = seen
    assert not any("l_orderkey" in p for p in plans) and released == "true"
    assert spark.conf.get(session.RELEASE) == "false"


def test_lineups_without_games(spark, tables, tmp_path):
    spark.read.parquet(f"{tables}/lineitem.parquet").where("false").write.parquet(f"{tmp_path}/none/lineitem.parquet")
    for name in ("nation", "customer", "supplier", "orders"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{tmp_path}/none/{name}.parquet")
    none = q_jobs.q_lineup_job_features(spark, f"{tmp_path}/none")
    assert none.columns == q_jobs.LINEUP_COLUMNS and none.count() == 0


@pytest.mark.parametrize("build", [q_features.batter_games, q_features.pitcher_games])
def test_batches_hold_every_game_once(spark, tables, no_broadcast, build):
    whole = build(spark, tables)
    batches = [build(spark, tables, (i, 3)) for i in range(3)]
    games = [{r.game_pk for r in b.select("game_pk").distinct().collect()} for b in batches]
    assert all(games) and sum(map(len, games)) == len(set().union(*games))
    back = session.store(*batches)
    assert back.schema.names == whole.schema.names and Counter(back.collect()) == Counter(whole.collect())
    assert [f.nullable for f in back.schema if f.name in ("h", "hr")] == [False, False]


def test_a_batch_is_dealt_by_supplier_and_by_game_alone(spark, tables, tmp_path):
    """Pitches that met a supplier table too large to broadcast are not dealt again for the rollup."""
    more = spark.sql("SELECT id s_suppkey, concat('S', id) s_name, CAST(id % 3 AS INT) s_nationkey, id * 3000.0D s_acctbal FROM range(60000)")
    more.write.parquet(f"{tmp_path}/more/supplier.parquet")
    for name in ("nation", "customer", "orders", "lineitem"):
        spark.read.parquet(f"{tables}/{name}.parquet").coalesce(1).write.parquet(f"{tmp_path}/more/{name}.parquet")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "6k")
    try:
        plan = q_features.batter_games(spark, f"{tmp_path}/more", (0, 3))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    dealt = [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert sorted(dealt) == ["l_orderkey", "l_suppkey", "o_orderkey", "s_suppkey"]


def test_shuffle_files_go_with_their_action(spark):
    before = shuffle_files(spark)
    with session.shuffles_released(spark):
        rows = session.store(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and rows.count() == 100
    assert spark.conf.get(session.RELEASE) == "false"


def test_stored_counts_change_no_feature(spark):
    games = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("long").alias("mlbam_id"),
        F.expr("date_add(DATE'2023-01-01', CAST(id DIV 4 AS INT))").alias("game_date"), F.col("id").alias("game_pk"),
        (F.col("id") % 2).cast("int").alias("gs"), (F.col("id") % 5).alias("hr"), (F.col("id") % 7 + 1).alias("bfp"))
    run = lambda **kw: Counter(rolling.pitcher_rolling_features(games, windows=[3, 10], **kw).collect())
    plain = run()
    assert run(rows_per_segment=40, stored=True) == plain == run(rows_per_segment=40)
    assert run(rows_per_segment=4000, stored=True) == plain


def test_rows_meet_few_stored_counts_without_a_shuffle(spark):
    games = spark.range(200_000).select((F.col("id") % 500).alias("mlbam_id"), F.expr("date_add(DATE'2001-01-01', CAST(id DIV 100 AS INT))").alias("game_date"),
                                        F.col("id").alias("game_pk"), F.lit(0).alias("gs"), F.lit(1).cast("long").alias("hr"), F.lit(4).cast("long").alias("bfp"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        plan = rolling.pitcher_rolling_features(games, rows_per_segment=1000, stored=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
