"""Jobs: incremental recompute equals full recompute; pair history re-run; streaming sink."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from fieldline.operators import rolling
from fieldline.plans import jobs
from fieldline.plans.q_features import batter_games, pitcher_games
from fieldline.plans.q_relational import lineup_rows
from fieldline.plans.views import pitch_view
from fieldline.sources import tables as TB
from fieldline.streaming.ingest import start_pitch_ingest

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_equals_full(spark):
    games = batter_games(spark, SF).cache()
    day = games.agg(F.max("game_date")).first()[0]
    inc = jobs.compute_features(spark, games, "batter", game_date=day)
    full = rolling.batter_rolling_features(games).filter(F.col("game_date") == F.lit(day))
    assert rows(inc) == rows(full.select(*inc.columns))
    assert jobs.compute_features(spark, games, "batter") == "skipped"


def test_pair_history_rerun_adds_nothing(spark, tmp_table_dir):
    p = pitch_view(spark, SF)
    days = sorted(r[0] for r in p.select("game_date").distinct().orderBy("game_date").limit(3)
                  .collect())
    path = os.path.join(tmp_table_dir, "bvp")
    for d in days:
        jobs.pair_history(spark, p, path, d)
    n = spark.read.parquet(path).count()
    assert jobs.pair_history(spark, p, path, days[-1]) == 0
    assert spark.read.parquet(path).count() == n


def test_streaming_replaces_dates(spark, tmp_table_dir):
    landing = tempfile.mkdtemp(prefix="fl-landing-", dir="/tmp")
    table = os.path.join(tmp_table_dir, "raw_pitches")
    ckpt = os.path.join(tmp_table_dir, "_stream_ckpt")
    d1 = dt.date(2023, 7, 15)
    schema = "game_pk long, at_bat_number int, pitch_number int, game_date date, events string, " \
             "_loaded_at timestamp_ntz"
    t0, t1 = dt.datetime(2023, 7, 16, 1), dt.datetime(2023, 7, 16, 2)
    spark.createDataFrame([(1, 1, 1, d1, None, t0), (1, 1, 1, d1, "single", t1)], schema) \
        .write.mode("append").parquet(landing)
    q = start_pitch_ingest(spark, landing, spark.read.parquet(landing).schema, table, ckpt,
                           trigger_once=True)
    q.awaitTermination(120)
    out = rows(spark.read.parquet(table).select("game_pk", "events"))
    assert out == [(1, "single")]


def test_feature_modes_store_the_same_rows(spark, tmp_table_dir):
    games = batter_games(spark, SF)
    day = games.agg(F.max("game_date")).first()[0]
    active = games.filter(F.col("game_date") == F.lit(day)).select("mlbam_id")
    games = games.join(active.distinct(), "mlbam_id", "left_semi").cache()
    full = os.path.join(tmp_table_dir, "full")
    assert jobs.write_features(spark, games, "batter", full, allow_full_recompute=True) == "written"
    want = TB.read_table(spark, full)
    ids = games.filter(F.col("game_date") == F.lit(day)).select("mlbam_id")
    modes = {"date": dict(game_date=day), "ids": dict(ids=ids, game_date=day),
             "year": dict(year=day.year), "list": dict(ids=[r[0] for r in ids.collect()], game_date=day)}
    for name, target in modes.items():
        path = os.path.join(tmp_table_dir, name)
        for _ in range(2 if name == "date" else 1):  # a re-run changes nothing
            jobs.write_features(spark, games, "batter", path, **target)
        part = want.filter(F.year("game_date") == day.year) if name == "year" else want.filter(F.col("game_date") == F.lit(day))
        assert rows(TB.read_table(spark, path)) == rows(part)
    years = os.path.join(tmp_table_dir, "years")
    jobs.write_feature_years(spark, games, "batter", years, day.year - 1, day.year)
    assert rows(TB.read_table(spark, years)) == rows(want.filter(F.year("game_date") >= day.year - 1))
    assert jobs.write_features(spark, games, "batter", full, ids=[]) == "skipped"


def test_changed_lineups_are_computed_once(spark, tmp_table_dir):
    p = pitch_view(spark, SF)
    day = p.agg(F.max("game_date")).first()[0]
    games = {"batter": batter_games(spark, SF), "pitcher": pitcher_games(spark, SF)}
    tables = {k: os.path.join(tmp_table_dir, k) for k in games}
    marks = os.path.join(tmp_table_dir, "marks")
    lineups = lineup_rows(p.filter(F.col("game_date") == F.lit(day)))
    at = dt.datetime(2024, 1, 1)

    def run(rows_now, **kw):
        return jobs.lineup_features(spark, rows_now, games, tables, kw.get("marks", marks), day, at)

    n = lineups.select("game_pk").distinct().count()
    assert run(lineups) == n and n > 0
    assert run(lineups) == 0
    players = {r[0] for r in lineups.filter("role = 'batter'").select("player_id").collect()}
    known = {r[0] for r in games["batter"].select("mlbam_id").distinct().collect()}
    assert {r[0] for r in TB.read_table(spark, tables["batter"]).select("mlbam_id").collect()} == players & known
    one = lineups.select("game_pk").first()[0]
    changed = lineups.unionByName(spark.createDataFrame([(one, 999_999, "batter")], lineups.schema))
    assert run(changed) == 1
    # a run that fails before its tables are written marks nothing
    broken = dict(tables, pitcher=os.path.join(tmp_table_dir, "marks2", "x", "\0"))
    try:
        jobs.lineup_features(spark, lineups, games, broken, os.path.join(tmp_table_dir, "marks3"), day, at)
    except Exception:
        pass
    assert not TB.table_exists(spark, os.path.join(tmp_table_dir, "marks3"))
