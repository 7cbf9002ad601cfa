"""Kept window state, ranged tables, batch commits, line-up windows, checked logs and the season backfill."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fieldline.operators import rolling
from fieldline.plans import jobs
from fieldline.plans.q_features import batter_games, pitcher_games
from fieldline.plans.q_history import games_keyed
from fieldline.plans.views import game_log_view, odds_log_view
from fieldline.sources import gamelogs as G
from fieldline.sources import tables as TB

SF = "/root/testdata/sf0.001"
D = dt.date


def rows(df, *cols):
    return sorted(str(tuple(r)) for r in (df.select(*cols) if cols else df).collect())


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("kind", ["batter", "pitcher"])
def test_days_rolled_from_tails_equal_a_full_recompute(spark, tmp_table_dir, kind):
    games = (batter_games if kind == "batter" else pitcher_games)(spark, SF).cache()
    build = rolling.batter_rolling_features if kind == "batter" else rolling.pitcher_rolling_features
    days = sorted(r[0] for r in games.select("game_date").distinct().collect())[-3:]
    tail, table = os.path.join(tmp_table_dir, "tail"), os.path.join(tmp_table_dir, "feats")
    jobs.start_tails(spark, games.where(F.col("game_date") < F.lit(days[0])), kind, tail)
    for day in [*days, days[-1]]:  # the newest day is run twice
        today = spark.createDataFrame(games.where(F.col("game_date") == F.lit(day)).collect(), games.schema)
        assert jobs.roll_features(spark, today, kind, tail, table, day) == today.select("mlbam_id").distinct().count()
    want = build(games).where(F.col("game_date") >= F.lit(days[0]))
    assert rows(TB.read_table(spark, table).select(*want.columns)) == rows(want)
    player = games.where(F.col("game_date") == F.lit(days[-1])).first()
    with pytest.raises(ValueError, match="start_tails"):
        old = games.where(F.col("mlbam_id") == player.mlbam_id).limit(1).withColumn("game_date", F.lit(D(1990, 1, 1)))
        jobs.roll_features(spark, old, kind, tail, table, D(1990, 1, 1))


def test_tail_holds_the_newest_day_and_the_games_before_it(spark):
    from fieldline.operators.tails import last_games
    data = [(1, D(2020, 1, d), d * 10 + g) for d in range(1, 9) for g in range(2)] + [(2, D(2020, 1, 1), 5), (3, None, 6)]
    games = spark.createDataFrame(data, "mlbam_id long, game_date date, game_pk long")
    assert rows(last_games(games, 3), "mlbam_id", "game_pk") == rows(spark.createDataFrame(
        [(1, 80), (1, 81), (1, 71), (1, 70), (1, 61), (2, 5)], "mlbam_id long, game_pk long"))


def test_upsert_of_one_key_rewrites_one_range(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "results")
    base = spark.range(1000).select(F.col("id").alias("game_pk"), F.lit("a").alias("x"))
    TB.upsert_table(spark, base.coalesce(1), path, ["game_pk"], ["game_pk/10"])
    before = files(path)
    assert len(before) == 100
    TB.upsert_table(spark, spark.createDataFrame([(507, "b")], "game_pk long, x string"), path, ["game_pk"])
    after = files(path)
    assert {os.path.dirname(f) for f in before ^ after} == {os.path.join(path, "_range_game_pk=50")} and len(before & after) == 99
    got = TB.read_table(spark, path)
    assert got.columns == ["game_pk", "x"] and got.count() == 1000
    assert rows(got.where("x = 'b'"), "game_pk") == ["(507,)"]
    # null and negative keys, widening, merges and truncation keep the layout
    TB.merge_update_insert_table(spark, spark.createDataFrame([(None, "n", 1), (-1, "m", 2)], "game_pk long, x string, y int"), path, ["game_pk"])
    TB.merge_latest_table(spark, spark.createDataFrame([(None, "z")], "game_pk long, x string"), path, ["game_pk"])
    got = TB.read_table(spark, path)
    assert got.count() == 1002 and rows(got.where("y IS NOT NULL OR game_pk IS NULL")) == ["(-1, 'm', 2)", "(None, 'z', None)"]
    TB.truncate(spark, path)
    TB.append(spark.createDataFrame([(7, "q")], "game_pk long, x string"), path)
    assert rows(TB.read_table(spark, path)) == ["(7, 'q', None)"]
    assert [n for n in os.listdir(path) if "=" in n] == ["_range_game_pk=0"]
    assert len([n for n in os.listdir(path) if n.startswith("_table-")]) == 1


def test_declaration_survives_a_crash_before_the_old_one_goes(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "t")
    TB.append(spark.createDataFrame([(1, "a")], "k int, x string"), path)
    TB.truncate(spark, path)
    older = os.path.join(path, "_table-000000.json")
    with open(older, "w") as f:
        f.write("{}")  # what a crash between writing the new declaration and dropping the old one leaves
    assert TB.read_table(spark, path).columns == ["k", "x"]
    TB.append(spark.createDataFrame([(1, "a", 2)], "k int, x string, y int"), path)
    assert TB.read_table(spark, path).columns == ["k", "x", "y"] and not os.path.exists(older)


def test_backfill_commits_batches_and_repeats_none(spark, tmp_table_dir):
    done, out = os.path.join(tmp_table_dir, "done"), os.path.join(tmp_table_dir, "out")
    work = spark.range(40).select(F.col("id").alias("mlbam_id"), F.lit(2021).alias("season"))
    ran, fail_at = [], 3

    def run(batch):
        if len(ran) == fail_at:
            raise RuntimeError("killed")
        ran.append({r.mlbam_id for r in batch.collect()})
        TB.append(batch, out)

    with pytest.raises(RuntimeError):
        jobs.backfill(spark, work, done, run, batch_keys=5)
    first = set().union(*ran)
    assert len(ran) == 3 and 0 < len(first) < 40 and TB.read_table(spark, done).count() == len(first)
    fail_at = -1
    assert jobs.backfill(spark, work, done, run, batch_keys=5) == 40 - len(first)
    assert sum(map(len, ran)) == 40 and set().union(*ran) == set(range(40))
    assert sorted(r.mlbam_id for r in TB.read_table(spark, out).collect()) == list(range(40))
    assert jobs.backfill(spark, work, done, run, batch_keys=5) == 0


def _pitcher_rows(spark, data):
    return spark.createDataFrame(data, "mlbam_id long, game_date date, game_pk long, gs int, hr long, bfp long")


def test_lineup_features_recompute_recent_relievers_and_lookback_only(spark, tmp_table_dir):
    as_of = D(2023, 7, 20)
    day = lambda n: as_of - dt.timedelta(days=n)
    pitchers = _pitcher_rows(spark, [
        (10, day(2), 1, 1, 1, 9), (10, day(400), 2, 1, 2, 9), (10, day(300), 3, 1, 2, 9),  # starts today
        (11, day(7), 4, 0, 0, 4), (12, day(8), 5, 0, 0, 4), (13, day(3), 6, 1, 0, 4)])  # reliever in and out of the week; a starter
    batters = spark.createDataFrame([(20, day(1), 1, 1, 4), (21, day(1), 1, 1, 4)], "mlbam_id long, game_date date, game_pk long, hr long, ab long")
    for c in ("bb", "h", "hbp", "sf", "x2b", "x3b", "hr_vs_r", "ab_vs_r", "hr_vs_l", "ab_vs_l", "barrels", "hard_hits", "sweet_spots", "batted_balls"):
        batters = batters.withColumn(c, F.lit(1).cast("long"))
    for c in ("ev_sum", "est_woba", "est_slg"):
        batters = batters.withColumn(c, F.lit(1.0))
    lineups = spark.createDataFrame([(900, 20, "batter"), (900, 10, "pitcher")], "game_pk long, player_id long, role string")
    tables = {k: os.path.join(tmp_table_dir, k) for k in ("batter", "pitcher")}
    marks = os.path.join(tmp_table_dir, "marks")
    args = (spark, lineups, {"batter": batters, "pitcher": pitchers}, tables, marks, as_of, dt.datetime(2023, 7, 20, 9))
    assert jobs.lineup_features(*args) == 1
    got = TB.read_table(spark, tables["pitcher"])
    assert rows(got, "mlbam_id", "game_date") == rows(pitchers.where(
        F.col("game_pk").isin(1, 3, 4)), "mlbam_id", "game_date")
    newest = got.where("mlbam_id = 10").orderBy(F.col("game_date").desc()).first()
    assert newest.rollsum_hr_10 == 4  # the window reaches behind the lookback
    assert rows(TB.read_table(spark, tables["batter"]), "mlbam_id") == ["(20,)"]
    before = files(tables["pitcher"])
    assert jobs.lineup_features(*args) == 0 and files(tables["pitcher"]) == before
    changed = spark.createDataFrame([(900, 20, "batter"), (900, 13, "pitcher")], lineups.schema)
    assert jobs.lineup_features(spark, changed, *args[2:], lookback_days=5, reliever_days=0) == 1
    touched = {os.path.basename(os.path.dirname(f)) for f in files(tables["pitcher"]) - before}
    assert touched == {f"game_date={day(3)}"}


def test_full_recompute_drops_rows_of_removed_games(spark, tmp_table_dir):
    games = _pitcher_rows(spark, [(1, D(2023, 7, d), d, 1, 1, 9) for d in range(1, 5)])
    table = os.path.join(tmp_table_dir, "f")
    assert jobs.write_features(spark, games, "pitcher", table, allow_full_recompute=True) == "written"
    assert jobs.write_features(spark, games.where("game_pk < 4"), "pitcher", table, game_date=D(2023, 7, 3)) == "written"
    assert TB.read_table(spark, table).count() == 4
    before = files(table)
    jobs.write_features(spark, games, "pitcher", table, game_date=D(2023, 7, 2))
    assert {os.path.basename(os.path.dirname(f)) for f in files(table) - before} == {"game_date=2023-07-02"}
    jobs.write_features(spark, games.where("game_pk < 4"), "pitcher", table, allow_full_recompute=True)
    assert rows(TB.read_table(spark, table), "game_pk") == ["(1,)", "(2,)", "(3,)"]


def test_bad_log_lines_are_set_apart(spark, tmp_table_dir):
    schema = G.gamelog_schema(["date", "team_v", "park", "score"], ["score"], ["date"])
    a, b = os.path.join(tmp_table_dir, "GL2001.TXT"), os.path.join(tmp_table_dir, "GL2002.TXT")
    with open(a, "w") as f:
        f.write('20010401,"BOS","Park, The",3\r\n\n20010402,"BOS","open,4\n20010403,"BOS",5\n20010404,"BOS","x",6,7\n')
    with open(b, "w") as f:
        f.write('2002-04-01,"BOS","x",1\n20020402,"NYA","",\n20020403,"NYA","x",many\n')
    lines = G.checked_lines(spark, [a, b], schema)
    assert rows(G.good_rows(lines)) == ["(20010401, 'BOS', 'Park, The', 3.0)", "(20020402, 'NYA', None, None)"]
    assert rows(G.rejected(lines), "reason", "line") == sorted(map(str, [
        ("quote", '20010402,"BOS","open,4'), ("short", '20010403,"BOS",5'), ("long", '20010404,"BOS","x",6,7'),
        ("value", '2002-04-01,"BOS","x",1'), ("value", '20020403,"NYA","x",many')]))
    counts = {os.path.basename(r.file): tuple(r)[1:] for r in G.line_counts(lines).collect()}
    assert counts == {"GL2001.TXT": (4, 1, 1, 1, 1, 0), "GL2002.TXT": (3, 1, 0, 0, 0, 2)}
    with pytest.raises(ValueError, match="not available"):
        G.checked_lines(spark, [a, os.path.join(tmp_table_dir, "GL1899.TXT")], schema)


def test_full_log_schema_and_names(spark, tmp_table_dir):
    schema = G.full_schema()
    assert len(schema) == 161 and schema.names[19:22] == ["visiting_line_score", "home_line_score", "visiting_abs"]
    assert schema.names[-3:] == ["home_9_pos", "misc", "acquisition_info"]
    path = os.path.join(tmp_table_dir, "GL2001.TXT")
    values = [str(i) if f.dataType.typeName() != "string" else f'"v{i}"' for i, f in enumerate(schema.fields)]
    values[0] = "20010401"
    with open(path, "w") as f:
        f.write(",".join(values) + "\n")
    game = G.season_rows(G.good_rows(G.checked_lines(spark, path, schema))).first().asDict()
    assert game["date"] == D(2001, 4, 1) and game["season"] == 2001
    assert (game["team_v"], game["team_h"], game["AB_v"], game["AB_h"], game["ERR_h"], game["batter9_pos_h"]) == ("v3", "v6", 21.0, 49.0, 73.0, 158.0)
    assert not set(G.GAMELOG_DROPPED) & set(game) and {"duration", "manager_h", "starting_pitcher_id_v", "runs_h"} <= set(game)


def test_season_backfill_is_taken_up_after_a_kill(spark, tmp_table_dir):
    from fieldline.plans.jobs import season_backfill, season_games
    games, odds_log = game_log_view(spark, SF).cache(), odds_log_view(spark, SF)
    table, done = os.path.join(tmp_table_dir, "seasons"), os.path.join(tmp_table_dir, "done")
    seasons = sorted(r[0] for r in games.select("season").distinct().collect())
    read, broken = [], {seasons[2]}

    def one(season):
        read.append(season)
        if season in broken:
            raise RuntimeError("killed")
        return games.where(F.col("season") == season)

    args = (spark, seasons, one, odds_log, table, done, "logs", dt.datetime(2024, 1, 1), 1998)
    with pytest.raises(RuntimeError):
        season_backfill(*args, seasons_per_batch=1)
    stored = [s for s in read if s not in broken]
    broken.clear()
    summary = season_backfill(*args, seasons_per_batch=1)
    assert not set(stored) & set(read[len(stored) + 1:])  # no finished season is read again
    want = season_games(games, odds_log, 1998)
    assert rows(TB.read_table(spark, table).select(*want.columns)) == rows(want)
    assert rows(summary) == rows(want.groupBy("season").count())
    assert games_keyed(spark, SF).count() >= want.count()
