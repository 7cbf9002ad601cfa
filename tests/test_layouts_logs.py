"""Co-located tables, pre-filtered key lookups, team log maps, scan counts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fieldline.operators import merge as M
from fieldline.operators import quality as Q
from fieldline.operators import rolling
from fieldline.plans import jobs
from fieldline.plans.q_features import pitcher_games
from fieldline.sources import tables as TB

SF = "/root/testdata/sf0.001"


def rows(df, *cols):
    return sorted(str(tuple(r)) for r in (df.select(*cols) if cols else df).collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_of_a_co_located_table_need_no_exchange(spark, tmp_table_dir):
    path, name = os.path.join(tmp_table_dir, "games"), f"games_{os.path.basename(tmp_table_dir).replace('-', '_')}"
    games = pitcher_games(spark, SF)
    stored = TB.co_located(spark, games, name, path, ["mlbam_id"], ["game_date", "game_pk"], 4)
    feats = rolling.pitcher_rolling_features(stored)
    assert "Exchange" not in plan(feats) and "Window" in plan(feats)
    want = rolling.pitcher_rolling_features(games)
    assert rows(feats.select(*want.columns)) == rows(want)
    history = stored.join(stored.where("gs = 0").select("mlbam_id"), "mlbam_id", "left_semi")
    assert "hashpartitioning" not in plan(history.hint("merge"))
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= 4
    spark.sql(f"DROP TABLE {name}")
    again = TB.attach_co_located(spark, stored.schema, name, path, ["mlbam_id"], ["game_date", "game_pk"], 4)
    assert "Exchange" not in plan(rolling.pitcher_rolling_features(again)) and again.count() == games.count()
    spark.sql(f"DROP TABLE {name}")


def test_new_keys_skip_other_key_ranges_of_the_target(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "t")
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), F.floor(F.col("id") / 1000).cast("int"))
    TB.append(spark.range(0, 20_000, numPartitions=20).select(F.col("id").alias("k"), day.alias("d"), F.lit("a").alias("x")), path)
    new = spark.range(19_990, 20_010).select(F.col("id").alias("k"), F.when(F.col("id") < 20_000, F.lit(dt.date(2020, 1, 20))).alias("d"), F.lit("b").alias("x"))
    out = M.new_rows_only(TB.read_table(spark, path), new, ["k", "d"])
    assert rows(out, "k") == sorted(f"({i},)" for i in range(20_000, 20_010))
    near = M.within_key_ranges(TB.read_table(spark, path), new, ["k", "d"])
    assert near.count() == 10
    assert "scalar-subquery" in plan(near).lower() or "subquery" in plan(near).lower()
    assert TB.merge_insert_only_table(spark, new, path, ["k", "d"]) == 10
    assert TB.merge_insert_only_table(spark, new, path, ["k", "d"]) == 0
    odd = spark.createDataFrame([(None, None, "n"), (None, None, "m"), (5, dt.date(2020, 1, 1), "o")], "k long, d date, x string")
    assert rows(M.new_rows_only(TB.read_table(spark, path), odd, ["k", "d"]), "x") == ["('m',)", "('n',)"]
    assert M.new_rows_only(TB.read_table(spark, path), odd.limit(0), ["k"]).count() == 0


def test_team_logs_under_their_stored_names(spark, tmp_table_dir):
    header = {c: c.split("_")[-1] for c in ("Batting Stats_PA", "Batting Stats_2B", "Batting Stats_BAbip")}
    base = {"Rk": "1", "Team": "BOS", "Season": "2023", "Date": "2023-04-01", "Opp Starter_T": "R", "Score_Inn": ""}
    data = [base | {"Batting Stats_PA": "38", "Batting Stats_2B": "2", "Batting Stats_BAbip": ".301"},
            base | {"Date": "2023-04-02 (2)", "Season": None, "Batting Stats_PA": "x", "Batting Stats_2B": "1", "Batting Stats_BAbip": None},
            base | {"Date": "Date"} | header, base | {"Date": None, "Batting Stats_PA": "76", "Batting Stats_2B": "3", "Batting Stats_BAbip": None}]
    landed = spark.createDataFrame([tuple(r.values()) for r in data], ", ".join(f"`{c}` string" for c in data[0]))
    log = Q.team_log(landed, "batting")
    assert log.columns == ["Team", "Season", "Date", "OppStartThrows", "Inn", "PA", "X2B", "BABIP"]
    assert rows(log, "Team", "Season", "Date", "Inn", "PA", "X2B", "BABIP") == sorted(map(str, [
        ("BOS", 2023, dt.date(2023, 4, 1), None, 38.0, 2.0, 0.301), ("BOS", 2023, dt.date(2023, 4, 2), None, None, 1.0, None)]))
    table = os.path.join(tmp_table_dir, "logs")
    for _ in range(2):
        assert rows(jobs.team_logs(spark, landed, "batting", table, "page", dt.datetime(2024, 1, 1))) == ["(2023, 2)"]
    assert TB.read_table(spark, table).count() == 2
    pitching = Q.team_log_columns("pitching")
    assert len(pitching) == 37 and pitching["Pitching Stats_IS"] == "Inh_Score" and pitching["Score_RA"] == "RA" and pitching["Opp"] == "Opp"
    assert len(Q.team_log_columns("batting")) == 31
    with pytest.raises(ValueError):
        Q.team_log_columns("fielding")


@pytest.mark.parametrize("name, scans", [("odds_join", 2), ("pregame_team_features", 1), ("recent_top", 2), ("dedup_latest", 1), ("rolling_rates", 1)])
def test_pitches_are_scanned_this_often(spark, name, scans):
    text = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("l_orderkey" in line and "parquet" in line for line in text.splitlines()) == scans


def test_dedup_latest_reads_only_what_decides(spark):
    p = spark.createDataFrame([(1, 5, "a", "long text")], "k int, v int, t string, other string")
    text = M.dedup_latest(p, ["k"], ["v"], ["t"], settle_ties=False).select("k", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in text
    assert "xxhash64" in M.dedup_latest(p, ["k"], ["v"], ["t"])._jdf.queryExecution().optimizedPlan().toString()


def test_games_put_together_from_their_sides_equal_the_join(spark):
    from fieldline.operators import team as T
    from fieldline.plans.q_history import games_keyed, team_stats
    games = games_keyed(spark, SF)
    joined = T.pregame_team_features(games, team_stats(spark, SF))
    again = T.games_with_features(team_stats(spark, SF), games.columns)
    assert sorted(again.columns) == sorted(joined.columns) and rows(again.select(*joined.columns)) == rows(joined)
    one = T.games_with_features(team_stats(spark, SF), games.columns, windows=[30], stats=["OBP"])
    assert rows(one, "game_pk", "OBP_30_h", "OBP_30_v") == rows(joined, "game_pk", "OBP_30_h", "OBP_30_v")


def test_season_rows_without_an_id_of_their_own(spark):
    """Log rows carry no game id: a game is its season, key and teams."""
    from fieldline.plans.views import game_log_view, odds_log_view
    games, log = game_log_view(spark, SF), odds_log_view(spark, SF)
    with_id = jobs.season_games(games, log, 1998)
    without = jobs.season_games(games.drop("game_pk"), log, 1998)
    assert with_id.count() == without.count()
    assert rows(without, "season", "date_dblhead", "team_h", "team_v", "AB_h") == rows(with_id, "season", "date_dblhead", "team_h", "team_v", "AB_h")
