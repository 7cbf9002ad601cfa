"""Table maintenance idempotence, payload flattening, odds and team operators."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from fieldline.functions.scalar import line_to_prob, roster_hash
from fieldline.operators import merge as M
from fieldline.operators import odds as O
from fieldline.operators import team as T
from fieldline.sources import payloads as P
from fieldline.sources import tables as TB

D1, D2 = dt.date(2023, 7, 15), dt.date(2023, 7, 16)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_exact_keys_and_idempotent(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "games")
    base = spark.createDataFrame([(1, D1, 10, 1), (1, D2, 11, 2), (2, D1, 12, 3)],
                                 "id long, d date, g long, v long")
    TB.overwrite(base, path, ["d"])
    # key (1, D1, 99) is new: the 3-key fast path of the source would have deleted (1, D1, 10)
    src = spark.createDataFrame([(1, D1, 99, 7), (2, D1, 12, 30)], "id long, d date, g long, v long")
    TB.upsert_table(spark, src, path, ["id", "d", "g"], partition_by=["d"])
    once = rows_of(TB.read_table(spark, path).select("id", "d", "g", "v"))
    TB.upsert_table(spark, src, path, ["id", "d", "g"], partition_by=["d"])
    twice = rows_of(TB.read_table(spark, path).select("id", "d", "g", "v"))
    assert once == twice == sorted([(1, D1, 10, 1), (1, D2, 11, 2), (2, D1, 12, 30),
                                    (1, D1, 99, 7)])


def test_replace_slice_idempotent(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "pitches")
    TB.overwrite(spark.createDataFrame([(D1, 1), (D1, 2), (D2, 3)], "d date, v long"), path, ["d"])
    src = spark.createDataFrame([(D1, 5)], "d date, v long")
    TB.replace_slice_table(spark, src, path, ["d"])
    TB.replace_slice_table(spark, src, path, ["d"])
    assert rows_of(TB.read_table(spark, path).select("d", "v")) == [(D1, 5), (D2, 3)]


def test_merge_insert_only_rerun_adds_nothing(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "bvp")
    TB.append(spark.createDataFrame([(1, 2, 10, 1)], "b long, p long, g long, pa long"), path)
    src = spark.createDataFrame([(1, 2, 10, 5), (1, 2, 11, 1)], "b long, p long, g long, pa long")
    assert TB.merge_insert_only_table(spark, src, path, ["b", "p", "g"]) == 1
    assert TB.merge_insert_only_table(spark, src, path, ["b", "p", "g"]) == 0
    assert rows_of(TB.read_table(spark, path)) == [(1, 2, 10, 1), (1, 2, 11, 1)]


def test_merge_update_insert(spark):
    tgt = spark.createDataFrame([(1, "a", D1), (2, "b", D1)], "g long, h string, d date")
    src = spark.createDataFrame([(2, "c", D2), (3, "d", D2)], "g long, h string, d date")
    out = M.merge_update_insert(tgt, src, ["g"], ["h"])
    assert rows_of(out) == [(1, "a", D1), (2, "c", D1), (3, "d", D2)]


def test_widen_schema(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "wide")
    TB.overwrite(spark.createDataFrame([(1, 2)], "a long, b long"), path)
    TB.widen_table(spark, spark.createDataFrame([(3, 4, 5)], "a long, b long, c long"), path)
    assert rows_of(TB.read_table(spark, path).select("a", "b", "c")) == [(1, 2, None), (3, 4, 5)]


def test_append_empty_is_noop(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "empty")
    assert TB.append(spark.createDataFrame([], "a long"), path) == 0
    assert not os.path.exists(path)


def test_dedup_latest_keeps_newest(spark):
    df = spark.createDataFrame([(1, 1, 1, 5), (1, 1, 2, 6), (2, 1, 1, 7)], "k long, a long, ts long, v long")
    assert rows_of(M.dedup_latest(df, ["k", "a"], ["ts"])) == [(1, 1, 2, 6), (2, 1, 1, 7)]


def test_flatten_schedule(spark):
    doc = {"dates": [{"date": "2023-07-15", "games": [
        {"gamePk": 1, "status": {"abstractGameState": "Final"},
         "teams": {"home": {"score": 5, "team": {"abbreviation": "NYY"}},
                   "away": {"score": 3, "team": {"abbreviation": "BOS"}}}},
        {"gamePk": 2, "status": {"abstractGameState": "Final"},
         "teams": {"home": {"team": {"abbreviation": "CHW"}},
                   "away": {"score": 2, "team": {"abbreviation": "HOU"}}}},
        {"gamePk": 3, "status": {"abstractGameState": "Preview"},
         "teams": {"home": {"team": {"abbreviation": "SEA"}},
                   "away": {"team": {"abbreviation": "OAK"}}}}]}]}
    docs = P.parse(spark.createDataFrame([(json.dumps(doc),)], "payload string"), "payload",
                   P.SCHEDULE_SCHEMA)
    out = {r.game_pk: r for r in P.flatten_schedule(docs).collect()}
    assert set(out) == {1, 2}
    assert (out[1].runs_h, out[1].runs_v, out[1].home_victory, out[1].run_diff) == (5, 3, 1, 2)
    assert (out[2].runs_h, out[2].home_victory, out[2].run_diff) == (0, 0, -2)


def test_flatten_boxscore_and_lineups(spark):
    box = {"teams": {"home": {"players": {"ID1": {"person": {"id": 1}, "position": {"abbreviation": "P"}},
                                          "ID2": {"person": {"id": 2}, "position": {"abbreviation": "SS"}}}},
                     "away": {"players": {"ID0": {"person": {"id": 0}, "position": {"abbreviation": "C"}},
                                          "ID2": {"person": {"id": 2}, "position": {"abbreviation": "SS"}}}}}}
    docs = P.parse(spark.createDataFrame([(7, json.dumps(box))], "game_pk long, t string"), "t",
                   P.BOXSCORE_SCHEMA)
    assert rows_of(P.flatten_boxscore(docs)) == [(7, "batter", 2), (7, "pitcher", 1)]
    sched = {"dates": [{"games": [
        {"gamePk": 8, "lineups": {"homePlayers": [{"id": 3, "primaryPosition": {"abbreviation": "P"}}],
                                  "awayPlayers": [{"id": 4, "primaryPosition": {"abbreviation": "CF"}}]},
         "teams": {"home": {"probablePitcher": {"id": 5}}, "away": {}}},
        {"gamePk": 9, "lineups": {"homePlayers": [{"id": 6}]}}]}]}
    docs = P.parse(spark.createDataFrame([(json.dumps(sched),)], "t string"), "t", P.SCHEDULE_SCHEMA)
    assert rows_of(P.flatten_lineups(docs)) == [(8, "batter", 4), (8, "pitcher", 3), (8, "pitcher", 5)]


def test_roster_hash_matches_python(spark):
    import hashlib

    ids = [10, 9, 100]
    exp = hashlib.md5("|".join(sorted(map(str, ids))).encode()).hexdigest()
    got = spark.createDataFrame([(ids,)], "ids array<long>").select(roster_hash("ids")).first()[0]
    assert got == exp


def test_line_to_prob(spark):
    df = spark.createDataFrame([(-150.0,), (150.0,), (0.0,)], "line double")
    got = [r[0] for r in df.select(line_to_prob("line")).collect()]
    assert got == pytest.approx([0.6, 0.4, 0.5])


def test_doubleheader_number_and_odds_join(spark):
    log = spark.createDataFrame(
        [("NYA", 2022, D1, "REG", -120.0, 8.5, "O", 1), ("NYA", 2022, D1, "REG", 110.0, 9.0, "U", 2),
         ("NYA", 2022, D2, "REG", 100.0, 7.5, "U", 3), ("NYA", 2022, D2, "POST", 100.0, 7.5, "U", 4),
         ("BOS", 2022, D2, "REG", -100.0, 7.5, "U", 1)],
        "team_source string, season int, Date date, Game string, Line double, Total double, "
        "OU string, source_row long")
    odds = O.prepare_odds_log(log)
    keys = {(r.team_source, r.date_dblhead) for r in odds.collect()}
    assert keys == {("NYA", 202307151), ("NYA", 202307152), ("NYA", 202307160), ("BOS", 202307160)}
    games = spark.createDataFrame([(1, 2022, "NYA", "BOS", 202307160), (2, 2022, "NYA", "TEX", 202307151),
                                   (3, 2021, "NYA", "BOS", 202107160), (4, 2022, "SEA", "BOS", 202307160)],
                                  "game_pk long, season int, team_h string, team_v string, date_dblhead long")
    out = {r.game_pk: r for r in O.odds_join(games, odds).collect()}
    assert set(out) == {1, 2, 3}  # game 4: home odds missing in a looked-up season -> dropped
    assert out[1].implied_prob_h == pytest.approx(0.5) and out[1].implied_prob_v == pytest.approx(0.5)
    assert out[2].implied_prob_v == 0.0 and out[2].implied_prob_h_mid == pytest.approx((0.5454545 + 1) / 2)
    assert (out[3].implied_prob_h, out[3].implied_prob_h_mid, out[3].over_under_result) == (0.0, 0.5, "")


def test_unpivot_covers_team_that_never_visits(spark):
    games = spark.createDataFrame([(1, "A", "B", 3, 4), (2, "A", "C", 1, 2)],
                                  "game_pk long, team_h string, team_v string, H_h long, H_v long")
    rows = rows_of(T.unpivot_sides(games).select("team", "game_pk", "H", "home_game", "opponent"))
    assert rows == [("A", 1, 3, 1, "B"), ("A", 2, 1, 1, "C"), ("B", 1, 4, 0, "A"), ("C", 2, 2, 0, "A")]


def test_season_stats_with_text_values(spark):
    docs = spark.createDataFrame([(
        '{"stats":[{"splits":[{"player":{"id":5},"stat":{"plateAppearances":600,"avg":".300"}},'
        '{"player":{"id":6},"stat":{"plateAppearances":12}},{"player":{"id":7},"stat":{"avg":"-"}}]}]}',)], "j string")
    from fieldline.sources import payloads

    out = payloads.flatten_season_stats(payloads.parse(docs, "j", payloads.SEASON_STATS_SCHEMA), "plateAppearances")
    assert sorted(tuple(r) for r in out.collect()) == [(5, 600), (6, 12), (7, None)]
