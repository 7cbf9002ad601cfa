"""Hand-computed rollups, rolling windows against pandas, no-leak and plan-shape checks."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldline.functions import constants as K
from fieldline.operators import rollup, rolling

PITCH_COLS = ("batter long, pitcher long, game_date date, game_pk long, at_bat_number int, "
              "pitch_number int, inning int, inning_topbot string, home_team string, "
              "away_team string, stand string, p_throws string, events string, "
              "launch_speed double, launch_angle double, launch_speed_angle int, "
              "estimated_woba_using_speedangle double, estimated_slg_using_speedangle double, "
              "age_bat double, bat_score int, post_bat_score int, bb_type string")
D1, D2 = dt.date(2023, 7, 15), dt.date(2023, 7, 16)


def pitch(batter, game, day, ab, pn, inning, half, ev=None, ls=None, la=None, lsa=None,
          woba=None, slg=None, age=None, pre=0, post=0, bbt=None, pitcher=9, throws="R"):
    return (batter, pitcher, day, game, ab, pn, inning, half, "NYY", "BOS", "L", throws, ev, ls,
            la, lsa, woba, slg, age, pre, post, bbt)


@pytest.fixture()
def pitches(spark):
    rows = [
        # game 1: batter 1 at home (Bot), a non-terminal pitch, a home run, a walk
        pitch(1, 100, D1, 1, 1, 1, "Bot", age=None),
        pitch(1, 100, D1, 1, 2, 1, "Bot", "home_run", 100.0, 25.0, 6, 2.0, 4.0, 30.0, 0, 1,
              "fly_ball"),
        pitch(1, 100, D1, 5, 1, 3, "Bot", "walk", age=31.0),
        # game 2 same day (doubleheader): empty event string and an out, opposite hand
        pitch(1, 101, D1, 2, 1, 2, "Top", "", throws="L"),
        pitch(1, 101, D1, 3, 1, 2, "Top", "field_out", 80.0, 5.0, 2, 0.25, None, pre=2, post=1,
              bbt="ground_ball", throws="L"),
        # game 3: no terminal event at all -> dropped
        pitch(1, 102, D2, 1, 1, 1, "Top"),
    ]
    return spark.createDataFrame(rows, PITCH_COLS)


def test_batter_rollup_hand_computed(pitches):
    out = {r["game_pk"]: r for r in rollup.batter_game_rollup(pitches).collect()}
    assert set(out) == {100, 101}
    g1 = out[100]
    assert (g1.is_home, g1.opponent, g1.opp_is_starter) == (1, "BOS", 1)
    assert (g1.ab, g1.h, g1.hr, g1.bb, g1.batted_balls, g1.hard_hits, g1.sweet_spots) == (
        1, 1, 1, 1, 1, 1, 1)
    assert (g1.barrels, g1.ev_sum, g1.est_woba, g1.est_slg, g1.age) == (1, 100.0, 2.0, 4.0, 30.0)
    assert (g1.hr_vs_r, g1.ab_vs_r, g1.hr_vs_l, g1.ab_vs_l) == (1, 1, 0, 0)
    g2 = out[101]
    assert (g2.is_home, g2.opponent, g2.opp_is_starter, g2.p_throws) == (0, "NYY", 0, "L")
    assert (g2.ab, g2.h, g2.batted_balls, g2.est_slg, g2.age) == (1, 0, 1, 0.0, None)
    assert (g2.ab_vs_l, g2.ab_vs_r) == (1, 0)


def test_pitcher_rollup_hand_computed(pitches):
    out = {r["game_pk"]: r for r in rollup.pitcher_game_rollup(pitches).collect()}
    g1, g2 = out[100], out[101]
    assert (g1.bfp, g1.hr, g1.bb, g1.h, g1.r, g1.er, g1.outs, g1.fly_balls) == (2, 1, 1, 1, 1, 1,
                                                                               0, 1)
    assert g1.is_home_pitcher == 0 and g1.gs == 1
    # clamped: post - pre = -1 counts as 0 runs; one out
    assert (g2.bfp, g2.r, g2.outs, g2.is_home_pitcher) == (1, 0, 1, 1)
    assert math.isclose(g2.ip, 1 / 3)


def _pandas_lenient(s: pd.Series, w: int) -> pd.Series:
    return s.rolling(window=w, min_periods=1).sum().shift(1)


def _pandas_strict(s: pd.Series, w: int) -> pd.Series:
    return s.rolling(w, closed="left").sum()


@pytest.mark.parametrize("strict", [False, True])
def test_rolling_sums_match_pandas(spark, strict):
    rnd = random.Random(7)
    rows = []
    for ent in range(4):
        for i in range(rnd.randint(1, 30)):
            v = None if rnd.random() < 0.2 else rnd.randint(0, 5)
            f = None if rnd.random() < 0.2 else rnd.randint(0, 40) / 8
            rows.append((ent, i, v, f))
    df = spark.createDataFrame(rows, "e long, t long, v long, f double")
    windows = [1, 3, 7]
    out = rolling.rolling_sums(df, ["v", "f"], windows, "e", ["t"], strict=strict).toPandas()
    pdf = pd.DataFrame(rows, columns=["e", "t", "v", "f"]).sort_values(["e", "t"])
    out = out.sort_values(["e", "t"]).reset_index(drop=True)
    for w in windows:
        for c in ("v", "f"):
            fn = _pandas_strict if strict else _pandas_lenient
            exp = pdf.groupby("e")[c].transform(lambda s, w=w: fn(s.astype(float), w))
            got = out[f"rollsum_{c}_{w}"].astype(float)
            pd.testing.assert_series_equal(got.reset_index(drop=True),
                                           exp.reset_index(drop=True), check_names=False)


@pytest.mark.parametrize("strict", [False, True])
def test_rolling_sums_of_general_doubles(spark, strict):
    """Huge values, NaN, NULL and decimal fractions: what leaves a window leaves no trace."""
    nan = float("nan")
    values = [1e16, 1.0, 2.0, 3.0, 0.1, 0.2, nan, 0.3, None, 0.7, -1e300, 1.1, 2.2, 3.3]
    rows = [(1, i, v) for i, v in enumerate(values)] + [(2, i, 0.1 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "e long, t long, f double")
    out = rolling.rolling_sums(df, ["f"], [2, 3], "e", ["t"], strict=strict).orderBy("e", "t").collect()
    for r in out:
        for w in (2, 3):
            past = [v for e, t, v in rows if e == r.e and r.t - w <= t < r.t]
            held = [v for v in past if v is not None and not math.isnan(v)]
            want = sum(held) if len(held) >= (w if strict else 1) else None
            got = r[f"rollsum_f_{w}"]
            assert got is None if want is None else math.isclose(got, want, rel_tol=1e-12)


def test_season_scope_keeps_one_exchange(spark):
    rows = [(e, dt.date(2019 + i // 6, 1, 1 + i % 6), i, i % 2, 1.5) for e in range(3) for i in range(12)]
    games = spark.createDataFrame(rows, "mlbam_id long, game_date date, game_pk long, hr long, ev_sum double")
    games = games.withColumn("_season", F.year("game_date"))
    df = rolling.rolling_sums(games, ["hr", "ev_sum"], [3], ["mlbam_id", "_season"], ["game_date", "game_pk"])
    df = rolling.last_non_null_per_key(df, ["mlbam_id", "_season", "game_date"], ["game_pk"])
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_no_leak(spark):
    """Changing a row's own value or later rows never changes its features."""
    rows = [(1, i, i % 3) for i in range(20)]
    base = rolling.rolling_sums(spark.createDataFrame(rows, "e long, t long, v long"), ["v"],
                                [5], "e", ["t"]).orderBy("t").collect()
    changed = [(e, t, v + 100 if t >= 10 else v) for e, t, v in rows]
    after = rolling.rolling_sums(spark.createDataFrame(changed, "e long, t long, v long"), ["v"],
                                 [5], "e", ["t"]).orderBy("t").collect()
    for a, b in zip(base[:11], after[:11]):
        assert a["rollsum_v_5"] == b["rollsum_v_5"]


def test_last_non_null_per_day(spark):
    rows = [(1, D1, 10, 1.0, None), (1, D1, 11, None, "b"), (1, D2, 12, None, None)]
    df = spark.createDataFrame(rows, "id long, d date, g long, x double, s string")
    out = {r["d"]: r for r in rolling.last_non_null_per_key(df, ["id", "d"], ["g"]).collect()}
    assert (out[D1].g, out[D1].x, out[D1].s) == (11, 1.0, "b")
    assert (out[D2].x, out[D2].s) == (None, None)


def _exec_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_window_plan_has_one_exchange(spark):
    rows = [(e, dt.date(2020, 1, 1) + dt.timedelta(days=i), i, i % 2, 1.5)
            for e in range(5) for i in range(12)]
    games = spark.createDataFrame(rows, "mlbam_id long, game_date date, game_pk long, hr long, "
                                        "ev_sum double")
    df = rolling.rolling_sums(games, ["hr", "ev_sum"], K.BATTER_WINDOWS, "mlbam_id",
                              ["game_date", "game_pk"])
    df = rolling.last_non_null_per_key(df, ["mlbam_id", "game_date"], ["game_pk"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_smoothed_rates_first_game_null(spark):
    rows = [(1, dt.date(2020, 1, d), d, 3, 9, 1, 0, 1, 2, 1, 0, 0, 1, 4) for d in range(1, 4)]
    games = spark.createDataFrame(rows, "mlbam_id long, game_date date, game_pk long, outs long, "
                                        "bfp long, h long, bb long, so long, hr long, er long, "
                                        "x2b long, x3b long, fly_balls long, "
                                        "batted_balls_allowed long")
    out = rolling.pitcher_rolling_features(games, windows=[10]).orderBy("game_date").collect()
    assert out[0]["whip_10"] is None and out[0]["era_10"] is None
    # second game: ip = 1, padded to 30 innings: (1 + 1.5 * 29) / 30
    assert math.isclose(out[1]["whip_10"], (1 + 1.5 * 29) / 30)
    assert math.isclose(out[1]["so_perc_10"], (1 + 0.2 * (120 - 9)) / 120)
