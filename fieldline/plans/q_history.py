"""Registered queries: team game logs, team windows, pre-game features and odds."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldline.functions import constants as K
from fieldline.functions.scalar import line_to_prob, yyyymmdd
from fieldline.operators import odds as O
from fieldline.operators import team as T
from fieldline.operators.rollup import bucket_rate
from fieldline.plans import sqlgen as S
from fieldline.plans.registry import register, with_pitches
from fieldline.plans.views import GAME_LOG_SQL, ODDS_LOG_SQL, SIDE_STATS, game_log_view, odds_log_view, tasks_for

# Odds are looked up from this season on in the registered queries (the driver data spans
# 1995-2001); the operator's default stays the source's 2022.
ODDS_FIRST_SEASON_DRIVER = 1998

DATE_DBLHEAD_SQL = "CAST(strftime(date, '%Y%m%d') || CAST(game_num AS VARCHAR) AS BIGINT)"
TEAM_COLS = ["game_pk", "date", "season", "game_num", "home_score", "visiting_score",
             "date_dblhead", "run_diff", "home_victory", "run_total"]


def games_keyed(spark, sf_dir):
    g = T.game_outcome(game_log_view(spark, sf_dir))
    return T.with_game_key(g)


GAMES_KEYED_SQL = f"""
gk AS (
  SELECT *, {DATE_DBLHEAD_SQL} AS date_dblhead,
    home_score - visiting_score AS run_diff,
    CAST(home_score - visiting_score > 0 AS INTEGER) AS home_victory,
    home_score + visiting_score AS run_total
  FROM games
)"""


# --- F6, F7, F9: game key and outcome -----------------------------------------------------------
@register("game_outcome", with_pitches(GAME_LOG_SQL, GAMES_KEYED_SQL, body="""
SELECT game_pk, team_h, team_v, home_score, visiting_score, run_diff, home_victory, run_total
FROM gk"""))
def q_game_outcome(spark, sf_dir):
    return games_keyed(spark, sf_dir).select(
        "game_pk", "team_h", "team_v", "home_score", "visiting_score", "run_diff",
        "home_victory", "run_total")


@register("composite_key", with_pitches(GAME_LOG_SQL, GAMES_KEYED_SQL, body="""
SELECT game_pk, strftime(date, '%Y%m%d') AS date_text, game_num, date_dblhead FROM gk"""))
def q_composite_key(spark, sf_dir):
    return games_keyed(spark, sf_dir).select(
        "game_pk", yyyymmdd("date").alias("date_text"), "game_num", "date_dblhead")


# --- W7, P4, T4: home / visitor unpivot ----------------------------------------------------------
def _side_select(own: str, other: str, home_game: int) -> str:
    cols = [f"{s}_{own} AS {s}" for s in SIDE_STATS] + [f"team_{own} AS team"]
    return (f"SELECT game_pk, date, season, game_num, home_score, visiting_score, date_dblhead, "
            f"run_diff, home_victory, run_total, {', '.join(cols)}, {home_game} AS home_game, "
            f"team_{other} AS opponent FROM gk")


UNPIVOT_SQL = f"""
team_games AS (
  {_side_select('h', 'v', 1)}
  UNION ALL
  {_side_select('v', 'h', 0)}
)"""


@register("unpivot_sides", with_pitches(GAME_LOG_SQL, GAMES_KEYED_SQL, UNPIVOT_SQL,
                                        body="SELECT * FROM team_games"))
def q_unpivot_sides(spark, sf_dir):
    return T.unpivot_sides(games_keyed(spark, sf_dir))


# --- W6: strict team windows per season ----------------------------------------------------------
def _team_rolling_cte() -> str:
    part, order = "team, season", "date_dblhead, game_pk"
    sums = [f"{S.lagged_sum(c, w, part, order, True, strict=True)} AS rollsum_{c}_{w}"
            for w in K.TEAM_WINDOWS for c in K.TEAM_SUM_COLUMNS]
    rates = []
    for w in K.TEAM_WINDOWS:
        g = lambda c: f"rollsum_{c}_{w}"
        slg = S.sdiv(f"({g('H')} + {g('x2B')} + 2 * {g('x3B')} + 3 * {g('HR')})", g("AB"))
        obp = S.sdiv(f"({g('H')} + {g('BB')})", f"({g('BB')} + {g('AB')})")
        rates += [f"{S.sdiv(g('H'), g('AB'))} AS rollsum_BATAVG_{w}", f"{obp} AS rollsum_OBP_{w}",
                  f"{slg} AS rollsum_SLG_{w}", f"({obp} + {slg}) AS rollsum_OBS_{w}"]
    return f"""
ts AS (SELECT *, {', '.join(sums)} FROM team_games),
team_stats AS (SELECT *, {', '.join(rates)} FROM ts)"""


def team_stats(spark, sf_dir):
    return T.team_rolling(T.unpivot_sides(games_keyed(spark, sf_dir)),
                          order=["date_dblhead", "game_pk"])


@register("team_rolling", with_pitches(GAME_LOG_SQL, GAMES_KEYED_SQL, UNPIVOT_SQL,
                                       _team_rolling_cte(), body="SELECT * FROM team_stats"))
def q_team_rolling(spark, sf_dir):
    return team_stats(spark, sf_dir)


# --- W8 + J2: both teams' pre-game features on every game ----------------------------------------
def _pregame_sql(stats=T.TEAM_STATS) -> str:
    names = [f"rollsum_{s}_{w}" for w in K.TEAM_WINDOWS for s in stats]
    hs = ", ".join(f"h.{n} AS {n[8:]}_h" for n in names)
    vs = ", ".join(f"v.{n} AS {n[8:]}_v" for n in names)
    return with_pitches(GAME_LOG_SQL, GAMES_KEYED_SQL, UNPIVOT_SQL, _team_rolling_cte(), body=f"""
SELECT g.*, {hs}, {vs}
FROM gk g
LEFT JOIN team_stats h ON h.season = g.season AND h.game_pk = g.game_pk AND h.team = g.team_h
LEFT JOIN team_stats v ON v.season = g.season AND v.game_pk = g.game_pk AND v.team = g.team_v""")


@register("pregame_team_features", _pregame_sql())
def q_pregame_team_features(spark, sf_dir):
    games = games_keyed(spark, sf_dir)
    sides = T.unpivot_sides(games).repartition(tasks_for(spark, sf_dir, "orders"), "team", "season")
    stats = T.team_rolling(sides, order=["date_dblhead", "game_pk"])
    return T.games_with_features(stats, games.columns)


@register("two_sided_lookup", with_pitches(GAME_LOG_SQL, GAMES_KEYED_SQL, UNPIVOT_SQL,
                                           _team_rolling_cte(), body="""
SELECT g.game_pk, g.team_h, g.team_v, h.rollsum_runs_30 AS runs_30_h, v.rollsum_runs_30 AS runs_30_v
FROM gk g
LEFT JOIN team_stats h ON h.season = g.season AND h.game_pk = g.game_pk AND h.team = g.team_h
LEFT JOIN team_stats v ON v.season = g.season AND v.game_pk = g.game_pk AND v.team = g.team_v"""))
def q_two_sided_lookup(spark, sf_dir):
    out = T.pregame_team_features(
        games_keyed(spark, sf_dir).select("game_pk", "season", "team_h", "team_v"),
        team_stats(spark, sf_dir), windows=[30], stats=["runs"])
    return out.select("game_pk", "team_h", "team_v", "runs_30_h", "runs_30_v")


# --- A17: bucketed win rate ----------------------------------------------------------------------
@register("bucket_rate", with_pitches(GAME_LOG_SQL, GAMES_KEYED_SQL, UNPIVOT_SQL,
                                      _team_rolling_cte(), body=f"""
SELECT CASE WHEN h.rollsum_OBP_30 >= 0.34 THEN 'Hot' ELSE 'Cold' END AS home_obp_status,
  count(*) AS games, {S.rnd('avg(g.home_victory) * 100', 1)} AS home_win_pct
FROM gk g
LEFT JOIN team_stats h ON h.season = g.season AND h.game_pk = g.game_pk AND h.team = g.team_h
GROUP BY 1"""))
def q_bucket_rate(spark, sf_dir):
    f = T.pregame_team_features(games_keyed(spark, sf_dir), team_stats(spark, sf_dir),
                                windows=[30], stats=["OBP"])
    bucket = F.when(F.col("OBP_30_h") >= 0.34, "Hot").otherwise("Cold")
    return bucket_rate(f, bucket, "home_victory", "home_obp_status", "games", "home_win_pct")


# --- W10, W11, F1: odds log numbering and implied probability ----------------------------------
ODDS_NUMBERED_SQL = f"""
odds_reg AS (
  SELECT *, strftime("Date", '%Y%m%d') AS date_numeric FROM odds_log WHERE "Game" = 'REG'
),
odds_num AS (
  SELECT *,
    row_number() OVER (PARTITION BY team_source, season ORDER BY "Date", source_row) AS game_no,
    coalesce(CAST(date_numeric = lead(date_numeric) OVER (PARTITION BY team_source, season
             ORDER BY "Date", source_row) AS INTEGER), 0)
    + 2 * coalesce(CAST(date_numeric = lag(date_numeric) OVER (PARTITION BY team_source, season
             ORDER BY "Date", source_row) AS INTEGER), 0) AS dblheader_num,
    (CAST(1 AS DOUBLE) - sign("Line")) / 2 + sign("Line") * (100 / (abs("Line") + 100))
      AS prob_implied
  FROM odds_reg
)"""


def odds_numbered(spark, sf_dir):
    log = odds_log_view(spark, sf_dir).filter(F.col("Game") == "REG")
    log = log.withColumn("date_numeric", yyyymmdd("Date"))
    out = T.doubleheader_number(log, ["team_source", "season"], ["Date", "source_row"])
    return out.withColumn("prob_implied", line_to_prob("Line"))


@register("game_numbers", with_pitches(GAME_LOG_SQL, ODDS_LOG_SQL, ODDS_NUMBERED_SQL, body="""
SELECT team_source, season, source_row, game_no FROM odds_num"""))
def q_game_numbers(spark, sf_dir):
    return odds_numbered(spark, sf_dir).select("team_source", "season", "source_row", "game_no")


@register("doubleheader_number", with_pitches(GAME_LOG_SQL, ODDS_LOG_SQL, ODDS_NUMBERED_SQL,
                                              body="""
SELECT team_source, season, source_row, dblheader_num,
  CAST(date_numeric || CAST(dblheader_num AS VARCHAR) AS BIGINT) AS date_dblhead
FROM odds_num"""))
def q_doubleheader_number(spark, sf_dir):
    from fieldline.functions.scalar import game_key

    return odds_numbered(spark, sf_dir).select(
        "team_source", "season", "source_row", "dblheader_num",
        game_key("date_numeric", "dblheader_num").alias("date_dblhead"))


@register("line_to_prob", with_pitches(GAME_LOG_SQL, ODDS_LOG_SQL, ODDS_NUMBERED_SQL, body="""
SELECT team_source, source_row, "Line" AS line, prob_implied FROM odds_num"""))
def q_line_to_prob(spark, sf_dir):
    return odds_numbered(spark, sf_dir).select(
        "team_source", "source_row", F.col("Line").alias("line"), "prob_implied")


# --- J3, J4, F2, P20, P22: odds enrichment ------------------------------------------------------
def _odds_join_sql() -> str:
    fs = ODDS_FIRST_SEASON_DRIVER
    return with_pitches(GAME_LOG_SQL, GAMES_KEYED_SQL, ODDS_LOG_SQL, ODDS_NUMBERED_SQL, f"""
odds AS (
  SELECT team_source, season,
    CAST(date_numeric || CAST(dblheader_num AS VARCHAR) AS BIGINT) AS date_dblhead,
    first(prob_implied ORDER BY "Date", source_row) AS prob_implied,
    first("Total" ORDER BY "Date", source_row) AS "Total",
    first("OU" ORDER BY "Date", source_row) AS "OU"
  FROM odds_num GROUP BY 1, 2, 3
),
j AS (
  SELECT g.game_pk, g.season, g.team_h, g.team_v, g.date_dblhead,
    CASE WHEN g.season >= {fs} THEN coalesce(h.prob_implied, 0) ELSE 0 END AS ph,
    CASE WHEN g.season >= {fs} THEN coalesce(v.prob_implied, 0) ELSE 0 END AS pv,
    CASE WHEN g.season >= {fs} THEN coalesce(h."Total", 0) ELSE 0 END AS total,
    CASE WHEN g.season >= {fs} THEN coalesce(h."OU", '') ELSE '' END AS ou
  FROM gk g
  LEFT JOIN odds h ON h.season = g.season AND h.date_dblhead = g.date_dblhead
                  AND h.team_source = g.team_h
  LEFT JOIN odds v ON v.season = g.season AND v.date_dblhead = g.date_dblhead
                  AND v.team_source = g.team_v
)""", body=f"""
SELECT game_pk, season, team_h, team_v, date_dblhead,
  CAST(ph AS DOUBLE) AS implied_prob_h, CAST(pv AS DOUBLE) AS implied_prob_v,
  (CAST(ph AS DOUBLE) + (1 - CAST(pv AS DOUBLE))) / 2 AS implied_prob_h_mid,
  CAST(total AS DOUBLE) AS over_under_line, ou AS over_under_result
FROM j WHERE NOT (season >= {fs} AND ph = 0)""")


@register("odds_join", _odds_join_sql())
def q_odds_join(spark, sf_dir):
    games = games_keyed(spark, sf_dir).select("game_pk", "season", "team_h", "team_v",
                                               "date_dblhead")
    odds = O.prepare_odds_log(odds_log_view(spark, sf_dir))
    return O.odds_join(games, odds, first_season=ODDS_FIRST_SEASON_DRIVER)
