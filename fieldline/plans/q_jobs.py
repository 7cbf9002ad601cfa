"""Registered queries that run whole jobs over the driver tables: files and tables are written to the
shared folder, read back, and compared with the plain SQL of what they should hold."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldline.functions import constants as K
from fieldline.operators import intervals, rolling, segments
from fieldline.plans import jobs
from fieldline.plans import sqlgen as S
from fieldline.plans.q_features import _pitcher_features_sql, batter_games, pitcher_games
from fieldline.plans.q_history import (
    ODDS_FIRST_SEASON_DRIVER,
    _odds_join_sql,
    _pregame_sql,
)
from fieldline.plans.q_relational import TEAM_SEASON_SQL, team_seasons
from fieldline.plans.q_sources import schedule_docs
from fieldline.plans.registry import ORACLES, register, with_pitches
from fieldline.plans.views import GAME_LOG_SQL, game_log_view, load, odds_log_view, pitch_view, tasks_for
from fieldline.session import ensure_checkpoint_dir, materialize, shuffles_released, store
from fieldline.sources import gamelogs as G
from fieldline.sources import landed as L
from fieldline.sources import payloads as P
from fieldline.sources import tables as TB

LOADED = dt.datetime(2024, 1, 1)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of the shared storage."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- W1, W2, W12 over a hot entity: a third of all games belong to player 0 ------------------------
HOT_ROWS = 400
HOT_SQL = "hot AS (SELECT CASE WHEN game_pk % 3 = 0 THEN 0 ELSE mlbam_id END AS player, * FROM pg)"


def hot_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = pitcher_games(spark, sf_dir).select("mlbam_id", "game_date", "game_pk", "bfp", "hr", "so", "outs")
    return g.withColumn("player", F.when(F.col("game_pk") % 3 == 0, 0).otherwise(F.col("mlbam_id")).cast("long"))


def _hot_sql(strict: bool) -> str:
    sums = [f"{S.lagged_sum(c, w, 'player', 'game_date, game_pk, mlbam_id', True, strict)} AS rollsum_{c}_{w}"
            for w in K.PITCHER_WINDOWS for c in ("bfp", "hr", "so", "outs")]
    return with_pitches(S.pitcher_game_cte(), HOT_SQL, body=f"""
SELECT player, mlbam_id, game_date, game_pk, bfp, hr, so, outs, {', '.join(sums)} FROM hot""")


def _hot_sums(spark, sf_dir, strict):
    return rolling.rolling_sums(hot_games(spark, sf_dir), ["bfp", "hr", "so", "outs"], K.PITCHER_WINDOWS, "player",
                                ["game_date", "game_pk", "mlbam_id"], strict=strict, rows_per_segment=HOT_ROWS,
                                tasks=tasks_for(spark, sf_dir, "lineitem"))


@register("hot_rolling_sums", _hot_sql(False))
def q_hot_rolling_sums(spark, sf_dir):
    return _hot_sums(spark, sf_dir, False)


@register("hot_strict_rolling_sums", _hot_sql(True))
def q_hot_strict_rolling_sums(spark, sf_dir):
    return _hot_sums(spark, sf_dir, True)


@register("hot_running_totals", with_pitches(S.pitcher_game_cte(), HOT_SQL, body="""
SELECT player, mlbam_id, game_date, game_pk, bfp, hr,
  CAST(sum(bfp) OVER w AS BIGINT) AS total_bfp, CAST(sum(hr) OVER w AS BIGINT) AS total_hr
FROM hot WINDOW w AS (PARTITION BY player ORDER BY game_date, game_pk, mlbam_id)"""))
def q_hot_running_totals(spark, sf_dir):
    g = hot_games(spark, sf_dir).drop("so", "outs")
    return segments.running_totals(g, ["bfp", "hr"], "player", ["game_date", "game_pk", "mlbam_id"], HOT_ROWS,
                                   tasks=tasks_for(spark, sf_dir, "lineitem"))


# --- I5: the newest day's features, rolled from the players' tails ---------------------------------
@register("rolled_day_features", f"""
WITH f AS MATERIALIZED ({_pitcher_features_sql()})
SELECT * FROM f WHERE game_date = (SELECT max(game_date) FROM f)""")
def q_rolled_day_features(spark, sf_dir):
    tail, table, stored = scratch(spark, "tails"), scratch(spark, "features"), scratch(spark, "games")
    TB.overwrite(pitcher_games(spark, sf_dir), stored)  # the job reads a game table, again and again
    games = TB.read_table(spark, stored)
    day = games.agg(F.max("game_date")).first()[0]
    if day is None:
        return rolling.pitcher_rolling_features(games)
    jobs.start_tails(spark, games.where(F.col("game_date") < F.lit(day)), "pitcher", tail)
    jobs.roll_features(spark, games.where(F.col("game_date") == F.lit(day)), "pitcher", tail, table, day)
    return TB.read_table(spark, table)


# --- I6 + J7 + P15: line-ups of the newest day ----------------------------------------------------
@register("lineup_job_features", f"""
WITH f AS MATERIALIZED ({_pitcher_features_sql()}), d AS (SELECT max(game_date) AS day FROM f),
ids AS (
  SELECT mlbam_id FROM f, d WHERE game_date = day
  UNION SELECT mlbam_id FROM f, d WHERE gs = 0 AND game_date < day AND game_date >= day - 7
)
SELECT mlbam_id, game_date, game_pk, rollsum_bfp_10, rollsum_hr_75, era_35 FROM f, d
WHERE mlbam_id IN (SELECT mlbam_id FROM ids) AND game_date >= day - 365""")
def q_lineup_job_features(spark, sf_dir):
    with shuffles_released(spark):
        return _lineup_job_features(spark, sf_dir)


def _lineup_job_features(spark, sf_dir):
    # The job reads its game tables again and again: they are built once, in batches that each release their shuffle files.
    batters, pitchers = (store(*[build(spark, sf_dir, (i, GAME_BATCHES)) for i in range(GAME_BATCHES)]) for build in (batter_games, pitcher_games))
    day = pitchers.agg(F.max("game_date")).first()[0] or dt.date(1970, 1, 1)
    sides = {"batter": batters, "pitcher": pitchers}
    rows = None
    for role, games in sides.items():
        one = games.where(F.col("game_date") == F.lit(day)).select("game_pk", F.col("mlbam_id").alias("player_id"), F.lit(role).alias("role"))
        rows = one if rows is None else rows.unionByName(one)
    base = scratch(spark, "lineups")
    tables = {k: f"{base}/{k}" for k in sides}
    if not jobs.lineup_features(spark, rows, sides, tables, f"{base}/marks", day, LOADED):
        return rolling.pitcher_rolling_features(pitchers).select(*LINEUP_COLUMNS)
    return TB.read_table(spark, tables["pitcher"], columns=LINEUP_COLUMNS)


#: Each batch of games scans the pitches and shuffles its share of them.
GAME_BATCHES = 4
LINEUP_COLUMNS = ["mlbam_id", "game_date", "game_pk", "rollsum_bfp_10", "rollsum_hr_75", "era_35"]


# --- I7: batches of work, half of it done before ---------------------------------------------------
@register("backfill_batches", with_pitches(body="""
SELECT DISTINCT batter AS mlbam_id, game_year AS season, batter % 2 = 0 AS done_before FROM pitches WHERE batter IS NOT NULL"""))
def q_backfill_batches(spark, sf_dir):
    p = pitch_view(spark, sf_dir).where("batter IS NOT NULL")
    work = p.select(F.col("batter").alias("mlbam_id"), F.col("game_year").alias("season")).distinct()
    base = scratch(spark, "backfill")
    done, out = f"{base}/done", f"{base}/out"
    run = lambda before: lambda batch: TB.append(batch.withColumn("done_before", F.lit(before)), out)
    jobs.backfill(spark, work.where("mlbam_id % 2 = 0"), done, run(True))
    jobs.backfill(spark, work, done, run(False), batch_keys=max(1, work.count() // 5))
    return TB.read_table(spark, out) if TB.table_exists(spark, out) else work.withColumn("done_before", F.lit(True))


# --- I3, I8, S1: landed schedule documents -> one row per game -------------------------------------
@register("landed_results", ORACLES["schedule_flatten"])
def q_landed_results(spark, sf_dir):
    base = scratch(spark, "results")
    schedule_docs(spark, sf_dir).write.text(f"{base}/landing")
    docs = L.read_documents(spark, f"{base}/landing", P.SCHEDULE_SCHEMA, lines=True, pattern="part-*")
    games = materialize(P.flatten_schedule(L.good_documents(docs)))  # both loads read them, the second twice
    late = games.where("game_pk % 7 = 0").withColumn("runs_h", F.col("runs_h") + 1).withColumn("_loaded_at", F.lit(LOADED))
    jobs.game_results(spark, late, f"{base}/table")
    jobs.game_results(spark, games.withColumn("_loaded_at", F.lit(LOADED + dt.timedelta(days=1))), f"{base}/table")
    return TB.read_table(spark, f"{base}/table").drop("_loaded_at")


# --- S6, S7: a season log written as text, with bad lines among the good ---------------------------


@register("gamelog_lines", with_pitches(GAME_LOG_SQL, body="""
SELECT CASE game_pk % 50 WHEN 0 THEN 'short' WHEN 1 THEN 'long' WHEN 2 THEN 'quote' WHEN 3 THEN 'value' END AS reason,
  CASE WHEN game_pk % 50 > 3 THEN CAST(strftime(date, '%Y%m%d') AS INTEGER) END AS date,
  CASE WHEN game_pk % 50 > 3 THEN team_v || ', ' || team_h END AS teams,
  CASE WHEN game_pk % 50 > 3 THEN CAST(home_score AS DOUBLE) END AS home_score,
  CASE WHEN game_pk % 50 > 3 THEN game_pk END AS game_pk
FROM games"""))
def q_gamelog_lines(spark, sf_dir):
    g = game_log_view(spark, sf_dir)
    bad = F.col("game_pk") % 50
    teams = F.concat(F.lit('"'), "team_v", F.lit(", "), "team_h", F.when(bad == 2, "").otherwise('"'))
    score = F.when(bad == 3, "none").otherwise(F.col("home_score").cast("string"))
    fields = [F.date_format("date", "yyyyMMdd"), teams, score, F.col("game_pk").cast("string")]
    line = F.when(bad == 0, F.concat_ws(",", *fields[:3])).when(bad == 1, F.concat_ws(",", *fields, F.lit("x"))).otherwise(F.concat_ws(",", *fields))
    path = scratch(spark, "logs")
    g.select(line.alias("value")).write.text(path)
    schema = G.gamelog_schema(["date", "teams", "home_score", "game_pk"], ["home_score"], ["date"])
    schema["game_pk"].dataType = load(spark, sf_dir, "orders").schema["o_orderkey"].dataType
    lines = G.checked_lines(spark, f"{path}/part-*", schema)
    return lines.select("reason", "row.date", "row.teams", "row.home_score", "row.game_pk")


# --- I9, A16: seasons with features and odds, stored in batches, and the run summary ---------------
def _season_sql(body: str) -> str:
    return f"""
WITH p AS MATERIALIZED ({_pregame_sql()}), o AS MATERIALIZED ({_odds_join_sql()}), s AS (
  SELECT p.*, o.implied_prob_h, o.implied_prob_v, o.implied_prob_h_mid, o.over_under_line, o.over_under_result
  FROM p JOIN o ON o.game_pk = p.game_pk
)
{body}"""


def _stored_seasons(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    # Every season and the odds read the games: they are built once, and a batch of seasons is one scan each.
    games, base = materialize(game_log_view(spark, sf_dir)), scratch(spark, "seasons")
    seasons = [r.season for r in games.select("season").distinct().orderBy("season").collect()]  # a few years
    read = lambda season: games.where(F.col("season") == season)
    summary = jobs.season_backfill(spark, seasons, read, odds_log_view(spark, sf_dir, games), f"{base}/table", f"{base}/done", "logs", LOADED,
                                   ODDS_FIRST_SEASON_DRIVER, seasons_per_batch=max(1, -(-len(seasons) // 2)))
    return TB.read_table(spark, f"{base}/table"), summary


@register("season_backfill", _season_sql("SELECT s.*, 'logs' AS _source, TIMESTAMP '2024-01-01 00:00:00' AS _loaded_at FROM s"))
def q_season_backfill(spark, sf_dir):
    return _stored_seasons(spark, sf_dir)[0]


@register("run_summary", _season_sql("SELECT season, count(*) AS n_rows FROM s GROUP BY season"))
def q_run_summary(spark, sf_dir):
    return _stored_seasons(spark, sf_dir)[1]


# --- K1, K2, K11, K12: one table through append, truncate, append and replaced slices ---------------
@register("table_round_trip", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'second' ELSE 'first' END AS _source,
  TIMESTAMP '2024-01-01 00:00:00' AS _loaded_at, o_orderstatus
FROM orders""")
def q_table_round_trip(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch(spark, "orders")
    TB.append(TB.with_load_columns(o.where("o_orderkey % 2 = 0"), "lost", LOADED), path, ["o_orderstatus"])
    TB.truncate(spark, path)
    TB.append(TB.with_load_columns(o.where("o_orderkey % 2 = 0"), "first", LOADED), path)
    TB.append(TB.with_load_columns(o.where("o_orderkey % 2 != 0"), "first", LOADED), path)
    TB.overwrite(TB.with_load_columns(o.where("o_orderstatus = 'F'"), "second", LOADED), path, dynamic=True)
    return TB.read_table(spark, path)


# --- S9 from folder names --------------------------------------------------------------------------
@register("stored_high_water_mark", "SELECT CAST(max(ts) AS DATE) AS max_loaded FROM events")
def q_stored_high_water_mark(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    path = scratch(spark, "events")
    TB.overwrite(events, path, ["day"])
    return TB.high_water_mark(spark, path, "day")


# --- J9 with several spans per team: overlapping, open and empty ones -------------------------------
SPANS_SQL = """
spans AS (
  SELECT n_name AS team, 1992 + n_nationkey % 3 AS first_season, 1994 + n_nationkey % 4 AS last_season, 'a' AS span FROM nation
  UNION ALL SELECT n_name, 1995, CASE WHEN n_nationkey % 2 = 0 THEN 1997 END, 'b' FROM nation
  UNION ALL SELECT n_name, NULL, 1993, 'c' FROM nation WHERE n_nationkey % 3 = 0
  UNION ALL SELECT n_name, 1998, 1996, 'd' FROM nation
)"""


def team_spans(spark, sf_dir) -> DataFrame:
    n, key = load(spark, sf_dir, "nation"), F.col("n_nationkey")
    none = F.lit(None).cast("int")
    span = lambda a, b, name: F.struct(a.cast("int").alias("first_season"), b.cast("int").alias("last_season"), F.lit(name).alias("span"))
    all_spans = F.array(span(1992 + key % 3, 1994 + key % 4, "a"), span(F.lit(1995), F.when(key % 2 == 0, 1997), "b"),
                        F.when(key % 3 == 0, span(none, F.lit(1993), "c")), span(F.lit(1998), F.lit(1996), "d"))
    return n.select(F.col("n_name").alias("team"), F.inline(F.filter(all_spans, lambda s: s.isNotNull())))


@register("validity_spans_join", f"""
WITH {TEAM_SEASON_SQL.strip()}, {SPANS_SQL.strip()}
SELECT t.o_orderkey, t.team, t.season, s.span FROM ts t JOIN spans s ON s.team = t.team
  AND t.season >= coalesce(s.first_season, t.season) AND t.season <= coalesce(s.last_season, t.season)""")
def q_validity_spans_join(spark, sf_dir):
    ts = team_seasons(spark, sf_dir).select("o_orderkey", "team", "season")
    out = intervals.point_in_intervals(ts, team_spans(spark, sf_dir), ["team"], "season", "first_season", "last_season", 2)
    return out.select("o_orderkey", "team", "season", "span")


@register("overlapping_spans", f"""
WITH {SPANS_SQL.strip()}
SELECT a.team, a.first_season AS first_season_left, a.last_season AS last_season_left,
  b.first_season AS first_season_right, b.last_season AS last_season_right,
  greatest(a.first_season, b.first_season) AS first_season_shared, least(a.last_season, b.last_season) AS last_season_shared
FROM spans a JOIN spans b ON a.team = b.team AND a.span < b.span
WHERE coalesce(greatest(a.first_season, b.first_season), -9999) <= coalesce(least(a.last_season, b.last_season), 9999)
  AND coalesce(a.first_season, -9999) <= coalesce(a.last_season, 9999) AND coalesce(b.first_season, -9999) <= coalesce(b.last_season, 9999)
  AND a.span = 'a'""")
def q_overlapping_spans(spark, sf_dir):
    s = team_spans(spark, sf_dir)
    return intervals.overlapping_intervals(s.where("span = 'a'").drop("span"), s.where("span > 'a'").drop("span"), ["team"],
                                           "first_season", "last_season", 2)
