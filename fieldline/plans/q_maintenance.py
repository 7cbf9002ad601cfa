"""Registered queries: table-maintenance semantics (the new table content as a DataFrame)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fieldline.operators import merge as M
from fieldline.plans import sqlgen as S
from fieldline.plans.q_features import pitcher_games
from fieldline.plans.q_relational import (
    PAIR_INC_SQL,
    PAIR_SQL,
    ROSTER_SQL,
    STORED_SQL,
    pair_increment,
    rosters,
    stored_checkpoints,
)
from fieldline.plans.registry import register, with_pitches
from fieldline.plans.views import load, pitch_view

KEYS = ["mlbam_id", "game_date", "game_pk"]
PG = S.pitcher_game_cte()


# --- K3: upsert (delete matching keys, insert) --------------------------------------------------
@register("upsert_rows", with_pitches(PG, """
stale AS (SELECT * REPLACE (bfp + 1 AS bfp) FROM pg)""",
                                      """
src AS (SELECT * FROM pg WHERE year(game_date) = 1998)""", body="""
SELECT * FROM stale t WHERE NOT EXISTS (
  SELECT 1 FROM src s WHERE s.mlbam_id = t.mlbam_id AND s.game_date = t.game_date
    AND s.game_pk = t.game_pk)
UNION ALL SELECT * FROM src"""))
def q_upsert_rows(spark, sf_dir):
    pg = pitcher_games(spark, sf_dir)
    stale = pg.withColumn("bfp", F.col("bfp") + 1)
    src = pg.filter((F.col("game_date") >= F.lit(dt.date(1998, 1, 1)))
                    & (F.col("game_date") < F.lit(dt.date(1999, 1, 1))))
    return M.upsert(stale, src, KEYS)


# --- K4: replace one date slice ------------------------------------------------------------------
@register("replace_slice", with_pitches("""
stale AS (SELECT game_pk, at_bat_number, pitch_number, game_date, CAST(NULL AS VARCHAR) AS events
          FROM pitches)""", """
src AS (SELECT game_pk, at_bat_number, pitch_number, game_date, events FROM pitches
        WHERE game_date = (SELECT max(game_date) FROM pitches))""", body="""
SELECT * FROM stale WHERE game_date NOT IN (SELECT game_date FROM src)
UNION ALL SELECT * FROM src"""))
def q_replace_slice(spark, sf_dir):
    from fieldline.operators.incremental import as_of_date

    p = pitch_view(spark, sf_dir).select("game_pk", "at_bat_number", "pitch_number",
                                         "game_date", "events")
    stale = p.withColumn("events", F.lit(None).cast("string"))
    src = p.filter(F.col("game_date") == as_of_date(p))
    return M.replace_slice(stale, src, ["game_date"])


# --- K5: insert-only merge (a re-sent day adds nothing) ----------------------------------------
@register("merge_insert_only", with_pitches(PAIR_SQL, PAIR_INC_SQL, """
resent AS (
  SELECT * FROM history WHERE game_date = (SELECT max(game_date) FROM history)
  UNION ALL SELECT * FROM increment
)""", body="""
SELECT * FROM history
UNION ALL
SELECT * FROM resent r WHERE NOT EXISTS (
  SELECT 1 FROM history h WHERE h.batter = r.batter AND h.pitcher = r.pitcher
    AND h.game_pk = r.game_pk)"""))
def q_merge_insert_only(spark, sf_dir):
    from fieldline.operators.incremental import as_of_date

    _, history, inc = pair_increment(spark, sf_dir)
    resent = history.filter(F.col("game_date") == as_of_date(history)).unionByName(inc)
    return M.merge_insert_only(history, resent, ["batter", "pitcher", "game_pk"])


# --- K6: update-or-insert merge of run checkpoints ---------------------------------------------
STORED_AT = dt.datetime(2000, 1, 1, 0, 0, 0)
COMPUTED_AT = dt.datetime(2001, 12, 31, 10, 0, 0)


@register("merge_update_insert", with_pitches(ROSTER_SQL, STORED_SQL, """
dates AS (SELECT o_orderkey AS game_pk, CAST(o_orderdate AS DATE) AS game_date FROM orders)""", """
tgt AS (SELECT s.game_pk, s.lineup_hash, d.game_date,
               TIMESTAMP '2000-01-01 00:00:00' AS computed_at
        FROM stored s JOIN dates d ON s.game_pk = d.game_pk)""", """
src AS (SELECT h.game_pk, h.lineup_hash, d.game_date,
               TIMESTAMP '2001-12-31 10:00:00' AS computed_at
        FROM hashed h LEFT JOIN stored s ON h.game_pk = s.game_pk
        JOIN dates d ON h.game_pk = d.game_pk
        WHERE s.lineup_hash IS DISTINCT FROM h.lineup_hash)""", body="""
SELECT * FROM tgt WHERE game_pk NOT IN (SELECT game_pk FROM src)
UNION ALL SELECT * FROM src"""))
def q_merge_update_insert(spark, sf_dir):
    from fieldline.operators.incremental import changed_rosters

    dates = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("game_pk"), F.col("o_orderdate").cast("date").alias("game_date"))
    stored = stored_checkpoints(spark, sf_dir)
    tgt = stored.join(dates, "game_pk").withColumn(
        "computed_at", F.lit(STORED_AT).cast("timestamp_ntz"))
    cur = rosters(spark, sf_dir).select("game_pk", "lineup_hash")
    src = changed_rosters(cur, stored).join(dates, "game_pk").withColumn(
        "computed_at", F.lit(COMPUTED_AT).cast("timestamp_ntz"))
    return M.merge_update_insert(tgt, src, ["game_pk"], ["lineup_hash", "game_date", "computed_at"])


# --- K7: schema widening ---------------------------------------------------------------------------
DDL_PITCHER_GAME = ["mlbam_id", "game_date", "game_pk", "opponent", "is_home_pitcher", "gs", "ip",
                    "bfp", "hr", "r", "fly_balls", "batted_balls_allowed"]


@register("schema_widen", with_pitches(PG, body=f"""
(SELECT {', '.join(DDL_PITCHER_GAME)} FROM pg WHERE game_date < DATE '1998-01-01')
UNION ALL BY NAME
(SELECT * FROM pg WHERE game_date >= DATE '1998-01-01')"""))
def q_schema_widen(spark, sf_dir):
    pg = pitcher_games(spark, sf_dir)
    cut = F.lit(dt.date(1998, 1, 1))
    old = pg.filter(F.col("game_date") < cut).select(*DDL_PITCHER_GAME)
    return M.widen_schema(old, pg.filter(F.col("game_date") >= cut))
