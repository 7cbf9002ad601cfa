"""Registered queries: payload flattening, calendars, cleaning, null handling, quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldline.functions import constants as K
from fieldline.functions.scalar import format_timestamp, lenient_date, lenient_number
from fieldline.operators import quality as Q
from fieldline.plans.registry import register, with_pitches
from fieldline.plans.views import load, pitch_view
from fieldline.sources import calendar as C
from fieldline.sources import payloads as P


# --- S1 on the events table: JSON text column -> typed value -----------------------------------
@register("json_flatten", """
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_json_flatten(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    parsed = ev.withColumn("_p", F.from_json("props", "k bigint"))
    return parsed.select("event_id", "user_id", F.col("_p.k").alias("k"))


# --- S1: schedule payloads built from orders, flattened back to finished games --------------------
def schedule_docs(spark, sf_dir):
    """One schedule document per order, in the source's nested shape."""
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    home = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("home"))
    away = n.select(F.col("n_nationkey").alias("_vk"), F.col("n_name").alias("away"))
    j = (o.join(c, o.o_custkey == c.c_custkey).join(home, "c_nationkey")
         .withColumn("_vk", ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25).cast("int"))
         .join(away, "_vk"))
    state = F.when(F.col("o_orderstatus") == "O", "Live").otherwise("Final")
    hscore = F.when(F.col("o_orderkey") % 5 != 0,
                    F.round(F.col("o_totalprice")).cast("long") % 10)
    game = F.struct(
        F.col("o_orderkey").alias("gamePk"),
        F.struct(state.alias("abstractGameState")).alias("status"),
        F.struct(
            F.struct(hscore.alias("score"), F.struct(F.col("home").alias("abbreviation"))
                     .alias("team")).alias("home"),
            F.struct((F.col("o_custkey") % 10).alias("score"),
                     F.struct(F.col("away").alias("abbreviation")).alias("team")).alias("away"),
        ).alias("teams"),
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    doc = F.struct(F.array(F.struct(day.alias("date"), F.array(game).alias("games")))
                   .alias("dates"))
    return j.select(F.to_json(doc).alias("payload"))


@register("schedule_flatten", """
WITH s AS (
  SELECT o.o_orderkey AS game_pk, CAST(o.o_orderdate AS DATE) AS game_date,
    hn.n_name AS team_h, an.n_name AS team_v, o.o_orderstatus,
    coalesce(CASE WHEN o.o_orderkey % 5 <> 0 THEN CAST(round(o.o_totalprice) AS BIGINT) % 10 END, 0)
      AS runs_h,
    o.o_custkey % 10 AS runs_v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation hn ON hn.n_nationkey = c.c_nationkey
  JOIN nation an ON an.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25
)
SELECT game_pk, game_date, team_h, team_v, runs_h, runs_v,
  CAST(runs_h > runs_v AS INTEGER) AS home_victory, runs_h - runs_v AS run_diff
FROM s WHERE o_orderstatus <> 'O'""")
def q_schedule_flatten(spark, sf_dir):
    docs = P.parse(schedule_docs(spark, sf_dir), "payload", P.SCHEDULE_SCHEMA)
    return P.flatten_schedule(docs)


# --- S2: boxscores, one per order; suppliers play, every third pitches ------------------------------
def order_players(spark, sf_dir):
    """One row per order line as a player: id 0 (unknown) for some suppliers."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_suppkey") % 50 != 0, F.col("l_suppkey")).otherwise(0).alias("id"),
        F.when(F.col("l_suppkey") % 3 == 0, "P").otherwise("SS").alias("abbreviation"))


def _side(value, odd: bool):
    return F.collect_list(F.when(F.col("l_linenumber") % 2 == int(odd), value))


@register("boxscore_flatten", """
SELECT DISTINCT l_orderkey AS game_pk,
  CASE WHEN l_suppkey % 3 = 0 THEN 'pitcher' ELSE 'batter' END AS role, l_suppkey AS player_id
FROM lineitem WHERE l_suppkey % 50 <> 0""")
def q_boxscore_flatten(spark, sf_dir):
    player = F.struct(F.struct("id").alias("person"), F.struct("abbreviation").alias("position"))
    sides = order_players(spark, sf_dir).groupBy("l_orderkey").agg(
        _side(player, True).alias("h"), _side(player, False).alias("a"))

    def named(side: str):
        keys = F.transform(side, lambda x, i: F.concat(F.lit("ID"), i.cast("string")))
        return F.struct(F.map_from_arrays(keys, F.col(side)).alias("players"))

    teams = F.struct(named("h").alias("home"), named("a").alias("away"))
    docs = sides.select(F.col("l_orderkey").alias("game_pk"), F.to_json(F.struct(teams.alias("teams"))).alias("payload"))
    return P.flatten_boxscore(P.parse(docs, "payload", P.BOXSCORE_SCHEMA))


# --- S3: line-ups; only games with players on both sides are posted --------------------------------
@register("lineups_flatten", """
WITH posted AS (
  SELECT l_orderkey FROM lineitem GROUP BY 1
  HAVING count(*) FILTER (WHERE l_linenumber % 2 = 1) > 0 AND count(*) FILTER (WHERE l_linenumber % 2 = 0) > 0
)
SELECT l_orderkey AS game_pk, CASE WHEN l_suppkey % 3 = 0 THEN 'pitcher' ELSE 'batter' END AS role,
  l_suppkey AS player_id
FROM lineitem JOIN posted USING (l_orderkey) WHERE l_suppkey % 50 <> 0
UNION SELECT l_orderkey, 'pitcher', 1000000 + l_orderkey FROM posted WHERE l_orderkey % 2 = 0""")
def q_lineups_flatten(spark, sf_dir):
    player = F.struct("id", F.struct("abbreviation").alias("primaryPosition"))
    sides = order_players(spark, sf_dir).groupBy("l_orderkey").agg(
        _side(player, True).alias("homePlayers"), _side(player, False).alias("awayPlayers"))
    probable = F.when(F.col("l_orderkey") % 2 == 0, F.struct((F.lit(1000000) + F.col("l_orderkey")).alias("id")))
    game = F.struct(F.col("l_orderkey").alias("gamePk"),
                    F.struct("homePlayers", "awayPlayers").alias("lineups"),
                    F.struct(F.struct(probable.alias("probablePitcher")).alias("home")).alias("teams"))
    doc = F.struct(F.array(F.struct(F.array(game).alias("games"))).alias("dates"))
    docs = P.parse(sides.select(F.to_json(doc).alias("payload")), "payload", P.SCHEDULE_SCHEMA)
    return P.flatten_lineups(docs)


# --- S5: season stats whose values are numbers and text side by side --------------------------------
@register("season_stats_flatten", """
SELECT o_custkey AS player_id,
  CASE WHEN o_custkey % 7 <> 0 THEN count(*) END AS "plateAppearances"
FROM orders GROUP BY o_custkey""")
def q_season_stats_flatten(spark, sf_dir):
    per = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    stat = F.struct(F.when(F.col("o_custkey") % 7 != 0, F.col("n")).alias("plateAppearances"),
                    F.lit(".300").alias("avg"))
    split = F.struct(F.struct(F.col("o_custkey").alias("id")).alias("player"), stat.alias("stat"))
    doc = F.struct(F.array(F.struct(F.array(split).alias("splits"))).alias("stats"))
    docs = P.parse(per.select(F.to_json(doc).alias("payload")), "payload", P.SEASON_STATS_SCHEMA)
    return P.flatten_season_stats(docs, "plateAppearances")


# --- S14: the range of dates to fetch per season -----------------------------------------------------
@register("fetch_range", """
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season, make_date(year(o_orderdate), 3, 1) AS range_start,
  CASE WHEN year(o_orderdate) = 1998 THEN DATE '1998-06-15' ELSE make_date(year(o_orderdate), 11, 30) END
    AS range_end
FROM orders""")
def q_fetch_range(spark, sf_dir):
    return C.fetch_range(seasons(spark, sf_dir), F.lit("1998-06-15").cast("date"))


# --- P17: cleaning of landed text pitches ------------------------------------------------------------
@register("clean_pitches", with_pitches(body="""
SELECT game_pk AS GAME_PK, at_bat_number AS AT_BAT_NUMBER, pitch_number AS PITCH_NUMBER,
  CASE WHEN game_pk % 11 <> 0 THEN game_date END AS GAME_DATE,
  CASE WHEN game_pk % 13 <> 0 THEN release_speed END AS RELEASE_SPEED
FROM pitches"""))
def q_clean_pitches(spark, sf_dir):
    p = pitch_view(spark, sf_dir)
    landed = p.select(
        "game_pk", "at_bat_number", "pitch_number",
        F.when(F.col("game_pk") % 11 != 0, F.col("game_date").cast("string")).otherwise("n/a").alias("game_date"),
        F.when(F.col("game_pk") % 13 != 0, F.col("release_speed").cast("string")).otherwise("--").alias("release_speed"),
        F.lit("x").alias("column_of_a_later_feed"))
    return Q.clean_pitches(landed, known_columns=landed.columns[:-1])


# --- S11, S12, F14: calendars per season found in the data -------------------------------------
def seasons(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("season")).distinct()


SEASONS_SQL = "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season FROM orders"


@register("season_calendar", f"""
SELECT season, CAST(unnest(generate_series(make_date(season, 3, 20), make_date(season, 11, 5),
  INTERVAL 1 DAY)) AS DATE) AS day FROM ({SEASONS_SQL})""")
def q_season_calendar(spark, sf_dir):
    return C.season_calendar(seasons(spark, sf_dir))


@register("weekly_chunks", f"""
SELECT season, strftime(st, '%Y-%m-%d') AS chunk_start,
  strftime(least(CAST(st AS DATE) + 6, make_date(season, 10, 15)), '%Y-%m-%d') AS chunk_end
FROM (SELECT season, unnest(generate_series(make_date(season, 3, 20), make_date(season, 10, 15),
  INTERVAL 7 DAY)) AS st FROM ({SEASONS_SQL}))""")
def q_weekly_chunks(spark, sf_dir):
    return C.weekly_chunks(seasons(spark, sf_dir))


# --- P1-P3, P5-P9: a team log landed as text, cleaned --------------------------------------------
def team_log_text(spark, sf_dir):
    """Flattened two-level headers, repeated header rows, a dateless total row, suffixed dates
    and text in numeric columns, as a scraped team log has them."""
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    header = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderkey") % 7 == 0)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    date_text = (F.when(header, "Date").when(F.col("o_orderkey") % 11 == 0, F.lit(None))
                 .when(F.col("o_orderkey") % 13 == 0, F.concat(day, F.lit(" (1)"))).otherwise(day))
    return j.select(
        F.col("o_orderkey").alias("Gtm"),
        F.col("n_name").alias("Team"),
        date_text.alias("Date"),
        F.when(header, "PA").otherwise(F.col("o_totalprice").cast("string"))
        .alias("Batting Stats_PA"),
        F.when(header, "R").when(F.col("o_orderkey") % 17 == 0, "n/a")
        .otherwise(F.col("o_custkey").cast("string")).alias("Batting Stats_R"),
        F.when(header, "Rk").otherwise(F.col("o_orderkey").cast("string")).alias("Rk"),
    )


TEAM_LOG_SQL = """
WITH j AS (
  SELECT o.*, n.n_name,
    (o.o_orderpriority = '5-LOW' AND o.o_orderkey % 7 = 0) AS header
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
t AS (
  SELECT o_orderkey AS "Gtm", n_name AS "Team",
    CASE WHEN header THEN 'Date' WHEN o_orderkey % 11 = 0 THEN NULL
         WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' (1)'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "Date",
    CASE WHEN header THEN 'PA' ELSE CAST(o_totalprice AS VARCHAR) END AS "Batting Stats_PA",
    CASE WHEN header THEN 'R' WHEN o_orderkey % 17 = 0 THEN 'n/a'
         ELSE CAST(o_custkey AS VARCHAR) END AS "Batting Stats_R",
    CASE WHEN header THEN 'Rk' ELSE CAST(o_orderkey AS VARCHAR) END AS "Rk"
  FROM j
)
"""
RENAME = {"Batting Stats_PA": "pa", "Batting Stats_R": "runs", "Team": "team", "Date": "date",
          "Gtm": "gtm"}


def renamed(spark, sf_dir):
    df = team_log_text(spark, sf_dir).withColumnsRenamed(RENAME).drop("Rk")
    return Q.upper_columns(df)


@register("rename_project", TEAM_LOG_SQL + """
SELECT "Gtm" AS GTM, "Team" AS TEAM, "Date" AS DATE, "Batting Stats_PA" AS PA,
  "Batting Stats_R" AS RUNS FROM t""")
def q_rename_project(spark, sf_dir):
    return renamed(spark, sf_dir)


@register("lenient_numeric", TEAM_LOG_SQL + """
SELECT "Gtm" AS GTM, TRY_CAST("Batting Stats_PA" AS DOUBLE) AS PA,
  TRY_CAST("Batting Stats_R" AS DOUBLE) AS RUNS FROM t""")
def q_lenient_numeric(spark, sf_dir):
    df = renamed(spark, sf_dir)
    return df.select("GTM", lenient_number("PA").alias("PA"), lenient_number("RUNS").alias("RUNS"))


@register("lenient_date", TEAM_LOG_SQL + """
SELECT "Gtm" AS GTM, CAST(TRY_STRPTIME("Date", '%Y-%m-%d') AS DATE) AS DATE FROM t""")
def q_lenient_date(spark, sf_dir):
    return renamed(spark, sf_dir).select("GTM", lenient_date("DATE").alias("DATE"))


CLEAN_SQL = TEAM_LOG_SQL + """
, c AS (
  SELECT "Gtm" AS GTM, "Team" AS TEAM, CAST(TRY_STRPTIME("Date", '%Y-%m-%d') AS DATE) AS DATE,
    TRY_CAST("Batting Stats_PA" AS DOUBLE) AS PA, TRY_CAST("Batting Stats_R" AS DOUBLE) AS RUNS
  FROM t
)
"""


def cleaned(spark, sf_dir):
    return Q.clean_team_log(team_log_text(spark, sf_dir), RENAME, ["Rk"], ["pa", "runs"])


@register("drop_all_null", CLEAN_SQL + """
SELECT GTM, TEAM, DATE, PA, RUNS, CAST(year(DATE) AS INTEGER) AS SEASON FROM c
WHERE (PA IS NOT NULL OR RUNS IS NOT NULL) AND DATE IS NOT NULL""")
def q_drop_all_null(spark, sf_dir):
    return cleaned(spark, sf_dir)


@register("derive_year", CLEAN_SQL + """
SELECT GTM, CAST(year(DATE) AS INTEGER) AS SEASON FROM c
WHERE (PA IS NOT NULL OR RUNS IS NOT NULL) AND DATE IS NOT NULL""")
def q_derive_year(spark, sf_dir):
    return cleaned(spark, sf_dir).select("GTM", "SEASON")


# --- K8: project to a target schema (case-insensitive) -------------------------------------------
TARGET_COLUMNS = ["GAME_PK", "GAME_DATE", "PITCHER", "BATTER", "EVENTS", "RELEASE_SPEED",
                  "NOT_IN_SOURCE"]


@register("project_to_schema", with_pitches(body="""
SELECT game_pk AS GAME_PK, game_date AS GAME_DATE, pitcher AS PITCHER, batter AS BATTER,
  events AS EVENTS, release_speed AS RELEASE_SPEED FROM pitches"""))
def q_project_to_schema(spark, sf_dir):
    return Q.project_to_schema(pitch_view(spark, sf_dir), TARGET_COLUMNS)


# --- P16 -----------------------------------------------------------------------------------------
@register("drop_blank", with_pitches(body="""
SELECT game_pk, at_bat_number, pitch_number, pitch_type FROM pitches
WHERE pitch_type IS NOT NULL AND pitch_type <> ''"""))
def q_drop_blank(spark, sf_dir):
    p = pitch_view(spark, sf_dir).select("game_pk", "at_bat_number", "pitch_number", "pitch_type")
    return Q.drop_blank(p, "pitch_type")


# --- P18, P19 ------------------------------------------------------------------------------------
@register("quality_report", with_pitches(body="""
SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE launch_angle > 90 OR launch_angle < -90) AS n_unusual_angle,
  count(*) FILTER (WHERE release_speed IS NULL OR release_speed < 40) AS n_bad_speed
FROM pitches"""))
def q_quality_report(spark, sf_dir):
    return Q.quality_report(Q.upper_columns(pitch_view(spark, sf_dir)))


# --- K9 ------------------------------------------------------------------------------------------
@register("normalize_nulls", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_discount END AS discount,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS flag
FROM lineitem""")
def q_normalize_nulls(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    raw = li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount"))
        .alias("discount"),
        F.when(F.col("l_returnflag") == "N",
               F.when(F.col("l_linestatus") == "O", "NaN").otherwise("nan"))
        .otherwise(F.col("l_returnflag")).alias("flag"),
    )
    return Q.normalize_nulls(raw)


# --- K10 -----------------------------------------------------------------------------------------
@register("timestamp_format", """
SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped
FROM lineitem""")
def q_timestamp_format(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     format_timestamp("l_shipdate").alias("shipped"))

