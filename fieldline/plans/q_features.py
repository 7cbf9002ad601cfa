"""Registered queries: rollups, rolling windows and rates (sections A and W of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldline.functions import constants as K
from fieldline.operators import rollup, rolling
from fieldline.plans import sqlgen as S
from fieldline.plans.registry import register, with_pitches
from fieldline.plans.views import PITCH_ORDER, load, pitch_view, tasks_for


def batter_games(spark: SparkSession, sf_dir: str, batch: tuple[int, int] | None = None) -> DataFrame:
    return rollup.batter_game_rollup(pitch_view(spark, sf_dir, batch), order_cols=PITCH_ORDER)


def pitcher_games(spark: SparkSession, sf_dir: str, batch: tuple[int, int] | None = None) -> DataFrame:
    return rollup.pitcher_game_rollup(pitch_view(spark, sf_dir, batch), order_cols=PITCH_ORDER)


def by_player(spark: SparkSession, sf_dir: str, games: DataFrame) -> DataFrame:
    """Player-game rows dealt by player for the windows, in tasks that don't grow with the tables."""
    return games.repartition(tasks_for(spark, sf_dir, "lineitem"), "mlbam_id")


# --- A1, A3-A9: batter-game rollup ------------------------------------------------------------
@register("entity_game_rollup",
          with_pitches(S.batter_game_cte(), body="SELECT * FROM bg"))
def q_entity_game_rollup(spark, sf_dir):
    return batter_games(spark, sf_dir)


# --- A2, A8, A10: pitcher-game rollup ---------------------------------------------------------
@register("supplier_game_rollup",
          with_pitches(S.pitcher_game_cte(), body="SELECT * FROM pg"))
def q_supplier_game_rollup(spark, sf_dir):
    return pitcher_games(spark, sf_dir)


# --- A6: first value by order in a group ------------------------------------------------------
@register("first_by_order", with_pitches(body=f"""
SELECT game_pk,
  first(pitcher ORDER BY {S.PITCH_ORDER_SQL}) AS first_pitcher,
  first(inning_topbot ORDER BY {S.PITCH_ORDER_SQL}) AS first_half,
  first(events ORDER BY {S.PITCH_ORDER_SQL}) AS first_event
FROM pitches GROUP BY game_pk"""))
def q_first_by_order(spark, sf_dir):
    p = pitch_view(spark, sf_dir)
    order = F.struct(*[F.col(c) for c in PITCH_ORDER])
    return p.groupBy("game_pk").agg(
        rollup.first_by_order("pitcher", order).alias("first_pitcher"),
        rollup.first_by_order("inning_topbot", order).alias("first_half"),
        rollup.first_by_order("events", order).alias("first_event"),
    )


# --- A7: first non-null value in a group -------------------------------------------------------
@register("first_non_null", with_pitches(body=f"""
SELECT batter, game_pk,
  first(age_bat ORDER BY {S.PITCH_ORDER_SQL}) FILTER (WHERE age_bat IS NOT NULL) AS age,
  first(estimated_slg_using_speedangle ORDER BY {S.PITCH_ORDER_SQL})
    FILTER (WHERE estimated_slg_using_speedangle IS NOT NULL) AS first_est_slg
FROM pitches GROUP BY batter, game_pk"""))
def q_first_non_null(spark, sf_dir):
    p = pitch_view(spark, sf_dir)
    order = F.struct(*[F.col(c) for c in PITCH_ORDER])
    return p.groupBy("batter", "game_pk").agg(
        rollup.first_non_null("age_bat", order).alias("age"),
        rollup.first_non_null("estimated_slg_using_speedangle", order).alias("first_est_slg"),
    )


# --- A10 / F11: clamped run sum ----------------------------------------------------------------
@register("clamped_sum", with_pitches(body=f"""
SELECT pitcher, game_year,
  CAST(sum(greatest(post_bat_score - bat_score, 0)) FILTER (WHERE {S.PA}) AS BIGINT) AS runs,
  CAST(sum(post_bat_score - bat_score) FILTER (WHERE {S.PA}) AS BIGINT) AS raw_runs
FROM pitches GROUP BY pitcher, game_year"""))
def q_clamped_sum(spark, sf_dir):
    p = pitch_view(spark, sf_dir)
    pa = F.col("events").isNotNull() & (F.col("events") != "")
    return p.groupBy("pitcher", "game_year").agg(
        rollup.clamped_sum("post_bat_score", "bat_score", pa).cast("long").alias("runs"),
        F.sum(F.when(pa, F.col("post_bat_score") - F.col("bat_score"))).cast("long")
        .alias("raw_runs"),
    )


# --- A11: season batting summary view -----------------------------------------------------------
def _season_stats_sql(corrected: bool) -> str:
    doubles = "'double'" if corrected else "'double', 'double_play'"
    ab = (f"{S.PA} AND events NOT IN ({S.qlist(K.NON_AB_EVENTS)})" if corrected else S.PA)
    pa = S.PA if corrected else "TRUE"
    ind = lambda p: f"CAST(sum(CASE WHEN {p} THEN 1 ELSE 0 END) AS BIGINT)"
    return with_pitches(body=f"""
SELECT game_year, batter, batter_name AS player_name,
  {ind(pa)} AS pa, {ind(ab)} AS ab,
  {ind("events = 'home_run'")} AS hr, {ind("events = 'single'")} AS single,
  {ind(f"events IN ({doubles})")} AS double, {ind("events = 'triple'")} AS triple,
  {ind("events IN ('walk', 'hit_by_pitch')")} AS bb_hbp,
  {ind("events IN ('strikeout', 'strikeout_double_play')")} AS so,
  {ind("type = 'B'")} AS balls_seen, {ind("type = 'S'")} AS strikes_seen,
  {S.rnd('avg(launch_speed)', 1)} AS avg_exit_velo,
  {S.rnd('avg(launch_angle)', 1)} AS avg_launch_angle,
  {S.rnd('avg(estimated_ba_using_speedangle)', 3)} AS avg_xba,
  {S.rnd('avg(estimated_woba_using_speedangle)', 3)} AS avg_xwoba,
  {S.rnd('sum(delta_run_exp)', 2)} AS total_runs_added
FROM pitches WHERE batter IS NOT NULL
GROUP BY game_year, batter, batter_name""")


@register("entity_season_stats", _season_stats_sql(False))
def q_entity_season_stats(spark, sf_dir):
    return rollup.season_batting_summary(pitch_view(spark, sf_dir))


@register("entity_season_stats_corrected", _season_stats_sql(True))
def q_entity_season_stats_corrected(spark, sf_dir):
    return rollup.season_batting_summary(pitch_view(spark, sf_dir), corrected=True)


# --- A12: pitch arsenal view --------------------------------------------------------------------
@register("category_arsenal", with_pitches(body=f"""
SELECT game_year, pitcher, player_name, pitch_type, pitch_name,
  count(*) AS pitches_thrown,
  {S.rnd('avg(release_speed)', 1)} AS avg_velo,
  {S.rnd('max(release_speed)', 1)} AS max_velo,
  {S.rnd('avg(release_spin_rate)', 0)} AS avg_spin,
  {S.rnd('avg(pfx_x) * 12', 1)} AS avg_h_break_in,
  {S.rnd('avg(pfx_z) * 12', 1)} AS avg_v_break_in,
  {S.rnd('avg(release_extension)', 1)} AS avg_extension,
  {S.rnd("CAST(sum(CASE WHEN type = 'S' OR description = 'hit_into_play' THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(count(*), 0) * 100", 1)} AS strike_pct,
  {S.rnd('avg(estimated_woba_using_speedangle)', 3)} AS avg_xwoba
FROM pitches GROUP BY game_year, pitcher, player_name, pitch_type, pitch_name"""))
def q_category_arsenal(spark, sf_dir):
    return rollup.pitch_arsenal(pitch_view(spark, sf_dir))


# --- W1: lenient lagged rolling sums ------------------------------------------------------------
def _pitcher_sums_sql(strict: bool) -> str:
    part, order = "mlbam_id", "game_date, game_pk"
    cols = ["bfp", "hr", "so", "outs"]
    sums = [f"{S.lagged_sum(c, w, part, order, True, strict)} AS rollsum_{c}_{w}"
            for w in K.PITCHER_WINDOWS for c in cols]
    return with_pitches(S.pitcher_game_cte(), body=f"""
SELECT mlbam_id, game_date, game_pk, {', '.join(cols)}, {', '.join(sums)} FROM pg""")


def _pitcher_sums(spark, sf_dir, strict: bool):
    g = pitcher_games(spark, sf_dir).select("mlbam_id", "game_date", "game_pk",
                                            "bfp", "hr", "so", "outs")
    return rolling.rolling_sums(by_player(spark, sf_dir, g), ["bfp", "hr", "so", "outs"], K.PITCHER_WINDOWS, "mlbam_id",
                                ["game_date", "game_pk"], strict=strict)


@register("rolling_sums", _pitcher_sums_sql(False))
def q_rolling_sums(spark, sf_dir):
    return _pitcher_sums(spark, sf_dir, strict=False)


# --- W2: strict lagged rolling sums -------------------------------------------------------------
@register("strict_rolling_sums", _pitcher_sums_sql(True))
def q_strict_rolling_sums(spark, sf_dir):
    return _pitcher_sums(spark, sf_dir, strict=True)


# --- W1, W2 on general doubles: prices with NaN and NULL among them -------------------------------
PRICE_WINDOWS = [3, 30]


def _price_sums_sql(strict: bool) -> str:
    out = []
    for w in PRICE_WINDOWS:
        frame = (f"OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber "
                 f"ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)")
        out.append(f"CASE WHEN count(price) {frame} >= {w if strict else 1} "
                   f"THEN round(sum(price) {frame}, 2) END AS price_{w}")
    return f"""
WITH p AS (
  SELECT *, CASE WHEN l_linenumber < 6 THEN l_extendedprice END AS price FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_suppkey, {', '.join(out)} FROM p"""


def _price_sums(spark, sf_dir, strict: bool):
    price = (F.when(F.col("l_linenumber") < 6, F.col("l_extendedprice"))
             .when(F.col("l_linenumber") == 6, F.lit(float("nan"))))
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey",
                                                "l_shipdate", price.alias("price"))
    sums = rolling.rolling_sums(li, ["price"], PRICE_WINDOWS, "l_suppkey",
                                ["l_shipdate", "l_orderkey", "l_linenumber"], strict=strict)
    return sums.select("l_orderkey", "l_linenumber", "l_suppkey",
                       *[F.round(f"rollsum_price_{w}", 2).alias(f"price_{w}")
                         for w in PRICE_WINDOWS])


@register("rolling_price_sums", _price_sums_sql(False))
def q_rolling_price_sums(spark, sf_dir):
    return _price_sums(spark, sf_dir, strict=False)


@register("strict_rolling_price_sums", _price_sums_sql(True))
def q_strict_rolling_price_sums(spark, sf_dir):
    return _price_sums(spark, sf_dir, strict=True)


# --- W3 (+A14): batter rolling features, the flagship --------------------------------------------
def _batter_features_sql() -> str:
    part, order = "mlbam_id", "game_date, game_pk"
    sums = [
        f"{S.lagged_sum(c, w, part, order, c not in S.BATTER_FLOAT)} AS rollsum_{c}_{w}"
        for w in K.BATTER_WINDOWS for c in K.BATTER_SUM_COLUMNS
    ]
    rates = [r for w in K.BATTER_WINDOWS for r in S.batter_rates_sql(w)]
    sum_names = [f"rollsum_{c}_{w}" for w in K.BATTER_WINDOWS for c in K.BATTER_SUM_COLUMNS]
    rate_names = [r.rsplit(" AS ", 1)[1] for r in rates]
    cols = S.BATTER_GAME_COLUMNS + sum_names + rate_names
    return with_pitches(
        S.batter_game_cte(),
        f"bs AS (SELECT *, {', '.join(sums)} FROM bg)",
        f"br AS (SELECT *, {', '.join(rates)} FROM bs)",
        body=S.collapse_sql("br", cols, ["mlbam_id", "game_date"], "game_pk"),
    )


@register("rolling_rates", _batter_features_sql())
def q_rolling_rates(spark, sf_dir):
    return rolling.batter_rolling_features(by_player(spark, sf_dir, batter_games(spark, sf_dir)))


# --- W4/W5 (+A14): pitcher rolling features with smoothed rates -------------------------------
def _pitcher_features_sql() -> str:
    part, order = "mlbam_id", "game_date, game_pk"
    sum_cols = [c for c in K.PITCHER_SUM_COLUMNS if c != "ip"] + ["outs"]
    sums = [f"{S.lagged_sum(c, w, part, order, True)} AS rollsum_{c}_{w}"
            for w in K.PITCHER_WINDOWS for c in sum_cols]
    ips = [f"CAST(rollsum_outs_{w} AS DOUBLE) / 3 AS rollsum_ip_{w}" for w in K.PITCHER_WINDOWS]
    rates = [r for w in K.PITCHER_WINDOWS for r in S.pitcher_rates_sql(w)]
    sum_names = [f"rollsum_{c}_{w}" for w in K.PITCHER_WINDOWS for c in sum_cols if c != "outs"]
    ip_names = [f"rollsum_ip_{w}" for w in K.PITCHER_WINDOWS]
    rate_names = [r.rsplit(" AS ", 1)[1] for r in rates]
    cols = S.PITCHER_GAME_COLUMNS + sum_names + ip_names + rate_names
    return with_pitches(
        S.pitcher_game_cte(),
        f"ps AS (SELECT *, {', '.join(sums)} FROM pg)",
        f"pi AS (SELECT *, {', '.join(ips)} FROM ps)",
        f"pr AS (SELECT *, {', '.join(rates)} FROM pi)",
        body=S.collapse_sql("pr", cols, ["mlbam_id", "game_date"], "game_pk"),
    )


@register("smoothed_rates", _pitcher_features_sql())
def q_smoothed_rates(spark, sf_dir):
    return rolling.pitcher_rolling_features(by_player(spark, sf_dir, pitcher_games(spark, sf_dir)))


# --- A14 alone: last non-null value per (entity, day) ------------------------------------------
@register("last_non_null_per_day", with_pitches(body="""
SELECT batter, game_date,
  arg_max(events, game_pk) FILTER (WHERE events IS NOT NULL) AS events,
  arg_max(age_bat, game_pk) FILTER (WHERE age_bat IS NOT NULL) AS age_bat,
  max(game_pk) AS game_pk
FROM (
  SELECT batter, game_date, game_pk,
    max(events) AS events, max(age_bat) AS age_bat
  FROM pitches GROUP BY batter, game_date, game_pk
) GROUP BY batter, game_date"""))
def q_last_non_null_per_day(spark, sf_dir):
    p = pitch_view(spark, sf_dir)
    per_game = p.groupBy("batter", "game_date", "game_pk").agg(
        F.max("events").alias("events"), F.max("age_bat").alias("age_bat"))
    return rolling.last_non_null_per_key(per_game, ["batter", "game_date"], ["game_pk"])
