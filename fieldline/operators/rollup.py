"""Player-game rollups and summary views (one ``groupBy.agg`` each).

Every aggregate is declarative (count_if / sum / min_by / max), so Spark runs a partial
aggregation before the shuffle: a player or game holding a third of all pitches is combined
map-side and never reaches one task as raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldline.functions.constants import (
    BARREL_CODE,
    HARD_HIT_MIN_SPEED,
    HIT_EVENTS,
    NON_AB_EVENTS,
    OUTS_BY_EVENT,
    SWEET_SPOT_MAX_ANGLE,
    SWEET_SPOT_MIN_ANGLE,
    WALK_EVENTS,
)
from fieldline.functions.scalar import non_empty

DEFAULT_ORDER = ("at_bat_number", "pitch_number")


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def _order_key(df: DataFrame, order_cols: Sequence[str]) -> Column:
    cols = [c for c in order_cols if _has(df, c)]
    return F.struct(*[F.col(c) for c in cols])


def first_by_order(value: str | Column, order: Column) -> Column:
    """Value of the first row of the group in ``order`` (a total order struct)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(v, order)


def first_row(order: Column, **values: Column) -> Column:
    """Struct of the first row's values in ``order``: one buffer and one comparison for all of them."""
    return F.min_by(F.struct(*[v.alias(k) for k, v in values.items()]), order)


def first_non_null(value: str | Column, order: Column) -> Column:
    """First non-null value in ``order``; NULL when every value is NULL."""
    v = F.col(value) if isinstance(value, str) else value
    return F.min_by(v, F.when(v.isNotNull(), order))


def clamped_sum(after: str | Column, before: str | Column, where: Column | None = None) -> Column:
    """sum(max(after - before, 0)); rows with a NULL operand are skipped, as a sum skips NaN."""
    a = F.col(after) if isinstance(after, str) else after
    b = F.col(before) if isinstance(before, str) else before
    diff = a - b
    term = F.when(diff.isNotNull(), F.greatest(diff, F.lit(0)))
    if where is not None:
        term = F.when(where, term)
    return F.sum(term)


def outs_expr(events: Column, outs_map: Mapping[str, int] = OUTS_BY_EVENT) -> Column:
    expr = F.lit(0)
    for n in sorted(set(outs_map.values()), reverse=True):
        names = [k for k, v in outs_map.items() if v == n]
        expr = F.when(events.isin(names), F.lit(n)).otherwise(expr)
    return expr


def batter_game_rollup(
    pitches: DataFrame,
    player: str = "batter",
    opponent_pitcher: str = "pitcher",
    date: str = "game_date",
    game: str = "game_pk",
    events: str = "events",
    order_cols: Sequence[str] = DEFAULT_ORDER,
) -> DataFrame:
    """Pitches -> one row per (player, date, game); games without a terminal event are dropped."""
    df = pitches.filter(
        F.col(player).isNotNull() & F.col(date).isNotNull() & F.col(game).isNotNull()
    )
    ev = F.col(events)
    pa = non_empty(ev)
    batted = pa & F.col("launch_speed").isNotNull()
    order = _order_key(df, order_cols)
    speed, angle = F.col("launch_speed"), F.col("launch_angle")
    text = lambda c: F.col(c) if _has(df, c) else F.lit("")
    aggs = [
        F.count_if(pa).alias("_pa"),
        first_row(order, topbot=F.col("inning_topbot"), home_team=F.col("home_team"),
                  away_team=F.col("away_team"), stand=text("stand"), p_throws=text("p_throws"),
                  opp_pitcher_id=F.col(opponent_pitcher) if _has(df, opponent_pitcher)
                  else F.lit(None).cast("long")).alias("_first"),
        (F.min("inning") == 1).cast("int").alias("opp_is_starter"),
        (first_non_null(F.col("age_bat").cast("double"), order) if _has(df, "age_bat")
         else F.lit(None).cast("double")).alias("age"),
        F.count_if(pa & ~ev.isin(NON_AB_EVENTS)).alias("ab"),
        F.count_if(pa & ev.isin(HIT_EVENTS)).alias("h"),
        F.count_if(pa & (ev == "double")).alias("x2b"),
        F.count_if(pa & (ev == "triple")).alias("x3b"),
        F.count_if(pa & (ev == "home_run")).alias("hr"),
        F.count_if(pa & ev.isin(WALK_EVENTS)).alias("bb"),
        F.count_if(pa & (ev == "hit_by_pitch")).alias("hbp"),
        F.count_if(pa & (ev == "sac_fly")).alias("sf"),
        F.count_if(batted).alias("batted_balls"),
        F.coalesce(F.sum(F.when(batted, speed)), F.lit(0.0)).alias("ev_sum"),
        F.count_if(batted & (speed >= HARD_HIT_MIN_SPEED)).alias("hard_hits"),
        F.count_if(batted & (angle >= SWEET_SPOT_MIN_ANGLE) & (angle <= SWEET_SPOT_MAX_ANGLE))
        .alias("sweet_spots"),
        (F.count_if(batted & (F.col("launch_speed_angle") == BARREL_CODE))
         if _has(df, "launch_speed_angle") else F.lit(0).cast("long")).alias("barrels"),
        (F.coalesce(F.sum(F.when(batted, F.col("estimated_woba_using_speedangle"))), F.lit(0.0))
         if _has(df, "estimated_woba_using_speedangle") else F.lit(0.0)).alias("est_woba"),
        (F.coalesce(F.sum(F.when(batted, F.col("estimated_slg_using_speedangle"))), F.lit(0.0))
         if _has(df, "estimated_slg_using_speedangle") else F.lit(0.0)).alias("est_slg"),
    ]
    g = df.groupBy(F.col(player).alias("mlbam_id"), F.col(date).alias("game_date"),
                   F.col(game).alias("game_pk")).agg(*aggs).filter(F.col("_pa") > 0)
    is_home = F.col("_first.topbot") == "Bot"
    right = F.col("_first.p_throws") == "R"
    left = F.col("_first.p_throws") == "L"
    return g.select(
        "mlbam_id", "game_date", "game_pk",
        F.when(is_home, F.col("_first.away_team")).otherwise(F.col("_first.home_team"))
        .alias("opponent"),
        is_home.cast("int").alias("is_home"),
        "_first.stand", "_first.p_throws", "_first.opp_pitcher_id", "opp_is_starter", "age",
        "ab", "h", "x2b", "x3b", "hr", "bb", "hbp", "sf",
        F.when(right, F.col("hr")).otherwise(0).alias("hr_vs_r"),
        F.when(right, F.col("ab")).otherwise(0).alias("ab_vs_r"),
        F.when(left, F.col("hr")).otherwise(0).alias("hr_vs_l"),
        F.when(left, F.col("ab")).otherwise(0).alias("ab_vs_l"),
        "batted_balls", "ev_sum", "hard_hits", "sweet_spots", "barrels", "est_woba", "est_slg",
    )


def pitcher_game_rollup(
    pitches: DataFrame,
    player: str = "pitcher",
    date: str = "game_date",
    game: str = "game_pk",
    events: str = "events",
    order_cols: Sequence[str] = DEFAULT_ORDER,
    outs_map: Mapping[str, int] = OUTS_BY_EVENT,
) -> DataFrame:
    """Pitches -> one row per (pitcher, date, game).

    ``ip`` is outs / 3; ``outs`` is kept as an exact integer so window sums of innings can be
    formed as (sum of outs) / 3 without float drift.
    """
    df = pitches.filter(
        F.col(player).isNotNull() & F.col(date).isNotNull() & F.col(game).isNotNull()
    )
    ev = F.col(events)
    pa = non_empty(ev)
    batted = pa & F.col("launch_speed").isNotNull()
    order = _order_key(df, order_cols)
    g = (
        df.groupBy(F.col(player).alias("mlbam_id"), F.col(date).alias("game_date"),
                   F.col(game).alias("game_pk"))
        .agg(
            F.count_if(pa).alias("bfp"),
            first_row(order, topbot=F.col("inning_topbot"), home_team=F.col("home_team"),
                      away_team=F.col("away_team")).alias("_first"),
            (F.min("inning") == 1).cast("int").alias("gs"),
            F.sum(F.when(pa, outs_expr(ev, outs_map)).otherwise(0)).cast("long").alias("outs"),
            F.count_if(pa & ev.isin(HIT_EVENTS)).alias("h"),
            F.count_if(pa & ev.isin(WALK_EVENTS)).alias("bb"),
            F.count_if(pa & (ev == "strikeout")).alias("so"),
            F.count_if(pa & (ev == "home_run")).alias("hr"),
            F.coalesce(clamped_sum("post_bat_score", "bat_score", pa), F.lit(0)).cast("long")
            .alias("r"),
            F.count_if(pa & (ev == "double")).alias("x2b"),
            F.count_if(pa & (ev == "triple")).alias("x3b"),
            (F.count_if(batted & (F.col("bb_type") == "fly_ball")) if _has(df, "bb_type")
             else F.lit(0).cast("long")).alias("fly_balls"),
            F.count_if(batted).alias("batted_balls_allowed"),
        )
        .filter(F.col("bfp") > 0)
    )
    is_home = F.col("_first.topbot") == "Top"
    return g.select(
        "mlbam_id", "game_date", "game_pk",
        F.when(is_home, F.col("_first.away_team")).otherwise(F.col("_first.home_team"))
        .alias("opponent"),
        is_home.cast("int").alias("is_home_pitcher"),
        "gs",
        (F.col("outs") / F.lit(3.0)).alias("ip"),
        "outs", "bfp", "h", "bb", "so", "hr", "r",
        F.col("r").alias("er"),
        "x2b", "x3b", "fly_balls", "batted_balls_allowed",
    )


def season_batting_summary(pitches: DataFrame, corrected: bool = False) -> DataFrame:
    """Per (year, batter, name) totals and rounded averages (the batter stats view).

    ``corrected=False`` keeps the view's definitions: ``pa`` counts pitches, ``ab`` counts
    terminal events and ``double`` includes double plays.
    """
    ev = F.col("events")
    term = non_empty(ev)
    doubles = ["double"] if corrected else ["double", "double_play"]
    ab = (term & ~ev.isin(NON_AB_EVENTS)) if corrected else term
    pa = term if corrected else F.lit(True)
    ind = lambda p: F.sum(F.when(p, 1).otherwise(0)).cast("long")
    return (
        pitches.filter(F.col("batter").isNotNull())
        .groupBy("game_year", "batter", F.col("batter_name").alias("player_name"))
        .agg(
            ind(pa).alias("pa"),
            ind(ab).alias("ab"),
            ind(ev == "home_run").alias("hr"),
            ind(ev == "single").alias("single"),
            ind(ev.isin(doubles)).alias("double"),
            ind(ev == "triple").alias("triple"),
            ind(ev.isin("walk", "hit_by_pitch")).alias("bb_hbp"),
            ind(ev.isin("strikeout", "strikeout_double_play")).alias("so"),
            ind(F.col("type") == "B").alias("balls_seen"),
            ind(F.col("type") == "S").alias("strikes_seen"),
            F.round(F.avg("launch_speed"), 1).alias("avg_exit_velo"),
            F.round(F.avg("launch_angle"), 1).alias("avg_launch_angle"),
            F.round(F.avg("estimated_ba_using_speedangle"), 3).alias("avg_xba"),
            F.round(F.avg("estimated_woba_using_speedangle"), 3).alias("avg_xwoba"),
            F.round(F.sum("delta_run_exp"), 2).alias("total_runs_added"),
        )
    )


def pitch_arsenal(pitches: DataFrame) -> DataFrame:
    """Per (year, pitcher, name, pitch type, pitch name): velocity, spin, break, strike share."""
    strike = (F.col("type") == "S") | (F.col("description") == "hit_into_play")
    return pitches.groupBy("game_year", "pitcher", "player_name", "pitch_type", "pitch_name").agg(
        F.count(F.lit(1)).alias("pitches_thrown"),
        F.round(F.avg("release_speed"), 1).alias("avg_velo"),
        F.round(F.max("release_speed"), 1).alias("max_velo"),
        F.round(F.avg("release_spin_rate"), 0).alias("avg_spin"),
        F.round(F.avg("pfx_x") * 12, 1).alias("avg_h_break_in"),
        F.round(F.avg("pfx_z") * 12, 1).alias("avg_v_break_in"),
        F.round(F.avg("release_extension"), 1).alias("avg_extension"),
        F.round(
            F.try_divide(F.sum(F.when(strike, 1).otherwise(0)).cast("double"),
                         F.nullif(F.count(F.lit(1)), F.lit(0))) * 100, 1
        ).alias("strike_pct"),
        F.round(F.avg("estimated_woba_using_speedangle"), 3).alias("avg_xwoba"),
    )


def pair_game_rollup(pitches: DataFrame, events: str = "events") -> DataFrame:
    """Plate appearances and home runs per (batter, pitcher, date, game)."""
    ev = F.col(events)
    return (
        pitches.filter(non_empty(ev))
        .groupBy("batter", "pitcher", "game_date", "game_pk")
        .agg(F.count(F.lit(1)).alias("pa"),
             F.sum(F.when(ev == "home_run", 1).otherwise(0)).cast("long").alias("hr"))
    )


def bucket_rate(df: DataFrame, bucket: Column, rate_col: str, bucket_name: str,
                count_name: str = "games", rate_name: str = "rate_pct") -> DataFrame:
    """Group by a CASE bucket; count and average of a 0/1 column in percent (1 decimal)."""
    return df.groupBy(bucket.alias(bucket_name)).agg(
        F.count(F.lit(1)).alias(count_name),
        F.round(F.avg(rate_col) * 100, 1).alias(rate_name),
    )
