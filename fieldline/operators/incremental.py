"""Operators of the incremental jobs: pair history, change detection, id selection, resume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldline.functions.scalar import key_text, roster_hash
from fieldline.operators.segments import running_totals


# --- batter-vs-pitcher history -------------------------------------------------------------------
def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """Newest row per key (``row_number() = 1``; Spark plans a partial top-1 before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_desc])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def pair_history_increment(day_pairs: DataFrame, history: DataFrame,
                           pair: Sequence[str] = ("batter", "pitcher")) -> DataFrame:
    """New history rows for one day's pair-games: prior cumulative totals (0 for a new pair)
    plus the day's counts. As in the source, the totals include the current game and two games
    of a pair on one day both start from the same prior."""
    pair = list(pair)
    prior = latest_per_key(history, pair, ["game_date", "game_pk"]).select(
        *pair, F.col("bvp_pa_prior").alias("_pa0"), F.col("bvp_hr_prior").alias("_hr0"))
    j = day_pairs.join(prior, pair, "left")
    return j.select(
        *pair, "game_date", "game_pk", "pa", "hr",
        (F.coalesce(F.col("_pa0"), F.lit(0)) + F.col("pa")).cast("long").alias("bvp_pa_prior"),
        (F.coalesce(F.col("_hr0"), F.lit(0)) + F.col("hr")).cast("long").alias("bvp_hr_prior"),
    )


def pair_history_rebuild(pair_games: DataFrame, pair: Sequence[str] = ("batter", "pitcher"),
                         rows_per_segment: int | None = None) -> DataFrame:
    """Full rebuild: running totals per pair over (date, game), current game included.

    ``rows_per_segment`` splits pairs with more games than that into segments with carried totals.
    """
    if rows_per_segment:
        out = running_totals(pair_games, ["pa", "hr"], list(pair), ["game_date", "game_pk"], rows_per_segment)
        return out.select(*pair, "game_date", "game_pk", "pa", "hr",
                          F.col("total_pa").alias("bvp_pa_prior"), F.col("total_hr").alias("bvp_hr_prior"))
    w = (Window.partitionBy(*pair).orderBy("game_date", "game_pk")
         .rowsBetween(Window.unboundedPreceding, 0))
    return pair_games.select(
        *pair, "game_date", "game_pk", "pa", "hr",
        F.sum("pa").over(w).cast("long").alias("bvp_pa_prior"),
        F.sum("hr").over(w).cast("long").alias("bvp_hr_prior"),
    )


# --- line-ups and change detection ----------------------------------------------------------------
def roster_sets(lineup_rows: DataFrame, game: str = "game_pk", player: str = "player_id",
                role: str = "role") -> DataFrame:
    """Per game: sorted distinct batter ids and pitcher ids."""
    return lineup_rows.groupBy(game).agg(
        F.array_sort(F.collect_set(F.when(F.col(role) == "batter", F.col(player))))
        .alias("batter_ids"),
        F.array_sort(F.collect_set(F.when(F.col(role) == "pitcher", F.col(player))))
        .alias("pitcher_ids"),
    )


def with_roster_hash(rosters: DataFrame) -> DataFrame:
    return rosters.withColumn(
        "lineup_hash", roster_hash(F.concat(F.col("batter_ids"), F.col("pitcher_ids"))))


def changed_rosters(current: DataFrame, checkpoints: DataFrame, game: str = "game_pk") -> DataFrame:
    """Games that are new or whose stored hash differs from the current one."""
    stored = checkpoints.select(game, F.col("lineup_hash").alias("_stored"))
    j = current.join(stored, game, "left")
    return j.filter(~F.col("lineup_hash").eqNullSafe(F.col("_stored"))).drop("_stored")


# --- id selection and history slices -----------------------------------------------------------
def as_of_date(df: DataFrame, date_col: str = "game_date") -> Column:
    """The newest date of ``df`` as a scalar subquery (no collect, no cross join)."""
    return df.agg(F.max(date_col)).scalar()


def ids_on_date(games: DataFrame, day: Column, entity: str = "mlbam_id",
                date_col: str = "game_date") -> DataFrame:
    return games.filter(F.col(date_col) == day).select(entity).distinct()


def recent_ids(games: DataFrame, day: Column, days: int, entity: str = "mlbam_id",
               date_col: str = "game_date", where: Column | None = None) -> DataFrame:
    cond = F.col(date_col) >= F.date_sub(day, days)
    if where is not None:
        cond = cond & where
    return games.filter(cond).select(entity).distinct()


def lookback(games: DataFrame, ids: DataFrame, day: Column, days: int,
             entity: str = "mlbam_id", date_col: str = "game_date") -> DataFrame:
    """History rows of ``ids`` from ``day - days`` on (date range pushed to the scan)."""
    recent = games.filter(F.col(date_col) >= F.date_sub(day, days))
    return recent.join(ids, entity, "left_semi")


def year_slice(df: DataFrame, year: int, date_col: str = "game_date") -> DataFrame:
    """Rows of one calendar year as a range predicate (prunable, unlike ``year(c) = y``)."""
    return df.filter((F.col(date_col) >= F.make_date(F.lit(year), F.lit(1), F.lit(1)))
                     & (F.col(date_col) < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))))


# --- resumable backfill ---------------------------------------------------------------------------
def remaining_work(all_keys: DataFrame, done_keys: DataFrame, parts: Sequence[str],
                   key_col: str = "work_key") -> DataFrame:
    """Work items whose ``id_year`` text key is not in the done table."""
    keyed = all_keys.withColumn(key_col, key_text(*parts))
    return keyed.join(done_keys.select(key_col), key_col, "left_anti")


def qualified(stats: DataFrame, stat: str, minimum: int) -> DataFrame:
    """Rows whose stat (missing = 0) reaches ``minimum``."""
    return stats.filter(F.coalesce(F.col(stat), F.lit(0)) >= minimum)
