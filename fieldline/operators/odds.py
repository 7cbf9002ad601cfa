"""Betting-odds enrichment: money line -> implied probability, joined to both sides of a game."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldline.functions import constants as K
from fieldline.functions.scalar import game_key, line_to_prob, mid_probability, yyyymmdd
from fieldline.operators.team import doubleheader_number


def prepare_odds_log(log: DataFrame, team: str = "team_source", season: str = "season",
                     date: str = "Date", source_order: str = "source_row") -> DataFrame:
    """Regular-season rows -> game number, doubleheader number, ``date_dblhead`` and probability.

    The game order inside a (team, season) log is (date, source row), explicit rather than
    relying on the file's row order. If a key still repeats, the first row in that order wins.
    """
    reg = log.filter(F.col("Game") == "REG").withColumn("date_numeric", yyyymmdd(date))
    numbered = doubleheader_number(reg, [team, season], [date, source_order])
    keyed = numbered.select(
        "*",
        game_key("date_numeric", "dblheader_num").alias("date_dblhead"),
        line_to_prob("Line").alias("prob_implied"),
    )
    order = F.struct(F.col(date), F.col(source_order))
    return keyed.groupBy(team, season, "date_dblhead").agg(
        F.min_by("prob_implied", order).alias("prob_implied"),
        F.min_by("Total", order).alias("Total"),
        F.min_by("OU", order).alias("OU"),
    )


def odds_join(games: DataFrame, odds: DataFrame, first_season: int = K.ODDS_FIRST_LOOKUP_SEASON,
              key: Sequence[str] = ("season", "date_dblhead"), team: str = "team_source",
              home_team: str = "team_h", visitor_team: str = "team_v",
              drop_missing: bool = True) -> DataFrame:
    """Look up both teams' implied probabilities, the total and its result.

    The odds of one key (a day, or a part of a doubleheader) are one map from team to odds, which holds
    at most every team once, so both sides are looked up by one join and the log is read once. ``odds`` must
    hold one row per key and team, as ``prepare_odds_log`` makes it; a repeat is an error.

    Seasons before ``first_season`` are not looked up (probabilities 0, line 0, result '').
    Missing games give 0 / 0 / ''. With ``drop_missing``, games of looked-up seasons whose home
    probability is 0 are removed, as the source does.
    """
    key = list(key)
    lookup = F.col("season") >= F.lit(first_season)
    quote = F.struct(F.col("prob_implied"), F.col("Total"), F.col("OU"))
    by_day = odds.where(F.col(team).isNotNull()).groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(team), quote))).alias("_odds"))
    j = games.join(by_day, key, "left").select(
        *games.columns, F.col("_odds")[F.col(home_team)].alias("_h"), F.col("_odds")[F.col(visitor_team)].alias("_v"))
    j = j.select(*games.columns, F.col("_h.prob_implied").alias("_ph"), F.col("_h.Total").alias("_total"),
                 F.col("_h.OU").alias("_ou"), F.col("_v.prob_implied").alias("_pv"))
    ph = F.when(lookup, F.coalesce(F.col("_ph"), F.lit(0.0))).otherwise(F.lit(0.0))
    pv = F.when(lookup, F.coalesce(F.col("_pv"), F.lit(0.0))).otherwise(F.lit(0.0))
    out = j.select(
        *games.columns,
        ph.alias("implied_prob_h"),
        pv.alias("implied_prob_v"),
        mid_probability(ph, pv).alias("implied_prob_h_mid"),
        F.when(lookup, F.coalesce(F.col("_total").cast("double"), F.lit(0.0)))
        .otherwise(F.lit(0.0)).alias("over_under_line"),
        F.when(lookup, F.coalesce(F.col("_ou"), F.lit(""))).otherwise(F.lit(""))
        .alias("over_under_result"),
    )
    if drop_missing:
        out = out.filter(~(lookup & (F.col("implied_prob_h") == 0)))
    return out
