"""Date grids for backfills, generated per season by Spark (``sequence`` + ``explode``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldline.functions import constants as K


def _md(season: Column, md: tuple[int, int]) -> Column:
    return F.make_date(season, F.lit(md[0]), F.lit(md[1]))


def season_calendar(seasons: DataFrame, season_col: str = "season",
                    bounds=K.SEASON_CALENDAR) -> DataFrame:
    """Every date of each season's window (default Mar 20 - Nov 5)."""
    s = F.col(season_col)
    return seasons.select(
        season_col, F.explode(F.sequence(_md(s, bounds[0]), _md(s, bounds[1]))).alias("day"))


def weekly_chunks(seasons: DataFrame, season_col: str = "season",
                  bounds=K.WEEKLY_CHUNK_SEASON, days: int = 7) -> DataFrame:
    """7-day pieces of each season's window; the last one is cut at the window's end."""
    s = F.col(season_col)
    start, end = _md(s, bounds[0]), _md(s, bounds[1])
    starts = F.sequence(start, end, F.expr(f"INTERVAL {days} DAYS"))
    out = seasons.select(season_col, end.alias("_end"), F.explode(starts).alias("_start"))
    return out.select(
        season_col,
        F.date_format("_start", "yyyy-MM-dd").alias("chunk_start"),
        F.date_format(F.least(F.date_add("_start", days - 1), F.col("_end")), "yyyy-MM-dd")
        .alias("chunk_end"),
    )


def fetch_range(seasons: DataFrame, today: Column, season_col: str = "season",
                bounds=K.PLAYER_FETCH_RANGE) -> DataFrame:
    """Per season: Mar 1 - Nov 30, or up to ``today`` in the current season."""
    s = F.col(season_col)
    end = F.when(s == F.year(today), F.least(_md(s, bounds[1]), today)).otherwise(_md(s, bounds[1]))
    return seasons.select(season_col, _md(s, bounds[0]).alias("range_start"), end.alias("range_end"))


def active_span_grid(rows: DataFrame, entity: str, season_col: str = "season") -> DataFrame:
    """(entity, season) for every season between an entity's first and last one.

    The work grid is built per entity from its own span, so no cross product of unrelated lists.
    """
    span = rows.groupBy(entity).agg(F.min(season_col).alias("_a"), F.max(season_col).alias("_b"))
    return span.select(entity, F.explode(F.sequence("_a", "_b")).alias(season_col))
