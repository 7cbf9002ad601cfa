"""Window state: the last games of every entity, enough to compute the next day's features.

A lagged window over ``w`` games needs the ``w`` games before a day and nothing older. The tail of an
entity holds its newest day's games and the ``keep`` games before that day, so the newest day can be
rolled again with the same result, and the next day needs the tail and its own games only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_games(games: DataFrame, keep: int, entity: str = "mlbam_id", date_col: str = "game_date",
               game_col: str = "game_pk") -> DataFrame:
    """Per entity: the games of its newest day and the ``keep`` games before it.

    The rank limit is applied before the shuffle, so an entity with a very long history is cut to
    ``keep`` games per input task.
    """
    newest = games.groupBy(entity).agg(F.max(date_col).alias("_newest"))
    marked = games.join(newest, entity).withColumn("_day", F.col(date_col) == F.col("_newest"))
    order = Window.partitionBy(entity).orderBy(F.col(date_col).desc(), F.col(game_col).desc())
    older = marked.where("NOT _day").withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= keep)
    return marked.where("_day").select(*games.columns).unionByName(older.select(*games.columns))


def rolled(tail: DataFrame, day_games: DataFrame, day, entity: str = "mlbam_id", date_col: str = "game_date") -> DataFrame:
    """The rows that decide one day's features: the day's games and the tails of who plays, before that day."""
    today = day_games.where(F.col(date_col) == day)
    active = today.select(entity).distinct()
    past = tail.where(F.col(date_col) < day).join(active, entity, "left_semi")
    return past.unionByName(today, allowMissingColumns=True)
