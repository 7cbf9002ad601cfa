"""Team game logs: home/visitor unpivot, strict team windows, pre-game features for both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldline.functions import constants as K
from fieldline.functions.scalar import game_key, safe_div, team_obp, yyyymmdd
from fieldline.operators.rolling import rolling_sums

TEAM_STATS = ["BATAVG", "OBP", "SLG", "OBS", "SB", "CS", "ERR"]


def side_columns(columns: Sequence[str], keep: str, drop: str) -> list[tuple[str, str]]:
    """(source, target) pairs: columns not ending in ``drop``, with ``keep`` stripped."""
    return [(c, c.removesuffix(keep)) for c in columns if not c.endswith(drop)]


def game_outcome(df: DataFrame, home_score: str = "home_score",
                 visitor_score: str = "visiting_score") -> DataFrame:
    """Run difference, total and the home-win flag (difference > 0)."""
    diff = F.col(home_score) - F.col(visitor_score)
    return df.select(
        "*",
        diff.alias("run_diff"),
        (diff > 0).cast("int").alias("home_victory"),
        (F.col(home_score) + F.col(visitor_score)).alias("run_total"),
    )


def with_game_key(df: DataFrame, date_col: str = "date", game_num: str = "game_num",
                  out: str = "date_dblhead") -> DataFrame:
    """``yyyymmdd`` of the date followed by the game number, as a long."""
    return df.withColumn(out, game_key(yyyymmdd(date_col), game_num))


def unpivot_sides(games: DataFrame, home_team: str = "team_h", visitor_team: str = "team_v",
                  home_suffix: str = "_h", visitor_suffix: str = "_v") -> DataFrame:
    """Each game -> two team rows (home then visitor view) with ``home_game`` and ``opponent``.

    Columns ending in the other side's suffix are dropped and the own suffix is stripped, so
    every team appears, including one that never visits.
    """
    cols = games.columns
    home = {t: s for s, t in side_columns(cols, home_suffix, visitor_suffix)}
    away = {t: s for s, t in side_columns(cols, visitor_suffix, home_suffix)}
    if home.keys() != away.keys():
        raise ValueError(f"columns of one side only: {sorted(home.keys() ^ away.keys())}")

    def view(source: dict[str, str], home_game: int, opponent: str) -> Column:
        return F.struct(*[F.col(source[t]).alias(t) for t in home],
                        F.lit(home_game).alias("home_game"), F.col(opponent).alias("opponent"))

    # One pass over the games, however they were built.
    return games.select(F.inline(F.array(view(home, 1, visitor_team), view(away, 0, home_team))))


def team_rolling(team_games: DataFrame, windows: Sequence[int] = K.TEAM_WINDOWS,
                 team: str = "team", order: Sequence[str] = ("date_dblhead",),
                 scope: Sequence[str] = ("season",), rows_per_segment: int | None = None) -> DataFrame:
    """Strict lagged sums of the team counts and BATAVG / OBP / SLG / OBS per window.

    ``scope`` adds partition columns: ``("season",)`` restarts every season (as the source
    computes one season at a time); ``()`` runs over the whole history.
    """
    df = rolling_sums(team_games, K.TEAM_SUM_COLUMNS, windows, [team, *scope], list(order),
                      strict=True, rows_per_segment=rows_per_segment)
    rates = []
    for w in windows:
        g = lambda c: F.col(f"rollsum_{c}_{w}")
        slg = safe_div(g("H") + g("x2B") + F.lit(2) * g("x3B") + F.lit(3) * g("HR"), g("AB"))
        obp = team_obp(g("H"), g("BB"), g("AB"))
        rates += [
            safe_div(g("H"), g("AB")).alias(f"rollsum_BATAVG_{w}"),
            obp.alias(f"rollsum_OBP_{w}"),
            slg.alias(f"rollsum_SLG_{w}"),
            (obp + slg).alias(f"rollsum_OBS_{w}"),
        ]
    return df.select("*", *rates)


def pregame_team_features(games: DataFrame, team_stats: DataFrame,
                          key: Sequence[str] = ("season", "game_pk"),
                          windows: Sequence[int] = K.TEAM_WINDOWS,
                          stats: Sequence[str] = TEAM_STATS,
                          home_team: str = "team_h", visitor_team: str = "team_v") -> DataFrame:
    """Attach each side's pre-game window stats: ``{stat}_{w}_h`` and ``{stat}_{w}_v``.

    Team rows that say which side they are (``home_game``, one row per game and side, as
    ``unpivot_sides`` makes them) are put back on one row per game by a single aggregation and joined
    once. Without that column the team table is joined per side on (key, team).
    """
    key = list(key)
    names = [f"rollsum_{s}_{w}" for w in windows for s in stats]
    if "home_game" in team_stats.columns:
        sides = [F.max(F.when(F.col("home_game") == flag, F.col(n))).alias(f"{n.removeprefix('rollsum_')}_{suffix}")
                 for suffix, flag in (("h", 1), ("v", 0)) for n in names]
        return games.join(team_stats.groupBy(*key).agg(*sides), key, "left")

    def side(suffix: str, team_col: str) -> DataFrame:
        return team_stats.select(
            *[F.col(k) for k in key], F.col("team").alias(team_col),
            *[F.col(n).alias(f"{n.removeprefix('rollsum_')}_{suffix}") for n in names],
        )

    out = games.join(side("h", home_team), [*key, home_team], "left")
    return out.join(side("v", visitor_team), [*key, visitor_team], "left")


def games_with_features(team_stats: DataFrame, columns: Sequence[str], key: Sequence[str] = ("season", "game_pk"),
                        windows: Sequence[int] = K.TEAM_WINDOWS, stats: Sequence[str] = TEAM_STATS,
                        home_team: str = "team_h", visitor_team: str = "team_v",
                        home_suffix: str = "_h", visitor_suffix: str = "_v") -> DataFrame:
    """Game rows put together again from their two team rows, with both sides' pre-game window stats.

    ``team_stats`` are rows of ``unpivot_sides`` (one per game and side, every column carried along), so the
    games are not read a second time; ``columns`` are the game's own columns, ``key`` tells a game. One
    aggregation gives the game row and the features that ``pregame_team_features`` joins.
    """
    key = list(key)

    def of_side(c: str, name: str, home: int) -> Column:
        return F.max(F.when(F.col("home_game") == home, F.col(c))).alias(name)

    def game_column(c: str) -> Column:
        if c in (home_team, visitor_team):
            return of_side("team", c, int(c == home_team))
        for suffix, home in ((home_suffix, 1), (visitor_suffix, 0)):
            if c.endswith(suffix):
                return of_side(c.removesuffix(suffix), c, home)
        return of_side(c, c, 1)

    features = [of_side(f"rollsum_{s}_{w}", f"{s}_{w}_{side}", home) for side, home in (("h", 1), ("v", 0)) for w in windows for s in stats]
    rows = team_stats.groupBy(*key).agg(*[game_column(c) for c in columns if c not in key], *features)
    return rows.select(*columns, *[c for c in rows.columns if c not in columns])


def doubleheader_number(log: DataFrame, partition: Sequence[str], order: Sequence[str],
                        date_text: str = "date_numeric") -> DataFrame:
    """1 if the next game is on the same date, plus 2 if the previous one is (0..3)."""
    from pyspark.sql import Window

    w = Window.partitionBy(*partition).orderBy(*order)
    nxt = F.lead(date_text).over(w)
    prv = F.lag(date_text).over(w)
    first = F.coalesce((F.col(date_text) == nxt).cast("int"), F.lit(0))
    second = F.coalesce((F.col(date_text) == prv).cast("int"), F.lit(0)) * 2
    return log.select("*", F.row_number().over(w).alias("game_no"),
                      (first + second).alias("dblheader_num"))
