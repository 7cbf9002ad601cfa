"""Landed JSON payloads (schedule, boxscore, line-ups, season stats) -> flat DataFrames.

Payloads are read as text columns (one document per row) and parsed with ``from_json`` against
a declared schema; nested lists become rows through ``explode``. No Python parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEAM_SIDE = T.StructType([
    T.StructField("score", T.LongType()),
    T.StructField("team", T.StructType([T.StructField("abbreviation", T.StringType())])),
    T.StructField("probablePitcher", T.StructType([T.StructField("id", T.LongType())])),
])
_PLAYER = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("primaryPosition", T.StructType([T.StructField("abbreviation", T.StringType())])),
])
GAME_SCHEMA = T.StructType([
    T.StructField("gamePk", T.LongType()),
    T.StructField("status", T.StructType([T.StructField("abstractGameState", T.StringType())])),
    T.StructField("teams", T.StructType([T.StructField("home", _TEAM_SIDE),
                                         T.StructField("away", _TEAM_SIDE)])),
    T.StructField("lineups", T.StructType([
        T.StructField("homePlayers", T.ArrayType(_PLAYER)),
        T.StructField("awayPlayers", T.ArrayType(_PLAYER)),
    ])),
])
SCHEDULE_SCHEMA = T.StructType([
    T.StructField("dates", T.ArrayType(T.StructType([
        T.StructField("date", T.StringType()),
        T.StructField("games", T.ArrayType(GAME_SCHEMA)),
    ]))),
])
_BOX_PLAYER = T.StructType([
    T.StructField("person", T.StructType([T.StructField("id", T.LongType())])),
    T.StructField("position", T.StructType([T.StructField("abbreviation", T.StringType())])),
])
BOXSCORE_SCHEMA = T.StructType([
    T.StructField("teams", T.StructType([
        T.StructField(side, T.StructType([
            T.StructField("players", T.MapType(T.StringType(), _BOX_PLAYER))]))
        for side in ("home", "away")
    ])),
])
SEASON_STATS_SCHEMA = T.StructType([
    T.StructField("stats", T.ArrayType(T.StructType([
        T.StructField("splits", T.ArrayType(T.StructType([
            T.StructField("player", T.StructType([T.StructField("id", T.LongType())])),
            # Some stats are text (rates), so every value is read as text.
            T.StructField("stat", T.MapType(T.StringType(), T.StringType())),
        ]))),
    ]))),
])


def parse(df: DataFrame, text_col: str, schema: T.StructType, out: str = "doc") -> DataFrame:
    return df.withColumn(out, F.from_json(F.col(text_col), schema))


def flatten_schedule(docs: DataFrame, doc: str = "doc", date_col: str | None = None, keep_date: bool = False) -> DataFrame:
    """Schedule -> one row per finished game: scores default to 0, home win and run difference.

    ``date_col`` gives the game date in place of the document's; with ``keep_date`` it is only carried along.
    """
    games = (docs.select(*([F.col(date_col)] if date_col else []),
                         F.explode(F.col(f"{doc}.dates")).alias("d"))
             .select(*([date_col] if date_col else []), F.col("d.date").alias("_date"),
                     F.explode(F.col("d.games")).alias("g")))
    final = games.filter(F.col("g.status.abstractGameState") == "Final")
    hs = F.coalesce(F.col("g.teams.home.score"), F.lit(0))
    vs = F.coalesce(F.col("g.teams.away.score"), F.lit(0))
    return final.select(
        F.col("g.gamePk").alias("game_pk"),
        (F.col(date_col) if date_col and not keep_date else F.to_date("_date")).alias("game_date"),
        F.col("g.teams.home.team.abbreviation").alias("team_h"),
        F.col("g.teams.away.team.abbreviation").alias("team_v"),
        hs.alias("runs_h"), vs.alias("runs_v"),
        (hs > vs).cast("int").alias("home_victory"),
        (hs - vs).alias("run_diff"),
        *([F.col(date_col)] if keep_date else []),
    )


def flatten_boxscore(docs: DataFrame, doc: str = "doc", game_col: str = "game_pk") -> DataFrame:
    """Boxscore -> distinct (game, role, player id); position P is a pitcher, others batters."""
    # Both sides in one pass; a side that the document lacks has no players.
    sides = F.array(*[F.map_values(F.col(f"{doc}.teams.{s}.players")) for s in ("home", "away")])
    players = F.flatten(F.filter(sides, lambda x: x.isNotNull()))
    rows = docs.select(game_col, F.explode(players).alias("p"))
    pid = F.col("p.person.id")
    role = F.when(F.col("p.position.abbreviation") == "P", "pitcher").otherwise("batter")
    return (rows.filter(pid.isNotNull() & (pid != 0))
            .select(game_col, role.alias("role"), pid.alias("player_id"))
            .dropDuplicates())


def flatten_lineups(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Games whose two line-ups are posted -> (game, role, player id), probable pitchers added."""
    games = docs.select(F.explode(F.col(f"{doc}.dates")).alias("d")).select(
        F.explode(F.col("d.games")).alias("g"))
    posted = games.filter((F.size(F.coalesce(F.col("g.lineups.homePlayers"), F.array())) > 0)
                          & (F.size(F.coalesce(F.col("g.lineups.awayPlayers"), F.array())) > 0))
    # Listed players and probable pitchers become entries of one array, so games are read once.
    entry = lambda role, pid: F.struct(role.alias("role"), pid.alias("player_id"))
    listed = F.transform(
        F.concat(F.col("g.lineups.homePlayers"), F.col("g.lineups.awayPlayers")),
        lambda p: entry(F.when(p["primaryPosition"]["abbreviation"] == "P", F.lit("pitcher")).otherwise(F.lit("batter")), p["id"]))
    probable = F.array(*[entry(F.lit("pitcher"), F.col(f"g.teams.{s}.probablePitcher.id")) for s in ("home", "away")])
    rows = posted.select(F.col("g.gamePk").alias("game_pk"), F.inline(F.concat(listed, probable)))
    return rows.filter(F.col("player_id").isNotNull() & (F.col("player_id") != 0)).dropDuplicates()


def flatten_season_stats(docs: DataFrame, stat: str, doc: str = "doc") -> DataFrame:
    """Season stats -> (player id, whole-number stat or NULL when absent or not a number)."""
    splits = docs.select(F.explode(F.col(f"{doc}.stats")).alias("s")).select(
        F.explode(F.col("s.splits")).alias("x"))
    return splits.select(F.col("x.player.id").alias("player_id"),
                         F.col("x.stat").getItem(stat).try_cast("long").alias(stat))
