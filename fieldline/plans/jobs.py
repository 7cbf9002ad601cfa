"""Batch jobs composed from the operators (daily load, pair history, feature recompute, backfills).

Every job is one Spark plan per output table; dates are parameters (``as_of``), never the clock.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldline.functions import constants as K
from fieldline.functions.scalar import key_text
from fieldline.operators import incremental as I
from fieldline.operators import merge as M
from fieldline.operators import odds, quality, rollup, rolling, tails, team
from fieldline.session import materialize, store
from fieldline.sources import tables as TB

GAME_KEYS = ["mlbam_id", "game_date", "game_pk"]
PAIR_KEYS = ["batter", "pitcher", "game_pk"]
#: Layouts: ids rise with time, so a day's rows fall into few ranges of them.
GAME_RANGES = ["game_pk/10000"]
PLAYER_RANGES = ["mlbam_id/1000"]
#: Games of one player in one window task at most.
ROWS_PER_SEGMENT = 100_000


# I1: landed pitches -> player-game rows, upserted on (id, date, game)
def daily_player_games(spark: SparkSession, pitches: DataFrame, batter_table: str,
                       pitcher_table: str) -> None:
    TB.upsert_table(spark, rollup.batter_game_rollup(pitches), batter_table, GAME_KEYS,
                    partition_by=["game_date"])
    TB.upsert_table(spark, rollup.pitcher_game_rollup(pitches), pitcher_table, GAME_KEYS,
                    partition_by=["game_date"])


# I2: replace the raw pitches of whole dates
def daily_pitches(spark: SparkSession, pitches: DataFrame, table: str, source: str,
                  loaded_at: dt.datetime | None = None) -> None:
    """``loaded_at`` marks the rows of this load; rows that carry a mark already keep it."""
    if "_loaded_at" not in pitches.columns:
        pitches = pitches.withColumn("_loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
    latest = M.dedup_latest(pitches, ["game_pk", "at_bat_number", "pitch_number"], ["_loaded_at"])
    TB.replace_slice_table(spark, latest.withColumn("_source", F.lit(source)), table, ["game_date"])


# I3 / I8: game results from schedule payloads, one row per game_pk (newest load wins)
def game_results(spark: SparkSession, results: DataFrame, table: str) -> None:
    """Only the ranges of ``game_pk`` that ``results`` has rows for are rewritten."""
    TB.merge_latest_table(spark, results, table, ["game_pk"], ["_loaded_at"], partition_by=GAME_RANGES)


# I4: pair history for one date (insert-only; a re-run adds nothing)
def pair_history(spark: SparkSession, pitches: DataFrame, history_table: str,
                 as_of: dt.date) -> int:
    day = rollup.pair_game_rollup(pitches.filter(F.col("game_date") == F.lit(as_of)))
    if not TB.table_exists(spark, history_table):
        return TB.append(I.pair_history_rebuild(day), history_table)
    history = TB.read_table(spark, history_table).filter(F.col("game_date") < F.lit(as_of))
    inc = I.pair_history_increment(day, history)
    return TB.merge_insert_only_table(spark, inc, history_table, PAIR_KEYS)


# I5 / I11: feature recompute in four modes, written for the target dates only
def compute_features(spark: SparkSession, games: DataFrame, kind: str,
                     ids: DataFrame | Sequence[int] | None = None, game_date: dt.date | None = None,
                     year: int | None = None, allow_full_recompute: bool = False,
                     history_days: int | None = None, lookback_days: int = 0, stored: bool = False) -> DataFrame | str:
    """Return the feature rows to write, or ``"skipped"`` when nothing selects the work.

    ``ids`` is a frame with a column mlbam_id (joined, so it may be of any size) or a list; None means
    no selection by id, an empty list that nobody is selected, which never widens to everybody.
    History read before the target is long enough for the largest window (``history_days``,
    default: all of it), so incremental rows equal a full recompute; only target rows are
    returned: those of ``game_date`` and of the ``lookback_days`` before it. ``stored`` counts the games
    of each player at once and stores the counts (``segments.with_segments``).
    """
    if isinstance(ids, (list, tuple, set)) and not ids and not allow_full_recompute:
        return "skipped"
    if ids is None and not year and not game_date and not allow_full_recompute:
        return "skipped"
    src = games
    if isinstance(ids, DataFrame):
        src = src.join(ids.select("mlbam_id"), "mlbam_id", "left_semi")
    elif ids:
        src = src.filter(F.col("mlbam_id").isin(list(ids)))
    elif game_date is not None:
        active = I.ids_on_date(games, F.lit(game_date))
        src = src.join(active, "mlbam_id", "left_semi")
    if game_date is not None:
        src = src.filter(F.col("game_date") <= F.lit(game_date))
        if history_days is not None:
            src = src.filter(F.col("game_date") >= F.date_sub(F.lit(game_date), history_days))
    feats = _features(src, kind, stored=stored)
    if game_date is not None:
        feats = feats.filter(F.col("game_date").between(F.date_sub(F.lit(game_date), lookback_days), F.lit(game_date)))
    elif year is not None:
        feats = I.year_slice(feats, year)
    return feats


def _features(games: DataFrame, kind: str, rows_per_segment: int | None = ROWS_PER_SEGMENT,
              stored: bool = False) -> DataFrame:
    build = rolling.batter_rolling_features if kind == "batter" else rolling.pitcher_rolling_features
    windows = K.BATTER_WINDOWS if kind == "batter" else K.PITCHER_WINDOWS
    return build(games, windows=windows, rows_per_segment=rows_per_segment, stored=stored)


def write_features(spark: SparkSession, games: DataFrame, kind: str, table: str, **target) -> str:
    """I5: ``compute_features`` stored on (id, date, game), one partition a day; "skipped" or "written".

    Only the days that get rows are rewritten. A full recompute replaces the table, so that rows of
    games that are gone go too.
    """
    feats = compute_features(spark, games, kind, **target)
    if isinstance(feats, str):
        return feats
    if target.get("allow_full_recompute") and not any(target.get(k) for k in ("game_date", "year")) and target.get("ids") is None:
        TB.overwrite(feats, table, partition_by=["game_date"])
    else:
        _store_features(spark, feats, table)
    return "written"


def _store_features(spark: SparkSession, feats: DataFrame, table: str) -> None:
    TB.upsert_table(spark, feats, table, [c for c in GAME_KEYS if c in feats.columns], partition_by=["game_date"])


def write_feature_years(spark: SparkSession, games: DataFrame, kind: str, table: str,
                        first: int, last: int) -> str:
    """I11: all years of a range in one plan, so that no year reads the history again."""
    feats = compute_features(spark, games, kind, allow_full_recompute=True)
    years = feats.filter((F.col("game_date") >= F.make_date(F.lit(first), F.lit(1), F.lit(1)))
                         & (F.col("game_date") < F.make_date(F.lit(last + 1), F.lit(1), F.lit(1))))
    _store_features(spark, years, table)
    return "written"


# I5 with kept state: a day's run reads the players' tails and the day, never the history
def start_tails(spark: SparkSession, games: DataFrame, kind: str, tail_table: str) -> None:
    """(Re)build the tail table from a game table, e.g. first or after games of past days changed."""
    keep = max(K.BATTER_WINDOWS if kind == "batter" else K.PITCHER_WINDOWS)
    TB.overwrite(tails.last_games(games, keep), tail_table, partition_by=PLAYER_RANGES)


def roll_features(spark: SparkSession, day_games: DataFrame, kind: str, tail_table: str, table: str,
                  game_date: dt.date) -> int:
    """One day's features from the tails and the day's games, then the tails rolled forward.

    Features are stored before the tails, and the newest day may be rolled again, so a run that fails
    is repeated as a whole. A day older than a player's tail can't be rolled (``ValueError``): rebuild
    the tails and recompute. Returns the players of the day.
    """
    day = F.lit(game_date)
    today = day_games.where(F.col("game_date") == day)
    known = TB.read_table(spark, tail_table) if TB.table_exists(spark, tail_table) else today.limit(0)
    rows = materialize(tails.rolled(known, today, day))
    active = rows.select("mlbam_id").distinct()
    newer = known.join(active, "mlbam_id", "left_semi").where(F.col("game_date") > day)
    if not newer.isEmpty():
        raise ValueError(f"the tails hold games after {game_date}: rebuild them with start_tails")
    feats = _features(rows, kind, None).where(F.col("game_date") == day)  # at most a tail and a day per player
    _store_features(spark, feats, table)
    keep = max(K.BATTER_WINDOWS if kind == "batter" else K.PITCHER_WINDOWS)
    TB.upsert_table(spark, tails.last_games(rows, keep), tail_table, ["mlbam_id"], partition_by=PLAYER_RANGES)
    return active.count()


# I6: changed line-ups only -> recompute -> checkpoint the games that were computed
def changed_lineups(spark: SparkSession, lineup_rows: DataFrame, checkpoints_table: str,
                    as_of: dt.date, computed_at: dt.datetime) -> DataFrame:
    current = I.with_roster_hash(I.roster_sets(lineup_rows))
    if TB.table_exists(spark, checkpoints_table):
        todo = I.changed_rosters(current, TB.read_table(spark, checkpoints_table))
    else:
        todo = current
    return todo.select("game_pk", "lineup_hash", F.lit(as_of).alias("game_date"),
                       F.lit(computed_at).cast("timestamp_ntz").alias("computed_at"),
                       "batter_ids", "pitcher_ids")


def checkpoint_games(spark: SparkSession, computed: DataFrame, checkpoints_table: str) -> None:
    TB.merge_update_insert_table(
        spark, computed.select("game_pk", "lineup_hash", "game_date", "computed_at"),
        checkpoints_table, ["game_pk"], ["lineup_hash", "game_date", "computed_at"], partition_by=GAME_RANGES)


def lineup_features(spark: SparkSession, lineup_rows: DataFrame, games: dict[str, DataFrame],
                    tables: dict[str, str], checkpoints_table: str, as_of: dt.date,
                    computed_at: dt.datetime, lookback_days: int = K.ROLLING_LOOKBACK_DAYS,
                    reliever_days: int = K.RECENT_RELIEVER_DAYS) -> int:
    """I6 whole: line-ups -> changed games -> their players' features -> checkpoints.

    ``games`` and ``tables`` are keyed "batter" and "pitcher". Pitchers also include those who came in
    as relievers in the last ``reliever_days``. Rows of the last ``lookback_days`` are written, from
    windows over all earlier games. The games are marked only after both feature tables are written,
    so a run that fails is taken up again. Returns the number of changed games.
    """
    todo = materialize(changed_lineups(spark, lineup_rows, checkpoints_table, as_of, computed_at))
    n = todo.count()
    if n == 0:
        return 0
    for kind in ("batter", "pitcher"):
        ids = todo.select(F.explode(f"{kind}_ids").alias("mlbam_id")).distinct()
        if kind == "pitcher":
            relief = games[kind].filter((F.col("gs") == 0) & (F.col("game_date") < F.lit(as_of))
                                        & (F.col("game_date") >= F.date_sub(F.lit(as_of), reliever_days)))
            ids = ids.unionByName(relief.select("mlbam_id")).distinct()
        # Stored, the ids have a known size: where that is small, games are not dealt by player to meet them.
        write_features(spark, games[kind], kind, tables[kind], ids=store(ids), game_date=as_of, lookback_days=lookback_days,
                       stored=True)
    checkpoint_games(spark, todo, checkpoints_table)
    return n


# I7: resumable backfill: the keys still to do; a key is done only after its write
def backfill_todo(spark: SparkSession, work: DataFrame, done_table: str,
                  parts: Sequence[str] = ("mlbam_id", "season")) -> DataFrame:
    if not TB.table_exists(spark, done_table):
        return work
    return I.remaining_work(work, TB.read_table(spark, done_table), list(parts))


def backfill(spark: SparkSession, work: DataFrame, done_table: str, run,
             parts: Sequence[str] = ("mlbam_id", "season"), batch_keys: int | None = None) -> int:
    """Do what is left of ``work`` in batches: ``run(batch)`` writes one, then its keys are marked. Returns the keys done.

    A batch holds about ``batch_keys`` keys (all of them by default), dealt by a hash of the key. Its done
    rows are the commit: after a failure only keys of uncommitted batches are run again, so ``run`` has
    to bear a repeat of the batch it failed in (as the upserts do).
    """
    todo = materialize(backfill_todo(spark, work, done_table, parts).select(*work.columns))
    key = key_text(*parts)
    n = todo.select(F.count_distinct(key)).first()[0]
    if n == 0:
        return 0
    batches = -(-n // batch_keys) if batch_keys else 1
    done = 0
    for number in range(batches):
        batch = todo.where(F.pmod(F.xxhash64(key), F.lit(batches)) == number)
        if not batch.isEmpty():
            run(batch)
            done += mark_done(spark, batch, done_table, parts)
    return done


# I9 / I10: season game logs and team logs, one partition per season
def season_logs(spark: SparkSession, logs: DataFrame, table: str, source: str,
                loaded_at: dt.datetime, season_col: str = "season") -> DataFrame:
    """Replace the seasons present in ``logs``; returns the run summary (season, n_rows) of what was stored."""
    rows = materialize(TB.with_load_columns(logs, source, loaded_at))
    TB.replace_slice_table(spark, rows, table, [season_col])
    return rows.groupBy(season_col).agg(F.count(F.lit(1)).alias("n_rows"))


def team_logs(spark: SparkSession, landed: DataFrame, kind: str, table: str, source: str, loaded_at: dt.datetime) -> DataFrame:
    """I10: a landed "batting" or "pitching" team log, cleaned and stored by season; returns the run summary."""
    return season_logs(spark, quality.team_log(landed, kind), table, source, loaded_at, "Season")


def season_games(games: DataFrame, odds_log: DataFrame, first_odds_season: int = K.ODDS_FIRST_LOOKUP_SEASON,
                 rows_per_segment: int | None = None) -> DataFrame:
    """Game rows (``gamelogs.season_rows``) -> outcome, game key, both teams' pre-game features, odds."""
    keyed = team.with_game_key(team.game_outcome(games))
    key = [c for c in ("date_dblhead", "game_pk") if c in keyed.columns]
    stats = team.team_rolling(team.unpivot_sides(keyed), order=key, rows_per_segment=rows_per_segment)
    own = ["season", "game_pk"]
    if "game_pk" not in keyed.columns:
        own, side = ["season", "date_dblhead", "team_h", "team_v"], F.col("home_game") == 1
        stats = stats.withColumns({"team_h": F.when(side, F.col("team")).otherwise(F.col("opponent")),
                                   "team_v": F.when(side, F.col("opponent")).otherwise(F.col("team"))})
    rows = team.games_with_features(stats, keyed.columns, own)
    return odds.odds_join(rows, odds.prepare_odds_log(odds_log), first_odds_season)


def season_backfill(spark: SparkSession, seasons: Sequence[int], read_season, odds_log: DataFrame, table: str, done_table: str,
                    source: str, loaded_at: dt.datetime, first_odds_season: int = K.ODDS_FIRST_LOOKUP_SEASON,
                    seasons_per_batch: int | None = None) -> DataFrame:
    """I9 whole: seasons not yet done -> logs -> features -> odds -> stored seasons; returns (season, n_rows) of the table.

    ``read_season(season)`` returns the game rows of one season. Each batch of seasons is one plan, replaces
    its seasons' partitions and is then marked done.
    """
    def run(batch: DataFrame) -> None:
        rows = None
        for (season,) in batch.select("season").orderBy("season").collect():  # a few years
            one = read_season(season)
            rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
        season_logs(spark, season_games(rows, odds_log, first_odds_season), table, source, loaded_at)

    work = spark.createDataFrame([(s,) for s in seasons], "season int")
    backfill(spark, work, done_table, run, ["season"], seasons_per_batch)
    return TB.read_table(spark, table).groupBy("season").agg(F.count(F.lit(1)).alias("n_rows"))


def mark_done(spark: SparkSession, written: DataFrame, done_table: str,
              parts: Sequence[str] = ("mlbam_id", "season")) -> int:
    keys = written.select(key_text(*parts).alias("work_key")).distinct()
    return TB.merge_insert_only_table(spark, keys, done_table, ["work_key"])
