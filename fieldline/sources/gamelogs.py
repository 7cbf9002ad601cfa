"""Season game logs: headerless quoted CSV with a declared schema, bad lines set apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of a season game log, in the order of the file. Both sides have the same
# statistics and line-up slots (visitors first), so those are spelled out once, each with its short name.
SIDES = {"visiting": "v", "home": "h"}
SIDE_STATS = {
    "abs": "AB", "hits": "H", "doubles": "x2B", "triples": "x3B", "homeruns": "HR", "rbi": "RBI", "sac_hits": "sac_hits",
    "sac_flies": "sac_flies", "hbp": "HBP", "bb": "BB", "iw": "IBB", "k": "K", "sb": "SB", "cs": "CS", "gdp": "GDP", "ci": "CI",
    "lob": "LOB", "pitchers_used": "num_pitchers", "individual_er": "IER", "er": "ER", "wp": "WP", "balks": "balks", "po": "PO",
    "assists": "assists", "errors": "ERR", "pb": "PB", "dp": "x2P", "tp": "x3P",
}
UMPIRES = ["home", "first", "second", "third", "lf", "rf"]
SLOTS = range(1, 10)
GAMELOG_COLUMNS = [
    "date", "game_num", "day_of_week",
    *[c for side in SIDES for c in (f"{side}_team", f"{side}_team_league", f"{side}_team_game_num")],
    "visiting_score", "home_score", "num_outs", "day_night", "completion_info", "forfeit_info", "protest_info", "park_id",
    "attendance", "time_of_game_minutes", "visiting_line_score", "home_line_score",
    *[f"{side}_{stat}" for side in SIDES for stat in SIDE_STATS],
    *[f"ump_{place}_{part}" for place in UMPIRES for part in ("id", "name")],
    *[f"{side}_manager_{part}" for side in SIDES for part in ("id", "name")],
    *[f"{role}_{part}" for role in ("winning_pitcher", "losing_pitcher", "save_pitcher", "game_winning_rbi") for part in ("id", "name")],
    *[f"{side}_starting_pitcher_{part}" for side in SIDES for part in ("id", "name")],
    *[f"{side}_{slot}_{part}" for side in SIDES for slot in SLOTS for part in ("id", "name", "pos")],
    "misc", "acquisition_info",
]
GAMELOG_INTEGERS = ["date", "game_num", "visiting_team_game_num", "home_team_game_num"]
GAMELOG_NUMBERS = [
    "visiting_score", "home_score", "num_outs", "attendance", "time_of_game_minutes",
    *[f"{side}_{stat}" for side in SIDES for stat in SIDE_STATS],
    *[f"{side}_{slot}_pos" for side in SIDES for slot in SLOTS],
]
#: Names of the stored game rows: side names become suffixes.
GAMELOG_RENAMES = {
    f"{side}_{old}": f"{new}_{s}"
    for side, s in SIDES.items()
    for old, new in {"team": "team", "team_league": "league", **SIDE_STATS,
                     **{f"starting_pitcher_{p}": f"starting_pitcher_{p}" for p in ("id", "name")},
                     **{f"{slot}_{p}": f"batter{slot}_{p}" for slot in SLOTS for p in ("id", "name", "pos")},
                     "manager_id": "manager"}.items()
} | {"time_of_game_minutes": "duration"}
#: Fields that the stored rows leave out.
GAMELOG_DROPPED = [
    "day_of_week", "misc", "acquisition_info", "visiting_team_game_num", "home_team_game_num", "completion_info", "forfeit_info",
    "protest_info", "visiting_line_score", "home_line_score", "visiting_manager_name", "home_manager_name",
    "num_outs", "day_night", "park_id", "attendance",
    *[f"ump_{place}_{part}" for place in UMPIRES for part in ("id", "name")],
    *[f"{role}_{part}" for role in ("winning_pitcher", "losing_pitcher", "save_pitcher", "game_winning_rbi") for part in ("id", "name")],
]


def gamelog_schema(columns: Sequence[str], numeric: Sequence[str] = (),
                   integer: Sequence[str] = ()) -> T.StructType:
    num, ints = set(numeric), set(integer)
    return T.StructType([
        T.StructField(c, T.IntegerType() if c in ints else
                      T.DoubleType() if c in num else T.StringType())
        for c in columns
    ])


def full_schema() -> T.StructType:
    """The 161 fields of a season game log."""
    return gamelog_schema(GAMELOG_COLUMNS, GAMELOG_NUMBERS, GAMELOG_INTEGERS)


def _found(spark: SparkSession, path: str) -> bool:
    """Whether a path (or pattern) has files on its own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_gamelogs(spark: SparkSession, path: str, schema: T.StructType,
                  require: bool = True) -> DataFrame:
    """Read one or many season files; a missing season raises ``ValueError``."""
    paths = [path] if isinstance(path, str) else list(path)
    if require:
        missing = [p for p in paths if not _found(spark, p)]
        if missing:
            raise ValueError(f"Season game logs not available: {', '.join(missing)}")
    return (spark.read.schema(schema)
            .option("header", "false").option("sep", ",").option("quote", '"')
            .option("mode", "PERMISSIVE").csv(paths))


def checked_lines(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, require: bool = True) -> DataFrame:
    """Every line of the logs, parsed: (file, line, reason, row).

    ``reason`` is null for a good line, else ``quote`` (a quote that is not closed), ``short`` or
    ``long`` (too few or too many fields) or ``value`` (a field that is no value of its type); the row
    of a bad line is null, so nothing half-read gets on. Blank lines are skipped.
    """
    paths = [path] if isinstance(path, str) else list(path)
    missing = [p for p in paths if not _found(spark, p)] if require else []
    if missing:
        raise ValueError(f"Season game logs not available: {', '.join(missing)}")
    corrupt = "_corrupt_line"
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    lines = lines.where(F.trim("line") != "")
    parsed = F.from_csv("line", f"{schema.toDDL()}, {corrupt} string",
                        {"sep": ",", "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"')))
    bare = F.regexp_replace("line", '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    reason = (F.when(quotes % 2 != 0, "quote").when(fields < len(schema), "short").when(fields > len(schema), "long")
              .when(F.col("parsed").isNull() | F.col(f"parsed.{corrupt}").isNotNull(), "value"))
    out = lines.withColumn("parsed", parsed).withColumn("reason", reason)
    row = F.struct(*[F.col(f"parsed.`{f.name}`").alias(f.name) for f in schema.fields])
    return out.select("file", "line", "reason", F.when(F.col("reason").isNull(), row).alias("row"))


def good_rows(lines: DataFrame) -> DataFrame:
    return lines.where("reason IS NULL").select("row.*")


def rejected(lines: DataFrame) -> DataFrame:
    """The bad lines (file, line, reason), for a table beside the data."""
    return lines.where("reason IS NOT NULL").select("file", "line", "reason")


def line_counts(lines: DataFrame) -> DataFrame:
    """Per file: lines read, kept and set apart by reason."""
    return lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("reason").isNull()).alias("n_kept"),
        *[F.count_if(F.col("reason") == r).alias(f"n_{r}") for r in ("quote", "short", "long", "value")])


def season_rows(log: DataFrame) -> DataFrame:
    """Rows of the full log under the names of the stored game rows, with date, season and scores."""
    date = F.to_date(F.col("date").cast("string"), "yyyyMMdd")
    named = log.drop(*GAMELOG_DROPPED).withColumnsRenamed(GAMELOG_RENAMES).withColumn("date", date)
    return named.withColumn("season", F.year("date")).withColumns(
        {"runs_h": F.col("home_score"), "runs_v": F.col("visiting_score")})
