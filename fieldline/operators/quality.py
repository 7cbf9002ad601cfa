"""Cleaning and data-quality operators for landed pitch and team-log frames."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldline.functions.constants import REQUIRED_PITCH_COLUMNS
from fieldline.functions.scalar import lenient_date, lenient_number, non_empty, null_if_nan

log = logging.getLogger("fieldline.quality")

DEFAULT_MIN_RELEASE_SPEED = 40.0
FLOAT_PITCH_COLUMNS = [
    "RELEASE_SPEED", "RELEASE_SPIN_RATE", "PFX_X", "PFX_Z", "PLATE_X", "PLATE_Z",
    "RELEASE_EXTENSION", "LAUNCH_SPEED", "LAUNCH_ANGLE",
]


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def drop_blank(df: DataFrame, column: str = "pitch_type") -> DataFrame:
    """Drop rows whose ``column`` is NULL or the empty string."""
    return df.filter(non_empty(column))


def project_to_schema(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Keep the columns also in ``target_columns`` (case-insensitive), named as in the target."""
    by_lower = {c.lower(): c for c in df.columns}
    keep = [(by_lower[t.lower()], t) for t in target_columns if t.lower() in by_lower]
    return df.select(*[F.col(s).alias(t) for s, t in keep])


def normalize_nulls(df: DataFrame) -> DataFrame:
    """NaN in floating columns and 'nan'/'NaN'/'NAN' text become NULL."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        out.append(null_if_nan(f.name, t).alias(f.name) if t in ("double", "float", "string")
                   else F.col(f.name))
    return df.select(*out)


def clean_pitches(df: DataFrame, date_col: str = "GAME_DATE",
                  known_columns: Sequence[str] | None = None,
                  float_columns: Sequence[str] = FLOAT_PITCH_COLUMNS) -> DataFrame:
    """Upper-case names, parse the date, cast physics columns to double, drop unknown columns."""
    df = upper_columns(df)
    if known_columns is not None:
        df = project_to_schema(df, [c.upper() for c in known_columns])
    cols = []
    for c in df.columns:
        if c == date_col:
            cols.append(lenient_date(c).alias(c))
        elif c in float_columns:
            cols.append(lenient_number(c, "double").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def _bad_speed(speed: Column, min_speed: float, max_speed: float | None) -> Column:
    """Missing or below the limit; an upper limit applies only where a caller sets one."""
    bad = speed.isNull() | (speed < min_speed)
    return bad if max_speed is None else bad | (speed > max_speed)


def quality_report(df: DataFrame, min_speed: float = DEFAULT_MIN_RELEASE_SPEED,
                   max_speed: float | None = None,
                   angle_col: str = "LAUNCH_ANGLE", speed_col: str = "RELEASE_SPEED") -> DataFrame:
    """One-row report in one pass: rows, unusual launch angles, implausible release speeds."""
    angle, speed = F.col(angle_col), F.col(speed_col)
    bad_speed = _bad_speed(speed, min_speed, max_speed)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if((angle > 90) | (angle < -90)).alias("n_unusual_angle"),
        F.count_if(bad_speed).alias("n_bad_speed"),
    )


def validate_pitches(df: DataFrame, required: Sequence[str] = REQUIRED_PITCH_COLUMNS,
                     min_speed: float = DEFAULT_MIN_RELEASE_SPEED,
                     max_speed: float | None = None) -> DataFrame:
    """Hard checks raise ``ValueError``; soft checks log warnings. Returns the kept rows.

    Empty input and missing key columns fail, each named in the message. Launch angles outside +-90 are only reported.
    Rows with a missing or implausible release speed are dropped and counted.
    """
    missing = [c for c in required if c not in df.columns]
    has_angle = "LAUNCH_ANGLE" in df.columns
    has_speed = "RELEASE_SPEED" in df.columns
    report = df.agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if((F.col("LAUNCH_ANGLE") > 90) | (F.col("LAUNCH_ANGLE") < -90))
         if has_angle else F.lit(0)).alias("bad_angle"),
        (F.count_if(_bad_speed(F.col("RELEASE_SPEED"), min_speed, max_speed)) if has_speed
         else F.lit(0)).alias("bad_speed"),
    ).first()  # one pass tells emptiness and both counts
    problems = [f"Missing required columns: {', '.join(missing)}"] if missing else []
    if not report["n"]:
        problems.append("No rows in DataFrame")
    if problems:
        raise ValueError("These pitches can't be used: " + "; ".join(problems))
    if report["bad_angle"]:
        log.warning("Unusual launch angles detected (>90 or <-90) — review source data.")
    kept = df
    if has_speed:
        kept = df.filter(~_bad_speed(F.col("RELEASE_SPEED"), min_speed, max_speed))
        if report["bad_speed"]:
            log.warning(
                f"Dropped {report['bad_speed']} rows with missing or implausible release speed.")
    log.info(f"Checked {report['n']:,} pitch rows.")
    return kept


def lenient_numeric_columns(df: DataFrame, columns: Sequence[str], to: str = "double") -> DataFrame:
    cols = set(columns)
    return df.select(*[lenient_number(c, to).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where every one of ``columns`` is NULL (repeated header rows)."""
    return df.dropna(how="all", subset=list(columns))


def clean_team_log(df: DataFrame, rename: Mapping[str, str], drop: Sequence[str],
                   numeric: Sequence[str], date_col: str = "DATE",
                   date_format: str = "yyyy-MM-dd", season_col: str = "SEASON") -> DataFrame:
    """Flatten/rename, drop columns, lenient numbers, drop header rows and dateless rows,
    parse the date, upper-case names and derive the season when absent."""
    df = df.withColumnsRenamed(dict(rename)).drop(*drop)
    df = lenient_numeric_columns(df, numeric)
    df = drop_all_null(df, numeric)
    df = upper_columns(df)
    dc = date_col.upper()
    df = df.withColumn(dc, lenient_date(dc, date_format)).dropna(subset=[dc])
    if season_col.upper() not in df.columns:
        df = df.withColumn(season_col.upper(), F.year(dc))
    return df


# The columns of a team's game log page, by header group; a flat landed column is named
# "group_name", or by the name alone outside of the groups.
_STARTER = {"Player": "OppStart", "T": "OppStartThrows"}
_STATS = {
    "batting": ["PA", "AB", "R", "H", "2B", "3B", "HR", "RBI", "BB", "IBB", "SO", "HBP", "SB", "CS", "LOB", "BA", "OBP", "SLG", "OPS",
                "TB", "GIDP", "SH", "SF", "ROE", "BAbip"],
    "pitching": ["IP", "H", "R", "ER", "HR", "BB", "IBB", "SO", "HBP", "BK", "WP", "BF", "ERA", "FIP", "GB", "FB", "LD", "PU", "IR", "IS",
                 "SB", "CS", "PO", "AB", "2B", "3B", "GIDP", "SF", "ROE", "BAbip"],
}
_RENAMED = {"2B": "X2B", "3B": "X3B", "BAbip": "BABIP", "IS": "Inh_Score"}
_TEXT_COLUMNS = ["Team", "Season", "Date", "Opp", *_STARTER.values()]


def team_log_columns(kind: str) -> dict[str, str]:
    """Landed flat column -> stored column of a "batting" or "pitching" team log."""
    if kind not in _STATS:
        raise ValueError(f"unknown team log {kind!r}; use 'batting' or 'pitching'")
    stats = {f"{kind.title()} Stats_{c}": _RENAMED.get(c, c) for c in _STATS[kind]}
    score = ["Inn"] if kind == "batting" else ["Inn", "RS", "RA"]
    own = {f"Opp Starter_{c}": name for c, name in _STARTER.items()} if kind == "batting" else {"Opp": "Opp"}
    return {c: c for c in ("Team", "Season", "Date")} | own | {f"Score_{c}": c for c in score} | stats


def team_log(df: DataFrame, kind: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A landed team log under its stored names: known columns only, lenient numbers, no header or total rows.

    Columns that the page lacks stay absent. The date keeps no doubleheader suffix such as " (1)". The season
    comes from the page, else from the date.
    """
    known = {s: t for s, t in team_log_columns(kind).items() if s in df.columns}
    numeric = [t for t in known.values() if t not in _TEXT_COLUMNS]
    named = df.select(*[F.col(f"`{s}`").alias(t) for s, t in known.items()])
    rows = drop_all_null(lenient_numeric_columns(named, numeric), numeric) if numeric else named
    day = lenient_date(F.regexp_replace("Date", r"\s*\(\d\)\s*$", ""), date_format)
    season = F.coalesce(F.col("Season").try_cast("int"), F.year("Date")) if "Season" in known.values() else F.year("Date")
    return rows.withColumn("Date", day).dropna(subset=["Date"]).withColumn("Season", season)
