"""Leak-free rolling windows over per-entity game sequences.

All window sums are "lagged": the row's own game is never inside its window.

Physical design
---------------
Spark's sliding ROWS frame recomputes every frame (O(n * w) per partition). For integer and decimal
columns a lagged window sum over ``w`` rows is taken instead as the difference of two running sums,
``prefix - lag(prefix, w)``, which is exact: one running sum per column serves all window lengths.
Floating columns can't be subtracted without rounding error (and one huge value or NaN would spoil
every later window), so they are summed over the frame itself; NaN counts as missing. All of it runs
behind one Exchange and one Sort on the entity. A count of non-null values over the same rows gives
the pandas semantics: NULL when the frame holds no value (``min_periods=1``) or, for strict windows,
fewer than ``w`` values.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from fieldline.functions import constants as K
from fieldline.functions.scalar import safe_div, null_safe_greatest
from fieldline.operators import segments

UNBOUNDED = Window.unboundedPreceding


def entity_window(entity: str | Sequence[str], order: Sequence[str]) -> WindowSpec:
    parts = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*parts).orderBy(*order)


def _is_floating(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (DoubleType, FloatType))


def rolling_sums(
    df: DataFrame,
    columns: Iterable[str],
    windows: Iterable[int],
    entity: str | Sequence[str],
    order: Sequence[str],
    strict: bool = False,
    name: str = "rollsum_{col}_{w}",
    rows_per_segment: int | None = None,
    grain: Column | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Append one lagged sum per (column, window) without another shuffle or sort.

    With ``rows_per_segment`` the rows of entities with more rows than that are split over several tasks
    (``operators.segments``; ``grain`` and ``tasks`` as there); the result is the same. ``df`` is then read once more
    for exact counts, so it should be a stored table.

    lenient (strict=False): NULL only when the frame holds no value (first row too).
    strict: NULL unless all ``w`` preceding rows exist and hold a value.
    Non-nullable columns (rollup counts) share one row count instead of a count per column.
    """
    windows = list(windows)
    cols = [c for c in columns if c in df.columns]
    if rows_per_segment:
        parts = [entity] if isinstance(entity, str) else list(entity)
        split = segments.with_segments(df, parts, order, rows_per_segment, max(windows), grain, tasks)
        sums = rolling_sums(segments.by_segment(split, parts, tasks), cols, windows, [*parts, segments.SEGMENT], order, strict, name)
        return sums.where(~F.col(segments.HALO)).drop(segments.SEGMENT, segments.HALO)
    spec = entity_window(entity, order)
    exact = [c for c in cols if not _is_floating(df, c)]
    prev = spec.rowsBetween(UNBOUNDED, -1)
    own = df.columns
    prefixes = [F.coalesce(F.count(F.lit(1)).over(prev), F.lit(0)).alias("_rows")]
    for c in exact:
        x = F.col(c) if isinstance(df.schema[c].dataType, DecimalType) else F.col(c).cast("long")
        prefixes.append(F.coalesce(F.sum(x).over(prev), F.lit(0)).alias(f"_sum_{c}"))
        if df.schema[c].nullable:
            prefixes.append(F.coalesce(F.count(x).over(prev), F.lit(0)).alias(f"_n_{c}"))

    def inside(prefix: str, w: int) -> Column:
        return F.col(prefix) - F.coalesce(F.lag(prefix, w).over(spec), F.lit(0))

    exprs = []
    for w in windows:
        need, frame = w if strict else 1, spec.rowsBetween(-w, -1)
        for c in cols:
            if c in exact:
                n = inside(f"_n_{c}" if df.schema[c].nullable else "_rows", w)
                out = F.when(n >= need, inside(f"_sum_{c}", w))
            else:
                x = F.when(~F.isnan(c), F.col(c).cast("double"))
                out = F.sum(x).over(frame)
                out = F.when(F.count(x).over(frame) >= need, out) if strict else out
            exprs.append(out.alias(name.format(col=c, w=w)))
    return df.select("*", *prefixes).select(*own, *exprs)


def batter_rates(w: int, rs=lambda c, w: F.col(f"rollsum_{c}_{w}")) -> list[Column]:
    g = lambda c: rs(c, w)
    pa = g("ab") + g("bb") + g("hbp") + g("sf")
    slg = safe_div(g("h") + g("x2b") + F.lit(2) * g("x3b") + F.lit(3) * g("hr"), g("ab"))
    obp = safe_div(g("h") + g("bb") + g("hbp"), pa)
    b = g("batted_balls")
    return [
        safe_div(g("hr"), pa).alias(f"hr_per_pa_{w}"),
        slg.alias(f"slg_{w}"),
        obp.alias(f"obp_{w}"),
        (slg + obp).alias(f"obs_{w}"),
        safe_div(g("ev_sum"), b).alias(f"ev_{w}"),
        safe_div(g("hard_hits"), b).alias(f"hardhit_{w}"),
        safe_div(g("sweet_spots"), b).alias(f"swspot_{w}"),
        safe_div(g("barrels"), b).alias(f"barrel_{w}"),
        safe_div(g("hr_vs_r"), g("ab_vs_r")).alias(f"hr_per_pa_vs_r_{w}"),
        safe_div(g("hr_vs_l"), g("ab_vs_l")).alias(f"hr_per_pa_vs_l_{w}"),
        safe_div(g("est_woba"), b).alias(f"est_woba_{w}"),
        safe_div(g("est_slg"), b).alias(f"est_slg_{w}"),
    ]


def pitcher_rates(w: int, smoothed: bool = True) -> list[Column]:
    g = lambda c: F.col(f"rollsum_{c}_{w}")
    out = [
        safe_div(g("hr"), g("bfp")).alias(f"hr_per_bf_{w}"),
        safe_div(g("fly_balls"), g("batted_balls_allowed")).alias(f"fb_perc_{w}"),
    ]
    if not smoothed:
        return out
    return out + smoothed_pitcher_rates(w)


def smoothed_pitcher_rates(w: int) -> list[Column]:
    """Rates padded with league-average play up to w*3 innings / w*12 batters faced.

    NULL window sums (first game) stay NULL: the maximum propagates NULL like numpy's NaN.
    """
    g = lambda c: F.col(f"rollsum_{c}_{w}").cast("double")
    ip, bf = g("ip"), g("bfp")
    ip_mod = null_safe_greatest(ip, F.lit(float(w * K.IP_PER_GAME_DEF)))
    bf_mod = null_safe_greatest(bf, F.lit(float(w * K.BF_PER_GAME_DEF)))
    h, bb, so, er, hr = g("h"), g("bb"), g("so"), g("er"), g("hr")
    tb = h + (g("x2b") + F.lit(2.0) * g("x3b") + F.lit(3.0) * hr)
    h_bb = h + bb
    fip = F.lit(13.0) * hr + F.lit(3.0) * h_bb - F.lit(2.0) * so
    d_ip, d_bf = ip_mod - ip, bf_mod - bf
    return [
        ((h_bb + F.lit(K.H_BB_PER_IP_DEF) * d_ip) / ip_mod).alias(f"whip_{w}"),
        ((so + F.lit(K.SO_PER_BF_DEF) * d_bf) / bf_mod).alias(f"so_perc_{w}"),
        ((h_bb + F.lit(K.H_BB_PER_BF_DEF) * d_bf) / bf_mod).alias(f"h_bb_perc_{w}"),
        (((tb + bb) + F.lit(K.TB_BB_PERC_DEF) * d_bf) / bf_mod).alias(f"tb_bb_perc_{w}"),
        (((er + F.lit(K.ER_PER_IP_DEF) * d_ip) / ip_mod) * F.lit(9.0)).alias(f"era_{w}"),
        ((fip + F.lit(K.FIP_PER_IP_DEF) * d_ip) / ip_mod).alias(f"fip_{w}"),
        ((fip + F.lit(K.FIP_PER_BF_DEF) * d_bf) / bf_mod).alias(f"fip_perc_{w}"),
    ]


def last_non_null_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], settled: Sequence[str] = (),
) -> DataFrame:
    """Collapse rows sharing ``keys`` to one: per column, the last non-null value in ``order``.

    Runs as one ``Window`` over ``keys`` ordered by ``order`` with an unbounded frame. Input that
    is already partitioned on a prefix of ``keys`` and sorted (the rolling window's output) needs
    no further Exchange or Sort. Non-nullable columns, and those the caller names as ``settled``
    (never NULL on a key's last row if any row of the key has a value), are read off the last row.
    """
    ordered = Window.partitionBy(*keys).orderBy(*order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    plain = set(settled) | {f.name for f in df.schema.fields if not f.nullable}
    values = [c for c in df.columns if c not in keys]
    out = df.select(
        *keys,
        *[F.col(c) if c in plain else F.last(F.col(c), ignorenulls=True).over(whole).alias(c) for c in values],
        F.row_number().over(ordered).alias("_rn"),
        F.count(F.lit(1)).over(whole).alias("_n"),
    )
    return out.filter(F.col("_rn") == F.col("_n")).select(*df.columns)


def _settled(games: DataFrame, columns: Iterable[str], windows: Iterable[int]) -> list[str]:
    """Lenient sums of non-nullable columns: once an entity has a past game they are never NULL again."""
    return [f"rollsum_{c}_{w}" for w in windows for c in columns if c in games.columns and not games.schema[c].nullable]


def _collapse_keys(entity: str, scope: str, date_col: str) -> list[str]:
    """The season stands in front of the date, so that the collapse keeps the windows' partitioning."""
    return [entity, date_col] if scope == "career" else [entity, "_season", date_col]


def _scope_entity(entity: str, scope: str, date_col: str) -> list[str] | str:
    if scope == "career":
        return entity
    if scope == "season":
        return [entity, "_season"]
    raise ValueError(f"unknown scope {scope!r}; use 'career' or 'season'")


def _split(df: DataFrame, entity: str, scope: str, date_col: str, order: Sequence[str], windows: Sequence[int],
           rows_per_segment: int | None, stored: bool) -> tuple[DataFrame, str | list[str], list[str]]:
    """The rows, the columns to partition windows by, and the keys of the daily collapse, which keep that partitioning.

    All games of a day are in one segment, so the collapse never crosses segments.
    """
    ent = _scope_entity(entity, scope, date_col)
    keys = _collapse_keys(entity, scope, date_col)
    if not rows_per_segment:
        return df, ent, keys
    ent = [ent] if isinstance(ent, str) else ent
    df = segments.with_segments(df, ent, order, rows_per_segment, max(windows), stored=stored)
    return df, [*ent, segments.SEGMENT], [*ent, segments.SEGMENT, date_col]


def _without_halo(df: DataFrame) -> DataFrame:
    return df.where(~F.col(segments.HALO)).drop(segments.HALO) if segments.HALO in df.columns else df


def batter_rolling_features(
    games: DataFrame,
    windows: Sequence[int] = K.BATTER_WINDOWS,
    entity: str = "mlbam_id",
    date_col: str = "game_date",
    game_col: str = "game_pk",
    scope: str = "career",
    collapse_days: bool = True,
    rows_per_segment: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Rolled-up batter games -> sums and rates per window; one row per (entity, date).

    ``rows_per_segment`` splits entities with more games than that (see ``rolling_sums``), ``stored`` as in
    ``segments.with_segments``.
    """
    df = games.withColumn("_season", F.year(date_col)) if scope == "season" else games
    df, ent, keys = _split(df, entity, scope, date_col, [date_col, game_col], windows, rows_per_segment, stored)
    df = _without_halo(rolling_sums(df, K.BATTER_SUM_COLUMNS, windows, ent, [date_col, game_col]))
    df = df.select("*", *[r for w in windows for r in batter_rates(w)])
    if collapse_days:
        df = last_non_null_per_key(df, keys, [game_col], _settled(games, K.BATTER_SUM_COLUMNS, windows))
    return df.drop("_season", segments.SEGMENT)


def pitcher_rolling_features(
    games: DataFrame,
    windows: Sequence[int] = K.PITCHER_WINDOWS,
    entity: str = "mlbam_id",
    date_col: str = "game_date",
    game_col: str = "game_pk",
    scope: str = "career",
    collapse_days: bool = True,
    rows_per_segment: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Rolled-up pitcher games -> sums, plain and smoothed rates; one row per (entity, date).

    Innings are summed as exact outs and divided by 3 afterwards. A stat column missing from
    the input counts as 0. ``rows_per_segment`` and ``stored`` as in ``batter_rolling_features``.
    """
    df = games
    for c in K.PITCHER_SUM_COLUMNS:
        if c not in df.columns and not (c == "ip" and "outs" in df.columns):
            df = df.withColumn(c, F.lit(0).cast("long"))
    if scope == "season":
        df = df.withColumn("_season", F.year(date_col))
    use_outs = "outs" in df.columns
    cols = [c for c in K.PITCHER_SUM_COLUMNS if not (c == "ip" and use_outs)]
    cols = cols + (["outs"] if use_outs else [])
    source = df
    df, ent, keys = _split(df, entity, scope, date_col, [date_col, game_col], windows, rows_per_segment, stored)
    df = _without_halo(rolling_sums(df, cols, windows, ent, [date_col, game_col]))
    if use_outs:
        df = df.select("*", *[(F.col(f"rollsum_outs_{w}") / F.lit(3.0)).alias(f"rollsum_ip_{w}")
                              for w in windows])
        df = df.drop(*[f"rollsum_outs_{w}" for w in windows])
    df = df.select("*", *[r for w in windows for r in pitcher_rates(w)])
    if collapse_days:
        settled = _settled(source, cols, windows)
        if "rollsum_outs_" in "".join(settled):
            settled += [f"rollsum_ip_{w}" for w in windows]
        df = last_non_null_per_key(df, keys, [game_col], settled)
    return df.drop("_season", segments.SEGMENT)
