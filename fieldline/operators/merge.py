"""Table-maintenance semantics as DataFrame operators (no MERGE-capable table format needed).

Each returns the new table content; ``fieldline.sources.tables`` writes it safely. Key matching
is exact (all key columns, null-safe), never a superset such as ``ids x dates``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def matching(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on exact keys, where null equals null."""
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).distinct()
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(right, cond, how)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete target rows whose key is in ``source``, then insert ``source`` (delete + insert)."""
    return matching(target, source, keys, "left_anti").unionByName(source, allowMissingColumns=True)


def replace_slice(target: DataFrame, source: DataFrame, slice_cols: Sequence[str]) -> DataFrame:
    """Replace every target row of the slices present in ``source`` (e.g. one date)."""
    return upsert(target, source, slice_cols)


def within_key_ranges(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose every key lies between the source's smallest and largest, or is null.

    A pre-filter for key lookups: the bounds are scalar subqueries, which Spark pushes into the scan, so
    row groups of other key ranges (other days, other games) are skipped. Only plain ordered types count.
    """
    for k in keys:
        if isinstance(source.schema[k].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)):
            low, high = (source.agg(f(k)).scalar() for f in (F.min, F.max))
            target = target.where(F.col(k).isNull() | ((F.col(k) >= low) & (F.col(k) <= high)))
    return target


def new_rows_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with keys that the target lacks. Only the source's keys of the target are read on."""
    stored = matching(within_key_ranges(target.select(*keys), source, keys), source, keys, "left_semi")
    return matching(source, stored, keys, "left_anti")


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """WHEN NOT MATCHED THEN INSERT: only source rows with new keys are added; re-runs add nothing."""
    return target.unionByName(new_rows_only(target, source, keys), allowMissingColumns=True)


def merge_update_insert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                        update_cols: Sequence[str] | None = None) -> DataFrame:
    """WHEN MATCHED THEN UPDATE SET update_cols, WHEN NOT MATCHED THEN INSERT.

    Columns outside ``update_cols`` keep the target's value on a match. Null keys match each other. A
    source that repeats a key has no defined result and raises an error.
    """
    keys = list(keys)
    cols = [c for c in target.columns]
    update_cols = list(update_cols) if update_cols is not None else [
        c for c in cols if c not in keys]
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t_hit"))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    once = F.when(n > 1, F.raise_error(F.lit(f"source repeats a key ({', '.join(keys)})")).cast("boolean")).otherwise(True)
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], once.alias("_s_hit"))
    j = t.join(s, reduce(and_, [F.col(f"_t_{k}").eqNullSafe(F.col(f"_s_{k}")) for k in keys]), "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(f"_t_{c}", f"_s_{c}").alias(c))
        elif c in update_cols and c in source.columns:
            out.append(F.when(F.col("_s_hit"), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}"))
                       .alias(c))
        elif c in source.columns:
            out.append(F.when(F.col("_t_hit"), F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}"))
                       .alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*out)


def widen_schema(target: DataFrame, source: DataFrame) -> DataFrame:
    """Union by name; columns missing on either side become NULL (schema widening)."""
    return target.unionByName(source, allowMissingColumns=True)


def dedup_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str],
                 tiebreak: Sequence[str] = (), settle_ties: bool = True) -> DataFrame:
    """Keep one row per key: the newest by ``newest`` (descending), then ``tiebreak`` ascending.

    Rows that still tie are ordered by a hash of all their columns, so the same row stays in any run. A
    caller whose order is total says so with ``settle_ties=False``; then no other column is read for it.
    ``row_number() = 1`` over the key lets Spark plan a partial per-key top-1 before the shuffle,
    so a key with very many copies is reduced map-side.
    """
    last = [] if not settle_ties else [F.xxhash64(*[F.to_json(F.struct(c)) if isinstance(df.schema[c].dataType, T.MapType) else F.col(c) for c in df.columns])]
    order = [F.col(c).desc_nulls_last() for c in newest] + [F.col(c).asc() for c in tiebreak] + last
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
