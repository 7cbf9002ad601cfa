"""Joins on validity intervals: several spans per key, open ends, overlaps.

A range condition alone would compare every row of a key with every span of that key. Here spans are
cut into bins of ``width`` and both sides meet by an equi-join on (key, bin), so a hot key is spread
over its bins, a row meets only spans near it, and Spark may broadcast the spans by their size. Ends
are inclusive; a null end is open and is clipped to the values that the other side has, so a span never
makes more bins than those values reach over. A span whose start lies after its end matches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _number(df: DataFrame, c: str) -> Column:
    """Dates and timestamps as days and seconds, numbers as they are."""
    kind = df.schema[c].dataType.typeName()
    if kind == "date":
        return F.unix_date(c)
    return F.unix_seconds(F.col(c).cast("timestamp")) if kind.startswith("timestamp") else F.col(c)


def _bin(x: Column, width) -> Column:
    return F.floor(x / F.lit(width)).cast("long")


def _same(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys])


def _binned(spans: DataFrame, start: str, end: str, low: Column, high: Column, width) -> DataFrame:
    """One row per span and bin that it reaches within [low, high]."""
    first = F.greatest(F.coalesce(_number(spans, start), low), low)
    last = F.least(F.coalesce(_number(spans, end), high), high)
    kept = spans.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
    bins = F.sequence(_bin(F.col("_first"), width), _bin(F.col("_last"), width))
    return kept.select("*", _bin(F.col("_first"), width).alias("_begin"), F.explode(bins).alias("_bin")).drop("_first", "_last")


def point_in_intervals(rows: DataFrame, spans: DataFrame, keys: Sequence[str], point: str, start: str, end: str,
                       width) -> DataFrame:
    """Each row with every span of its key that holds its point (inner join; overlapping spans give several rows).

    A row's point lies in one bin, so no pair is found twice. Columns of ``spans`` other than the keys are
    appended. Null keys and null points match nothing. ``width`` is in days for dates, seconds for
    timestamps, else in the point's unit.
    """
    keys = list(keys)
    value = _number(rows, point)
    reach = rows.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    binned = _binned(spans, start, end, reach.select("low").scalar(), reach.select("high").scalar(), width).alias("r")
    placed = rows.withColumn("_bin", _bin(value, width)).alias("l")
    p = F.col(f"l.{point}")
    holds = ((F.col(f"r.{start}").isNull() | (F.col(f"r.{start}") <= p)) & (F.col(f"r.{end}").isNull() | (p <= F.col(f"r.{end}"))))
    joined = placed.join(binned, _same(keys) & (F.col("l._bin") == F.col("r._bin")) & holds)
    return joined.select(*[F.col(f"l.{c}") for c in rows.columns], *[F.col(f"r.{c}") for c in spans.columns if c not in keys])


def overlapping_intervals(left: DataFrame, right: DataFrame, keys: Sequence[str], start: str, end: str, width) -> DataFrame:
    """Pairs of spans of one key that share a value: keys, ``start``/``end`` of both sides with suffixes, and the shared span.

    Both sides are cut into bins; a pair that meets in several bins is kept in the bin where the later of
    the two begins, so it comes out once.
    """
    keys = list(keys)
    ends = [f.agg(F.min(_number(f, start)).alias("a"), F.min(_number(f, end)).alias("b"), F.max(_number(f, start)).alias("c"),
                  F.max(_number(f, end)).alias("d")) for f in (left, right)]
    both = ends[0].unionByName(ends[1]).agg(F.least(F.min("a"), F.min("b")).alias("low"), F.greatest(F.max("c"), F.max("d")).alias("high"))
    low, high = F.coalesce(both.select("low").scalar(), F.lit(0)), F.coalesce(both.select("high").scalar(), F.lit(0))
    l, r = (_binned(f, start, end, low, high, width).alias(n) for f, n in ((left, "l"), (right, "r")))
    first, last = F.col("_start"), F.col("_end")
    joined = l.join(r, _same(keys) & (F.col("l._bin") == F.col("r._bin")) & (F.col("l._bin") == F.greatest("l._begin", "r._begin")))
    out = joined.select(
        *[F.col(f"l.{k}").alias(k) for k in keys],
        *[F.col(f"{s}.{c}").alias(f"{c}_{n}") for s, n in (("l", "left"), ("r", "right")) for c in (start, end)],
        F.greatest(f"l.{start}", f"r.{start}").alias("_start"), F.least(f"l.{end}", f"r.{end}").alias("_end"))
    return out.where(first.isNull() | last.isNull() | (first <= last)).withColumnsRenamed({"_start": f"{start}_shared", "_end": f"{end}_shared"})

