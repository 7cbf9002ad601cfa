"""Split the rows of hot entities, so that no window task holds a whole one.

A window over an entity runs in one task. For entities with more than ``rows_per_segment`` rows the
rows are cut into segments of consecutive *grains* (a coarse monotone key of the window order, by
default its first column, e.g. the game date), sized from exact counts:

* lagged windows (``with_segments``): a segment also gets the last ``halo`` rows before it, so every
  frame of up to ``halo`` rows is complete inside one segment, and results equal those of the one big
  window; halo rows are marked and dropped afterwards;
* running totals (``running_totals``): a two-level scan; each segment is summed, an exclusive running
  sum over the few segment rows gives the total carried into each, and rows add it to their own.

The counts are taken per (entity, grain) with map-side combining; the frames that cut and number
grains see one row per grain (days of a calendar, not games). Rows look up their segments by an
equi-join on (entity, grain) of hot entities only, which Spark may broadcast by its size. Rows of other
entities are segment 0. A segment holds at most ``rows_per_segment`` rows, one grain and the halo.

Left to AQE, tasks are joined up to 64 MB of compressed columns, which are millions of rows once they
are sorted. ``tasks`` deals the counted rows by (entity, grain), then without map-side combining, and
the rows of the windows by segment into so many partitions, which the caller derives from its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldline.session import store

#: Segment number of a row, and whether the row only completes the frames of a later segment.
SEGMENT, HALO = "_segment", "_halo"
GRAIN = "_grain"


def hot_grains(df: DataFrame, entity: Sequence[str], grain: Column, rows_per_segment: int, halo: int,
               tasks: int | None = None) -> DataFrame:
    """(entity, grain, segment, halos) of the entities with more rows than a segment holds.

    ``segment`` is the grain's own, ``halos`` the later segments that need its rows.
    """
    if not 0 <= halo < rows_per_segment:
        raise ValueError("a segment must hold more rows than the widest window")
    keys = list(entity)
    grains = df.select(*keys, grain.alias(GRAIN))
    grains = grains.repartition(tasks, *keys, GRAIN) if tasks else grains
    counts = grains.groupBy(*keys, GRAIN).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.groupBy(*keys).agg(F.sum("n").alias("rows")).where(F.col("rows") > rows_per_segment).drop("rows")
    counts = _matching(counts, whole, keys, "left_semi")
    by_grain = Window.partitionBy(*keys).orderBy(F.col(GRAIN).asc_nulls_first())
    numbered = counts.select(*keys, GRAIN, "n", F.row_number().over(by_grain).alias("no"),
                             F.sum("n").over(by_grain.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    cut = numbered.withColumn("segment", F.floor((F.col("upto") - F.col("n")) / F.lit(rows_per_segment)).cast("int"))
    # The halo of what follows a grain: the earliest grain among the last ``halo`` rows up to it.
    trailing = Window.partitionBy(*keys).orderBy("upto").rangeBetween(-max(halo - 1, 0), 0)
    cut = cut.withColumn("reach", F.min("no").over(trailing) if halo else F.col("no") + 1)
    before = Window.partitionBy(*keys).orderBy("no")
    starts = cut.withColumn("reach", F.lag("reach").over(before)).withColumn("last", F.lag("segment").over(before))
    starts = starts.where("last IS NOT NULL AND segment != last AND reach < no")
    halos = starts.select(*keys, F.col("segment").alias("target"), F.explode(F.sequence("reach", F.col("no") - 1)).alias("no"))
    targets = halos.groupBy(*keys, "no").agg(F.array_sort(F.collect_list("target")).alias("halos"))
    joined = _matching(cut.select(*keys, GRAIN, "no", "segment"), targets, [*keys, "no"], "left", ["halos"])
    return joined.select(*keys, GRAIN, "segment", F.coalesce("halos", F.array().cast("array<int>")).alias("halos"))


def _matching(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, values: Sequence[str] = ()) -> DataFrame:
    """Join on exact keys, where null equals null; the left columns and the right ``values``."""
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *values)
    cond = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(right, cond, how).select(*left.columns, *values)


def with_segments(df: DataFrame, entity: str | Sequence[str], order: Sequence[str], rows_per_segment: int,
                  halo: int, grain: Column | None = None, tasks: int | None = None, stored: bool = False) -> DataFrame:
    """The rows with ``_segment`` and ``_halo``; halo rows are copies for a later segment.

    ``grain`` must rise with the first order column; by default it is that column. ``tasks`` deals only
    the counts; the rows are dealt by ``by_segment``. ``stored`` counts at once and stores the hot grains: their size
    is known then, and where they are few the rows are not dealt by grain to meet them.
    """
    keys = [entity] if isinstance(entity, str) else list(entity)
    grain = F.col(order[0]) if grain is None else grain
    hot = hot_grains(df, keys, grain, rows_per_segment, halo, tasks)
    hot = store(hot) if stored else hot
    marked = _matching(df.withColumn(GRAIN, grain), hot, [*keys, GRAIN], "left", ["segment", "halos"])
    own = F.struct(F.coalesce("segment", F.lit(0)).alias(SEGMENT), F.lit(False).alias(HALO))
    later = F.transform(F.coalesce("halos", F.array().cast("array<int>")),
                        lambda s: F.struct(s.alias(SEGMENT), F.lit(True).alias(HALO)))
    return marked.select(*df.columns, F.inline(F.concat(F.array(own), later)))


def by_segment(split: DataFrame, keys: Sequence[str], tasks: int | None) -> DataFrame:
    """Rows of ``with_segments`` dealt into ``tasks`` partitions for windows over a segment; None leaves it to AQE."""
    return split.repartition(tasks, *keys, SEGMENT) if tasks else split


def running_totals(df: DataFrame, columns: Sequence[str], entity: str | Sequence[str], order: Sequence[str],
                   rows_per_segment: int, grain: Column | None = None, name: str = "total_{col}",
                   tasks: int | None = None) -> DataFrame:
    """Append the running sum of each column up to and including the row (nulls skipped), as long."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    split = with_segments(df, keys, order, rows_per_segment, 0, grain, tasks).drop(HALO)
    parts = split.where(F.col(SEGMENT) >= 0).groupBy(*keys, SEGMENT).agg(*[F.sum(F.col(c).cast("long")).alias(f"_s_{c}") for c in columns])
    earlier = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(*keys, SEGMENT, *[F.sum(f"_s_{c}").over(earlier).alias(f"_c_{c}") for c in columns])
    carried = carried.where(F.col(SEGMENT) > 0)  # nothing is carried into a first segment: only hot entities have rows here
    upto = Window.partitionBy(*keys, SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = by_segment(split, keys, tasks).select("*", *[F.sum(F.col(c).cast("long")).over(upto).alias(f"_o_{c}") for c in columns])
    both = _matching(own, carried, [*keys, SEGMENT], "left", [f"_c_{c}" for c in columns])
    def total(c: str) -> Column:
        return F.when(F.col(f"_o_{c}").isNull(), F.col(f"_c_{c}")).otherwise(F.col(f"_o_{c}") + F.coalesce(f"_c_{c}", F.lit(0)))

    return both.select(*df.columns, *[total(c).alias(name.format(col=c)) for c in columns])
