"""Segmented windows equal the one-window form, and no window group holds a hot entity whole."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldline.operators import incremental as I
from fieldline.operators import rolling, segments

D0 = dt.date(2001, 4, 1)


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())  # as text: NaN equals NaN


@pytest.fixture(scope="module")
def games(spark):
    """One player holds a third of all games, on uneven days; one player is null."""
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        e = 0 if i % 3 == 0 else rnd.choice([None, *range(1, 60)])
        day = min(rnd.randint(0, 400), rnd.randint(0, 400)) if rnd.random() < 0.9 else 77  # 77: a very full day
        data.append((e, D0 + dt.timedelta(days=day), i, rnd.choice([None, 0, 1, 2]), rnd.choice([None, float("nan"), 0.1, 1e15, -3.25])))
    return spark.createDataFrame(data, "mlbam_id long, game_date date, game_pk long, hr long, ev_sum double").cache()


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("size", [41, 100, 5000])
def test_segmented_sums_equal_one_window(games, strict, size):
    args = (["hr", "ev_sum"], [1, 7, 40], "mlbam_id", ["game_date", "game_pk"])
    assert rows(rolling.rolling_sums(games, *args, strict=strict, rows_per_segment=size)) == rows(rolling.rolling_sums(games, *args, strict=strict))


def test_segments_bound_what_a_task_holds(games):
    size, halo = 100, 40
    split = segments.with_segments(games, "mlbam_id", ["game_date", "game_pk"], size, halo)
    fullest = games.groupBy("mlbam_id", "game_date").count().agg(F.max("count")).first()[0]
    groups = [r["count"] for r in split.groupBy("mlbam_id", segments.SEGMENT).count().collect()]
    assert max(groups) <= size + 2 * fullest + halo < games.where("mlbam_id = 0").count() / 2
    assert rows(split.where(~F.col(segments.HALO)).drop(segments.SEGMENT, segments.HALO)) == rows(games)
    # A coarser grain than the order column: weeks.
    weekly = segments.with_segments(games, "mlbam_id", ["game_date", "game_pk"], size, halo, F.date_trunc("week", "game_date"))
    per_week = weekly.where(~F.col(segments.HALO)).groupBy("mlbam_id", F.date_trunc("week", "game_date")).agg(F.countDistinct(segments.SEGMENT).alias("n"))
    assert per_week.agg(F.max("n")).first()[0] == 1


def test_no_task_above_twice_the_median(spark):
    """A third of all rows belong to one player; rows per window task stay even."""
    data = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 0L, id % 4000) AS mlbam_id", "date_add(DATE'2001-04-01', cast(id div 20 as int)) AS game_date", "id AS game_pk", "id % 5 AS hr")
    split = segments.with_segments(data, "mlbam_id", ["game_date", "game_pk"], 500, 350)
    tasks = split.repartition(16, "mlbam_id", segments.SEGMENT).groupBy(F.spark_partition_id()).count()
    n = sorted(r["count"] for r in tasks.collect())
    assert len(n) == 16 and n[-1] <= 2 * n[len(n) // 2]
    whole = sorted(r["count"] for r in data.repartition(16, "mlbam_id").groupBy(F.spark_partition_id()).count().collect())
    assert whole[-1] > 5 * whole[len(whole) // 2]


def test_segmented_features_equal_one_window(spark, games):
    stats = [F.lit(None).cast("long").alias(c) if c == "sf" else F.pmod(F.xxhash64(F.lit(c), "game_pk"), F.lit(4)).alias(c)
             for c in ("ab", "h", "x2b", "x3b", "bb", "hbp", "sf", "hr_vs_r", "ab_vs_r", "hr_vs_l", "ab_vs_l", "batted_balls",
                       "hard_hits", "sweet_spots", "barrels", "bfp", "so", "er", "outs", "fly_balls", "batted_balls_allowed")]
    full = games.withColumn("ev_sum", F.lit(0.5)).select("*", *stats, F.lit(1.5).alias("est_woba"), F.lit(2.5).alias("est_slg"))
    for build in (rolling.batter_rolling_features, rolling.pitcher_rolling_features):
        for scope in ("career", "season"):
            plain = build(full, windows=[3, 30], scope=scope)
            split = build(full, windows=[3, 30], scope=scope, rows_per_segment=60)
            assert split.columns == plain.columns and rows(split) == rows(plain)


@pytest.mark.parametrize("size", [1, 30, 10_000])
def test_running_totals_carry_over_segments(spark, games, size):
    pairs = games.select("mlbam_id", F.lit(7).alias("pitcher"), "game_date", "game_pk", F.col("hr").alias("pa"), F.lit(None).cast("long").alias("hr"))
    got = I.pair_history_rebuild(pairs, ["mlbam_id", "pitcher"], rows_per_segment=size)
    assert rows(got) == rows(I.pair_history_rebuild(pairs, ["mlbam_id", "pitcher"]).select(*got.columns))


def test_empty_and_bad_sizes(games):
    none = games.limit(0)
    assert rolling.rolling_sums(none, ["hr"], [3], "mlbam_id", ["game_date", "game_pk"], rows_per_segment=10).count() == 0
    with pytest.raises(ValueError):
        rolling.rolling_sums(games, ["hr"], [30], "mlbam_id", ["game_date", "game_pk"], rows_per_segment=30)
