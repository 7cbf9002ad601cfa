"""Tasks over pitches hold a bounded number of rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldline.plans import q_features, q_jobs, views


def largest(df):
    return df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]


def test_a_task_holds_few_pitches(spark, tables, monkeypatch):
    whole = views.pitch_view(spark, tables)
    monkeypatch.setattr(views, "PITCHES_PER_TASK", 10, raising=False)
    dealt = views.pitch_view(spark, tables)
    assert Counter(dealt.collect()) == Counter(whole.collect()) and dealt.count() == 1200
    assert dealt.rdd.getNumPartitions() == 120 and largest(dealt) <= 60


def test_a_window_task_holds_few_players(spark, tables, monkeypatch):
    monkeypatch.setattr(views, "PITCHES_PER_TASK", 10, raising=False)
    assert q_features.q_rolling_sums(spark, tables).rdd.getNumPartitions() == 120


def test_pitches_meet_whole_orders(spark, tables):
    """Pitches are dealt by game alone, not once more by the order's customer."""
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.pitch_view(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    dealt = [line for line in plan.splitlines() if "hashpartitioning(o_custkey" in line]
    at = plan.splitlines().index(dealt[0])
    below = [line for line in plan.splitlines()[at:] if "FileScan" in line]
    assert len(dealt) == 1 and "o_orderkey" in below[0] and "l_orderkey" not in below[0]


@pytest.mark.parametrize("name", ["hot_rolling_sums", "hot_strict_rolling_sums", "hot_running_totals"])
def test_hot_windows_are_dealt_by_segment(spark, tables, monkeypatch, name):
    """Counts are dealt by (player, date) and windows by (player, segment), in tasks of bounded rows."""
    run = getattr(q_jobs, f"q_{name}")
    whole = Counter(run(spark, tables).collect())
    monkeypatch.setattr(views, "PITCHES_PER_TASK", 10)
    dealt = run(spark, tables)
    assert Counter(dealt.collect()) == whole
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    for keys in ("player, _grain", "player, _segment"):
        shape = r"hashpartitioning\(" + r"#\d+L?, ".join(keys.split(", ")) + r"#\d+L?, 120\), REPARTITION_BY_NUM"
        assert re.search(shape, plan), keys
