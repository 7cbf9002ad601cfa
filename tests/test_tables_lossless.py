"""Writers and the streaming sink lose nothing: split dates, late files, widening, layouts, null keys."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fieldline.plans import jobs
from fieldline.sources import tables as TB
from fieldline.streaming.ingest import start_pitch_ingest

D1, D2 = dt.date(2021, 4, 1), dt.date(2021, 4, 2)
T0, T1 = dt.datetime(2021, 4, 3, 1), dt.datetime(2021, 4, 3, 2)
PITCH = ("game_pk long, at_bat_number int, pitch_number int, game_date date, events string, "
         "_loaded_at timestamp_ntz")


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def stored(spark, path, *cols):
    return rows(TB.read_table(spark, path), *cols)


def test_date_split_over_batches_and_late_and_replayed_files(spark, tmp_table_dir):
    landing = tempfile.mkdtemp(prefix="fl-landing-", dir="/tmp")
    table, ckpt = os.path.join(tmp_table_dir, "p"), os.path.join(tmp_table_dir, "_c")

    def land(*data):
        spark.createDataFrame(list(data), PITCH).coalesce(1).write.mode("append").parquet(landing)

    def ingest():
        schema = spark.read.parquet(landing).schema
        start_pitch_ingest(spark, landing, schema, table, ckpt, trigger_once=True, max_files_per_trigger=1).awaitTermination(120)

    land((1, 1, 1, D1, "single", T1))
    land((1, 2, 1, D1, None, T0), (2, 1, 1, D2, "walk", T0))
    ingest()
    assert stored(spark, table, "game_pk", "at_bat_number") == [(1, 1), (1, 2), (2, 1)]
    land((1, 1, 1, D1, "older copy", T0), (1, 3, 1, D1, "late", T0))
    land((1, 2, 1, D1, "double", T1))
    ingest()
    assert stored(spark, table, "at_bat_number", "events") == [(1, "single"), (1, "walk"), (2, "double"), (3, "late")]


def test_widened_partitioned_upsert_then_narrow_one(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "t")
    keys = ["d", "k"]
    TB.upsert_table(spark, spark.createDataFrame([(D1, 1, "a"), (D2, 2, "b")], "d date, k int, x string"), path, keys, ["d"])
    TB.upsert_table(spark, spark.createDataFrame([(D1, 3, "c", 7.5)], "d date, k int, x string, y double"), path, keys, ["d"])
    assert stored(spark, path, "k", "x", "y") == [(1, "a", None), (2, "b", None), (3, "c", 7.5)]
    TB.upsert_table(spark, spark.createDataFrame([(D1, 4, "d")], "d date, k int, x string"), path, keys)
    assert stored(spark, path, "k", "y") == [(1, None), (2, None), (3, 7.5), (4, None)]
    assert sorted(n for n in os.listdir(path) if "=" in n) == ["d=2021-04-01", "d=2021-04-02"]


@pytest.mark.parametrize("extra", [False, True])
def test_widen_and_truncate_keep_the_layout(spark, tmp_table_dir, extra):
    path = os.path.join(tmp_table_dir, "t")
    TB.append(spark.createDataFrame([(1, "p")], "v int, part string"), path, ["part"])
    new = spark.createDataFrame([(2, "q", 9)] if extra else [(2, "q")], "v int, part string" + (", z int" if extra else ""))
    TB.widen_table(spark, new, path)
    assert stored(spark, path, "v", "part") == [(1, "p"), (2, "q")]
    assert {n for n in os.listdir(path) if "=" in n} == {"part=p", "part=q"}
    TB.truncate(spark, path)
    assert TB.read_table(spark, path).columns == ["v", "part"] + ["z"] * extra and stored(spark, path) == []
    assert TB.append(spark.createDataFrame([(3, "r")], "v int, part string"), path) == 1
    assert "part=r" in os.listdir(path)


def test_null_keys_and_reruns(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "t")
    src = spark.createDataFrame([(None, 1), (5, 2)], "k int, v int")
    for _ in range(3):
        TB.upsert_table(spark, src, path, ["k"])
        assert stored(spark, path) == [(5, 2), (None, 1)]
    assert TB.merge_insert_only_table(spark, src, path, ["k"]) == 0
    TB.merge_update_insert_table(spark, spark.createDataFrame([(None, 8), (6, 9)], "k int, v int"), path, ["k"])
    assert stored(spark, path) == [(5, 2), (6, 9), (None, 8)]
    with pytest.raises(Exception, match="repeats a key"):
        TB.merge_update_insert_table(spark, src.unionByName(src), path, ["k"])
    assert stored(spark, path) == [(5, 2), (6, 9), (None, 8)]


def test_interrupted_rewrite_is_recovered(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "t")
    TB.overwrite(spark.createDataFrame([(1,)], "v int"), path)
    os.rename(path, path + "._former")  # the state between the two renames
    assert TB.table_exists(spark, path) and stored(spark, path) == [(1,)]
    TB.overwrite(spark.createDataFrame([(2,)], "v int"), path)
    assert stored(spark, path) == [(2,)] and not os.path.exists(path + "._former")


def test_nulls_are_normalised_on_write(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "t")
    assert TB.append(spark.createDataFrame([(float("nan"), "NaN"), (1.0, "x")], "a double, b string"), path) == 2
    assert stored(spark, path) == [(1.0, "x"), (None, None)]


def test_game_results_keep_the_newest(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "g")
    schema = "game_pk long, runs_h int, _loaded_at timestamp_ntz"
    jobs.game_results(spark, spark.createDataFrame([(1, 0, T0), (1, 4, T1)], schema), path)
    jobs.game_results(spark, spark.createDataFrame([(1, 2, T0), (2, 3, T0)], schema), path)
    assert stored(spark, path, "game_pk", "runs_h") == [(1, 4), (2, 3)]


def test_empty_selection_is_skipped(spark):
    games = spark.createDataFrame([], "mlbam_id long, game_date date")
    assert jobs.compute_features(spark, games, "batter", ids=[], game_date=D1) == "skipped"
    assert jobs.compute_features(spark, games, "batter") == "skipped"


def test_backfill_resumes(spark, tmp_table_dir):
    done, out = os.path.join(tmp_table_dir, "done"), os.path.join(tmp_table_dir, "out")
    work = spark.createDataFrame([(1, 2020), (1, 2021), (2, 2020)], "mlbam_id long, season int")

    def fail(todo):
        raise RuntimeError("source is down")

    with pytest.raises(RuntimeError):
        jobs.backfill(spark, work, done, fail)
    assert jobs.backfill(spark, work.filter("mlbam_id = 1"), done, lambda t: TB.append(t, out)) == 2
    assert jobs.backfill(spark, work, done, lambda t: TB.append(t, out)) == 1
    assert jobs.backfill(spark, work, done, fail) == 0
    assert stored(spark, out) == [(1, 2020), (1, 2021), (2, 2020)]


def test_season_logs_replace_whole_seasons(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "logs")
    logs = spark.createDataFrame([(2020, 1), (2020, 2), (2021, 3)], "season int, g int")
    for _ in range(2):
        assert rows(jobs.season_logs(spark, logs, path, "test", T0)) == [(2020, 2), (2021, 1)]
    assert stored(spark, path, "season", "g", "_source") == [(2020, 1, "test"), (2020, 2, "test"), (2021, 3, "test")]
    assert TB.read_table(spark, path).agg(F.max("_loaded_at")).first()[0] == T0
