"""Landed JSON folders, interval joins, the results stream and the high-water mark."""

import datetime as dt
import gzip
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from fieldline.operators.intervals import overlapping_intervals, point_in_intervals
from fieldline.sources import landed as L
from fieldline.sources import payloads as P
from fieldline.sources import tables as TB
from fieldline.streaming.ingest import start_result_ingest

D = dt.date


def rows(df, *cols):
    return sorted(str(tuple(r)) for r in (df.select(*cols) if cols else df).collect())


def schedule(day, *games):
    return json.dumps({"dates": [{"date": day, "games": [
        {"gamePk": pk, "status": {"abstractGameState": state}, "teams": {
            "home": {"score": h, "team": {"abbreviation": "BOS"}}, "away": {"score": v, "team": {"abbreviation": "NYA"}}}}
        for pk, state, h, v in games]}]})


def test_folder_of_documents_with_bad_ones_set_apart(spark, tmp_table_dir):
    deep = os.path.join(tmp_table_dir, "a", "b")
    os.makedirs(deep)
    good = schedule("2023-07-15", (1, "Final", 3, 2), (2, "Live", 0, 0))
    texts = {"one.json": json.dumps(json.loads(good), indent=2), "empty.json": " \n", "cut.json": good[:-30],
             "other.json": '{"hello": 1}', "list.json": "[1, 2]", "type.json": '{"dates": 7}', "notes.txt": "no payload"}
    for name, text in texts.items():
        with open(os.path.join(tmp_table_dir, "a", name), "w") as f:
            f.write(text)
    with gzip.open(os.path.join(deep, "two.json.gz"), "wt") as f:
        f.write(schedule("2023-07-16", (3, "Final", 1, None)))
    docs = L.read_documents(spark, os.path.join(tmp_table_dir, "a"), P.SCHEDULE_SCHEMA, pattern="*.json*")
    reasons = {os.path.basename(r.file): r.reason for r in docs.collect()}
    assert reasons == {"one.json": None, "two.json.gz": None, "empty.json": "empty", "cut.json": "malformed",
                       "other.json": "foreign", "list.json": "malformed", "type.json": "malformed"}
    games = P.flatten_schedule(L.good_documents(docs))
    assert rows(games, "game_pk", "game_date", "runs_h", "runs_v") == rows(spark.createDataFrame(
        [(1, D(2023, 7, 15), 3, 2), (3, D(2023, 7, 16), 1, 0)], "a long, b date, c long, d long"))
    assert L.rejected_documents(docs).count() == 5
    assert docs.where("file_size > 0").count() == 7


def test_documents_by_line_are_counted_per_file(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "day.jsonl")
    with open(path, "w") as f:
        f.write("\n".join([schedule("2023-07-15", (1, "Final", 3, 2)), "", "oops", schedule("2023-07-16", (2, "Final", 3, 4)), "{}"]))
    docs = L.read_documents(spark, path, P.SCHEDULE_SCHEMA, lines=True)
    assert rows(L.document_counts(docs).drop("file")) == ["(4, 2, 0, 1, 1)"]
    assert rows(P.flatten_schedule(L.good_documents(docs)), "game_pk") == ["(1,)", "(2,)"]


def test_points_in_many_overlapping_open_spans(spark):
    rnd = random.Random(5)
    spans = [(rnd.choice(["A", "B", "C", None]), rnd.choice([None, rnd.randint(1980, 2030)]), rnd.choice([None, rnd.randint(1980, 2030)]), i)
             for i in range(60)] + [("A", 2000, 2000, 100), ("A", 2005, 2001, 101)]
    points = [(rnd.choice(["A", "A", "B", "D", None]), rnd.choice([None, rnd.randint(1975, 2035)]), i) for i in range(300)]
    left = spark.createDataFrame(points, "team string, season int, id int")
    right = spark.createDataFrame(spans, "team string, first int, last int, span int")
    want = [(i, s) for t, y, i in points for u, a, b, s in spans
            if t is not None and t == u and y is not None and (a is None or a <= y) and (b is None or y <= b)]
    for width in (1, 7, 1000):
        got = point_in_intervals(left, right, ["team"], "season", "first", "last", width)
        assert got.columns == ["team", "season", "id", "first", "last", "span"]
        assert sorted((r.id, r.span) for r in got.collect()) == sorted(want)
    assert point_in_intervals(left.limit(0), right, ["team"], "season", "first", "last", 5).count() == 0
    plan = point_in_intervals(left, right, ["team"], "season", "first", "last", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "_bin" in plan


def test_points_in_spans_of_dates(spark):
    left = spark.createDataFrame([(1, D(2020, 1, d)) for d in range(1, 11)], "k int, day date")
    right = spark.createDataFrame([(1, D(2020, 1, 3), D(2020, 1, 5)), (1, D(2020, 1, 5), None), (2, None, None)], "k int, f date, t date")
    got = point_in_intervals(left, right, ["k"], "day", "f", "t", 2)
    assert rows(got.groupBy("day").count()) == sorted(f"(datetime.date(2020, 1, {d}), {2 if d == 5 else 1})" for d in range(3, 11))


def test_overlapping_spans_come_out_once(spark):
    rnd = random.Random(6)
    make = lambda n: [(rnd.choice("AB"), *(x if rnd.random() < 0.8 else None for x in sorted(rnd.sample(range(100), 2)))) for _ in range(n)]
    a, b = make(40), make(40)
    schema = "k string, f int, t int"
    lo, hi = float("-inf"), float("inf")
    want = sorted(str((k, f, t, g, u, max([x for x in (f, g) if x is not None], default=None), min([x for x in (t, u) if x is not None], default=None)))
                  for k, f, t in a for j, g, u in b if k == j
                  and max(lo if f is None else f, lo if g is None else g) <= min(hi if t is None else t, hi if u is None else u))
    for width in (1, 10, 500):
        assert rows(overlapping_intervals(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], "f", "t", width)) == want


def test_results_stream_keeps_one_row_per_game(spark, tmp_table_dir):
    landing, table, ckpt = (os.path.join(tmp_table_dir, n) for n in ("in", "results", "ckpt"))
    os.makedirs(landing)
    clock = [time.time() - 10_000]

    def land(name, *docs, at=None):
        path = os.path.join(landing, name)
        with open(path, "w") as f:
            f.write("\n".join(docs))
        clock[0] += 60
        os.utime(path, (at or clock[0],) * 2)

    def ingest():
        q = start_result_ingest(spark, landing, table, ckpt, trigger_once=True, delay="1 hour", max_files_per_trigger=1)
        q.awaitTermination(120)
        return sum(p["numInputRows"] for p in q.recentProgress)

    day = schedule("2023-07-15", (1, "Final", 3, 2), (20_001, "Live", 0, 0))
    land("a.json", day)
    land("b.json", day, day)
    land("c.json", schedule("2023-07-15", (1, "Final", 4, 2), (20_001, "Final", 5, 6)))  # a correction
    assert ingest() > 0
    assert rows(TB.read_table(spark, table), "game_pk", "runs_h", "runs_v") == ["(1, 4, 2)", "(20001, 5, 6)"]
    before = {f for f in os.listdir(table) if "=" in f}
    land("d.json", schedule("2023-07-15", (1, "Final", 9, 9)), at=clock[0] - 1200)  # an older copy that comes late
    land("e.json", schedule("2023-07-16", (2, "Final", 1, 0)))
    ingest()
    assert rows(TB.read_table(spark, table), "game_pk", "runs_h") == ["(1, 4)", "(2, 1)", "(20001, 5)"]
    assert before == {"_range_game_pk=0", "_range_game_pk=2"}


def test_high_water_mark_from_folder_names(spark, tmp_table_dir):
    a, b = os.path.join(tmp_table_dir, "a"), os.path.join(tmp_table_dir, "b")
    data = spark.createDataFrame([(D(2021, 4, d), d) for d in (1, 9, 3)] + [(None, 0)], "d date, k int")
    TB.append(data, a, ["d"])
    TB.append(data, b)
    for path in (a, b):
        assert TB.high_water_mark(spark, path, "d").first()[0] == D(2021, 4, 9)
    assert "Scan parquet" not in TB.high_water_mark(spark, a, "d")._jdf.queryExecution().executedPlan().toString()
    TB.truncate(spark, a)
    assert TB.high_water_mark(spark, a, "d").first()[0] is None
    with pytest.raises(ValueError):
        TB.high_water_mark(spark, os.path.join(tmp_table_dir, "none"), "d")
