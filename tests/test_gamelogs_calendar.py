"""Season game-log CSV (quoted comma, doubleheader, missing season) and fetch ranges."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fieldline.operators import team as T
from fieldline.sources import calendar as C
from fieldline.sources import gamelogs as G

COLS = ["date", "game_num", "team_v", "team_h", "visiting_score", "home_score", "park"]


def test_read_gamelogs_quoted_and_doubleheader(spark, tmp_table_dir):
    path = os.path.join(tmp_table_dir, "GL2023.TXT")
    with open(path, "w") as f:
        f.write('20230715,1,"BOS","NYA",3,5,"Park, The"\n')
        f.write('20230715,2,"BOS","NYA",4,2,"Park, The"\n')
        f.write('20230716,0,"TEX","NYA",1,1,"Other"\n')
    schema = G.gamelog_schema(COLS, numeric=["visiting_score", "home_score"],
                              integer=["date", "game_num"])
    df = G.read_gamelogs(spark, path, schema)
    df = df.withColumn("date", F.to_date(F.col("date").cast("string"), "yyyyMMdd"))
    out = T.with_game_key(T.game_outcome(df)).orderBy("date_dblhead").collect()
    assert [r.date_dblhead for r in out] == [202307151, 202307152, 202307160]
    assert [r.park for r in out] == ["Park, The", "Park, The", "Other"]
    assert [(r.run_diff, r.home_victory) for r in out] == [(2.0, 1), (-2.0, 0), (0.0, 0)]


def test_missing_season_raises(spark, tmp_table_dir):
    schema = G.gamelog_schema(COLS)
    with pytest.raises(ValueError, match="not available"):
        G.read_gamelogs(spark, os.path.join(tmp_table_dir, "GL1899.TXT"), schema)


def test_fetch_range_current_season_ends_today(spark):
    seasons = spark.createDataFrame([(2022,), (2023,)], "season int")
    today = F.lit(dt.date(2023, 7, 15))
    out = {r.season: (r.range_start, r.range_end)
           for r in C.fetch_range(seasons, today).collect()}
    assert out[2022] == (dt.date(2022, 3, 1), dt.date(2022, 11, 30))
    assert out[2023] == (dt.date(2023, 3, 1), dt.date(2023, 7, 15))


def test_weekly_chunks_last_piece_is_cut(spark):
    out = C.weekly_chunks(spark.createDataFrame([(2023,)], "season int")).orderBy(
        "chunk_start").collect()
    assert (out[0].chunk_start, out[0].chunk_end) == ("2023-03-20", "2023-03-26")
    assert out[-1].chunk_end == "2023-10-15"


def test_missing_season_with_a_scheme_raises(spark, tmp_table_dir):
    import os

    from fieldline.sources.gamelogs import gamelog_schema, read_gamelogs

    schema = gamelog_schema(["date", "runs"], numeric=["runs"])
    path = os.path.join(tmp_table_dir, "gl2020.csv")
    with pytest.raises(ValueError, match="gl2020"):
        read_gamelogs(spark, f"file://{path}", schema)
    with open(path, "w") as f:
        f.write('"20200401",3\n')
    assert read_gamelogs(spark, f"file://{path}", schema).collect()[0].runs == 3.0
