"""Cleaning and validation of landed pitches."""

import datetime as dt
import logging

import pytest
from pyspark.sql import functions as F

from fieldline.operators import quality as Q

# one row per pitch: game, day, batter, pitcher, at-bat, pitch, kind, speed, angle
LANDED = [
    (41, "2019-05-04", 8, 70, 3, 1, "CH", "84.5", None),
    (41, "2019-05-04", 8, 70, 3, 2, "SI", "93.0", 12.0),
    (41, "2019-05-04", 9, 70, 4, 1, "FC", "88.25", None),
    (57, "2019-05-06", 8, 71, 1, 1, "KN", "70.0", -31.5),
]
SCHEMA = ("game_pk long, game_date string, batter long, pitcher long, at_bat_number int, pitch_number int, "
          "pitch_type string, release_speed string, launch_angle double")
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
# fixed values: messages that users of the checks look for
ANGLE_WARNING = "Unusual launch angles detected (>90 or <-90) — review source data."
SPEED_WARNING = "Dropped {} rows with missing or implausible release speed."


@pytest.fixture(scope="module")
def landed(spark):
    return spark.createDataFrame(LANDED, SCHEMA)


@pytest.fixture(scope="module")
def cleaned(landed):
    return Q.clean_pitches(landed, known_columns=NAMES)


def with_value(df, column, value, pitch):
    """``df`` with another value in the pitch (game, at-bat, number)."""
    here = F.struct(*[F.col(c) for c in df.columns if c.lower() in ("game_pk", "at_bat_number", "pitch_number")])
    at = F.struct(*[F.lit(x) for x in pitch])
    return df.withColumn(column, F.when(here.cast("struct<a:long,b:long,c:long>") == at.cast("struct<a:long,b:long,c:long>"),
                                        F.lit(value)).otherwise(F.col(column)))


@pytest.mark.parametrize("blank", [None, ""])
def test_pitches_without_a_kind_go(landed, blank):
    left = Q.drop_blank(with_value(landed, "pitch_type", blank, (41, 3, 2)))
    assert sorted(r.pitch_type for r in left.collect()) == ["CH", "FC", "KN"]
    assert Q.drop_blank(landed).count() == len(LANDED)


def test_cleaning_types_and_names(cleaned):
    assert cleaned.columns == [n.upper() for n in NAMES]
    got = {(r.GAME_DATE, r.RELEASE_SPEED) for r in cleaned.collect()}
    assert got == {(dt.date.fromisoformat(r[1]), float(r[7])) for r in LANDED}


def test_columns_the_table_lacks_are_left_out(landed):
    out = Q.clean_pitches(landed.withColumn("bat_weight", F.lit(1)), known_columns=NAMES)
    assert "BAT_WEIGHT" not in out.columns and out.count() == len(LANDED)


def test_sound_pitches_pass_without_warnings(cleaned, caplog):
    with caplog.at_level(logging.WARNING):
        assert Q.validate_pitches(cleaned).count() == len(LANDED)
    assert not caplog.records


def test_empty_and_incomplete_frames_fail(spark, cleaned):
    with pytest.raises(ValueError, match="No rows"):
        Q.validate_pitches(cleaned.filter("PITCHER < 0"))
    with pytest.raises(ValueError, match="GAME_PK"):
        Q.validate_pitches(cleaned.drop("GAME_PK"))
    with pytest.raises(ValueError, match="No rows") as both:
        Q.validate_pitches(spark.createDataFrame([], "struct<>"))
    assert "GAME_PK" in str(both.value)


@pytest.mark.parametrize("angle", [-90.5, 144.0])
def test_odd_angles_warn_and_stay(cleaned, caplog, angle):
    with caplog.at_level(logging.WARNING):
        kept = Q.validate_pitches(with_value(cleaned, "LAUNCH_ANGLE", angle, (57, 1, 1)))
    assert ANGLE_WARNING in caplog.text and kept.count() == len(LANDED)


@pytest.mark.parametrize("speed, gone", [(31.0, 1), (None, 1), (40.0, 0), (125.0, 0)])
def test_slow_and_missing_speeds_go(cleaned, caplog, speed, gone):
    with caplog.at_level(logging.WARNING):
        kept = Q.validate_pitches(with_value(cleaned, "RELEASE_SPEED", speed, (41, 4, 1)))
    assert kept.count() == len(LANDED) - gone
    assert (SPEED_WARNING.format(1) in caplog.text) == bool(gone)


def test_an_upper_speed_limit_is_the_callers_choice(cleaned):
    assert Q.validate_pitches(cleaned, max_speed=90.0).count() == 3
    report = Q.quality_report(cleaned, max_speed=90.0).first()
    assert (report.n_rows, report.n_bad_speed) == (4, 1)
