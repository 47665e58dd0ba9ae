"""Merged states against one pass over all rows, sketch errors, and gaps against the calendar."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plumbline.columns import col
from plumbline.operators import profile, profile_states, series


def readings(spark, n=6_000):
    dice = random.Random(2)
    start = datetime(2024, 1, 1)
    rows = [
        (start + timedelta(minutes=7 * i), dice.choice([None, dice.gauss(1e6, 3.0)]), dice.choice(["x", "y", None]), i % 977, None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "ts timestamp, `v v` double, name string, id long, void int")


def landed(spark, frame, path):
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    weeks = sorted(r[0] for r in frame.select(week).distinct().collect())
    for w in [*weeks, weeks[0]]:
        profile_states.keep_states(profile_states.profile_states(frame.where(week == w), week, "ts"), path)
    return weeks


def test_merged_weeks_equal_one_pass(spark, tmp_path):
    frame = readings(spark)
    weeks = landed(spark, frame, str(tmp_path))
    assert len(weeks) > 3
    merged = {r["column"]: r for r in profile_states.merge_states(profile_states.read_states(spark, str(tmp_path))).collect()}
    whole = {r["column"]: r for r in profile.profile(frame).collect()}
    exact = {c: sorted(v for (v,) in frame.select(col(c)).dropna().collect()) for c in ("v v", "id")}
    assert set(merged) == set(whole)
    for name, row in merged.items():
        for field in ("rows", "non_null", "min", "max"):
            assert row[field] == whole[name][field]
        for field in ("mean", "stddev"):
            assert row[field] == (None if whole[name][field] is None else pytest.approx(whole[name][field], rel=1e-9))
        assert row["distinct_values"] == pytest.approx(whole[name]["distinct_values"], rel=0.05)
        if name in exact:
            for share, value in zip((0.25, 0.5, 0.75), row["quantiles"]):
                at = sum(x <= value for x in exact[name]) / len(exact[name])
                assert abs(at - share) < 0.01
    assert merged["void"]["quantiles"] is None and merged["void"]["missing_ratio"] == 1.0


def test_states_of_some_weeks_read_no_others(spark, tmp_path, plan):
    frame = readings(spark)
    weeks = landed(spark, frame, str(tmp_path))
    (tmp_path / f"period={weeks[0]}").rename(tmp_path / f"period={weeks[0]}x")
    for part in (tmp_path / f"period={weeks[0]}x").glob("*.parquet"):
        part.write_bytes(b"not read")
    later = profile_states.read_states(spark, str(tmp_path), weeks[1], weeks[2])
    row = profile_states.merge_states(later).where("column = 'id'").first()
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    assert row["rows"] == frame.where(week.between(weeks[1], weeks[2])).count()
    assert "PartitionFilters: [isnotnull(period" in plan(later)


def test_empty_states(spark, tmp_path):
    states = profile_states.profile_states(readings(spark).limit(0), F.lit("w"), "ts")
    assert states.count() == 0 and profile_states.merge_states(states).count() == 0


def test_days_and_rollups_of_states(spark, tmp_path, rows):
    frame = readings(spark).where("day(ts) % 4 <> 0")
    landed(spark, frame, str(tmp_path / "p"))
    days = profile_states.days_of_states(profile_states.read_states(spark, str(tmp_path / "p")), "ts")
    assert rows(profile.missing_dates(days, "day")) == rows(profile.missing_dates(frame, "ts"))
    for k in (0, 1, 1):
        part = frame.where(col("id") % 2 == k)
        profile_states.keep_states(profile_states.rollup_states(part, F.lit(k), "ts", ["id", "void"], ["name"]), str(tmp_path / "r"))
    merged = profile_states.merge_rollups(spark.read.parquet(str(tmp_path / "r")), ["id", "void"], ["name"], ts="ts")
    assert rows(merged) == rows(series.daily_rollup(frame, "ts", ["id", "void"], ["name"]))


def test_gaps_expand_to_the_missing_days(spark, rows):
    dice = random.Random(4)
    drawn = [(dice.choice(["a", "b", None]), date(2023, 12, 20) + timedelta(days=dice.randrange(120))) for _ in range(70)]
    frame = spark.createDataFrame([*drawn, ("a", None), ("lone", date(2024, 1, 1)), ("none", None)], "`s s` string, d date")
    gaps = profile.date_gaps(frame, "d", ["s s"])
    assert rows(profile.expand_gaps(gaps)) == rows(profile.missing_dates(frame, "d", ["s s"]))
    assert all(r["days"] == (r["last_missing"] - r["first_missing"]).days + 1 for r in gaps.collect())
    whole = profile.expand_gaps(profile.date_gaps(frame, "d"))
    assert rows(whole) == rows(profile.missing_dates(frame, "d"))
    far = spark.createDataFrame([(date(1, 1, 1),), (date(9999, 1, 1),)], "d date")
    assert profile.date_gaps(far, "d").first()["days"] == (date(9999, 1, 1) - date(1, 1, 1)).days - 1
    assert profile.date_gaps(frame.limit(0), "d").count() == 0
