"""Views refreshed by the periods that changed against views of all rows."""

import random
from datetime import date, datetime, timedelta

import pytest

from plumbline.columns import col
from plumbline.operators import increments, integrate

START = date(2024, 1, 1)


def tables(spark, seed):
    """Weather with repeated rows and times, energy with holes, both over some months."""
    dice = random.Random(seed)
    weather = [
        (datetime(2024, 1, 1, 12) + timedelta(days=d), s, dice.choice([None, 1.0, 2.0]), float(d), 0.0)
        for d in range(150) for s in "AB" if dice.random() < 0.8 for _ in range(dice.choice([1, 1, 2]))
    ]
    energy = [(START + timedelta(days=d), dice.random()) for d in range(150) if dice.random() < 0.7]
    return weather, energy


def frames(spark, weather, energy):
    w = spark.createDataFrame(weather, "datetime_iso timestamp, station string, TMAX double, TMIN double, PRCP double")
    return {"weather": w, "energy": spark.createDataFrame(energy, "datetime_iso date, value double")}


def dated(made):
    return {name: (frame, "datetime_iso") for name, frame in made.items()}


@pytest.mark.parametrize("grain", ["day", "week", "month"])
def test_second_landing_by_delta(spark, tmp_path, rows, grain):
    weather, energy = tables(spark, 1)
    path, cut = str(tmp_path / "view"), START + timedelta(days=100)
    early = frames(spark, [r for r in weather if r[0].date() < cut], [r for r in energy if r[0] < cut])
    increments.refresh_view(spark, path, integrate.weather_energy_view, dated(early), dated(early), "datetime_iso", grain)
    assert rows(increments.read_view(spark, path).select(*"datetime_iso station TMAX TMIN PRCP cenergy".split())) == rows(
        integrate.weather_energy_view(**early)
    )
    # The second week: new days, a day whose energy comes late, a corrected day, a day that went.
    hole = next(START + timedelta(days=d) for d in range(150) if START + timedelta(days=d) not in {r[0] for r in energy})
    gone = START + timedelta(days=40)
    changed = START + timedelta(days=20)
    energy2 = [(d, v + (d == changed)) for d, v in energy] + [(hole, 5.0)]
    weather2 = [r for r in weather if r[0].date() != gone]
    now = frames(spark, weather2, energy2)
    landed = frames(
        spark,
        [r for r in weather if r[0].date() >= cut or r[0].date() == gone],
        [r for r in energy2 if r[0] >= cut or r[0] in (hole, changed)] + [(changed, 0.0)],
    )
    for _ in range(2):
        report = increments.refresh_view(spark, path, integrate.weather_energy_view, dated(now), dated(landed), "datetime_iso", grain)
        found = increments.read_view(spark, path).select(*"datetime_iso station TMAX TMIN PRCP cenergy".split())
        wanted = integrate.weather_energy_view(**now)
        assert rows(found) == rows(wanted)
        per = {r[0]: r[1] for r in wanted.groupBy(increments.period_of(col("datetime_iso"), grain).alias("p")).count().collect()}
        assert {r[0]: r["rows_after"] for r in report.collect()} == {p: per.get(p, 0) for p in (r[0] for r in report.collect())}
    assert report.where("rows_before <> rows_after").count() == 0
    if grain == "day":
        assert report.where(f"view_period = DATE '{gone}'").first()["rows_after"] == 0


def test_only_touched_dates_are_read(spark, tmp_path, rows):
    """Inputs stored by day, with every other day unreadable; and bounds that reach any scan."""
    made = frames(spark, *tables(spark, 2))
    made["weather"] = made["weather"].withColumn("datetime_iso", col("datetime_iso").cast("date"))
    touched = [date(2024, 4, 10), date(2024, 4, 11), date(2024, 5, 1)]
    for name, frame in made.items():
        frame.write.partitionBy("datetime_iso").parquet(str(tmp_path / name))
        for folder in (tmp_path / name).glob("datetime_iso=*"):
            if date.fromisoformat(folder.name.split("=")[1]) not in touched:
                for part in folder.glob("*.parquet"):
                    part.write_bytes(b"not read")
    stored = {n: spark.read.schema(f.schema).parquet(str(tmp_path / n)) for n, f in made.items()}
    landed = {"energy": (spark.createDataFrame([(d,) for d in touched], "datetime_iso date"), "datetime_iso")}
    path = str(tmp_path / "view")
    report = increments.refresh_view(spark, path, integrate.weather_energy_view, dated(stored), landed, "datetime_iso", "day")
    assert [r[0] for r in report.collect()] == touched
    wanted = integrate.weather_energy_view(**made).where(col("datetime_iso").isin(touched))
    assert rows(increments.read_view(spark, path).select(wanted.columns)) == rows(wanted)
    made["energy"].write.parquet(str(tmp_path / "flat"))
    sliced = spark.read.parquet(str(tmp_path / "flat")).where(increments.within(col("datetime_iso"), touched, "day"))
    pushed = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(datetime_iso,2024-04-10),LessThan(datetime_iso,2024-04-12))" in pushed


def test_days_that_are_null_and_nothing_landed(spark, tmp_path, rows):
    made = frames(spark, [(None, "A", 1.0, 2.0, 3.0), (datetime(2024, 1, 5), "A", 1.0, 2.0, 3.0)], [(None, 4.0)])
    path = str(tmp_path / "view")
    assert increments.refresh_view(spark, path, integrate.weather_energy_view, dated(made), {}, "datetime_iso").count() == 0
    increments.refresh_view(spark, path, integrate.weather_energy_view, dated(made), dated(made), "datetime_iso")
    assert rows(increments.read_view(spark, path).select("datetime_iso", "cenergy")) == [(None, None), (date(2024, 1, 5), None)]


def test_periods_end_where_the_next_begins():
    assert increments.end_of(date(2024, 12, 1), "month") == date(2025, 1, 1)
    assert increments.end_of(date(2024, 2, 1), "month") == date(2024, 3, 1)
    assert increments.end_of(date(2024, 1, 1), "year") == date(2025, 1, 1)
    assert increments.end_of(date(2023, 12, 25), "week") == date(2024, 1, 1)
