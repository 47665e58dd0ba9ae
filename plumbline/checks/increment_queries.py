"""Views refreshed by the days that landed, and views of bucketed tables, against the views of all rows."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from plumbline.checks import analysis_queries as whole
from plumbline.checks import standins as st
from plumbline.checks.registry import query
from plumbline.columns import col
from plumbline.operators import increments, integrate
from plumbline.session import cut_lineage, scratch_path
from plumbline.sources import tables

#: The second landing begins here; the days of the two months before land again, corrected.
SECOND = date(1999, 6, 1)
CORRECTED = date(1999, 4, 1)


def landings(frame, day, measure):
    """A table as it was after the first landing, with provisional values for its last days and
    without every ninth day; and as it is now, with the rows that landed in between."""
    late = (F.dayofyear(day) % 9 == 0) & (col(day) >= F.lit(CORRECTED))
    provisional = F.when(col(day) >= F.lit(CORRECTED), col(measure) + 1000).otherwise(col(measure))
    first = cut_lineage(frame.where((col(day) < F.lit(SECOND)) & ~late).withColumn(measure, provisional))
    return first, frame, frame.where(col(day) >= F.lit(CORRECTED))


def refreshed(spark, label, build, frames, day, grain):
    """The stored view after a first refresh by everything and a second by the delta, run twice."""
    path = scratch_path(spark, label)
    parts = {name: landings(cut_lineage(frame), own, measure) for name, (frame, own, measure) in frames.items()}
    for version, changed in ((0, 0), (1, 2), (1, 2)):
        inputs = {name: (parts[name][version], own) for name, (_, own, _) in frames.items()}
        changes = {name: (parts[name][changed], own) for name, (_, own, _) in frames.items()}
        increments.refresh_view(spark, path, build, inputs, changes, day, grain)
    return increments.read_view(spark, path)


def daily(spark, sf):
    return {"weather": (st.weather_daily(spark, sf), "datetime_iso", "TMIN"), "energy": (st.energy_daily(spark, sf), "datetime_iso", "value")}


@query("view_weather_energy_delta", "datetime_iso:d station:s TMAX:f TMIN:f PRCP:f cenergy:f", whole.VIEW_WEATHER)
def view_weather_energy_delta(spark, sf):
    return refreshed(spark, "weather-energy", integrate.weather_energy_view, daily(spark, sf), "datetime_iso", "month")


@query("view_air_energy_weather_delta", whole.AIR_COLUMNS, whole.VIEW_AIR)
def view_air_energy_weather_delta(spark, sf):
    inputs = {"air_daily": (st.air_daily(spark, sf), "datetime_iso", "pm25"), **daily(spark, sf)}

    def build(air_daily, weather, energy):
        return integrate.air_energy_weather_view(air_daily, weather, energy, whole.MEASURED)

    return refreshed(spark, "air-energy-weather", build, inputs, "datetime_iso", "year")


@query("view_event_weather_delta", whole.EVENT_KINDS, whole.VIEW_EVENTS)
def view_event_weather_delta(spark, sf):
    inputs = {"events": (whole.event_rows(spark, sf), "date_occ", "latitude"), "weather": daily(spark, sf)["weather"]}
    return refreshed(spark, "event-weather", integrate.event_weather_view, inputs, "date_occ", "month")


BUCKETS = 8


def bucketed(spark, sf):
    """Air, weather and energy as tables bucketed by (station, day); merge joins keep the buckets at any size."""
    made = [st.air_daily(spark, sf), st.weather_daily(spark, sf), integrate.per_station(st.energy_daily(spark, sf), list(whole.MEASURED))]
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in made]
    stored = [
        tables.write_bucketed(frame, name, ["station", "datetime_iso"], BUCKETS, scratch_path(spark, "bucketed"))
        for frame, name in zip(made, names)
    ]
    return [stored[0], *[frame.hint("merge") for frame in stored[1:]]]


@query("view_air_energy_weather_bucketed", whole.AIR_COLUMNS, whole.VIEW_AIR)
def view_air_energy_weather_bucketed(spark, sf):
    return integrate.air_energy_weather_view(*bucketed(spark, sf), whole.MEASURED)


@query("view_weather_energy_bucketed", "datetime_iso:d station:s TMAX:f TMIN:f PRCP:f cenergy:f", whole.VIEW_WEATHER)
def view_weather_energy_bucketed(spark, sf):
    return integrate.weather_energy_view(*bucketed(spark, sf)[1:])
