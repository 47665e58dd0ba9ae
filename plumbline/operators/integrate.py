"""Date-joined views over station tables.

Stations live in one table with a ``station`` column, so a view over several stations is
one join. No side is hinted for broadcast: a daily side shrinks to one row per day and is
broadcast at run time when it measures small enough.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.columns import col


def with_columns_or_null(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Exactly the named columns, typed NULL where the frame lacks one."""
    return df.select(
        *[(col(c) if c in df.columns else F.lit(None)).cast(dtype).alias(c) for c, dtype in columns.items()]
    )


def left_join_by_date(left: DataFrame, right: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left join on the calendar day, and on further keys as given.

    ``on`` maps left columns to right columns; time columns are compared by day. ``take``
    maps right columns to their names in the result.
    """
    def key(frame: DataFrame, name: str):
        kind = frame.schema[name].dataType.typeName()
        return F.to_date(col(name)) if kind in ("timestamp", "timestamp_ntz") else col(name)

    picked = right.select(
        *[key(right, r).alias(f"__on_{i}") for i, r in enumerate(on.values())],
        *[(col(r) if r in right.columns else F.lit(None).cast("double")).alias(name) for r, name in take.items()],
    )
    condition = None
    for i, name in enumerate(on):
        equal = key(left, name) == F.col(f"__on_{i}")
        condition = equal if condition is None else condition & equal
    return left.join(picked, condition, "left").drop(*[f"__on_{i}" for i in range(len(on))])


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION of frames by column name, duplicates removed once at the end."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.distinct()


def per_station(daily: DataFrame, stations: Sequence[str]) -> DataFrame:
    """A series that holds for all stations as one row per station and row.

    A table bucketed by (station, day) meets others of the kind without a shuffle. The stations
    are the few of a configuration.
    """
    return daily.withColumn("station", F.explode(F.array(*[F.lit(s) for s in stations])))


def _energy_keys(energy: DataFrame) -> dict[str, str]:
    """Energy holds for all stations, or is given ``per_station``."""
    return {c: c for c in ("station", "datetime_iso") if c in energy.columns}


def weather_energy_view(weather: DataFrame, energy: DataFrame, columns: Sequence[str] = ("TMAX", "TMIN", "PRCP")) -> DataFrame:
    """Daily weather of each station next to the energy demand of the day."""
    base = weather.select(
        F.to_date(col("datetime_iso")).alias("datetime_iso"),
        "station",
        *[(col(c) if c in weather.columns else F.lit(None)).cast("double").alias(c) for c in columns],
    )
    joined = left_join_by_date(base, energy, _energy_keys(energy), {"value": "cenergy"})
    return joined.distinct()


def air_energy_weather_view(
    air_daily: DataFrame,
    weather: DataFrame,
    energy: DataFrame,
    measured: Mapping[str, Sequence[str]] | None = None,
    parameters: Sequence[str] = ("co", "no2", "o3", "pm25", "so2"),
) -> DataFrame:
    """Daily air quality per station with weather and energy.

    ``measured`` lists the parameters a station measures; the others are NULL for it.
    """
    def value(name: str):
        if name not in air_daily.columns:
            return F.lit(None).cast("double")
        if measured is None:
            return col(name)
        stations = [s for s, names in measured.items() if name in names]
        return F.when(col("station").isin(*stations), col(name)) if stations else F.lit(None).cast("double")

    base = air_daily.select(
        F.to_date(col("datetime_iso")).alias("datetime_iso"), "station", *[value(p).alias(p) for p in parameters]
    )
    by_station = {"station": "station", "datetime_iso": "datetime_iso"}
    with_weather = left_join_by_date(base, weather, by_station, {c: c for c in ("TMAX", "TMIN", "PRCP")})
    joined = left_join_by_date(with_weather, energy, _energy_keys(energy), {"value": "cenergy"})
    return joined.distinct()


# Columns of the event view, with their types.
EVENT_VIEW_COLUMNS = {
    "dr_no": "string",
    "date_occ": "date",
    "date_rptd": "date",
    "time_occ": "string",
    "area_name": "string",
    "latitude": "double",
    "longitude": "double",
    "rpt_dist_no": "string",
    "mocodes": "array<string>",
    "vict_age": "double",
    "vict_sex": "string",
    "vict_descent": "string",
    "premis_cd": "string",
    "location": "string",
    "cross_street": "string",
}


def event_weather_view(events: DataFrame, weather: DataFrame, columns: Mapping[str, str] = EVENT_VIEW_COLUMNS) -> DataFrame:
    """Events with the weather of their station and day; dropped event columns come back as NULL.

    The station of an event (see ``accidents.add_station``) takes the place of its area's
    name; events without a station column are joined by the area's name itself.
    """
    if "station" in events.columns:
        events = events.withColumn("area_name", col("station"))
    base = with_columns_or_null(events, columns).distinct()
    by_day = {"area_name": "station", "date_occ": "datetime_iso"}
    daily = weather.select("station", "datetime_iso", *[c for c in ("TMAX", "TMIN", "PRCP") if c in weather.columns])
    return left_join_by_date(base, daily.distinct(), by_day, {c: c for c in ("TMAX", "TMIN", "PRCP")})
