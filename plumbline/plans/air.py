"""Air quality: long sensor readings to trusted hourly and daily tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.columns import col
from plumbline.functions import predicates as p
from plumbline.functions.convert import parse_offset_timestamp, safe_cast
from plumbline.functions.text import OBSERVATION_NULLS, nullify_tokens, rename_snake
from plumbline.operators.clean import dedup, drop_sparse_columns
from plumbline.operators.impute import interpolate
from plumbline.operators.ordered import WHOLE, Layout, order_violations
from plumbline.operators.profile import relation_completeness, removal_report
from plumbline.operators.rules import Constraint, blank_negative, enforce_null, recompute_sum
from plumbline.operators.series import (
    daily_rollup,
    detect_outliers,
    outliers_per_column,
    outliers_per_row,
    pivot_wide,
)
from plumbline.plans.common import TIME, Trusted, assess, assess_rules, station_of
from plumbline.session import cut_lineage
from plumbline.sources.schemas import AIR_PARAMETERS

# Highest plausible reading per parameter, rows of the outlier window (7 days
# of 12 readings), highest NULL share of a column, tolerance of nox = no + no2.
HIGHEST = {"pm25": 250, "pm10": 500, "co": 50, "no": 10, "no2": 1, "nox": 2, "o3": 0.2}
OUTLIER_ROWS = 84
SPARSE_LIMIT = 0.2
NOX_TOLERANCE = 0.001


def format_air(long: DataFrame, parameters: Sequence[str] | None = AIR_PARAMETERS) -> DataFrame:
    """One row per station and time, one column per parameter."""
    rows = safe_cast(rename_snake(long), {"lat": "double", "lon": "double", "value": "double"})
    rows = rows.withColumn(TIME, parse_offset_timestamp(col("datetime"))).drop("datetime")
    rows = nullify_tokens(rows, OBSERVATION_NULLS).na.drop(subset=[TIME, "parameter", "value"])
    rows = rows.withColumn("station", F.coalesce(station_of(col("location_id"), 1), col("location_id")))
    index = [TIME, "station", "location", "lat", "lon"]
    return pivot_wide(rows, index, "parameter", "value", ["sensors_id", "value"], parameters)


def present_parameters(df: DataFrame) -> list[str]:
    return [c for c in AIR_PARAMETERS if c in df.columns]


def rules(df: DataFrame) -> list[Constraint]:
    """Rules that apply to the parameters at hand; the time order is checked separately."""
    have = present_parameters(df)
    found = [Constraint("pos_params", p.all_non_negative(have))]
    if "lat" in df.columns:
        found.append(Constraint("valid_lat", col("lat").between(-90, 90)))
    if "lon" in df.columns:
        found.append(Constraint("valid_lon", col("lon").between(-180, 180)))
    if {"pm10", "pm25"} <= set(have):
        found.append(Constraint("PM_cons", p.not_less_or_missing("pm10", "pm25")))
    found += limits(have)
    if {"no", "no2", "nox"} <= set(have):
        found.append(Constraint("check_NOx", p.sum_identity("nox", ["no", "no2"], NOX_TOLERANCE)))
    found.append(Constraint("non_null_row", p.any_present(have)))
    return found


def limits(have: Sequence[str]) -> list[Constraint]:
    """Upper limit per parameter; a reading at or above it is blanked."""
    return [Constraint(f"{c}_realistic", p.below_or_missing(c, top), (c,)) for c, top in HIGHEST.items() if c in have]


def trust_air(df: DataFrame, as_of: Column | None = None, layout: Layout | None = None) -> Trusted:
    """Blank impossible values, repair nox, thin out columns, fill gaps; extreme values stay."""
    have = present_parameters(df)
    series, order = ["station"], [TIME]
    layout = layout or WHOLE
    reports = assess(df, ["station", TIME], as_of)

    # Ties in time are told apart by every other column, so the order is total.
    rest = [c for c in df.columns if c not in {TIME, "station"}]
    ordered = order_violations(df, TIME, ["station", "location"], rest, name="__ordered", layout=layout)
    reports |= assess_rules(ordered, [*rules(df), Constraint("ordered_timestamps", col("__ordered"))])

    flagged = detect_outliers(df, have, [TIME, *rest], series, window=OUTLIER_ROWS, layout=layout)
    reports["outliers_per_row"] = outliers_per_row(flagged, have, ["station", TIME, *rest])
    reports["outliers_per_column"] = outliers_per_column(flagged, have)

    repaired = enforce_null(blank_negative(df, have), limits(have))
    repaired = recompute_sum(repaired, "nox", ["no", "no2"])
    # Everything below reads these rows several times, and two steps choose columns by them.
    unique = cut_lineage(dedup(repaired, ["station", TIME], rest))
    reports["removed"] = removal_report(df, [("duplicates", unique)])
    # The constants are those of the input: after the repair a rare level may be gone.
    constants = [r["column"] for r in reports["constant_columns"].select("column").collect()]
    kept = drop_sparse_columns(unique.drop(*[c for c in constants if c not in ("station", TIME)]), SPARSE_LIMIT)
    still = present_parameters(kept)
    data = interpolate(kept, order, still, series, fallback=0.0, layout=layout)
    reports["final_completeness"] = relation_completeness(data)
    return Trusted(data, reports)


def daily_air(trusted: DataFrame) -> DataFrame:
    """Mean per station and day of each parameter, with the number of readings."""
    return daily_rollup(trusted, TIME, present_parameters(trusted), ["station"])
