"""Weather: long element observations to a trusted daily table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.columns import col, total_order
from plumbline.functions.convert import COMPACT_DATE, parse_date, scale_columns
from plumbline.functions.text import OBSERVATION_NULLS, nullify_tokens
from plumbline.operators.clean import dedup
from plumbline.operators.impute import interpolate
from plumbline.operators.ordered import Layout
from plumbline.operators.profile import date_coverage, relation_completeness
from plumbline.operators.rules import Constraint, enforce_filter
from plumbline.operators.series import pivot_wide
from plumbline.plans.common import TIME, Trusted, assess, assess_rules, blank_unstable, station_of
from plumbline.session import cut_lineage

# Elements kept in tenths by the source, and updates per day.
TENTHS = ("PRCP", "TMAX", "TMIN")
UPDATES_PER_DAY = 24


def rules() -> list[Constraint]:
    """Physical limits of a daily reading."""
    return [
        Constraint("non_negative_precipitation", col("PRCP") >= 0),
        Constraint("tmax_gte_tmin", col("TMAX") >= col("TMIN")),
        Constraint("valid_tmax_range", col("TMAX").between(-65, 60)),
        Constraint("valid_tmin_range", col("TMIN").between(-65, 60)),
    ]


def format_weather(long: DataFrame, elements: Sequence[str] | None = None) -> DataFrame:
    """One row per station and day, one column per element, in whole units."""
    rows = nullify_tokens(long, OBSERVATION_NULLS)
    rows = rows.select(
        F.coalesce(station_of(col("STATION"), 0), col("STATION")).alias("station"),
        parse_date(col("DATE"), COMPACT_DATE).alias(TIME),
        "OBS_TIME",
        "ELEMENT",
        "DATA_VALUE",
    ).na.drop(subset=[TIME, "DATA_VALUE"])
    wide = pivot_wide(rows, ["station", TIME], "ELEMENT", "DATA_VALUE", ["OBS_TIME", "DATA_VALUE"], elements)
    return scale_columns(wide, TENTHS, 10.0)


def trust_weather(df: DataFrame, as_of: Column | None = None, layout: Layout | None = None) -> Trusted:
    """One row per station and day, plausible days only, gaps filled from their neighbours.

    Copies go first, so that no gap is filled from a row that does not stay: of the rows of a
    station and day the first in the order of their values. The daily table is written once.
    """
    df = cut_lineage(df)
    reports = assess(df, ["station", TIME], as_of, UPDATES_PER_DAY)
    reports["missing_dates"] = date_coverage(df, TIME, ["station"])
    stable = blank_unstable(df, "station", exclude=TENTHS)
    reports |= assess_rules(stable, rules())
    valid = enforce_filter(stable, rules())
    unique = dedup(valid, ["station", TIME], total_order(valid, [], ["station", TIME]))
    data = interpolate(unique, [TIME], series=["station"], layout=layout).select(*df.columns)
    reports["final_completeness"] = relation_completeness(data)
    return Trusted(data, reports)
