"""Electricity demand: API records to a trusted daily table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from plumbline.columns import col
from plumbline.functions import predicates as p
from plumbline.functions.categories import recode
from plumbline.functions.convert import parse_date, safe_cast
from plumbline.functions.text import ENERGY_NULLS, normalize_text, nullify_tokens
from plumbline.operators.clean import dedup
from plumbline.operators.impute import interpolate
from plumbline.operators.ordered import Layout
from plumbline.operators.profile import date_coverage, relation_completeness
from plumbline.operators.rules import Constraint, enforce_filter
from plumbline.plans.common import TIME, Trusted, assess, assess_rules
from plumbline.session import cut_lineage
from plumbline.sources.files import keep_records

# Column names, the unit's short name, wanted records, limits and time zones.
RENAMES = {
    "period": "date",
    "respondent": "respondent_id",
    "respondent-name": "respondent_name",
    "type": "data_type",
    "timezone": "timezone_id",
    "value-units": "unit_of_measure",
}
UNITS = {"megawatthours": "mwh"}
WANTED = {"type-name": "Demand", "timezone": "Pacific"}
UNUSED = ("type-name", "timezone-description")
HIGHEST_DEMAND = 500000
TIME_ZONES = ("pacific", "eastern", "central")
TEXT = ("respondent_id", "respondent_name", "data_type", "timezone_id", "unit_of_measure")


def land_energy(records: DataFrame) -> DataFrame:
    return keep_records(records, WANTED, UNUSED)


def format_energy(raw: DataFrame) -> DataFrame:
    """Renamed, typed and normalised records."""
    rows = raw.withColumnsRenamed(RENAMES)
    rows = safe_cast(rows, {"value": "double"}).withColumn(TIME, parse_date(col("date")))
    rows = rows.withColumn("unit_of_measure", recode(col("unit_of_measure"), UNITS))
    rows = normalize_text(rows, TEXT, lower=True, tokens=ENERGY_NULLS)
    return nullify_tokens(rows, ENERGY_NULLS, ["date"])


def rules() -> list[Constraint]:
    return [
        Constraint("pos_value", col("value") >= 0),
        Constraint("valid_date", p.valid_date("date")),
        Constraint("value_realistic", col("value") <= HIGHEST_DEMAND),
        Constraint("valid_unit_of_measure", col("unit_of_measure").isin("mwh")),
        Constraint("valid_timezone", col("timezone_id").isin(*TIME_ZONES)),
    ]


def trust_energy(df: DataFrame, as_of: Column | None = None, layout: Layout | None = None) -> Trusted:
    """Keep rows that satisfy every rule, one per day, without constant columns."""
    reports = assess(df, [TIME], as_of)
    reports["missing_dates"] = date_coverage(df, TIME)
    reports |= assess_rules(df, rules())
    # The constants are those of the input: after the rules a rare level may be gone.
    constants = [r["column"] for r in reports["constant_columns"].select("column").collect()]
    # One row per day from here on: later steps read those, not the records again.
    unique = cut_lineage(dedup(enforce_filter(df, rules()), [TIME], [c for c in df.columns if c != TIME]))
    data = interpolate(unique.drop(*constants, "date"), [TIME], layout=layout)
    reports["final_completeness"] = relation_completeness(data)
    return Trusted(data, reports)
