"""Traffic accidents: nested JSON records to a trusted event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.columns import col, numeric_columns, string_columns
from plumbline.functions import predicates as p
from plumbline.functions.categories import DESCENT_NAMES, lookup, recode, split_codes
from plumbline.functions.convert import at_clock, clock_text, flatten_struct
from plumbline.functions.text import EVENT_NULLS, normalize_text
from plumbline.operators.clean import dedup, drop_sparse_rows, sparse_columns
from plumbline.operators.impute import impute_mode, impute_numeric
from plumbline.operators.profile import relation_completeness, removal_report
from plumbline.operators.rules import Constraint, enforce_null, recode_unlisted
from plumbline.plans.common import TIME, Trusted, assess, assess_rules, station_of
from plumbline.session import cut_lineage

# The area the events lie in, valid codes, and NULL limits of rows and columns.
LATITUDE = (33.0, 34.5)
LONGITUDE = (-119.0, -117.5)
AGES = (0, 120)
AREAS = (1, 21)
CRIME_CODES = (100, 999)
PREMISES = (101, 102, 103, 104, 105, 106, 107, 108)
SEXES = ("M", "F", "X")
CLOCK = "^[0-2][0-9]:[0-5][0-9]$"
SPARSE_ROW, SPARSE_COLUMN = 0.7, 0.5

# Names of the rules, in their order, and the columns that a violation blanks.
BLANKED = {
    "valid_report_date": ("date_rptd", "date_occ"),
    "valid_time_format": ("time_occ",),
    "valid_latitude": ("latitude",),
    "valid_longitude": ("longitude",),
    "valid_vict_age": ("vict_age",),
    "valid_vict_sex": ("vict_sex",),
    "valid_area": ("area",),
    "valid_crm_cd": ("crm_cd",),
    "valid_premis": ("premis_cd",),
    "street_location": ("location", "cross_street"),
    "valid_dr_no": ("dr_no",),
}


def format_accidents(raw: DataFrame) -> DataFrame:
    """Flat, typed and normalised events; the descent code is looked up before X is recoded."""
    rows = flatten_struct(raw, "location_1", ["latitude", "longitude"])
    clock = clock_text(col("time_occ"))
    rows = rows.withColumns(
        {
            "latitude": col("latitude").try_cast("double"),
            "longitude": col("longitude").try_cast("double"),
            "vict_age": col("vict_age").try_cast("int"),
            "mocodes": split_codes(col("mocodes")),
            "time_occ": clock,
            TIME: at_clock(col("date_occ"), clock),
            "date_rptd": F.to_date(col("date_rptd")),
            "date_occ": F.to_date(col("date_occ")),
        }
    )
    rows = normalize_text(rows, string_columns(rows), tokens=EVENT_NULLS)
    return rows.withColumns(
        {
            "vict_sex": recode(col("vict_sex"), {"X": "Unknown"}),
            "vict_descent": lookup(col("vict_descent"), DESCENT_NAMES),
        }
    )


def rules() -> list[Constraint]:
    """Rules with the columns a violation blanks."""
    street = col("location").isNotNull() & col("cross_street").isNotNull()
    conditions = {
        "valid_report_date": col("date_rptd") >= col("date_occ"),
        "valid_time_format": p.matches("time_occ", CLOCK),
        "valid_latitude": col("latitude").between(*LATITUDE),
        "valid_longitude": col("longitude").between(*LONGITUDE),
        "valid_vict_age": col("vict_age").between(*AGES),
        "valid_vict_sex": p.one_of_or_unknown("vict_sex", (*SEXES, "Unknown")),
        "valid_area": p.integer_between("area", *AREAS),
        "valid_crm_cd": p.integer_between("crm_cd", *CRIME_CODES),
        "valid_premis": col("premis_cd").try_cast("int").isin(*PREMISES),
        "street_location": p.implies(col("premis_desc") == "STREET", street),
        "valid_dr_no": col("dr_no").try_cast("long") > 0,
    }
    return [Constraint(name, conditions[name], columns) for name, columns in BLANKED.items()]


def add_station(df: DataFrame) -> DataFrame:
    """Station name of the police area; normalised and plain spellings are both known."""
    plain = F.regexp_replace(col("area_name"), "_", " ")
    return df.withColumn("station", F.coalesce(station_of(plain, 2), col("area_name")))


def trust_accidents(df: DataFrame, as_of: Column | None = None, by: tuple[str, ...] = ("area_name",)) -> Trusted:
    """Blank violations, one row per report, thin out rows and columns, fill by area.

    Rows whose report number is missing or blanked are no copies of each other and stay.
    """
    # Read by the reports, the rules and two kinds of rows: the formatting behind it runs once.
    df = cut_lineage(df)
    reports = assess(df, [TIME], as_of)
    reports |= assess_rules(df, rules())
    repaired = recode_unlisted(enforce_null(df, rules()), "vict_sex", SEXES)
    # Everything below reads these rows several times, and one step chooses columns by them.
    # A report number that a rule blanked says nothing about the event: such rows all stay.
    numbered = repaired.filter(col("dr_no").isNotNull())
    unique = dedup(numbered, ["dr_no"], [c for c in df.columns if c != "dr_no"])
    unique = cut_lineage(unique.unionByName(repaired.filter(col("dr_no").isNull())))
    dense = drop_sparse_rows(unique, SPARSE_ROW)
    reports["removed"] = removal_report(df, [("duplicates", unique), ("sparse rows", dense)])
    constants = [r["column"] for r in reports["constant_columns"].select("column").collect()]
    dense = dense.drop(*[c for c in constants if c not in by])
    # One report names the columns to drop and those with anything to fill: a unique key
    # without NULLs is then never counted level by level.
    shares = {r["column"]: r for r in sparse_columns(dense, SPARSE_COLUMN).collect()}
    kept = dense.drop(*[c for c, r in shares.items() if r["is_sparse"] and c not in by])
    gaps = [c for c in kept.columns if shares[c]["null_ratio"] and c not in by]
    filled = impute_mode(kept, [c for c in string_columns(kept) if c in gaps], by)
    numbers = numeric_columns(kept)
    filled = impute_numeric(filled, [c for c in numbers if c in gaps], "median", by=by)
    filled = filled.withColumns({c: col(c).cast("double") for c in numbers})
    reports["final_completeness"] = relation_completeness(filled)
    return Trusted(filled, reports)
