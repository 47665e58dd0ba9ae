"""Filters, denial constraints and repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.checks import standins as st
from plumbline.checks.registry import query, quoted, table
from plumbline.columns import col
from plumbline.functions import predicates as p
from plumbline.functions.convert import clock_text
from plumbline.operators import clean, rules
from plumbline.operators.ordered import Layout, order_violations
from plumbline.operators.profile import relation_completeness
from plumbline.operators.rules import Constraint
from plumbline.plans import accidents, air, weather

ACC = st.select("accidents")
GASES = st.select("gases")
CLOCKED = f"(SELECT * REPLACE (CONCAT(SUBSTRING(time_occ, 1, 2), ':', SUBSTRING(time_occ, 3, 2)) AS time_occ) FROM {ACC})"

# The rules once more as SQL, in the order of the plans.
WEATHER_SQL = {
    "non_negative_precipitation": '"PRCP" >= 0',
    "tmax_gte_tmin": '"TMAX" >= "TMIN"',
    "valid_tmax_range": '"TMAX" >= -65 AND "TMAX" <= 60',
    "valid_tmin_range": '"TMIN" >= -65 AND "TMIN" <= 60',
}
ACCIDENT_SQL = {
    "valid_report_date": "date_rptd >= date_occ",
    "valid_time_format": "regexp_matches(time_occ, '^[0-2][0-9]:[0-5][0-9]$')",
    "valid_latitude": "latitude >= 33.0 AND latitude <= 34.5",
    "valid_longitude": "longitude >= -119.0 AND longitude <= -117.5",
    "valid_vict_age": "vict_age BETWEEN 0 AND 120",
    "valid_vict_sex": "CASE WHEN vict_sex IN ('M', 'F', 'X', 'Unknown') THEN TRUE END",
    "valid_area": "TRY_CAST(area AS INTEGER) BETWEEN 1 AND 21",
    "valid_crm_cd": "TRY_CAST(crm_cd AS INTEGER) BETWEEN 100 AND 999",
    "valid_premis": "TRY_CAST(premis_cd AS INTEGER) BETWEEN 101 AND 108",
    "street_location": "premis_desc <> 'STREET' OR (location IS NOT NULL AND cross_street IS NOT NULL)",
    "valid_dr_no": "CAST(dr_no AS BIGINT) > 0",
}
GAS_LIMITS = {"pm25": 250, "pm10": 500, "co": 50, "no": 10, "no2": 1, "nox": 2, "o3": 0.2}


def clocked(spark, sf):
    return st.frame(spark, sf, "accidents").withColumn("time_occ", clock_text(col("time_occ")))


def sql_flags(conditions: dict[str, str], source: str, keep: str) -> str:
    flags = ", ".join(f"({c}) AS {quoted('check_' + n)}" for n, c in conditions.items())
    combined = " AND ".join(f"({c})" for c in conditions.values())
    return f"SELECT {keep}, {flags}, ({combined}) AS all_valid FROM {source}"


def flag_columns(conditions) -> str:
    return " ".join(f"check_{n}:b" for n in conditions) + " all_valid:b"


@query(
    "filter_not_null",
    "dr_no:s location:s cross_street:s",
    f"SELECT dr_no, location, cross_street FROM {ACC} WHERE location IS NOT NULL AND cross_street IS NOT NULL",
)
def filter_not_null(spark, sf):
    return st.frame(spark, sf, "accidents").na.drop(subset=["location", "cross_street"])


@query(
    "dc_flags",
    "station:s datetime_iso:d " + flag_columns(WEATHER_SQL),
    sql_flags(WEATHER_SQL, st.WEATHER_DAILY, "station, datetime_iso"),
)
def dc_flags(spark, sf):
    return rules.add_flags(st.weather_daily(spark, sf), weather.rules())


@query(
    "dc_accident_flags",
    "id:s " + flag_columns(ACCIDENT_SQL),
    sql_flags(ACCIDENT_SQL, CLOCKED, "dr_no AS id"),
)
def dc_accident_flags(spark, sf):
    return rules.add_flags(clocked(spark, sf).withColumn("id", col("dr_no")), accidents.rules())


@query(
    "dc_regex",
    "dr_no:s time_occ:s valid:b",
    f"SELECT dr_no, time_occ, regexp_matches(time_occ, '^[0-2][0-9]:[0-5][0-9]$') AS valid FROM {CLOCKED}",
)
def dc_regex(spark, sf):
    return clocked(spark, sf).withColumn("valid", p.matches("time_occ", accidents.CLOCK))


@query(
    "dc_membership",
    "dr_no:s vict_sex:s never_false:b null_ok:b recoded:s",
    f"""SELECT dr_no, vict_sex, CASE WHEN vict_sex IN ('M', 'F', 'X') THEN TRUE END AS never_false,
    (vict_sex IS NULL OR vict_sex IN ('M', 'F', 'X')) AS null_ok,
    CASE WHEN vict_sex IN ('M', 'F', 'X') THEN vict_sex ELSE 'Unknown' END AS recoded FROM {ACC}""",
)
def dc_membership(spark, sf):
    listed = ("M", "F", "X")
    rows = st.frame(spark, sf, "accidents").withColumns(
        {
            "never_false": p.one_of_or_unknown("vict_sex", listed),
            "null_ok": p.one_of_or_missing("vict_sex", listed),
            "recoded": col("vict_sex"),
        }
    )
    return rules.recode_unlisted(rows, "recoded", listed)


@query(
    "dc_null_tolerant",
    "order_key:i line:i " + " ".join(f"check_{g}_realistic:b" for g in GAS_LIMITS) + " check_PM_cons:b",
    "SELECT order_key, line, "
    + ", ".join(f"({g} < {top} OR {g} IS NULL) AS check_{g}_realistic" for g, top in GAS_LIMITS.items())
    + f', (pm10 >= pm25 OR pm10 IS NULL OR pm25 IS NULL) AS "check_PM_cons" FROM {GASES}',
)
def dc_null_tolerant(spark, sf):
    rows = st.frame(spark, sf, "gases")
    return rules.add_flags(rows, [*air.limits(list(GAS_LIMITS)), Constraint("PM_cons", p.not_less_or_missing("pm10", "pm25"))])


@query(
    "dc_implication",
    "dr_no:s valid:b",
    f"""SELECT dr_no, (premis_desc <> 'STREET' OR (location IS NOT NULL AND cross_street IS NOT NULL)) AS valid FROM {ACC}""",
)
def dc_implication(spark, sf):
    both = col("location").isNotNull() & col("cross_street").isNotNull()
    return st.frame(spark, sf, "accidents").withColumn("valid", p.implies(col("premis_desc") == "STREET", both))


@query(
    "dc_sum_identity",
    "order_key:i line:i valid:b",
    f"""SELECT order_key, line, (no IS NULL OR no2 IS NULL OR nox IS NULL OR abs(nox - (no + no2)) < 0.001) AS valid
    FROM {GASES}""",
)
def dc_sum_identity(spark, sf):
    return st.frame(spark, sf, "gases").withColumn("valid", p.sum_identity("nox", ["no", "no2"], 0.001))


MONOTONIC = """SELECT event_id, event_type, hour > LAG(hour) OVER (PARTITION BY event_type ORDER BY hour, event_id) AS ordered
    FROM (SELECT event_id, event_type, date_trunc('hour', ts) AS hour FROM events)"""


def by_hour(spark, sf):
    return table(spark, sf, "events").select("event_id", "event_type", F.date_trunc("hour", "ts").alias("hour"))


@query("dc_monotonic", "event_id:i event_type:s ordered:b", MONOTONIC)
def dc_monotonic(spark, sf):
    return order_violations(by_hour(spark, sf), "hour", ["event_type"], ["event_id"])


@query("dc_monotonic_split", "event_id:i event_type:s ordered:b", MONOTONIC)
def dc_monotonic_split(spark, sf):
    """The form for a series too long for one task."""
    return order_violations(by_hour(spark, sf), "hour", ["event_type"], ["event_id"], layout=Layout(True, 16))


@query(
    "dc_reduce",
    "order_key:i line:i pos:b present:b",
    f"""SELECT order_key, line, (co >= 0 AND no >= 0 AND no2 >= 0 AND nox >= 0 AND o3 >= 0) AS pos,
    (no IS NOT NULL OR nox IS NOT NULL OR pm25 IS NOT NULL) AS present FROM {GASES}""",
)
def dc_reduce(spark, sf):
    return st.frame(spark, sf, "gases").withColumns(
        {"pos": p.all_non_negative(["co", "no", "no2", "nox", "o3"]), "present": p.any_present(["no", "nox", "pm25"])}
    )


@query(
    "dc_date_valid",
    "dr_no:s valid:b",
    f"SELECT dr_no, (vict_sex IS NOT NULL AND vict_sex <> 'M') AS valid FROM {ACC}",
)
def dc_date_valid(spark, sf):
    """Dates as text, spoiled for one level and missing for another."""
    day = col("date_occ").cast("string")
    text = F.when(col("vict_sex") == "M", F.concat(F.substring(day, 1, 5), F.lit("13-45"))).when(col("vict_sex").isNotNull(), day)
    return st.frame(spark, sf, "accidents").withColumn("date", text).withColumn("valid", p.valid_date("date"))


GAS_COLUMNS = ["co", "no", "no2", "nox", "o3", "pm10", "pm25"]


def gas_nulls(limit: float) -> str:
    count = " + ".join(f"CAST({g} IS NULL AS INTEGER)" for g in GAS_COLUMNS)
    return f"SELECT * FROM {GASES} WHERE ({count}) / {len(GAS_COLUMNS)}.0 < {limit}"


@query("row_null_ratio", "order_key:i line:i co:f pm25:f", gas_nulls(0.25))
def row_null_ratio(spark, sf):
    return clean.drop_sparse_rows(st.frame(spark, sf, "gases"), 0.25, GAS_COLUMNS)


@query(
    "drop_any_null",
    "order_key:i line:i co:f no:f no2:f nox:f o3:f pm10:f pm25:f",
    f"SELECT * FROM {GASES} WHERE " + " AND ".join(f"{g} IS NOT NULL" for g in GAS_COLUMNS),
)
def drop_any_null(spark, sf):
    return clean.drop_any_null(st.frame(spark, sf, "gases"))


@query(
    "dc_enforce_filter",
    "station:s datetime_iso:d TMAX:f TMIN:f PRCP:f",
    f"SELECT * FROM {st.WEATHER_DAILY} WHERE " + " AND ".join(f"({c})" for c in WEATHER_SQL.values()),
)
def dc_enforce_filter(spark, sf):
    return rules.enforce_filter(st.weather_daily(spark, sf), weather.rules())


def repaired_accidents(source: str = CLOCKED) -> str:
    """Rules in sequence: each step sees what the steps before it blanked."""
    for name, columns in accidents.BLANKED.items():
        blanked = ", ".join(f"CASE WHEN {ACCIDENT_SQL[name]} THEN {c} END AS {c}" for c in columns)
        source = f"(SELECT * REPLACE ({blanked}) FROM {source})"
    return f"(SELECT * REPLACE (CASE WHEN vict_sex IN ('M', 'F', 'X') THEN vict_sex ELSE 'Unknown' END AS vict_sex) FROM {source})"


@query(
    "dc_enforce_null",
    "dr_no:s date_rptd:d date_occ:d time_occ:s latitude:f longitude:f vict_age:i vict_sex:s area:s crm_cd:s premis_cd:s "
    "location:s cross_street:s",
    f"SELECT * FROM {repaired_accidents()}",
)
def dc_enforce_null(spark, sf):
    repaired = rules.enforce_null(clocked(spark, sf), accidents.rules())
    return rules.recode_unlisted(repaired, "vict_sex", accidents.SEXES)


@query(
    "dc_recompute",
    "order_key:i line:i no:f no2:f nox:f",
    f"""SELECT order_key, line, CASE WHEN no < 0 THEN NULL ELSE no END AS no, no2,
    CASE WHEN no < 0 THEN NULL ELSE no END + no2 AS nox FROM {GASES}""",
)
def dc_recompute(spark, sf):
    return rules.recompute_sum(rules.blank_negative(st.frame(spark, sf, "gases"), ["no"]), "nox", ["no", "no2"])


@query(
    "dc_repaired_completeness",
    "completeness:f",
    f"""SELECT AVG(CASE WHEN no IS NOT NULL AND no2 IS NOT NULL AND nox IS NOT NULL THEN 1.0 ELSE 0.0 END) AS completeness
    FROM (SELECT no, no2, no + no2 AS nox FROM {GASES})""",
)
def dc_repaired_completeness(spark, sf):
    rows = st.frame(spark, sf, "gases").select("no", "no2", "nox")
    return relation_completeness(rules.recompute_sum(rows, "nox", ["no", "no2"]))


