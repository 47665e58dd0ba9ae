"""Profiles and rollups merged from the states of landed weeks, and gaps as intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.checks import standins as st
from plumbline.checks.metric_queries import DAYS
from plumbline.checks.registry import query, table
from plumbline.columns import col
from plumbline.operators import profile, profile_states
from plumbline.session import scratch_path

READINGS = st.select("readings")
#: Weeks from this one on land later than the others, and the first of them twice.
LATE = "2024-01-15"


def week(ts: str):
    return F.date_format(F.date_trunc("week", ts), "yyyy-MM-dd")


def land(spark, states_of, path, rows):
    """Two landings, the second with a week of the first again."""
    profile_states.keep_states(states_of(rows.where(col("week") <= LATE)), path)
    profile_states.keep_states(states_of(rows.where(col("week") >= LATE)), path)


def weekly_states(spark, sf):
    rows = st.frame(spark, sf, "readings").withColumn("week", week("datetime_iso"))
    path = scratch_path(spark, "states")
    land(spark, lambda part: profile_states.profile_states(part.drop("week"), week("datetime_iso"), "datetime_iso"), path, rows)
    return profile_states.read_states(spark, path)


COLUMNS = ("event_id", "parameter", "user_id", "raw", "value", "level")


def moments(c: str) -> str:
    if c == "parameter":
        return "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max"
    return f"AVG({c}) AS mean, STDDEV_SAMP({c}) AS stddev, MIN({c})::DOUBLE AS min, MAX({c})::DOUBLE AS max"


@query(
    "profile_states",
    "column:s rows:i non_null:i missing_ratio:f mean:f stddev:f min:f max:f",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) AS rows, COUNT({c}) AS non_null, 1 - COUNT({c}) / COUNT(*) AS missing_ratio,
        {moments(c)} FROM {READINGS}"""
        for c in COLUMNS
    ),
)
def merged_profile(spark, sf):
    """The exact fields of the profile of all weeks, merged from the kept states."""
    return profile_states.merge_states(weekly_states(spark, sf)).where(col("column") != "datetime_iso")


@query(
    "profile_states_weeks",
    "column:s rows:i non_null:i mean:f",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) AS rows, COUNT({c}) AS non_null, AVG({c}) AS mean FROM {READINGS}
        WHERE date_trunc('week', datetime_iso) BETWEEN DATE '2024-01-08' AND DATE '2024-01-15'"""
        for c in ("raw", "value")
    ),
)
def two_weeks(spark, sf):
    """The profile of two of the weeks; states of other weeks are pruned."""
    states = weekly_states(spark, sf).where(col("period").between("2024-01-08", "2024-01-15"))
    return profile_states.merge_states(states).where(col("column").isin("raw", "value"))


@query(
    "profile_states_coverage",
    "first_day:d last_day:d present:i missing:i",
    f"""SELECT MIN(CAST(datetime_iso AS DATE)) AS first_day, MAX(CAST(datetime_iso AS DATE)) AS last_day,
    COUNT(DISTINCT CAST(datetime_iso AS DATE)) AS present,
    date_diff('day', MIN(CAST(datetime_iso AS DATE)), MAX(CAST(datetime_iso AS DATE))) + 1 - COUNT(DISTINCT CAST(datetime_iso AS DATE)) AS missing
    FROM {READINGS}""",
)
def coverage_of_states(spark, sf):
    days = profile_states.days_of_states(weekly_states(spark, sf), "datetime_iso")
    return profile.date_coverage(days, "day")


@query(
    "rollup_states",
    "parameter:s datetime_iso:d cents:f level:f hourly_readings:i",
    f"""SELECT parameter, CAST(datetime_iso AS DATE) AS datetime_iso, ROUND(AVG(CAST(ROUND(raw * 100) AS BIGINT)), 4) AS cents,
    ROUND(AVG(level), 4) AS level, COUNT(datetime_iso) AS hourly_readings FROM {READINGS} GROUP BY 1, 2""",
)
def merged_rollup(spark, sf):
    """The daily rollup from states that landed by user, so that every day comes in three parts."""
    cents = F.round(col("raw") * 100).cast("bigint")  # whole numbers add up alike in any order
    landed = st.frame(spark, sf, "readings").withColumns({"landing": col("user_id") % 3, "cents": cents})
    path = scratch_path(spark, "rollups")
    for part in (landed.where("landing < 2"), landed.where("landing > 0")):
        profile_states.keep_states(
            profile_states.rollup_states(part, col("landing"), "datetime_iso", ["cents", "level"], ["parameter"]), path
        )
    return profile_states.merge_rollups(spark.read.parquet(path), ["cents", "level"], ["parameter"])


GAPS = """SELECT {key}, CAST(day + 1 AS DATE) AS first_missing, CAST(later - 1 AS DATE) AS last_missing, later - day - 1 AS days
    FROM (SELECT {key}, day, LEAD(day) OVER ({part} ORDER BY day) AS later FROM {days}) WHERE later - day > 1"""


@query(
    "dq_date_gaps",
    "station:s first_missing:d last_missing:d days:i",
    GAPS.format(key="station", part="PARTITION BY station", days=DAYS)
    + " UNION ALL "
    + GAPS.format(key="'apart' AS station", part="", days="(SELECT DISTINCT DATE '1995-01-01' + CAST(o_orderkey % 997 * 5 AS INT) AS day FROM orders)"),
)
def dq_date_gaps(spark, sf):
    """Gaps of each station, and of days that are set apart."""
    lines = table(spark, sf, "lineitem").select(col("l_returnflag").alias("station"), "l_shipdate")
    day = F.date_add(F.lit("1995-01-01").cast("date"), (col("o_orderkey") % 997 * 5).cast("int"))
    apart = profile.date_gaps(table(spark, sf, "orders").select(day.alias("day")), "day")
    return profile.date_gaps(lines, "l_shipdate", ["station"]).unionByName(apart.withColumn("station", F.lit("apart")))
