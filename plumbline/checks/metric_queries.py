"""Profiles and quality metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.checks import standins as st
from plumbline.checks.registry import query, quoted, table
from plumbline.checks.rule_queries import ACCIDENT_SQL, CLOCKED, WEATHER_SQL, clocked
from plumbline.columns import col
from plumbline.operators import clean, observed, profile, rules
from plumbline.plans import accidents, weather
from plumbline.session import scratch_path

ACC = st.select("accidents")
GASES = st.select("gases")
AS_OF = "2026-01-01"


def sql_profile(source: str, columns: dict[str, bool]) -> str:
    parts = []
    for name, numeric in columns.items():
        c = quoted(name)
        moments = f"AVG({c}), STDDEV_SAMP({c}), MIN({c}), MAX({c})" if numeric else "NULL, NULL, NULL, NULL"
        parts.append(
            f"SELECT '{name}', COUNT(*), COUNT({c}), COUNT(DISTINCT {c}) + CASE WHEN COUNT({c}) < COUNT(*) THEN 1 ELSE 0 END, "
            f"{moments} FROM {source}"
        )
    return (
        'SELECT * FROM (' + " UNION ALL ".join(parts)
        + ') AS t("column", "rows", non_null, distinct_values, mean, stddev, "min", "max")'
    )


PROFILE = "column:s rows:i non_null:i distinct_values:i mean:f stddev:f min:f max:f"


@query(
    "dq_profile",
    PROFILE,
    sql_profile(ACC, {"dr_no": False, "date_occ": False, "vict_age": True, "vict_sex": False, "location": False, "crm_cd_desc": False}),
)
def dq_profile(spark, sf):
    columns = ["dr_no", "date_occ", "vict_age", "vict_sex", "location", "crm_cd_desc"]
    return profile.profile(st.frame(spark, sf, "accidents"), columns)


@query("dq_profile_readings", PROFILE, sql_profile(st.select("readings"), {"parameter": False, "raw": True, "level": True}))
def dq_profile_readings(spark, sf):
    return profile.profile(st.frame(spark, sf, "readings"), ["parameter", "raw", "level"])


def sql_ratio_per_column(source: str, names: list[str], condition: str, out: str) -> str:
    return " UNION ALL ".join(
        f'SELECT \'{n}\' AS "column", AVG(CASE WHEN {condition.format(quoted(n))} THEN 1.0 ELSE 0.0 END) AS {out} FROM {source}'
        for n in names
    )


@query(
    "dq_column_completeness",
    "column:s missing_ratio:f",
    sql_ratio_per_column(ACC, list(st.ROW_LEVEL["accidents"][1]), "{0} IS NULL", "missing_ratio"),
)
def dq_column_completeness(spark, sf):
    return profile.column_completeness(st.frame(spark, sf, "accidents"))


@query(
    "dq_relation_completeness",
    "completeness:f",
    "SELECT AVG(CASE WHEN "
    + " AND ".join(f"{quoted(c)} IS NOT NULL" for c in st.ROW_LEVEL["accidents"][1])
    + f" THEN 1.0 ELSE 0.0 END) AS completeness FROM {ACC}",
)
def dq_relation_completeness(spark, sf):
    return profile.relation_completeness(st.frame(spark, sf, "accidents"))


SCORE = f"1.0 / (1.0 + (date_diff('day', date_occ, DATE '{AS_OF}') + 1e-9) * 12.0)"


@query(
    "dq_timeliness",
    "attribute:s timeliness:f",
    f"""SELECT a.attribute, ROUND(s.timeliness * 1000, 6) AS timeliness FROM (SELECT AVG({SCORE}) AS timeliness FROM {ACC}) s,
    (SELECT unnest(['dr_no', 'vict_age', 'location']) AS attribute) a
    UNION ALL SELECT 'relation', ROUND(AVG({SCORE}) * 1000, 6) FROM {ACC}
    UNION ALL SELECT 'location where present', ROUND(AVG({SCORE}) FILTER (location IS NOT NULL) * 1000, 6) FROM {ACC}""",
)
def dq_timeliness(spark, sf):
    """Scores are scaled by 1000: the dates lie far back, so the scores are small."""
    rows = st.frame(spark, sf, "accidents").select("date_occ", "dr_no", "vict_age", "location")
    as_of = F.lit(AS_OF).cast("date")
    scores = profile.timeliness(rows, "date_occ", as_of, 12)
    relation = profile.relation_timeliness(scores).select(F.lit("relation").alias("attribute"), "timeliness")
    present = profile.timeliness(rows, "date_occ", as_of, 12, ["location"], non_null_only=True).select(
        F.lit("location where present").alias("attribute"), "timeliness"
    )
    return scores.unionByName(relation).unionByName(present).withColumn("timeliness", col("timeliness") * 1000)


@query(
    "dq_redundancy",
    "rows:i keys:i redundancy:f",
    """SELECT COUNT(*) AS "rows", COUNT(DISTINCT (l_orderkey, l_linenumber)) AS keys,
    COUNT(*) * 1.0 / COUNT(DISTINCT (l_orderkey, l_linenumber)) AS redundancy FROM lineitem""",
)
def dq_redundancy(spark, sf):
    return profile.redundancy(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


WITH_NOTHING = f"(SELECT *, CAST(NULL AS VARCHAR) AS nothing FROM {ACC})"
# Per column its levels, NULL being one, and the least of them.
LEVELS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(MIN({c}) AS VARCHAR) AS value,
    COUNT(DISTINCT {c}) + CASE WHEN COUNT(*) > COUNT({c}) THEN 1 ELSE 0 END AS levels FROM {{0}}"""
    for c in [*st.ROW_LEVEL["accidents"][1], "nothing"]
)


@query(
    "dq_constant_columns",
    "column:s value:s",
    f"""SELECT "column", value FROM ({LEVELS.format(WITH_NOTHING)}) WHERE levels = 1""",
)
def dq_constant_columns(spark, sf):
    rows = st.frame(spark, sf, "accidents").withColumn("nothing", F.lit(None).cast("string"))
    return profile.constant_columns(rows)


DAYS = "(SELECT DISTINCT l_returnflag AS station, CAST(l_shipdate AS DATE) AS day FROM lineitem)"


STRETCHED = """(SELECT DATE '1995-01-01' + CAST(3 * date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day
    FROM orders)"""


@query(
    "dq_missing_dates",
    "station:s missing_date:d",
    f"""SELECT station, missing_date FROM (SELECT station, CAST(unnest(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY)) AS DATE)
      AS missing_date FROM {DAYS} GROUP BY station) c
    WHERE NOT EXISTS (SELECT 1 FROM {DAYS} d WHERE d.station = c.station AND d.day = c.missing_date)
    UNION ALL SELECT 'orders', missing_date FROM (SELECT CAST(unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate),
      INTERVAL 1 DAY)) AS DATE) AS missing_date FROM orders)
    WHERE missing_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
    UNION ALL SELECT 'stretched', missing_date FROM (SELECT CAST(unnest(generate_series(MIN(day), MAX(day),
      INTERVAL 1 DAY)) AS DATE) AS missing_date FROM {STRETCHED}) WHERE missing_date NOT IN (SELECT day FROM {STRETCHED})""",
)
def dq_missing_dates(spark, sf):
    """Per station, for the orders as a whole, and for orders with their days set apart."""
    lines = table(spark, sf, "lineitem").select(col("l_returnflag").alias("station"), "l_shipdate")
    orders = table(spark, sf, "orders")
    whole = profile.missing_dates(orders, "o_orderdate").withColumn("station", F.lit("orders"))
    origin = F.lit("1995-01-01").cast("date")
    apart = orders.withColumn("day", F.date_add(origin, F.datediff("o_orderdate", origin) * 3))
    holes = profile.missing_dates(apart, "day").withColumn("station", F.lit("stretched"))
    return profile.missing_dates(lines, "l_shipdate", ["station"]).unionByName(whole).unionByName(holes)


@query(
    "dq_date_coverage",
    "station:s first_day:d last_day:d present:i expected:i missing:i is_complete:b",
    f"""SELECT station, MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS present,
    date_diff('day', MIN(day), MAX(day)) + 1 AS expected, date_diff('day', MIN(day), MAX(day)) + 1 - COUNT(*) AS missing,
    date_diff('day', MIN(day), MAX(day)) + 1 = COUNT(*) AS is_complete FROM {DAYS} GROUP BY station""",
)
def dq_date_coverage(spark, sf):
    lines = table(spark, sf, "lineitem").select(col("l_returnflag").alias("station"), "l_shipdate")
    return profile.date_coverage(lines, "l_shipdate", ["station"])


def sql_all(conditions: dict[str, str]) -> str:
    return " AND ".join(f"({c})" for c in conditions.values())


@query(
    "dq_consistency",
    "data:s rows:i valid_rows:i consistency:f",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS data, COUNT(*) AS "rows", COUNT(*) FILTER ({sql_all(conditions)}) AS valid_rows,
        COUNT(*) FILTER ({sql_all(conditions)}) * 1.0 / COUNT(*) AS consistency FROM {source}"""
        for name, conditions, source in (("weather", WEATHER_SQL, st.WEATHER_DAILY), ("accidents", ACCIDENT_SQL, CLOCKED))
    ),
)
def dq_consistency(spark, sf):
    by_weather = rules.consistency(st.weather_daily(spark, sf), weather.rules()).withColumn("data", F.lit("weather"))
    by_accident = rules.consistency(clocked(spark, sf), accidents.rules()).withColumn("data", F.lit("accidents"))
    return by_weather.unionByName(by_accident)


@query(
    "dq_constraint_stats",
    "constraint:s satisfied:i unknown:i ratio:f",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS "constraint", COUNT(*) FILTER ({c}) AS satisfied, COUNT(*) FILTER (({c}) IS NULL) AS unknown,
        COUNT(*) FILTER ({c}) * 1.0 / COUNT(*) AS ratio FROM {CLOCKED}"""
        for n, c in ACCIDENT_SQL.items()
    ),
)
def dq_constraint_stats(spark, sf):
    return rules.constraint_report(clocked(spark, sf), accidents.rules())


KEYED = "(SELECT DISTINCT ON (order_key, line) * FROM {0} ORDER BY order_key, line, co NULLS FIRST, no NULLS FIRST, " \
    "no2 NULLS FIRST, nox NULLS FIRST, pm10 NULLS FIRST, pm25 NULLS FIRST, station, o3 NULLS FIRST, lat, lon)"
TOTAL_ORDER = ["co", "no", "no2", "nox", "pm10", "pm25", "station", "o3", "lat", "lon"]


def sql_sparse(source: str) -> str:
    count = " + ".join(f"CAST({g} IS NULL AS INTEGER)" for g in ("co", "no", "no2", "nox", "o3", "pm10", "pm25"))
    return f"(SELECT * FROM {source} WHERE ({count}) / 7.0 < 0.25)"


CLEANED = f"""WITH counts AS (SELECT (SELECT COUNT(*) FROM lineitem) AS a, (SELECT COUNT(*) FROM {KEYED.format(GASES)}) AS b,
      (SELECT COUNT(*) FROM {sql_sparse(KEYED.format(GASES))}) AS c)
    SELECT 'input' AS step, a AS "rows", 0 AS removed FROM counts UNION ALL SELECT 'duplicates', b, a - b FROM counts
    UNION ALL SELECT 'sparse rows', c, b - c FROM counts"""


@query("clean_report", "step:s rows:i removed:i", CLEANED)
def clean_report(spark, sf):
    rows = st.frame(spark, sf, "gases")
    unique = clean.dedup(rows, ["order_key", "line"], TOTAL_ORDER)
    dense = clean.drop_sparse_rows(unique, 0.25, ["co", "no", "no2", "nox", "o3", "pm10", "pm25"])
    return profile.removal_report(rows, [("duplicates", unique), ("sparse rows", dense)])


@query("clean_report_observed", "step:s rows:i removed:i", CLEANED)
def clean_report_observed(spark, sf):
    """The same counts, taken by the one job that writes the clean rows."""
    counter = observed.RowCounts()
    rows = counter.watch("input", st.frame(spark, sf, "gases"))
    unique = counter.watch("duplicates", clean.dedup(rows, ["order_key", "line"], TOTAL_ORDER))
    dense = clean.drop_sparse_rows(unique, 0.25, ["co", "no", "no2", "nox", "o3", "pm10", "pm25"])
    counter.watch("sparse rows", dense).write.parquet(scratch_path(spark, "clean"))
    return counter.removals(spark)


@query(
    "dedup_key",
    "order_key:i line:i station:s co:f no:f no2:f nox:f pm10:f pm25:f",
    f"SELECT * FROM {KEYED.format(GASES)}",
)
def dedup_key(spark, sf):
    return clean.dedup(st.frame(spark, sf, "gases"), ["order_key", "line"], TOTAL_ORDER)


@query(
    "drop_constant_columns",
    "column:s",
    f"""SELECT "column" FROM ({LEVELS.format(WITH_NOTHING)}) WHERE levels <> 1""",
)
def drop_constant_columns(spark, sf):
    """The columns that remain, one row each, so that the result has a fixed schema."""
    rows = st.frame(spark, sf, "accidents").withColumn("nothing", F.lit(None).cast("string"))
    kept = clean.drop_constant_columns(rows)
    return kept.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(*[F.lit(c) for c in kept.columns])).alias("column"))


@query(
    "drop_sparse_columns",
    "column:s null_ratio:f is_sparse:b",
    f"""SELECT "column", missing_ratio AS null_ratio, missing_ratio > 0.2 AS is_sparse
    FROM ({sql_ratio_per_column(ACC, list(st.ROW_LEVEL["accidents"][1]), "{0} IS NULL", "missing_ratio")})""",
)
def drop_sparse_columns(spark, sf):
    return clean.sparse_columns(st.frame(spark, sf, "accidents"), 0.2)


RECENT = """(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station ORDER BY datetime_iso DESC, parameter, event_id)
    AS rank FROM (SELECT CASE WHEN user_id < 50 THEN 'low' ELSE 'high' END AS station, * FROM {0})) WHERE rank <= 730)"""


@query(
    "drop_unstable_columns",
    "station:s column:s nulls:i is_unstable:b",
    " UNION ALL ".join(
        f"""SELECT station, '{c}' AS "column", COUNT(*) - COUNT({c}) AS nulls, COUNT(*) - COUNT({c}) > 730 * 0.12 AS is_unstable
        FROM {RECENT.format(st.select("readings"))} GROUP BY station"""
        for c in ("parameter", "raw", "value", "level")
    ),
)
def drop_unstable_columns(spark, sf):
    rows = st.frame(spark, sf, "readings").withColumn("station", F.when(col("user_id") < 50, "low").otherwise("high"))
    return clean.unstable_columns(
        rows, "datetime_iso", ["station"], share=0.12, tie_break=["parameter", "event_id"], exclude=["event_id", "user_id"]
    )


MARKED = f"""(SELECT COALESCE(mocodes, 'unknown') AS mocodes, vict_sex,
    CASE WHEN premis_desc = 'STREET' THEN premis_desc ELSE 'unknown' END AS premis_desc FROM {ACC})"""


@query(
    "drop_unknown_columns",
    "column:s token_ratio:f is_dropped:b",
    f"""SELECT "column", r AS token_ratio, r > 0.5 AS is_dropped FROM (
    {sql_ratio_per_column(MARKED, ["mocodes", "premis_desc", "vict_sex"], "{0} = 'unknown'", "r")})""",
)
def drop_unknown_columns(spark, sf):
    rows = st.frame(spark, sf, "accidents").select(
        F.coalesce("mocodes", F.lit("unknown")).alias("mocodes"),
        F.when(col("premis_desc") == "STREET", col("premis_desc")).otherwise("unknown").alias("premis_desc"),
        "vict_sex",
    )
    return clean.token_columns(rows)
