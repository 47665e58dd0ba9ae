"""Raw records through format, trust and view, end to end."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from plumbline.checks import standins as st
from plumbline.checks.analysis_queries import CODES_OF, FEATURES, event_weather, features, sql_histogram
from plumbline.checks.column_queries import sql_case, sql_code_groups, sql_text
from plumbline.checks.plan_queries import AIR_NAMES, AIR_TRUSTED, AREA_NUMBERS, AREA_TEXT, WEATHER_SOURCE
from plumbline.checks.plan_queries import air_long, sql_trusted_weather, weather_source
from plumbline.checks.registry import query, table
from plumbline.checks.rule_queries import WEATHER_SQL, repaired_accidents
from plumbline.checks.series_queries import sql_group_modes
from plumbline.columns import col
from plumbline.functions import categories as cat
from plumbline.functions.convert import clock_text
from plumbline.operators import integrate
from plumbline.plans import accidents, air, analysis, weather
from plumbline.session import cut_lineage

ACC = st.select("accidents")

# Station identifiers and areas as the sources write them.
STATION_IDS = {"A": "USW00023129", "N": "USW00093134", "R": "USC00049785"}
STATION_NAMES = {"A": "long_beach", "N": "downtown", "R": "reseda"}
AREAS = {"F": "Harbor", "O": "Central", "P": "West Valley"}
AREA_STATIONS = {"Harbor": "long_beach", "Central": "downtown", "West_Valley": "reseda"}
ELEMENTS = ["PRCP", "SNOW", "TMAX", "TMIN"]


def raw_weather(spark, sf):
    """Element observations as landed: some with an unreadable date, some without a value."""
    rows = st.frame(spark, sf, "weather_long")
    station = cat.lookup(col("station"), STATION_IDS)
    return rows.select(
        station.alias("STATION"),
        F.when(col("order_key") % 97 == 0, "not a day").otherwise(F.date_format("day", "yyyyMMdd")).alias("DATE"),
        F.lpad(col("order_key").cast("string"), 12, "0").alias("OBS_TIME"),
        col("element").alias("ELEMENT"),
        F.when(col("order_key") % 89 != 0, col("data_value")).alias("DATA_VALUE"),
    )


RAW_WEATHER = f"(SELECT * FROM {st.select('weather_long')} WHERE order_key % 97 <> 0 AND order_key % 89 <> 0)"
FIRST_VALUES = ", ".join(
    f"""FIRST(data_value ORDER BY order_key, data_value) FILTER (element = '{e}') / {1 if e == 'SNOW' else 10}.0 AS "{e}" """ for e in ELEMENTS
)
FORMATTED_WEATHER = f"""(SELECT {sql_case('station', STATION_NAMES)} AS station, day AS datetime_iso, {FIRST_VALUES}
    FROM {RAW_WEATHER} GROUP BY ALL)"""


@query("formatted_weather", "station:s datetime_iso:d PRCP:f SNOW:f TMAX:f TMIN:f", f"SELECT * FROM {FORMATTED_WEATHER}")
def formatted_weather(spark, sf):
    return weather.format_weather(raw_weather(spark, sf), ELEMENTS)


def raw_accidents(spark, sf):
    """Accidents as landed: nested place, padded text, days as timestamps, numbers as text."""
    rows = st.frame(spark, sf, "accidents")
    place = F.struct(
        col("latitude").cast("string").alias("latitude"),
        col("longitude").cast("string").alias("longitude"),
        F.lit("{}").alias("human_address"),
    )
    return rows.withColumns(
        {
            "date_occ": col("date_occ").cast("timestamp"),
            "date_rptd": col("date_rptd").cast("timestamp"),
            "vict_age": col("vict_age").cast("string"),
            "area_name": F.concat(F.lit(" "), cat.lookup(col("area_name"), AREAS)),
            "location_1": place,
        }
    ).drop("latitude", "longitude")


def sql_underscored(c: str) -> str:
    return f"REPLACE({c}, ' ', '_') AS {c}"


FORMATTED = f"""(SELECT * REPLACE (CONCAT(SUBSTRING(time_occ, 1, 2), ':', SUBSTRING(time_occ, 3, 2)) AS time_occ,
    REPLACE({sql_case('area_name', AREAS)}, ' ', '_') AS area_name, {', '.join(map(sql_underscored, ('crm_cd_desc', 'premis_desc', 'location', 'cross_street')))},
    CASE WHEN vict_sex = 'X' THEN 'Unknown' ELSE vict_sex END AS vict_sex, {sql_case('vict_descent', cat.DESCENT_NAMES)} AS vict_descent,
    CASE WHEN mocodes IS NULL THEN [] ELSE regexp_split_to_array(mocodes, '\\s+') END AS mocodes),
    try_strptime(CONCAT(strftime(date_occ, '%Y-%m-%d'), ' ', SUBSTRING(time_occ, 1, 2), ':', SUBSTRING(time_occ, 3, 2)),
      '%Y-%m-%d %H:%M') AS datetime_iso FROM {ACC})"""
FORMATTED_KINDS = (
    "dr_no:s datetime_iso:t date_rptd:d date_occ:d time_occ:s area:s area_name:s rpt_dist_no:s crm_cd:s crm_cd_desc:s mocodes:a "
    "vict_age:i vict_sex:s vict_descent:s premis_cd:s premis_desc:s location:s cross_street:s latitude:f longitude:f"
)


@query("formatted_accidents", FORMATTED_KINDS, f"SELECT * FROM {FORMATTED}")
def formatted_accidents(spark, sf):
    return accidents.format_accidents(raw_accidents(spark, sf))


def sql_trusted(source: str) -> str:
    medians = ", ".join(f"quantile_disc({c}, 0.5) AS median_{c}" for c in AREA_NUMBERS)
    fills = ", ".join(f"COALESCE(m.{c}, median_{c}) AS {c}" for c in AREA_NUMBERS)
    return f"""(WITH repaired AS {repaired_accidents(source)}, filled AS ({sql_group_modes(["dr_no", *AREA_TEXT], "area_name", "repaired")})
    SELECT m.* REPLACE ({fills}) FROM filled m JOIN (SELECT area_name, {medians} FROM repaired GROUP BY area_name) d USING (area_name))"""


CHAIN_WEATHER = f"""(SELECT * FROM {FORMATTED_WEATHER} WHERE {' AND '.join(f'({c})' for c in WEATHER_SQL.values())})"""
CHAIN_FIELDS = [c for c in integrate.EVENT_VIEW_COLUMNS if c != "area_name"]
CHAIN_KINDS = (
    "dr_no:s date_occ:d date_rptd:d time_occ:s area_name:s latitude:f longitude:f rpt_dist_no:s mocodes:a vict_age:f "
    "vict_sex:s vict_descent:s premis_cd:s location:s cross_street:s TMAX:f TMIN:f PRCP:f"
)


@query(
    "view_event_weather_chain",
    CHAIN_KINDS,
    f"""SELECT DISTINCT {', '.join('t.' + c for c in CHAIN_FIELDS)}, s.station AS area_name, w."TMAX", w."TMIN", w."PRCP"
    FROM (SELECT *, {sql_case('area_name', AREA_STATIONS)} AS station FROM {sql_trusted(FORMATTED)}) s
    JOIN {sql_trusted(FORMATTED)} t ON t.dr_no = s.dr_no
    LEFT JOIN {CHAIN_WEATHER} w ON w.station = s.station AND w.datetime_iso = t.date_occ""",
)
def view_event_weather_chain(spark, sf):
    """Raw accidents and raw weather, formatted, trusted and joined by station and day."""
    events = accidents.trust_accidents(accidents.add_station(accidents.format_accidents(raw_accidents(spark, sf)))).data
    long = raw_weather(spark, sf).filter("ELEMENT <> 'SNOW'")
    daily = weather.trust_weather(weather.format_weather(long, ["PRCP", "TMAX", "TMIN"])).data
    return integrate.event_weather_view(events, daily)


# Accidents of which a tenth has no valid number, a thirteenth hardly any value, and one column few values.
SPOILT = "(CAST(dr_no AS BIGINT) % 13 = 0)"
BAD = "(CAST(dr_no AS BIGINT) % 10 = 0)"


@query(
    "trusted_accidents_bad_keys",
    "item:s n:i",
    f"""WITH a AS (SELECT COUNT(*) AS n, COUNT(*) FILTER ({BAD}) AS bad, COUNT(*) FILTER ({SPOILT} AND NOT {BAD}) AS sparse,
      COUNT(*) FILTER ({SPOILT} AND {BAD}) AS both_ FROM {ACC})
    SELECT 'in' AS item, 2 * n AS n FROM a UNION ALL SELECT 'duplicates', n - bad FROM a
    UNION ALL SELECT 'sparse rows', sparse + 2 * both_ FROM a
    UNION ALL SELECT 'out', 2 * n - (n - bad) - (sparse + 2 * both_) FROM a
    UNION ALL SELECT 'cross_street kept', CASE WHEN AVG(CASE WHEN cross_street IS NOT NULL AND NOT {SPOILT}
      AND CAST(dr_no AS BIGINT) % 4 = 1 THEN 0.0 ELSE 1.0 END) > 0.5 THEN 0 ELSE 1 END FROM {ACC}""",
)
def trusted_accidents_bad_keys(spark, sf):
    """Every row is either in the result or in a report: rows in = rows out + reported."""
    rows = st.frame(spark, sf, "accidents").withColumns(
        {"time_occ": clock_text(col("time_occ")), "datetime_iso": col("date_occ"), "mocodes": F.split("mocodes", r"\s+")}
    )
    spoilt, bad = F.expr(SPOILT), F.expr(BAD)
    kept = {"dr_no", "area_name", "date_occ", "datetime_iso", "crm_cd_desc"}
    names = {c: F.when(~spoilt, col(c)) for c in rows.columns if c not in kept}
    rows = rows.withColumns(names | {"cross_street": F.when(col("dr_no").cast("long") % 4 == 1, names["cross_street"])})
    rows = rows.withColumn("dr_no", F.when(bad, F.concat(F.lit("-"), "dr_no")).otherwise(col("dr_no")))
    doubled = rows.unionByName(rows)
    trusted = accidents.trust_accidents(doubled)
    removed = trusted.reports["removed"].filter("step <> 'input'").select(col("step").alias("item"), col("removed").alias("n"))
    counts = [
        doubled.agg(F.count(F.lit(1)).alias("n")).select(F.lit("in").alias("item"), "n"),
        trusted.data.agg(F.count(F.lit(1)).alias("n")).select(F.lit("out").alias("item"), "n"),
        trusted.data.agg(F.max(F.lit(int("cross_street" in trusted.data.columns))).alias("n")).select(
            F.lit("cross_street kept").alias("item"), col("n").cast("long").alias("n")
        ),
    ]
    return removed.unionByName(counts[0]).unionByName(counts[1]).unionByName(counts[2])


GROUPS = list(cat.MO_CODE_GROUPS)


@query(
    "analysis_columns",
    "column:s",
    " UNION ALL ".join(
        f"""SELECT {sql_text(g)} AS "column" FROM ({sql_code_groups(CODES_OF)}) HAVING AVG(CAST("{g}" = 'unknown' AS INTEGER)) <= 0.5"""
        for g in GROUPS
        if g != analysis.TARGET
    )
    + f" UNION ALL SELECT {sql_text(analysis.TARGET)}",
)
def analysis_columns(spark, sf):
    """The code groups that the analysis keeps: 'unknown' in at most half of the rows."""
    view = event_weather(spark, sf).drop("vict_sex", "rpt_dist_no")
    features = analysis.informative(analysis.accident_features(view))
    kept = [c for c in features.columns if c in GROUPS]
    return features.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(*[F.lit(c) for c in kept])).alias("column"))


def sql_complete(name: str, source: str, columns: list[str]) -> str:
    held = " AND ".join(f'"{c}" IS NOT NULL' for c in columns)
    return f"SELECT '{name}' AS data, AVG(CASE WHEN {held} THEN 1.0 ELSE 0.0 END) AS completeness FROM {source}"


@query(
    "clean_pipeline",
    "data:s completeness:f",
    " UNION ALL ".join(
        [
            sql_complete("weather", f"({sql_trusted_weather(WEATHER_SOURCE)})", ["station", "datetime_iso", "TMAX", "TMIN", "PRCP", "SNOW", "AWND"]),
            sql_complete("air", AIR_TRUSTED, ["station", "datetime_iso", *AIR_NAMES]),
        ]
    ),
)
def clean_pipeline(spark, sf):
    """Completeness after the whole plan, as the plan itself reports it."""
    reports = {
        "weather": weather.trust_weather(weather_source(spark, sf)).reports,
        "air": air.trust_air(air.format_air(air_long(spark, sf), AIR_NAMES)).reports,
    }
    found = [r["final_completeness"].withColumn("data", F.lit(name)) for name, r in reports.items()]
    return found[0].unionByName(found[1])


RESIDUALS = "(SELECT value - 48 - user_id / 10.0 AS error FROM events WHERE value IS NOT NULL)"


@query(
    "error_distribution",
    "kind:s place:i x:f y:f",
    f"""WITH s AS (SELECT COUNT(error) AS n, MIN(error) AS lo, (MAX(error) - MIN(error)) / 99 AS step,
      STDDEV_SAMP(error) * POW(COUNT(error), -0.2) AS h FROM {RESIDUALS})
    SELECT 'density' AS kind, g.point AS place, s.lo + g.point * s.step AS x,
      SUM(EXP(-0.5 * POW((s.lo + g.point * s.step - e.error) / s.h, 2))) / (s.n * s.h * SQRT(2 * PI())) AS y
    FROM s, (SELECT unnest(range(100)) AS point) g, {RESIDUALS} e GROUP BY g.point, s.lo, s.step, s.n, s.h
    UNION ALL SELECT 'histogram', bin, lower, n FROM ({sql_histogram(RESIDUALS, 'error', 30)})""",
)
def error_distribution(spark, sf):
    """Residuals of a fixed guess, as the analysis shows those of a model."""
    guessed = table(spark, sf, "events").withColumn("prediction", F.lit(48) + col("user_id") / 10.0)
    shapes = analysis.error_distribution(guessed, "value")
    histogram = shapes["histogram"].select(F.lit("histogram").alias("kind"), col("bin").alias("place"), col("lower").alias("x"), col("n").alias("y"))
    return histogram.unionByName(shapes["density"].select(F.lit("density").alias("kind"), col("point").alias("place"), "x", col("density").alias("y")))


FEATURE_ROWS = f"({FEATURES})"
FEATURE_WEEK = "CAST(date_trunc('week', CAST({0} AS DATE) - 1) AS DATE) + 7"


@query(
    "accident_results",
    "result:s item:s value:f",
    f"""SELECT 'weekly_counts' AS result, CONCAT(CAST(w.week AS VARCHAR), ' ', a.area_name) AS item, COUNT(t.dr_no) AS value
    FROM (SELECT DISTINCT {FEATURE_WEEK.format('datetime_occ')} AS week FROM {FEATURE_ROWS}) w, (SELECT DISTINCT area_name FROM {FEATURE_ROWS}) a
    LEFT JOIN {FEATURE_ROWS} t ON {FEATURE_WEEK.format('t.datetime_occ')} = w.week AND t.area_name = a.area_name GROUP BY w.week, a.area_name
    UNION ALL SELECT 'tmax_histogram', CAST(bin AS VARCHAR), n FROM ({sql_histogram(FEATURE_ROWS, '"TMAX"', 20)})
    UNION ALL SELECT 'tmin_histogram', CAST(bin AS VARCHAR), n FROM ({sql_histogram(FEATURE_ROWS, '"TMIN"', 20)})
    UNION ALL SELECT 'rain_rate', CAST(is_raining AS VARCHAR), COUNT(*) * 1.0 / COUNT(DISTINCT CAST(datetime_occ AS DATE))
      FROM {FEATURE_ROWS} GROUP BY is_raining
    UNION ALL SELECT 'month_weekday', CONCAT(CAST(month_no AS VARCHAR), ' ', CAST(day_no AS VARCHAR)), AVG(n) FROM (
      SELECT MONTH(datetime_occ) AS month_no, ISODOW(datetime_occ) - 1 AS day_no, YEAR(datetime_occ) AS year, COUNT(*) AS n
      FROM {FEATURE_ROWS} GROUP BY ALL) GROUP BY month_no, day_no""",
)
def accident_results(spark, sf):
    """The charts of the accident analysis that need no model, from the same rows."""
    found = analysis.accident_charts(cut_lineage(features(spark, sf)))
    items = {
        "weekly_counts": (F.concat_ws(" ", col("week").cast("string"), "area_name"), "n"),
        "tmax_histogram": (col("bin").cast("string"), "n"),
        "tmin_histogram": (col("bin").cast("string"), "n"),
        "rain_rate": (col("is_raining").cast("string"), "per_day"),
        "month_weekday": (F.concat_ws(" ", col("month_no").cast("string"), col("day_no").cast("string")), "mean_yearly_count"),
    }
    frames = [
        found[name].select(F.lit(name).alias("result"), item.alias("item"), col(value).cast("double").alias("value"))
        for name, (item, value) in items.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)
