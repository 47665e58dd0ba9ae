"""Views, aggregates, model preparation and model reports."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from plumbline.checks import standins as st
from plumbline.checks.column_queries import sql_case, sql_code_groups
from plumbline.checks.registry import query, quoted, table
from plumbline.columns import col
from plumbline.functions import categories as cat
from plumbline.functions.convert import clock_text
from plumbline.operators import integrate, models, stats
from plumbline.plans import analysis
from plumbline.session import scratch_path
from plumbline.sources import tables

ACC = st.select("accidents")
READINGS = st.select("readings")

VIEW_WEATHER = f"""SELECT DISTINCT w.datetime_iso, w.station, w."TMAX", w."TMIN", w."PRCP", e.value AS cenergy
    FROM {st.WEATHER_DAILY} w LEFT JOIN {st.ENERGY_DAILY} e ON w.datetime_iso = e.datetime_iso"""


def weather_energy(spark, sf):
    return integrate.weather_energy_view(st.weather_daily(spark, sf), st.energy_daily(spark, sf))


@query("view_weather_energy", "datetime_iso:d station:s TMAX:f TMIN:f PRCP:f cenergy:f", VIEW_WEATHER)
def view_weather_energy(spark, sf):
    return tables.create_view(weather_energy(spark, sf), "weather_energy")


MEASURED = {"A": ("co", "no2", "o3", "pm25"), "N": ("co", "no2", "o3", "pm25", "so2"), "R": ("no2", "o3", "so2")}


def sql_air_branch(station: str) -> str:
    listed = ", ".join(
        (f"a.{p}" if p in MEASURED[station] else f"CAST(NULL AS DOUBLE) AS {p}") for p in ("co", "no2", "o3", "pm25", "so2")
    )
    return f"""SELECT a.datetime_iso, '{station}' AS station, {listed}, w."TMAX", w."TMIN", w."PRCP", e.value AS cenergy
    FROM {st.AIR_DAILY} a LEFT JOIN (SELECT * FROM {st.WEATHER_DAILY} WHERE station = '{station}') w
      ON a.datetime_iso = w.datetime_iso LEFT JOIN {st.ENERGY_DAILY} e ON a.datetime_iso = e.datetime_iso
    WHERE a.station = '{station}'"""


VIEW_AIR = " UNION ".join(sql_air_branch(s) for s in MEASURED)
AIR_COLUMNS = "datetime_iso:d station:s co:f no2:f o3:f pm25:f so2:f TMAX:f TMIN:f PRCP:f cenergy:f"


def air_energy_weather(spark, sf):
    return integrate.air_energy_weather_view(
        st.air_daily(spark, sf), st.weather_daily(spark, sf), st.energy_daily(spark, sf), MEASURED
    )


@query("view_air_energy_weather", AIR_COLUMNS, VIEW_AIR)
def view_air_energy_weather(spark, sf):
    return tables.create_view(air_energy_weather(spark, sf), "air_energy_weather")


STATION_OF_AREA = {"F": "A", "O": "N", "P": "R"}
CLOCKED = f"""(SELECT * REPLACE (CONCAT(SUBSTRING(time_occ, 1, 2), ':', SUBSTRING(time_occ, 3, 2)) AS time_occ,
    {sql_case('area_name', STATION_OF_AREA)} AS area_name,
    CASE WHEN mocodes IS NULL THEN NULL ELSE regexp_split_to_array(mocodes, '\\s+') END AS mocodes) FROM {ACC})"""
EVENT_FIELDS = [c for c in integrate.EVENT_VIEW_COLUMNS if c not in ("rpt_dist_no",)]
VIEW_EVENTS = f"""SELECT DISTINCT {', '.join('t.' + c for c in EVENT_FIELDS)}, NULL AS rpt_dist_no,
    w."TMAX", w."TMIN", w."PRCP" FROM {CLOCKED} t LEFT JOIN {st.WEATHER_DAILY} w
    ON t.area_name = w.station AND t.date_occ = w.datetime_iso"""
EVENT_KINDS = (
    "dr_no:s date_occ:d date_rptd:d time_occ:s area_name:s latitude:f longitude:f rpt_dist_no:s mocodes:a vict_age:f "
    "vict_sex:s vict_descent:s premis_cd:s location:s cross_street:s TMAX:f TMIN:f PRCP:f"
)


def event_rows(spark, sf):
    """Accidents with their area's station; one column was dropped on the way."""
    rows = st.frame(spark, sf, "accidents").drop("rpt_dist_no")
    return rows.withColumns(
        {
            "time_occ": clock_text(col("time_occ")),
            "area_name": cat.lookup(col("area_name"), STATION_OF_AREA),
            "mocodes": F.split("mocodes", r"\s+"),
        }
    )


def event_weather(spark, sf):
    """Accidents with the weather of their area's station and day."""
    return integrate.event_weather_view(event_rows(spark, sf), st.weather_daily(spark, sf))


@query("view_event_weather", EVENT_KINDS, VIEW_EVENTS)
def view_event_weather(spark, sf):
    return tables.create_view(event_weather(spark, sf), "event_weather")


@query(
    "union_distinct",
    "segment:s nation:i",
    """SELECT c_mktsegment AS segment, c_nationkey AS nation FROM customer
    UNION SELECT NULL, s_nationkey FROM supplier UNION SELECT c_mktsegment, c_nationkey FROM customer""",
)
def union_distinct(spark, sf):
    customers = table(spark, sf, "customer").select(col("c_mktsegment").alias("segment"), col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf, "supplier").select(col("s_nationkey").alias("nation"))
    return integrate.union_distinct([customers, suppliers, customers])


WEEK = "CAST(date_trunc('week', {0} - 1) AS DATE) + 7"


@query(
    "weekly_counts",
    "week:d area_name:s n:i",
    f"""SELECT w.week, a.area_name, COUNT(t.dr_no) AS n
    FROM (SELECT DISTINCT {WEEK.format('date_occ')} AS week FROM {ACC}) w, (SELECT DISTINCT area_name FROM {ACC}) a
    LEFT JOIN {ACC} t ON {WEEK.format('t.date_occ')} = w.week AND t.area_name = a.area_name GROUP BY 1, 2""",
)
def weekly_counts(spark, sf):
    return stats.weekly_counts(st.frame(spark, sf, "accidents"), "date_occ", "area_name")


STRETCHED = "(SELECT *, DATE '1995-01-01' + CAST(20 * date_diff('day', DATE '1995-01-01', date_occ) AS INTEGER) AS day FROM " + ACC + ")"


@query(
    "weekly_counts_gaps",
    "week:d area_name:s n:i",
    f"""SELECT w.week, a.area_name, COUNT(t.dr_no) AS n FROM (SELECT CAST(unnest(generate_series(
      (SELECT MIN({WEEK.format('day')}) FROM {STRETCHED}), (SELECT MAX({WEEK.format('day')}) FROM {STRETCHED}),
      INTERVAL 7 DAY)) AS DATE) AS week) w, (SELECT DISTINCT area_name FROM {ACC}) a
    LEFT JOIN {STRETCHED} t ON {WEEK.format('t.day')} = w.week AND t.area_name = a.area_name GROUP BY 1, 2""",
)
def weekly_counts_gaps(spark, sf):
    """Days stretched twentyfold, so that most weeks are empty and filled with zeros."""
    origin = F.lit("1995-01-01").cast("date")
    day = F.date_add(origin, F.datediff("date_occ", origin) * 20)
    return stats.weekly_counts(st.frame(spark, sf, "accidents").withColumn("day", day), "day", "area_name", fill_gaps=True)


NULL_AREAS = f"(SELECT * REPLACE (CASE WHEN area_name <> 'P' THEN area_name END AS area_name) FROM {ACC})"


@query(
    "weekly_counts_null_group",
    "week:d area_name:s n:i",
    f"""SELECT w.week, a.area_name, COUNT(t.dr_no) AS n
    FROM (SELECT DISTINCT {WEEK.format('date_occ')} AS week FROM {NULL_AREAS} WHERE area_name IS NOT NULL) w,
      (SELECT DISTINCT area_name FROM {NULL_AREAS} WHERE area_name IS NOT NULL) a
    LEFT JOIN {NULL_AREAS} t ON {WEEK.format('t.date_occ')} = w.week AND t.area_name = a.area_name GROUP BY 1, 2""",
)
def weekly_counts_null_group(spark, sf):
    """Events without an area count nowhere."""
    rows = st.frame(spark, sf, "accidents").withColumn("area_name", F.when(col("area_name") != "P", col("area_name")))
    return stats.weekly_counts(rows, "date_occ", "area_name")


@query(
    "monthly_weekday_avg",
    "month_no:i month:s day_no:i day:s mean_yearly_count:f",
    f"""SELECT month_no, month, day_no, day, AVG(n) AS mean_yearly_count FROM (SELECT MONTH(date_occ) AS month_no,
      MONTHNAME(date_occ) AS month, ISODOW(date_occ) - 1 AS day_no, DAYNAME(date_occ) AS day, YEAR(date_occ) AS year,
      COUNT(*) AS n FROM {ACC} GROUP BY ALL) GROUP BY ALL""",
)
def monthly_weekday_avg(spark, sf):
    return stats.month_weekday_mean(st.frame(spark, sf, "accidents"), "date_occ")


@query(
    "rain_rate",
    "is_raining:b total:i days:i per_day:f",
    f"""SELECT "PRCP" > 0 AS is_raining, COUNT(*) AS total, COUNT(DISTINCT date_occ) AS days,
    COUNT(*) * 1.0 / COUNT(DISTINCT date_occ) AS per_day FROM ({VIEW_EVENTS}) GROUP BY 1""",
)
def rain_rate(spark, sf):
    view = event_weather(spark, sf).withColumn("is_raining", col("PRCP") > 0)
    return stats.rate_per_day(view, "is_raining", "date_occ")


def sql_histogram(source: str, c: str, bins: int) -> str:
    return f"""SELECT b.bin, s.lo + b.bin * s.width AS lower, s.lo + (b.bin + 1) * s.width AS upper, COUNT(x.place) AS n
    FROM (SELECT unnest(range({bins})) AS bin) b
    CROSS JOIN (SELECT MIN({c}) AS lo, (MAX({c}) - MIN({c})) / {bins} AS width FROM {source}) s
    LEFT JOIN (SELECT LEAST(FLOOR((t.{c} - u.lo) / u.width), {bins - 1}) AS place FROM {source} t,
      (SELECT MIN({c}) AS lo, (MAX({c}) - MIN({c})) / {bins} AS width FROM {source}) u WHERE t.{c} IS NOT NULL) x
    ON x.place = b.bin GROUP BY ALL"""


@query("histogram", "bin:i lower:f upper:f n:i", sql_histogram(READINGS, "raw", 20))
def histogram(spark, sf):
    return stats.histogram(st.frame(spark, sf, "readings"), "raw", stats.TEMPERATURE_BINS)


@query("histogram_errors", "bin:i lower:f upper:f n:i", sql_histogram(f"(SELECT *, raw - 50 AS error FROM {READINGS})", "error", 30))
def histogram_errors(spark, sf):
    errors = st.frame(spark, sf, "readings").withColumn("error", col("raw") - 50)
    return stats.histogram(errors, "error", stats.ERROR_BINS)


CORRELATED = ["co", "no", "no2", "nox", "o3", "pm10", "pm25", "lat", "lon"]


def sql_correlations(source: str, columns: list[str]) -> str:
    pairs = list(combinations_with_replacement(columns, 2))
    row = ", ".join(f"CORR({quoted(a)}, {quoted(b)}) AS r_{i}" for i, (a, b) in enumerate(pairs))
    lines = []
    for i, (a, b) in enumerate(pairs):
        for left, right in dict.fromkeys([(a, b), (b, a)]):
            lines.append(f"SELECT '{left}' AS a, '{right}' AS b, r_{i} AS corr FROM c")
    return f"WITH c AS (SELECT {row} FROM {source}) " + " UNION ALL ".join(lines)


@query("corr_matrix", "a:s b:s corr:f", sql_correlations(st.select("gases"), CORRELATED))
def corr_matrix(spark, sf):
    return stats.correlations(st.frame(spark, sf, "gases"), CORRELATED)


@query(
    "kde_grid",
    "point:i x:f density:f",
    """WITH s AS (SELECT COUNT(value) AS n, MIN(value) AS lo, (MAX(value) - MIN(value)) / 99 AS step,
      STDDEV_SAMP(value) * POW(COUNT(value), -0.2) AS h FROM events)
    SELECT g.point, s.lo + g.point * s.step AS x,
      SUM(EXP(-0.5 * POW((s.lo + g.point * s.step - e.value) / s.h, 2))) / (s.n * s.h * SQRT(2 * PI())) AS density
    FROM s, (SELECT unnest(range(100)) AS point) g, events e GROUP BY g.point, s.lo, s.step, s.n, s.h""",
)
def kde_grid(spark, sf):
    return stats.density(table(spark, sf, "events"), "value")


@query(
    "scatter_data",
    "datetime_iso:d TMAX:f TMIN:f PRCP:f cenergy:f",
    f"SELECT * FROM ({VIEW_WEATHER}) WHERE station = 'N'",
)
def scatter_data(spark, sf):
    return analysis.scatter(weather_energy(spark, sf), "N")


COMPLETE = f"""(SELECT *, try_strptime(CONCAT(strftime(date_occ, '%Y-%m-%d'), ' ', time_occ), '%Y-%m-%d %H:%M') AS occurred
    FROM ({VIEW_EVENTS}))"""
FEATURE_INPUT = [c for c in EVENT_FIELDS if c != "vict_sex"]
COMPLETE_ROWS = f"""(SELECT * FROM {COMPLETE} WHERE occurred IS NOT NULL AND "TMAX" IS NOT NULL AND "TMIN" IS NOT NULL
    AND "PRCP" IS NOT NULL AND {' AND '.join(c + ' IS NOT NULL' for c in FEATURE_INPUT)})"""
CODES_OF = f"""(SELECT dr_no, array_to_string(mocodes, ' ') AS mocodes FROM {COMPLETE_ROWS})"""
PART = """CASE WHEN HOUR(occurred) >= 6 AND HOUR(occurred) < 12 THEN 'Morning' WHEN HOUR(occurred) >= 12 AND
    HOUR(occurred) < 17 THEN 'Afternoon' WHEN HOUR(occurred) >= 17 AND HOUR(occurred) < 20 THEN 'Evening'
    WHEN HOUR(occurred) >= 20 THEN 'Late Evening' ELSE 'Night' END"""
AGE = """CASE WHEN vict_age < 0 THEN NULL WHEN vict_age < 17 THEN 'Minor' WHEN vict_age < 25 THEN 'Young Adult'
    WHEN vict_age < 40 THEN 'Adult' WHEN vict_age < 60 THEN 'Middle-Aged' ELSE 'Senior' END"""
FEATURES = f"""SELECT r.dr_no, occurred AS datetime_occ, YEAR(occurred) AS occ_year, MONTH(occurred) AS occ_month,
    DAY(occurred) AS occ_day, ISODOW(occurred) - 1 AS occ_dayofweek, HOUR(occurred) AS occ_hour,
    MINUTE(occurred) AS occ_minute, {PART} AS occ_part_of_day,
    CASE WHEN ISODOW(occurred) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    date_diff('day', date_occ, date_rptd) AS report_delay_days, area_name, vict_age, {AGE} AS vict_age_group,
    CASE WHEN location IN (SELECT location FROM {COMPLETE_ROWS} GROUP BY 1 HAVING COUNT(*) > 100) THEN location
      ELSE 'secondary_st' END AS location,
    premis_cd, "TMAX", "TMIN", "PRCP", "TMAX" - "TMIN" AS temp_range, "PRCP" > 0 AS is_raining,
    "Location_Type", "Collision_Type", "Collision_Factor", "Hit_Run_Property",
    {sql_case('"Injury_Level"', cat.INJURY_REGROUP)[:-4]} ELSE "Injury_Level" END AS "Injury_Level"
    FROM {COMPLETE_ROWS} r JOIN ({sql_code_groups(CODES_OF)}) g ON r.dr_no = g.dr_no WHERE "Injury_Level" <> 'unknown'"""
FEATURE_KINDS = (
    "dr_no:s datetime_occ:t occ_year:i occ_month:i occ_day:i occ_dayofweek:i occ_hour:i occ_minute:i occ_part_of_day:s "
    "is_weekend:i report_delay_days:i area_name:s vict_age:f vict_age_group:s location:s premis_cd:s TMAX:f TMIN:f PRCP:f "
    "temp_range:f is_raining:b Location_Type:s Collision_Type:s Collision_Factor:s Hit_Run_Property:s Injury_Level:s"
)


def features(spark, sf):
    view = event_weather(spark, sf).drop("vict_sex", "rpt_dist_no")
    return analysis.injury_rows(analysis.accident_features(view))


@query("injury_features", FEATURE_KINDS, FEATURES)
def injury_features(spark, sf):
    return features(spark, sf)


@query(
    "class_weights",
    "class:s n:i weight:f",
    f"""SELECT vict_sex AS "class", COUNT(*) AS n, (SELECT COUNT(*) FROM {ACC}) * 1.0 /
    ((SELECT COUNT(*) FROM (SELECT DISTINCT vict_sex FROM {ACC})) * COUNT(*)) AS weight FROM {ACC} GROUP BY 1""",
)
def class_weights(spark, sf):
    return stats.class_weights(st.frame(spark, sf, "accidents"), "vict_sex")


@query(
    "class_weighted_rows",
    "dr_no:s weight:f",
    f"""SELECT dr_no, (SELECT COUNT(*) FROM {ACC}) * 1.0 / ((SELECT COUNT(*) FROM (SELECT DISTINCT vict_sex FROM {ACC})) * n)
    AS weight FROM (SELECT dr_no, COUNT(*) OVER (PARTITION BY vict_sex) AS n FROM {ACC})""",
)
def class_weighted_rows(spark, sf):
    return stats.add_class_weight(st.frame(spark, sf, "accidents"), "vict_sex")


@query(
    "standardize",
    "event_id:i raw:f level:f",
    f"""SELECT event_id, (raw - (SELECT AVG(raw) FROM {READINGS})) / (SELECT STDDEV_POP(raw) FROM {READINGS}) AS raw,
    (level - (SELECT AVG(level) FROM {READINGS})) / (SELECT STDDEV_POP(level) FROM {READINGS}) AS level FROM {READINGS}""",
)
def standardize(spark, sf):
    return stats.standardize(st.frame(spark, sf, "readings"), ["raw", "level"])


# A fixed guess stands for a model's prediction: 48 plus a tenth of the user's number.
GUESS = "(SELECT *, 48 + user_id / 10.0 AS guess FROM events)"


@query(
    "regression_metrics",
    "event_type:s n:i mse:f rmse:f mae:f r2:f",
    f"""SELECT event_type, COUNT(*) AS n, AVG(POW(value - guess, 2)) AS mse, SQRT(AVG(POW(value - guess, 2))) AS rmse,
    AVG(ABS(value - guess)) AS mae, 1 - SUM(POW(value - guess, 2)) / SUM(POW(value - mean, 2)) AS r2
    FROM (SELECT *, AVG(value) OVER (PARTITION BY event_type) AS mean FROM {GUESS}) GROUP BY 1""",
)
def regression_metrics(spark, sf):
    guessed = table(spark, sf, "events").withColumn("guess", F.lit(48) + col("user_id") / 10.0)
    return stats.regression_metrics(guessed, "value", "guess", ["event_type"])


# The sex code stands for a label, and the priority with one level misread for a prediction.
GUESSED_CLASS = "CASE o_orderpriority WHEN '1-URGENT' THEN 'F' WHEN '5-LOW' THEN 'M' ELSE o_orderstatus END"
CLASSES = f"(SELECT o_orderkey, o_orderstatus AS label, {GUESSED_CLASS} AS guess FROM orders)"


def classified(spark, sf):
    guess = cat.lookup(col("o_orderpriority"), {"1-URGENT": "F", "5-LOW": "M"})
    return table(spark, sf, "orders").select(
        "o_orderkey", col("o_orderstatus").alias("label"), F.coalesce(guess, col("o_orderstatus")).alias("guess")
    )


@query(
    "classification_report",
    "class:s precision:f recall:f f1:f support:i",
    f"""SELECT "class", CASE WHEN p = 0 THEN 0 ELSE h * 1.0 / p END AS precision, CASE WHEN s = 0 THEN 0 ELSE h * 1.0 / s END AS recall,
    CASE WHEN p + s = 0 THEN 0 ELSE 2.0 * h / (p + s) END AS f1, s AS support FROM (
      SELECT c."class", (SELECT COUNT(*) FROM {CLASSES} WHERE label = c."class" AND guess = c."class") AS h,
      (SELECT COUNT(*) FROM {CLASSES} WHERE guess = c."class") AS p, (SELECT COUNT(*) FROM {CLASSES} WHERE label = c."class") AS s
      FROM (SELECT label AS "class" FROM {CLASSES} UNION SELECT guess FROM {CLASSES}) c)""",
)
def classification_report(spark, sf):
    return stats.classification_report(classified(spark, sf), "label", "guess")


@query(
    "classification_accuracy",
    "accuracy:f",
    f"SELECT AVG(CASE WHEN label = guess THEN 1.0 ELSE 0.0 END) AS accuracy FROM {CLASSES}",
)
def classification_accuracy(spark, sf):
    return stats.accuracy(classified(spark, sf), "label", "guess")


@query(
    "confusion_matrix",
    "label:s F:i M:i O:i P:i",
    f"""SELECT label, COUNT(*) FILTER (guess = 'F') AS "F", COUNT(*) FILTER (guess = 'M') AS "M",
    COUNT(*) FILTER (guess = 'O') AS "O", COUNT(*) FILTER (guess = 'P') AS "P" FROM {CLASSES} GROUP BY 1""",
)
def confusion_matrix(spark, sf):
    return stats.confusion_matrix(classified(spark, sf), "label", "guess")


def sql_is_train(*keys: str) -> str:
    """The same split from the same MD5 text."""
    text = " || '|' || ".join(["'42'", *[f"COALESCE(CAST({k} AS VARCHAR), '')" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 7) AS BIGINT) % 100 < 80"


@query(
    "hash_split",
    "o_orderstatus:s is_train:b n:i",
    f"SELECT o_orderstatus, {sql_is_train('o_orderkey')} AS is_train, COUNT(*) AS n FROM orders GROUP BY ALL",
)
def hash_split(spark, sf):
    split = models.hash_split(table(spark, sf, "orders"), ["o_orderkey"])
    return split.groupBy("o_orderstatus", "is_train").agg(F.count(F.lit(1)).alias("n"))


@query(
    "save_results",
    "name:s event_type:s n:i value:f",
    """SELECT 'counts' AS name, event_type, COUNT(*) AS n, NULL AS value FROM events GROUP BY event_type
    UNION ALL SELECT 'means', event_type, NULL, AVG(value) FROM events GROUP BY event_type""",
)
def save_results(spark, sf):
    """Two result frames stored as tables and read back."""
    events = table(spark, sf, "events")
    paths = stats.save_results(
        {
            "counts": events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")),
            "means": events.groupBy("event_type").agg(F.avg("value").alias("value")),
        },
        scratch_path(spark, "results"),
    )
    read = {name: spark.read.parquet(path).withColumn("name", F.lit(name)) for name, path in paths.items()}
    return read["counts"].unionByName(read["means"], allowMissingColumns=True)
