"""The four data-set plans from raw rows to trusted tables, and the fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.checks import standins as st
from plumbline.checks.analysis_queries import FEATURES, VIEW_AIR, air_energy_weather, features, sql_is_train
from plumbline.checks.registry import query, table
from plumbline.checks.rule_queries import WEATHER_SQL, repaired_accidents
from plumbline.checks.series_queries import sql_group_modes
from plumbline.columns import any_of, col
from plumbline.functions.convert import clock_text
from plumbline.operators import stats
from plumbline.plans import accidents, air, analysis, energy, weather

RAW_ENERGY = """SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date,
    CASE o_orderstatus WHEN 'F' THEN 'pacific' WHEN 'O' THEN 'eastern' ELSE 'utc' END AS timezone_id,
    CASE WHEN o_totalprice < 20000 THEN NULL ELSE o_totalprice * 1.1 END AS value,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'mwh' END AS unit_of_measure,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'los_angeles_water' ELSE 'los_angeles_power' END AS respondent_name,
    CAST(o_orderdate AS DATE) AS datetime_iso FROM orders"""


def raw_energy(spark, sf):
    """Orders as API records: all text, padded names, one unusable spelling per field."""
    orders, value = table(spark, sf, "orders"), (col("o_totalprice") * 1.1).cast("string")
    name = F.when(col("o_orderpriority") == "1-URGENT", "Los  Angeles Water ").otherwise(" Los Angeles   Power")
    return orders.select(
        F.to_date("o_orderdate").cast("string").alias("period"),
        F.lit("LDWP").alias("respondent"),
        name.alias("respondent-name"),
        F.lit("D").alias("type"),
        F.when(col("o_orderstatus") == "F", "Pacific").when(col("o_orderstatus") == "O", "EASTERN").otherwise("utc").alias("timezone"),
        F.when(col("o_totalprice") < 20000, F.concat(value, F.lit(" MW"))).otherwise(value).alias("value"),
        F.when(col("o_orderpriority") == "5-LOW", " ").otherwise("megawatthours").alias("value-units"),
    )


@query(
    "formatted_energy",
    "date:s timezone_id:s value:f unit_of_measure:s respondent_name:s datetime_iso:d respondent_id:s data_type:s",
    f"SELECT *, 'ldwp' AS respondent_id, 'd' AS data_type FROM ({RAW_ENERGY})",
)
def formatted_energy(spark, sf):
    return energy.format_energy(raw_energy(spark, sf))


@query(
    "trusted_energy",
    "datetime_iso:d respondent_name:s timezone_id:s value:f unit_of_measure:s",
    f"""SELECT DISTINCT ON (datetime_iso) * FROM ({RAW_ENERGY}) WHERE value >= 0 AND value <= 500000
    AND unit_of_measure = 'mwh' AND timezone_id IN ('pacific', 'eastern', 'central')
    ORDER BY datetime_iso, respondent_name, timezone_id, value""",
)
def trusted_energy(spark, sf):
    return energy.trust_energy(energy.format_energy(raw_energy(spark, sf))).data


# Weather with two more elements, one of them mostly missing at one station.
WEATHER_SOURCE = f"""(SELECT *, CASE WHEN station = 'A' AND "TMIN" < 60 THEN NULL ELSE "TMIN" / 2 END AS "SNOW",
    CASE WHEN "TMAX" > 62 THEN NULL ELSE "TMAX" + "PRCP" END AS "AWND" FROM {st.WEATHER_DAILY})"""


def weather_source(spark, sf):
    return st.weather_daily(spark, sf).withColumns(
        {
            "SNOW": F.when(~((col("station") == "A") & (col("TMIN") < 60)), col("TMIN") / 2),
            "AWND": F.when(~(col("TMAX") > 62), col("TMAX") + col("PRCP")),
        }
    )


WEATHER_TIES = '"TMAX" NULLS FIRST, "TMIN" NULLS FIRST, "PRCP" NULLS FIRST, "SNOW" NULLS FIRST, "AWND" NULLS FIRST'


def sql_unstable(c: str, source: str) -> str:
    return f"""(SELECT COUNT(*) - COUNT({c}) > 730 * 0.2 FROM (SELECT * FROM {source} i WHERE i.station = o.station
      ORDER BY datetime_iso DESC, {WEATHER_TIES} LIMIT 730))"""


def sql_fill(c: str, by: str, order: str, fallback: str = "NULL") -> str:
    w = f"PARTITION BY {by} ORDER BY {order} ROWS BETWEEN"
    before = f"LAST({c} IGNORE NULLS) OVER ({w} UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = f"FIRST({c} IGNORE NULLS) OVER ({w} 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    return f"COALESCE({c}, ({before} + {after}) / 2.0, {before}, {after}, {fallback}) AS {c}"


def sql_trusted_weather(source: str) -> str:
    """Unstable columns blanked, implausible days and copies gone, gaps filled, in this order."""
    return f"""SELECT station, datetime_iso, "TMAX", "TMIN", "PRCP", {sql_fill('"SNOW"', 'station', 'datetime_iso')},
    {sql_fill('"AWND"', 'station', 'datetime_iso')} FROM (
      SELECT DISTINCT ON (station, datetime_iso) * FROM (
        SELECT o.station, datetime_iso, "TMAX", "TMIN", "PRCP",
          CASE WHEN u.no_snow THEN NULL ELSE "SNOW" END AS "SNOW", CASE WHEN u.no_awnd THEN NULL ELSE "AWND" END AS "AWND"
        FROM {source} o JOIN (SELECT station, {sql_unstable('"SNOW"', source)} AS no_snow, {sql_unstable('"AWND"', source)} AS no_awnd
          FROM (SELECT DISTINCT station FROM {source}) o) u ON u.station = o.station)
      WHERE {' AND '.join(f'({c})' for c in WEATHER_SQL.values())}
      ORDER BY station, datetime_iso, {WEATHER_TIES})"""


@query(
    "trusted_weather",
    "station:s datetime_iso:d TMAX:f TMIN:f PRCP:f SNOW:f AWND:f",
    sql_trusted_weather(WEATHER_SOURCE),
)
def trusted_weather(spark, sf):
    return weather.trust_weather(weather_source(spark, sf)).data


COPIES = f"""(SELECT * FROM {WEATHER_SOURCE} UNION ALL
    SELECT * REPLACE ("TMAX" + 1 AS "TMAX", "SNOW" - 2 AS "SNOW") FROM {WEATHER_SOURCE} WHERE DAY(datetime_iso) % 3 = 0)"""


@query("trusted_weather_copies", "station:s datetime_iso:d TMAX:f TMIN:f PRCP:f SNOW:f AWND:f", sql_trusted_weather(COPIES))
def trusted_weather_copies(spark, sf):
    """A third of the days come twice, with other values the second time."""
    rows = weather_source(spark, sf)
    again = rows.filter(F.dayofmonth("datetime_iso") % 3 == 0)
    return weather.trust_weather(rows.unionByName(again.withColumns({"TMAX": col("TMAX") + 1, "SNOW": col("SNOW") - 2}))).data


@query(
    "trusted_weather_core",
    "station:s datetime_iso:d TMAX:f TMIN:f PRCP:f",
    f"SELECT * FROM {st.WEATHER_DAILY} WHERE {' AND '.join(f'({c})' for c in WEATHER_SQL.values())}",
)
def trusted_weather_core(spark, sf):
    """Weather of the three core elements only: no column is left to judge."""
    return weather.trust_weather(st.weather_daily(spark, sf)).data


AREA_TEXT = ["time_occ", "area", "rpt_dist_no", "crm_cd", "vict_sex", "vict_descent", "premis_cd", "premis_desc", "location", "cross_street"]
AREA_NUMBERS = ["latitude", "longitude", "vict_age"]
REPAIRED = repaired_accidents()


def sql_trusted_accidents() -> str:
    medians = ", ".join(f"quantile_disc({c}, 0.5) AS median_{c}" for c in AREA_NUMBERS)
    fills = ", ".join(f"COALESCE(m.{c}, median_{c}) AS {c}" for c in AREA_NUMBERS)
    listed = ", ".join(f"m.{c}" for c in ["dr_no", "area_name", "date_occ", "date_rptd", *AREA_TEXT])
    # A report without a valid number is no copy of another: both its rows stay.
    return f"""WITH repaired AS (SELECT * FROM {REPAIRED} UNION ALL SELECT * FROM {REPAIRED} WHERE dr_no IS NULL), filled AS ({sql_group_modes(["dr_no", *AREA_TEXT], "area_name", "repaired")})
    SELECT {listed}, {fills} FROM filled m JOIN (SELECT area_name, {medians} FROM repaired GROUP BY area_name) d USING (area_name)"""


@query(
    "trusted_accidents",
    "dr_no:s area_name:s date_occ:d date_rptd:d " + " ".join(f"{c}:s" for c in AREA_TEXT) + " " + " ".join(f"{c}:f" for c in AREA_NUMBERS),
    sql_trusted_accidents(),
)
def trusted_accidents(spark, sf):
    rows = st.frame(spark, sf, "accidents").withColumns(
        {"time_occ": clock_text(col("time_occ")), "datetime_iso": col("date_occ"), "mocodes": F.split("mocodes", r"\s+")}
    )
    # Each report comes twice: the copy must vanish, unless its number says nothing.
    return accidents.trust_accidents(rows.unionByName(rows)).data


# Events as sensor readings: every six hours, two stations, one parameter per event type.
# Whole values over powers of two keep every mean exact, so that rounding cannot differ.
SENSOR = {"click": ("co", 4.0), "error": ("no", 16.0), "purchase": ("no2", 128.0), "signup": ("o3", 512.0), "view": ("pm25", 1.0)}
AIR_LONG = f"""(SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS datetime_iso,
    CASE WHEN user_id < 50 THEN 'downtown' ELSE 'reseda' END AS station, event_id,
    CASE event_type {' '.join(f"WHEN '{k}' THEN '{p}'" for k, (p, _) in SENSOR.items())} END AS parameter,
    FLOOR(value) / CASE event_type {' '.join(f"WHEN '{k}' THEN {d}" for k, (_, d) in SENSOR.items())} END AS value FROM events)"""
AIR_NAMES = [p for p, _ in SENSOR.values()]
FIRST_READINGS = ", ".join(f"FIRST(value ORDER BY event_id) FILTER (parameter = '{p}') AS {p}" for p in AIR_NAMES)
AIR_WIDE = f"(SELECT station, datetime_iso, {FIRST_READINGS} FROM {AIR_LONG} GROUP BY ALL)"


def air_long(spark, sf):
    """The readings as landed: text only, camel-case names, time with an offset."""
    parameter, divisor = F.lit(None), F.lit(None)
    for kind, (name, by) in SENSOR.items():
        parameter = F.when(col("event_type") == kind, name).otherwise(parameter)
        divisor = F.when(col("event_type") == kind, by).otherwise(divisor)
    block = F.date_trunc("day", "ts") + F.make_interval(hours=F.floor(F.hour("ts") / 6) * 6)
    downtown = col("user_id") < 50
    return table(spark, sf, "events").select(
        F.when(downtown, "7936").otherwise("2138").alias("locationId"),
        F.lpad(col("event_id").cast("string"), 12, "0").alias("sensorsId"),
        F.when(downtown, "Main St").otherwise("Gault St").alias("location"),
        F.concat(F.date_format(block, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("datetime"),
        F.when(downtown, "34.06").otherwise("34.19").alias("lat"),
        F.when(downtown, "-118.22").otherwise("-118.53").alias("lon"),
        parameter.alias("parameter"),
        F.lit("ppm").alias("units"),
        (F.floor("value") / divisor).cast("string").alias("value"),
    )


@query("formatted_air", "station:s datetime_iso:t " + " ".join(f"{p}:f" for p in AIR_NAMES), f"SELECT * FROM {AIR_WIDE}")
def formatted_air(spark, sf):
    return air.format_air(air_long(spark, sf), AIR_NAMES)


LIMITS = {"co": 50, "no": 10, "no2": 1, "o3": 0.2, "pm25": 250}
AIR_TRUSTED = f"""(SELECT station, datetime_iso, {', '.join(sql_fill(p, 'station', 'datetime_iso', '0') for p in AIR_NAMES)}
    FROM (SELECT station, datetime_iso, {', '.join(f"CASE WHEN {p} < 0 OR {p} >= {LIMITS[p]} THEN NULL ELSE {p} END AS {p}" for p in AIR_NAMES)}
    FROM {AIR_WIDE}))"""


@query("trusted_air", "station:s datetime_iso:t " + " ".join(f"{p}:f" for p in AIR_NAMES), f"SELECT * FROM {AIR_TRUSTED}")
def trusted_air(spark, sf):
    return air.trust_air(air.format_air(air_long(spark, sf), AIR_NAMES)).data


@query(
    "trusted_air_daily",
    "station:s datetime_iso:d " + " ".join(f"{p}:f" for p in AIR_NAMES) + " hourly_readings:i",
    f"""SELECT station, CAST(datetime_iso AS DATE) AS datetime_iso, {', '.join(f'ROUND(AVG({p}), 4) AS {p}' for p in AIR_NAMES)},
    COUNT(datetime_iso) AS hourly_readings FROM {AIR_TRUSTED} GROUP BY 1, 2""",
)
def trusted_air_daily(spark, sf):
    return air.daily_air(air.trust_air(air.format_air(air_long(spark, sf), AIR_NAMES)).data)


@query(
    "air_reports",
    "report:s item:s value:f",
    f"""SELECT 'completeness' AS report, p AS item, r AS value FROM (
      SELECT unnest(['co', 'no', 'no2', 'o3', 'pm25']) AS p, unnest([{', '.join(f'AVG(CAST({p} IS NULL AS INTEGER))' for p in AIR_NAMES)}]) AS r
      FROM {AIR_WIDE})
    UNION ALL SELECT 'removed', 'duplicates', COUNT(*) - COUNT(DISTINCT (station, datetime_iso)) FROM {AIR_WIDE}
    UNION ALL SELECT 'constraints', 'ordered_timestamps', (COUNT(*) - COUNT(DISTINCT station)) * 1.0 / COUNT(*) FROM {AIR_WIDE}""",
)
def air_reports(spark, sf):
    """Reports of the air plan: completeness, removals, and the share of rows in time order."""
    reports = air.trust_air(air.format_air(air_long(spark, sf), AIR_NAMES)).reports
    complete = reports["column_completeness"].filter(col("column").isin(*AIR_NAMES)).select(
        F.lit("completeness").alias("report"), col("column").alias("item"), col("missing_ratio").alias("value")
    )
    removed = reports["removed"].filter("step = 'duplicates'").select(
        F.lit("removed").alias("report"), col("step").alias("item"), col("removed").cast("double").alias("value")
    )
    order = reports["constraints"].filter("constraint = 'ordered_timestamps'").select(
        F.lit("constraints").alias("report"), col("constraint").alias("item"), col("ratio").alias("value")
    )
    return complete.unionByName(removed).unionByName(order)


TARGETS = {"A": "pm25", "N": "pm25", "R": "o3"}


def regressions(spark, sf):
    return analysis.air_regression(air_energy_weather(spark, sf), TARGETS)


def sql_held_out(station: str, target: str) -> str:
    """The held-out rows with a target, which the station's mean fills where it is missing."""
    return f"""SELECT '{station}' AS station, COUNT(*) AS n, AVG({target}) AS target_mean, TRUE AS scored FROM (
      SELECT station, datetime_iso, COALESCE({target}, AVG({target}) OVER ()) AS {target} FROM ({VIEW_AIR}) WHERE station = '{station}')
    WHERE NOT ({sql_is_train('station', 'datetime_iso')}) AND {target} IS NOT NULL"""


@query(
    "gbt_regression",
    "station:s n:i target_mean:f scored:b",
    " UNION ALL ".join(sql_held_out(s, t) for s, t in TARGETS.items()),
)
def gbt_regression(spark, sf):
    """Boosted trees per station: every held-out row has a prediction within the range of the target.

    The errors themselves have no SQL form; the tests compare them with the mean's.
    """
    scores = []
    for s, f in regressions(spark, sf).items():
        target, guess = col(TARGETS[s]), col("prediction")
        scores.append(
            f.predictions.agg(
                F.count(guess).alias("n"),
                F.avg(target).alias("target_mean"),
                F.coalesce(F.min(guess) >= F.min(target) - F.stddev(target), F.lit(False)).alias("above"),
                F.coalesce(F.max(guess) <= F.max(target) + F.stddev(target), F.lit(False)).alias("below"),
            ).select(F.lit(s).alias("station"), "n", "target_mean", (F.col("above") & F.col("below")).alias("scored"))
        )
    return scores[0].unionByName(scores[1]).unionByName(scores[2])


def sql_incomplete(station: str, target: str) -> str:
    held_out = f"""(SELECT * FROM ({VIEW_AIR}) WHERE station = '{station}' AND NOT ({sql_is_train('station', 'datetime_iso')}))"""
    lacking = " OR ".join(f'"{f}" IS NULL' for f in analysis.REGRESSION_FEATURES if f != target)
    return f"""SELECT '{station}' AS station, COUNT(*) AS predicted, COUNT(*) FILTER (WHERE {lacking}) AS incomplete,
      COUNT(*) FILTER (WHERE {target} IS NULL) AS without_target FROM {held_out}"""


@query(
    "gbt_missing_sides",
    "station:s predicted:i incomplete:i without_target:i",
    " UNION ALL ".join(sql_incomplete(s, t) for s, t in TARGETS.items()),
)
def gbt_missing_sides(spark, sf):
    """Boosted trees that split missing features: predictions of held-out rows, and those with gaps among them.

    The tests compare the errors with the mean's and with those of filled rows.
    """
    fitted = analysis.air_regression(air_energy_weather(spark, sf), TARGETS, missing="sides", maxIter=10)
    counted = []
    for s, f in fitted.items():
        lacking = any_of(col(c).isNull() for c in analysis.REGRESSION_FEATURES if c != TARGETS[s])
        counts = F.count("prediction"), F.count_if(lacking), F.count_if(col(TARGETS[s]).isNull())
        counted.append(f.predictions.agg(*counts).toDF("predicted", "incomplete", "without_target").withColumn("station", F.lit(s)))
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# The chronological parts of the rows that the forest takes.
PARTED = f"""(SELECT *, CASE WHEN place <= FLOOR(total * 0.85) THEN 'train'
      WHEN place <= FLOOR(total * 0.85) + FLOOR(total * 0.15) THEN 'validation' END AS part
    FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY datetime_occ, dr_no) AS place, COUNT(*) OVER () AS total FROM ({FEATURES})))"""


def severity(spark, sf, **params):
    return analysis.severity_model(analysis.severity_parts(features(spark, sf)), **params)


@query(
    "rf_classifier",
    "class:s support:i bounded:b",
    f"""SELECT "Injury_Level" AS "class", COUNT(*) AS support, TRUE AS bounded FROM {PARTED} WHERE part = 'validation' GROUP BY 1""",
)
def rf_classifier(spark, sf):
    """Severity forest on the later rows: the classes found there, every row counted, ratios between 0 and 1."""
    report = stats.classification_report(severity(spark, sf).predictions, analysis.TARGET, "prediction")
    ratios = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1")]
    return report.filter("support > 0").select("class", "support", (ratios[0] & ratios[1] & ratios[2]).alias("bounded"))


ENCODED = analysis.CATEGORY_FEATURES


@query(
    "feature_importance",
    "source:s features:i total:f",
    " UNION ALL ".join(
        [
            f"SELECT 'plain' AS source, {len(analysis.NUMERIC_FEATURES) + len(analysis.TIME_FEATURES)} AS features, NULL AS total",
            *[
                f"""SELECT '{c}', COUNT(DISTINCT "{c}") + 2, NULL FROM {PARTED} WHERE part = 'train'"""
                for c in ENCODED
            ],
            "SELECT 'all', NULL, 1.0",
        ]
    ),
)
def feature_importance(spark, sf):
    """Importances of a small forest: one per plain feature and per level (two for levels not seen), 1 in sum."""
    found = severity(spark, sf, numTrees=10, maxDepth=5).importances
    origin = F.when(F.instr("feature", "=") > 0, F.substring_index("feature", "=", 1)).otherwise("plain")
    counts = found.groupBy(origin.alias("source")).agg(F.count(F.lit(1)).alias("features"))
    total = found.agg(F.sum("importance").alias("total")).select(F.lit("all").alias("source"), "total")
    return counts.unionByName(total, allowMissingColumns=True)
