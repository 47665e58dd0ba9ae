"""Outliers, imputation, pivots and ordered operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.checks import standins as st
from plumbline.checks.registry import query, quoted, table
from plumbline.columns import col
from plumbline.operators import impute, ordered, series

READINGS = st.select("readings")
ACC = st.select("accidents")
WINDOW = 84
# Forces the form for a series too long for one task.
CUT = ordered.Layout(True, 16)


def sql_outliers(source: str, columns: list[str], by: str, order: str, keep: str, window: int = WINDOW) -> str:
    part = f"PARTITION BY {by}" if by else ""
    steps = ", ".join(
        f"COALESCE({c} - LAG({c}) OVER ({part} ORDER BY {order}), 0.0) AS increase_{c}" for c in columns
    )
    frame = f"OVER ({part} ORDER BY {order} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    quartiles = ", ".join(
        f"quantile_disc(increase_{c}, 0.25) {frame} AS q1_{c}, quantile_disc(increase_{c}, 0.75) {frame} AS q3_{c}"
        for c in columns
    )
    flags = ", ".join(f"increase_{c} > q3_{c} + 7.5 * (q3_{c} - q1_{c}) AS is_outlier_{c}" for c in columns)
    increases = ", ".join(f"increase_{c}" for c in columns)
    return f"""SELECT {keep}, {increases}, {flags} FROM (SELECT *, {quartiles} FROM (SELECT *, {steps} FROM {source}))"""


OUTLIER_COLUMNS = "event_id:i parameter:s increase_raw:f is_outlier_raw:b"
OUTLIERS = sql_outliers(READINGS, ["raw"], "parameter", "datetime_iso, event_id", "event_id, parameter")


@query("ts_outliers", OUTLIER_COLUMNS, OUTLIERS)
def ts_outliers(spark, sf):
    rows = st.frame(spark, sf, "readings")
    return series.detect_outliers(rows, ["raw"], ["datetime_iso", "event_id"], ["parameter"], window=WINDOW)


@query("ts_outliers_split", OUTLIER_COLUMNS, OUTLIERS)
def ts_outliers_split(spark, sf):
    """The form for a series too long for one task."""
    rows = st.frame(spark, sf, "readings")
    return series.detect_outliers(
        rows, ["raw"], ["datetime_iso", "event_id"], ["parameter"], window=WINDOW, layout=CUT, block_rows=500
    )


PARAMETERS = ["click", "error", "purchase", "signup", "view"]


def hourly(spark, sf):
    """One row per hour, one column per parameter: the first reading of the hour."""
    rows = st.frame(spark, sf, "readings").withColumn("hour", F.date_trunc("hour", "datetime_iso"))
    return series.pivot_wide(rows, ["hour"], "parameter", "raw", ["event_id"], PARAMETERS)


HOURLY = (
    "(SELECT hour, "
    + ", ".join(f"FIRST(raw ORDER BY event_id) FILTER (parameter = '{p}') AS {quoted(p)}" for p in PARAMETERS)
    + f" FROM (SELECT *, date_trunc('hour', datetime_iso) AS hour FROM {READINGS}) GROUP BY hour)"
)


@query("pivot_hourly", "hour:t " + " ".join(f"{p}:f" for p in PARAMETERS), f"SELECT * FROM {HOURLY}")
def pivot_hourly(spark, sf):
    return hourly(spark, sf)


@query("pivot_discovered", "hour:t " + " ".join(f"{p}:f" for p in PARAMETERS), f"SELECT * FROM {HOURLY}")
def pivot_discovered(spark, sf):
    """The same pivot, its columns found in the data."""
    rows = st.frame(spark, sf, "readings").withColumn("hour", F.date_trunc("hour", "datetime_iso"))
    return series.pivot_wide(rows, ["hour"], "parameter", "raw", ["event_id"])


ELEMENTS = ["TMAX", "TMIN", "PRCP", "SNOW"]


@query(
    "pivot_wide",
    "station:s day:d " + " ".join(f"{e}:i" for e in ELEMENTS),
    "SELECT station, day, "
    + ", ".join(
        f"FIRST(data_value ORDER BY order_key, part_key, price, data_value) FILTER (element = '{e}') AS {quoted(e)}"
        for e in ELEMENTS
    )
    + f" FROM {st.select('weather_long')} GROUP BY station, day",
)
def pivot_wide(spark, sf):
    rows = st.frame(spark, sf, "weather_long")
    return series.pivot_wide(rows, ["station", "day"], "element", "data_value", ["order_key", "part_key", "price", "data_value"], ELEMENTS)


HOURLY_OUTLIERS = sql_outliers(HOURLY, PARAMETERS, "", "hour", "hour")


def flagged_hours(spark, sf):
    return series.detect_outliers(hourly(spark, sf), PARAMETERS, ["hour"], window=WINDOW)


@query(
    "outliers_per_row",
    "hour:t total_outliers:i",
    "SELECT hour, total_outliers FROM (SELECT hour, "
    + " + ".join(f"CAST(is_outlier_{p} AS INTEGER)" for p in PARAMETERS)
    + f" AS total_outliers FROM ({HOURLY_OUTLIERS})) ORDER BY total_outliers DESC, hour LIMIT 5",
)
def outliers_per_row(spark, sf):
    return series.outliers_per_row(flagged_hours(spark, sf), PARAMETERS, ["hour"])


@query(
    "outliers_per_column",
    "parameter:s total_outliers:i outlier_pct:f",
    " UNION ALL ".join(
        f"""SELECT '{p}' AS parameter, SUM(CAST(is_outlier_{p} AS INTEGER)) AS total_outliers,
        ROUND(SUM(CAST(is_outlier_{p} AS INTEGER)) * 100.0 / COUNT(*), 2) AS outlier_pct FROM ({HOURLY_OUTLIERS})"""
        for p in PARAMETERS
    ),
)
def outliers_per_column(spark, sf):
    return series.outliers_per_column(flagged_hours(spark, sf), PARAMETERS)


def sql_interpolate(c: str, next_value: str | None = None, fallback: str = "NULL") -> str:
    w = "PARTITION BY parameter ORDER BY datetime_iso, event_id ROWS BETWEEN"
    after = next_value or f"FIRST({c} IGNORE NULLS) OVER ({w} 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    before = f"LAST({c} IGNORE NULLS) OVER ({w} UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"COALESCE({c}, ({before} + {after}) / 2.0, {before}, {after}, {fallback}) AS {c}"


FILLED = "event_id:i parameter:s value:f level:f"
INTERPOLATED = f"SELECT event_id, parameter, {sql_interpolate('value')}, {sql_interpolate('level')} FROM {READINGS}"


@query("impute_interpolate", FILLED, INTERPOLATED)
def impute_interpolate(spark, sf):
    rows = st.frame(spark, sf, "readings")
    return impute.interpolate(rows, ["datetime_iso", "event_id"], ["value", "level"], ["parameter"])


@query("impute_interpolate_split", FILLED, INTERPOLATED)
def impute_interpolate_split(spark, sf):
    """The form for a series too long for one task."""
    rows = st.frame(spark, sf, "readings")
    return impute.interpolate(
        rows, ["datetime_iso", "event_id"], ["value", "level"], ["parameter"], layout=CUT
    )


def sql_emptied(c: str) -> str:
    return f"CASE WHEN parameter = 'view' THEN NULL ELSE {c} END AS {c}"


EMPTIED = f"(SELECT * REPLACE ({sql_emptied('value')}, {sql_emptied('level')}) FROM {READINGS})"


def emptied(spark, sf):
    """One series without any value."""
    empty = {c: F.when(col("parameter") != "view", col(c)) for c in ("value", "level")}
    return st.frame(spark, sf, "readings").withColumns(empty)


@query(
    "impute_interpolate_zero",
    FILLED,
    f"""SELECT event_id, parameter, {sql_interpolate('value', fallback='0')}, {sql_interpolate('level', fallback='0')}
    FROM {EMPTIED}""",
)
def impute_interpolate_zero(spark, sf):
    return impute.interpolate(emptied(spark, sf), ["datetime_iso", "event_id"], ["value", "level"], ["parameter"], fallback=0)


def series_end(c: str) -> str:
    return (
        f"FIRST({c} IGNORE NULLS) OVER (PARTITION BY parameter ORDER BY datetime_iso DESC, event_id DESC "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    )


@query(
    "impute_series_end",
    FILLED,
    f"""SELECT event_id, parameter, {sql_interpolate('value', series_end('value'), '0')},
    {sql_interpolate('level', series_end('level'), '0')} FROM {EMPTIED}""",
)
def impute_series_end(spark, sf):
    return impute.interpolate(
        emptied(spark, sf),
        ["datetime_iso", "event_id"],
        ["value", "level"],
        ["parameter"],
        fallback=0,
        next_anchor="series_end",
    )


MODE_COLUMNS = ["vict_sex", "premis_desc", "location", "cross_street", "crm_cd"]


def sql_mode(c: str, where: str = "TRUE") -> str:
    return f"""COALESCE({c}, (SELECT COALESCE({c}, 'unknown') FROM {ACC} i WHERE {where} GROUP BY {c}
      ORDER BY COUNT(*) DESC, {c} NULLS LAST LIMIT 1)) AS {c}"""


@query(
    "impute_mode",
    "dr_no:s " + " ".join(f"{c}:s" for c in MODE_COLUMNS),
    f"SELECT dr_no, {', '.join(sql_mode(c) for c in MODE_COLUMNS)} FROM {ACC} o",
)
def impute_mode(spark, sf):
    return impute.impute_mode(st.frame(spark, sf, "accidents"), MODE_COLUMNS)


def sql_group_modes(columns: list[str], by: str, source: str) -> str:
    """Per group and column the first level by count; joined back on the group."""
    tables = []
    for c in columns:
        tables.append(
            f"""(SELECT {by}, COALESCE({c}, 'unknown') AS mode_{c} FROM (SELECT {by}, {c}, ROW_NUMBER() OVER
            (PARTITION BY {by} ORDER BY COUNT(*) DESC, {c} NULLS LAST) AS rank FROM {source} GROUP BY {by}, {c}) WHERE rank = 1) m_{c}"""
        )
    joins = " ".join(f"JOIN {t} USING ({by})" for t in tables)
    fills = ", ".join(f"COALESCE(s.{c}, mode_{c}) AS {c}" for c in columns)
    return f"SELECT s.* REPLACE ({fills}) FROM {source} s {joins}"


@query(
    "impute_mode_by_area",
    "dr_no:s area_name:s " + " ".join(f"{c}:s" for c in MODE_COLUMNS),
    sql_group_modes(MODE_COLUMNS, "area_name", ACC),
)
def impute_mode_by_area(spark, sf):
    return impute.impute_mode(st.frame(spark, sf, "accidents"), MODE_COLUMNS, by=["area_name"])


@query(
    "impute_median",
    FILLED,
    f"""SELECT event_id, parameter, COALESCE(value, (SELECT quantile_disc(value, 0.5) FROM {READINGS})) AS value,
    COALESCE(level, (SELECT quantile_disc(level, 0.5) FROM {READINGS})) AS level FROM {READINGS}""",
)
def impute_median(spark, sf):
    return impute.impute_numeric(st.frame(spark, sf, "readings"), ["value", "level"])


@query(
    "impute_mean",
    FILLED,
    f"""SELECT event_id, parameter, COALESCE(value, (SELECT AVG(value) FROM {READINGS})) AS value,
    COALESCE(level, (SELECT AVG(level) FROM {READINGS})) AS level FROM {READINGS}""",
)
def impute_mean(spark, sf):
    return impute.impute_numeric(st.frame(spark, sf, "readings"), ["value", "level"], "mean")


@query(
    "impute_group_mean",
    FILLED,
    f"""SELECT event_id, parameter, COALESCE(value, AVG(value) OVER (PARTITION BY parameter)) AS value,
    COALESCE(level, AVG(level) OVER (PARTITION BY parameter)) AS level FROM {EMPTIED}""",
)
def impute_group_mean(spark, sf):
    return impute.impute_group_mean(emptied(spark, sf), ["value", "level"], ["parameter"])


@query(
    "daily_rollup",
    "parameter:s datetime_iso:d raw:f level:f hourly_readings:i",
    f"""SELECT parameter, CAST(datetime_iso AS DATE) AS datetime_iso, ROUND(AVG(raw), 4) AS raw,
    ROUND(AVG(level), 4) AS level, COUNT(datetime_iso) AS hourly_readings FROM {READINGS} GROUP BY 1, 2""",
)
def daily_rollup(spark, sf):
    return series.daily_rollup(st.frame(spark, sf, "readings"), "datetime_iso", ["raw", "level"], ["parameter"])


@query(
    "latest_n",
    "event_id:i parameter:s raw:f",
    f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY parameter ORDER BY datetime_iso DESC, event_id) AS rank
    FROM {READINGS}) WHERE rank <= 730""",
)
def latest_n(spark, sf):
    return ordered.latest(st.frame(spark, sf, "readings"), 730, "datetime_iso", ["parameter"], ["event_id"])


@query(
    "latest_n_overall",
    "event_id:i parameter:s raw:f",
    f"SELECT * FROM {READINGS} ORDER BY datetime_iso DESC, event_id LIMIT 730",
)
def latest_n_overall(spark, sf):
    return ordered.latest(st.frame(spark, sf, "readings"), 730, "datetime_iso", tie_break=["event_id"])


@query(
    "latest_n_many",
    "event_id:i parameter:s raw:f",
    f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY parameter ORDER BY datetime_iso DESC, event_id) AS rank
    FROM {READINGS}) WHERE rank <= 1500""",
)
def latest_n_many(spark, sf):
    """More rows per series than Spark limits on the map side by itself."""
    return ordered.latest(st.frame(spark, sf, "readings"), 1500, "datetime_iso", ["parameter"], ["event_id"])


@query(
    "rank_levels",
    "level:s n:i rank:i",
    f"""SELECT location AS level, COUNT(*) AS n, DENSE_RANK() OVER (ORDER BY COUNT(*) DESC) AS rank FROM {ACC} GROUP BY location""",
)
def rank_levels(spark, sf):
    return impute.rank_levels(st.frame(spark, sf, "accidents"), "location")


SPLIT = f"""SELECT dr_no, area_name, CASE WHEN position <= train THEN 'train'
    WHEN position <= train + FLOOR(total * 0.15) THEN 'validation' END AS part FROM (
      SELECT *, FLOOR(total * 0.85) AS train FROM (SELECT dr_no, area_name,
        ROW_NUMBER() OVER (PARTITION BY area_name ORDER BY date_occ, CAST(dr_no AS BIGINT)) AS position,
        CAST(COUNT(*) OVER (PARTITION BY area_name) AS DOUBLE) AS total FROM {ACC}))"""


def numbered(spark, sf):
    return st.frame(spark, sf, "accidents").withColumn("number", col("dr_no").cast("bigint"))


@query("chrono_split", "dr_no:s area_name:s part:s", SPLIT)
def chrono_split(spark, sf):
    return ordered.chronological_split(numbered(spark, sf), "date_occ", ["number"], ["area_name"])


@query("chrono_split_split", "dr_no:s area_name:s part:s", SPLIT)
def chrono_split_split(spark, sf):
    """The form for a series too long for one task."""
    return ordered.chronological_split(numbered(spark, sf), "date_occ", ["number"], ["area_name"], layout=CUT)


@query(
    "chrono_split_whole",
    "dr_no:s part:s",
    SPLIT.replace("PARTITION BY area_name ", "").replace("OVER (PARTITION BY area_name)", "OVER ()"),
)
def chrono_split_whole(spark, sf):
    """One split point for the whole table."""
    return ordered.chronological_split(numbered(spark, sf), "date_occ", ["number"], layout=CUT)


@query(
    "row_positions",
    "event_id:i position:i",
    "SELECT event_id, ROW_NUMBER() OVER (ORDER BY value, event_id) AS position FROM events",
)
def row_positions(spark, sf):
    events = table(spark, sf, "events")
    return ordered.number_rows(events, ["value", "event_id"], layout=CUT)
