"""The given tables read as weather, air, energy and accident data.

Each stand-in is a projection of one given table, written in expressions that both engines
read alike, so that only the operator under test differs between the two sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.checks.registry import quoted, table

# One day of one station is many lineitem rows; see ``weather_daily``.
_WEATHER_SOURCE = {
    "station": "l_returnflag",
    "datetime_iso": "CAST(l_shipdate AS DATE)",
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "tax": "CAST(ROUND(l_tax * 100) AS BIGINT)",
}
_WEATHER_LONG = {
    "station": "l_returnflag",
    "day": "CAST(l_shipdate AS DATE)",
    "element": "CASE WHEN l_linenumber <= 2 THEN 'TMAX' WHEN l_linenumber <= 4 THEN 'TMIN' "
    "WHEN l_linenumber <= 6 THEN 'PRCP' ELSE 'SNOW' END",
    "data_value": "CAST(l_quantity AS BIGINT)",
    "order_key": "l_orderkey",
    "part_key": "l_partkey",
    "price": "l_extendedprice",
}
_GASES = {
    "order_key": "l_orderkey",
    "line": "l_linenumber",
    "station": "l_returnflag",
    "co": "CASE WHEN l_quantity > 48 THEN NULL ELSE l_quantity + 10 END",
    "no": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount * 150 - 1 END",
    "no2": "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_tax * 15 END",
    "nox": "CASE WHEN l_linenumber = 5 THEN NULL WHEN l_quantity > 40 THEN l_discount * 150 "
    "ELSE l_discount * 150 - 1 + l_tax * 15 END",
    "o3": "CASE WHEN l_linenumber = 4 THEN NULL ELSE l_discount * 3 END",
    "pm10": "CASE WHEN l_quantity < 3 THEN NULL ELSE l_quantity * 12 END",
    "pm25": "CASE WHEN l_linenumber >= 3 AND l_linenumber <= 6 THEN NULL ELSE l_quantity * l_linenumber END",
    "lat": "l_tax * 1200",
    "lon": "l_discount * 2000 - 50",
}
_READINGS = {
    "event_id": "event_id",
    "datetime_iso": "ts",
    "parameter": "event_type",
    "user_id": "user_id",
    "raw": "value",
    "value": "CASE WHEN value > 100 THEN NULL ELSE value END",
    "level": "CASE WHEN value > 100 THEN NULL ELSE CAST(FLOOR(value) AS BIGINT) END",
}
_ACCIDENTS = {
    "dr_no": "CAST(o_orderkey AS STRING)",
    "date_rptd": "CAST(o_orderdate AS DATE) + CAST(o_custkey % 12 - 1 AS INT)",
    "date_occ": "CAST(o_orderdate AS DATE)",
    "time_occ": "LPAD(CAST((o_custkey * 37 + o_orderkey) % 2500 AS STRING), 4, '0')",
    "area": "CAST(o_custkey % 24 AS STRING)",
    "area_name": "o_orderstatus",
    "rpt_dist_no": "CAST(o_custkey % 300 AS STRING)",
    "crm_cd": "CASE WHEN o_custkey % 11 = 0 THEN 'n/a' ELSE CAST(o_custkey % 1100 AS STRING) END",
    "crm_cd_desc": "'TRAFFIC COLLISION'",
    "mocodes": "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE "
    "CONCAT(LPAD(CAST(3001 + o_custkey % 45 AS STRING), 4, '0'), '  ', "
    "LPAD(CAST(3020 + o_orderkey % 21 AS STRING), 4, '0'), ' ', LPAD(CAST(3100 + o_custkey % 6 AS STRING), 4, '0'), "
    "' ', LPAD(CAST(600 + o_orderkey % 8 AS STRING), 4, '0'), ' ', LPAD(CAST(3024 + o_orderkey % 5 AS STRING), 4, '0')) END",
    "vict_age": "CAST(o_custkey % 131 - 5 AS INT)",
    "vict_sex": "CASE o_orderpriority WHEN '1-URGENT' THEN 'M' WHEN '2-HIGH' THEN 'F' WHEN '3-MEDIUM' THEN 'X' "
    "WHEN '5-LOW' THEN 'H' ELSE NULL END",
    "vict_descent": "CHR(CAST(65 + o_custkey % 26 AS INT))",
    "premis_cd": "CAST(99 + o_custkey % 11 AS STRING)",
    "premis_desc": "CASE WHEN o_custkey % 3 = 0 THEN 'STREET' WHEN o_custkey % 3 = 1 THEN 'PARKING LOT' ELSE NULL END",
    "location": "CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE CONCAT('ST ', CAST(FLOOR(SQRT(o_custkey)) AS INT)) END",
    "cross_street": "CASE WHEN o_totalprice < 60000 THEN NULL ELSE CONCAT('AV ', CAST(o_custkey % 50 AS STRING)) END",
    "latitude": "33.0 + FLOOR(o_totalprice / 300) / 1000",
    "longitude": "-117.4 - FLOOR(o_totalprice / 300) / 1000",
}

ROW_LEVEL = {
    "weather_source": ("lineitem", _WEATHER_SOURCE),
    "weather_long": ("lineitem", _WEATHER_LONG),
    "gases": ("lineitem", _GASES),
    "readings": ("events", _READINGS),
    "accidents": ("orders", _ACCIDENTS),
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, expressions = ROW_LEVEL[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} AS {c}" for c, e in expressions.items()])


def select(name: str) -> str:
    """The stand-in as a SQL subquery."""
    source, expressions = ROW_LEVEL[name]
    listed = ", ".join(f"{e} AS {quoted(c)}" for c, e in expressions.items())
    return f"(SELECT {listed} FROM {source})"


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per station and day: TMAX, TMIN and PRCP."""
    return (
        frame(spark, sf_dir, "weather_source")
        .groupBy("station", "datetime_iso")
        .agg(
            (F.max("quantity") * 1.3).alias("TMAX"),
            (F.min("price") / 1000).alias("TMIN"),
            (F.avg("tax") - 3).alias("PRCP"),
        )
    )


WEATHER_DAILY = f"""(SELECT station, datetime_iso, MAX(quantity) * 1.3 AS "TMAX", MIN(price) / 1000 AS "TMIN",
  AVG(tax) - 3 AS "PRCP" FROM {select("weather_source")} GROUP BY 1, 2)"""


def energy_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day: the summed order value as demand."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.to_date("o_orderdate").alias("datetime_iso")).agg(F.sum("o_totalprice").alias("value"))


ENERGY_DAILY = """(SELECT CAST(o_orderdate AS DATE) AS datetime_iso, SUM(o_totalprice) AS value
  FROM orders GROUP BY 1)"""


def air_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per station and day with daily means of the gases, in whole hundredths."""
    tax, discount = F.round(F.col("l_tax") * 100).cast("bigint"), F.round(F.col("l_discount") * 100).cast("bigint")
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_returnflag").alias("station"), F.to_date("l_shipdate").alias("datetime_iso")).agg(
        F.avg(F.when(F.col("l_linenumber") <= 2, F.col("l_quantity"))).alias("co"),
        F.avg(F.when(F.col("l_linenumber") == 3, tax)).alias("no2"),
        F.avg(discount).alias("o3"),
        F.avg("l_quantity").alias("pm25"),
        F.avg(F.when(F.col("l_linenumber") >= 5, tax)).alias("so2"),
    )


AIR_DAILY = """(SELECT l_returnflag AS station, CAST(l_shipdate AS DATE) AS datetime_iso,
  AVG(CASE WHEN l_linenumber <= 2 THEN l_quantity END) AS co,
  AVG(CASE WHEN l_linenumber = 3 THEN CAST(ROUND(l_tax * 100) AS BIGINT) END) AS no2,
  AVG(CAST(ROUND(l_discount * 100) AS BIGINT)) AS o3, AVG(l_quantity) AS pm25,
  AVG(CASE WHEN l_linenumber >= 5 THEN CAST(ROUND(l_tax * 100) AS BIGINT) END) AS so2
  FROM lineitem GROUP BY 1, 2)"""
