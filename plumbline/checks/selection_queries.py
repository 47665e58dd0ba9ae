"""Exact ranks, quantiles and cuts by narrowing histograms."""

from __future__ import annotations

from plumbline.checks import standins as st
from plumbline.checks.registry import query, table
from plumbline.checks.series_queries import FILLED, READINGS, SPLIT, numbered
from plumbline.operators import impute, selection
from plumbline.columns import col
from pyspark.sql import functions as F

SHARES = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


@query(
    "select_quantiles",
    "station:s column:s share:f value:f",
    " UNION ALL ".join(
        f"""SELECT station, '{c}' AS "column", {s} AS share, quantile_disc({c}, {s}) AS value FROM {st.select("gases")} GROUP BY 1
        HAVING count({c}) > 0"""
        for c in ("co", "no2", "o3", "pm25", "lat")
        for s in SHARES
    ),
)
def select_quantiles(spark, sf):
    """Quantiles of five gases at each station, in one set of passes."""
    return selection.quantiles(st.frame(spark, sf, "gases"), ["co", "no2", "o3", "pm25", "lat"], SHARES, ["station"])


@query(
    "select_ranks",
    "o_orderstatus:s rank:i o_orderkey:i",
    """SELECT o_orderstatus, position AS rank, o_orderkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderstatus
    ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS position FROM orders) WHERE position IN (1, 100, 2500)""",
)
def select_ranks(spark, sf):
    """The 1st, 100th and 2,500th order of each status by text, a falling number and the key."""
    orders = table(spark, sf, "orders").withColumn("falling", -col("o_totalprice"))
    targets = orders.select("o_orderstatus").distinct().select(
        "o_orderstatus", F.explode(F.array(F.lit(1), F.lit(100), F.lit(2500))).alias("__which"), col("__which").cast("long").alias("__rank")
    )
    found = selection.kth_rows(orders, targets, ["o_orderpriority", "falling", "o_orderkey"], ["o_orderstatus"])
    priority, falling = col("__k0") == col("o_orderpriority"), col("__k1") == col("falling")
    joined = orders.withColumnRenamed("o_orderstatus", "status").join(F.broadcast(found), (col("status") == col("o_orderstatus")) & priority & falling)
    return joined.select("o_orderstatus", col("__which").alias("rank"), "o_orderkey")


@query("chrono_cut", "dr_no:s area_name:s part:s", SPLIT)
def chrono_cut(spark, sf):
    """The chronological split by two selected rows per area."""
    return selection.chronological_cut(numbered(spark, sf), "date_occ", ["number"], ["area_name"])


@query(
    "chrono_cut_whole",
    "dr_no:s part:s",
    SPLIT.replace("PARTITION BY area_name ", "").replace("OVER (PARTITION BY area_name)", "OVER ()"),
)
def chrono_cut_whole(spark, sf):
    """The same for the table as one series."""
    return selection.chronological_cut(numbered(spark, sf), "date_occ", ["number"])


@query(
    "impute_median_by_parameter",
    FILLED,
    f"""SELECT event_id, r.parameter, COALESCE(value, m) AS value, COALESCE(level, n) AS level FROM {READINGS} r JOIN
    (SELECT parameter, quantile_disc(value, 0.5) AS m, quantile_disc(level, 0.5) AS n FROM {READINGS} GROUP BY 1) g USING (parameter)""",
)
def impute_median_by_parameter(spark, sf):
    return impute.impute_numeric(st.frame(spark, sf, "readings"), ["value", "level"], by=["parameter"])
