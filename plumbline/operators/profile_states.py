"""Profiles that merge: the state of each landed period is kept, old rows are not read again.

A state holds, per period and column, the rows, non-NULL values, mean and squared deviations,
bounds, a HyperLogLog sketch of the distinct values and a KLL sketch of the quantiles, and
for the time column the days seen. States of any periods merge into the profile of all their
rows: counts, means, deviations, bounds and days exactly, distinct values and quantiles
within the error of the sketches. A period that lands again replaces its state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.columns import col, numeric_columns, rows_from
from plumbline.operators.profile import nulls

#: Buckets of a distinct sketch, as a power of two (relative error about 1.04 / sqrt(2**12) = 1.6 %),
#: and size of a quantile sketch (rank error about 0.4 % each way at 800).
DISTINCT_BITS = 12
QUANTILE_SIZE = 800
STATE = (
    "period string, `column` string, rows long, non_null long, mean double, deviations double, min double, max double,"
    " distinct_sketch binary, quantile_sketch binary, days array<date>"
)


def profile_states(df: DataFrame, period: Column, ts: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per period and column, from one aggregation; sketches are built on the map side.

    ``period`` names the landed portion of a row, such as its week, and must not be NULL.
    The days of ``ts`` are kept as a set: at most as many as a period has days.
    """
    names = list(df.columns if columns is None else columns)
    numeric = set(numeric_columns(df))
    aggregates = [F.count(F.lit(1)).alias("n")]
    if ts is not None:
        aggregates.append(F.array_sort(F.collect_set(F.to_date(col(ts)))).alias("days"))
    for i, c in enumerate(names):
        hashed = F.when(col(c).isNotNull(), F.xxhash64(col(c)))
        aggregates += [nulls(c).alias(f"m_{i}"), F.hll_sketch_agg(hashed, DISTINCT_BITS).alias(f"hll_{i}")]
        if c in numeric:
            value = col(c).cast("double")
            aggregates += [
                F.avg(value).alias(f"avg_{i}"),
                (F.var_pop(value) * F.count(value)).alias(f"dev_{i}"),
                F.min(value).alias(f"min_{i}"),
                F.max(value).alias(f"max_{i}"),
                F.kll_sketch_agg_double(value, QUANTILE_SIZE).alias(f"kll_{i}"),
            ]

    def number(kind: str, i: int, c: str, cast: str = "double") -> Column:
        return F.col(f"{kind}_{i}") if c in numeric else F.lit(None).cast(cast)

    return rows_from(
        df.groupBy(period.cast("string").alias("period")).agg(*aggregates),
        [
            F.struct(
                F.col("period"),
                F.lit(c).alias("column"),
                F.col("n").alias("rows"),
                (F.col("n") - F.col(f"m_{i}")).alias("non_null"),
                number("avg", i, c).alias("mean"),
                number("dev", i, c).alias("deviations"),
                number("min", i, c).alias("min"),
                number("max", i, c).alias("max"),
                F.col(f"hll_{i}").alias("distinct_sketch"),
                number("kll", i, c, "binary").alias("quantile_sketch"),
                (F.col("days") if c == ts else F.lit(None)).cast("array<date>").alias("days"),
            )
            for i, c in enumerate(names)
        ],
    )


def keep_states(states: DataFrame, path: str) -> None:
    """Write the states of some periods at ``path``; a period that is there already is replaced."""
    writer = states.write.mode("overwrite").partitionBy("period").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_states(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The kept states, of the periods within [first, last]; other periods are not listed."""
    states = spark.read.schema(STATE).parquet(path)
    if first is not None:
        states = states.where(F.col("period") >= first)
    return states if last is None else states.where(F.col("period") <= last)


def merge_states(states: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profile of all rows behind ``states``: one row per column.

    rows, non_null, missing_ratio, mean, stddev (of the sample), min and max are exact;
    distinct_values (NULL is one) and quantiles, one per share, come from the sketches.
    """
    present = F.when(F.col("non_null") > 0, F.struct("non_null", "mean", "deviations"))
    merged = states.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("non_null").alias("non_null"),
        F.collect_list(present).alias("parts"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("estimate"),
        F.kll_merge_agg_double(F.when(F.col("non_null") > 0, F.col("quantile_sketch"))).alias("quantile_sketch"),
    )

    def total(value) -> Column:
        return F.aggregate("parts", F.lit(0.0), lambda sum_, part: sum_ + value(part))

    merged = merged.withColumn("mean", F.try_divide(total(lambda p: p["non_null"] * p["mean"]), F.col("non_null")))
    spread = total(lambda p: p["deviations"] + p["non_null"] * F.pow(p["mean"] - F.col("mean"), F.lit(2)))
    quantile = [F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(s))) for s in shares]
    return merged.select(
        "column",
        "rows",
        "non_null",
        (1 - F.try_divide("non_null", "rows")).alias("missing_ratio"),
        "mean",
        F.when(F.col("non_null") > 1, F.sqrt(spread / (F.col("non_null") - 1))).alias("stddev"),
        "min",
        "max",
        (F.col("estimate") + F.when(F.col("non_null") < F.col("rows"), 1).otherwise(0)).alias("distinct_values"),
        F.when((F.col("non_null") > 0) & F.col("mean").isNotNull(), F.array(*quantile)).alias("quantiles"),
    )


def days_of_states(states: DataFrame, ts: str) -> DataFrame:
    """One row per day seen in the time column: the input of ``missing_dates`` and ``date_coverage``."""
    return states.where(F.col("column") == ts).select(F.explode("days").alias("day")).distinct()


def rollup_states(df: DataFrame, period: Column, ts: str, columns: Sequence[str], series: Sequence[str] = ()) -> DataFrame:
    """(period, series, day, rows, totals): sums and counts per day, in a form that merges.

    ``totals`` holds a struct (sum, n) per column, in their order.
    """
    totals = F.array(*[F.struct(F.sum(col(c).cast("double")).alias("sum"), F.count(col(c)).alias("n")) for c in columns])
    keys = [period.cast("string").alias("period"), *[col(s) for s in series], F.to_date(col(ts)).alias("day")]
    return df.groupBy(*keys).agg(F.count(col(ts)).alias("rows"), totals.alias("totals"))


def merge_rollups(
    states: DataFrame, columns: Sequence[str], series: Sequence[str] = (), *, ts: str = "datetime_iso", digits: int = 4,
    counter: str = "hourly_readings",
) -> DataFrame:
    """The daily rollup of all rows behind the states; a day that landed in parts is one day."""
    sums = [F.sum(F.col("totals")[i]["sum"]) for i in range(len(columns))]
    counts = [F.sum(F.col("totals")[i]["n"]) for i in range(len(columns))]
    return states.groupBy(*[col(s) for s in series], col("day").alias(ts)).agg(
        *[F.round(F.try_divide(s, n), digits).alias(c) for s, n, c in zip(sums, counts, columns)], F.sum("rows").alias(counter)
    )
