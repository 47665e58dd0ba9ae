"""Profiles and quality metrics, each as one aggregation in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.columns import all_of, col, join_null_safe, numeric_columns, rows_from


def _rows() -> Column:
    return F.count(F.lit(1)).alias("n")


def nulls(name: str) -> Column:
    """Number of NULLs of a column, from plain counts.

    Not ``count_if(isNull)``: after a filter on NULLs the optimiser would restate the filter
    once per combination of the columns it names.
    """
    return F.count(F.lit(1)) - F.count(col(name))


def profile(df: DataFrame, columns: Sequence[str] | None = None, distinct: str = "exact") -> DataFrame:
    """Per column: rows, non-NULL count, distinct values (NULL is one), and numeric moments.

    ``distinct="exact"`` counts as the data demands and therefore shuffles the distinct
    values of each column; ``"approx"`` (HyperLogLog) and ``"none"`` stay in one pass
    without a shuffle of values, for tables where exact counts are not worth their price.
    """
    names = list(df.columns if columns is None else columns)
    numeric = set(numeric_columns(df))
    counters = {
        "exact": lambda c: F.countDistinct(col(c)),
        "approx": lambda c: F.approx_count_distinct(col(c)),
        "none": lambda c: F.lit(None).cast("long"),
    }
    if distinct not in counters:
        raise ValueError(f"distinct must be one of {sorted(counters)}")
    aggregates = [_rows()]
    for i, c in enumerate(names):
        aggregates.append(F.count(col(c)).alias(f"c_{i}"))
        if distinct != "none":
            aggregates.append(counters[distinct](c).alias(f"d_{i}"))
        if c in numeric:
            value = col(c).cast("double")
            aggregates += [
                F.avg(value).alias(f"avg_{i}"),
                F.stddev_samp(value).alias(f"std_{i}"),
                F.min(value).alias(f"min_{i}"),
                F.max(value).alias(f"max_{i}"),
            ]

    def moment(kind: str, i: int, c: str) -> Column:
        return F.col(f"{kind}_{i}") if c in numeric else F.lit(None).cast("double")

    def distinct_values(i: int) -> Column:
        if distinct == "none":
            return F.lit(None).cast("long")
        return F.col(f"d_{i}") + F.when(F.col(f"c_{i}") < F.col("n"), 1).otherwise(0)

    return rows_from(
        df.agg(*aggregates),
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col("n").alias("rows"),
                F.col(f"c_{i}").alias("non_null"),
                distinct_values(i).alias("distinct_values"),
                moment("avg", i, c).alias("mean"),
                moment("std", i, c).alias("stddev"),
                moment("min", i, c).alias("min"),
                moment("max", i, c).alias("max"),
            )
            for i, c in enumerate(names)
        ],
    )


def column_completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, missing_ratio)``; no rows for an empty input."""
    names = list(df.columns if columns is None else columns)
    counted = df.agg(_rows(), *[nulls(c).alias(f"m_{i}") for i, c in enumerate(names)])
    return rows_from(
        counted.filter(F.col("n") > 0),
        [
            F.struct(F.lit(c).alias("column"), (F.col(f"m_{i}") / F.col("n")).alias("missing_ratio"))
            for i, c in enumerate(names)
        ],
    )


def relation_completeness(df: DataFrame) -> DataFrame:
    """One row: the share of rows without a NULL, 0.0 for an empty input."""
    complete = all_of(col(c).isNotNull() for c in df.columns) if df.columns else F.lit(False)
    return df.agg(F.coalesce(F.avg(complete.cast("double")), F.lit(0.0)).alias("completeness"))


def timeliness_score(ts: Column, as_of: Column, update_rate: float) -> Column:
    """1 / (1 + age in days * update rate); the age never is exactly zero."""
    age = F.datediff(as_of, ts) + F.lit(1e-9)
    return F.lit(1.0) / (F.lit(1.0) + age * F.lit(float(update_rate)))


def timeliness(
    df: DataFrame,
    ts: str,
    as_of: Column,
    update_rate: float = 12,
    columns: Sequence[str] | None = None,
    non_null_only: bool = False,
) -> DataFrame:
    """``(attribute, timeliness)`` for every attribute but the time column.

    All attributes of a row share its age, so they score alike unless ``non_null_only``
    restricts each attribute to the rows where it has a value.
    """
    names = [c for c in (df.columns if columns is None else columns) if c != ts]
    score = timeliness_score(col(ts), as_of, update_rate)
    if non_null_only:
        scored = df.agg(*[F.avg(F.when(col(c).isNotNull(), score)).alias(f"s_{i}") for i, c in enumerate(names)])
    else:
        scored = df.agg(F.avg(score).alias("s")).select(*[F.col("s").alias(f"s_{i}") for i in range(len(names))])
    return rows_from(
        scored, [F.struct(F.lit(c).alias("attribute"), F.col(f"s_{i}").alias("timeliness")) for i, c in enumerate(names)]
    )


def relation_timeliness(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("timeliness").alias("timeliness"))


def redundancy(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and rows per key.

    The inner aggregation combines copies on the map side, so a heavily repeated key
    sends one row per task.
    """
    groups = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    counted = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys"))
    return counted.withColumn("redundancy", F.try_divide(F.col("rows"), F.col("keys")))


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, value)`` of the columns with one level, NULL being a level.

    Minimum, maximum and NULL count decide this, so no distinct count is needed.
    """
    names = list(df.columns if columns is None else columns)
    counted = df.agg(
        _rows(),
        *[F.count(col(c)).alias(f"c_{i}") for i, c in enumerate(names)],
        *[F.min(col(c)).alias(f"lo_{i}") for i, c in enumerate(names)],
        *[F.max(col(c)).alias(f"hi_{i}") for i, c in enumerate(names)],
    )
    levels = rows_from(
        counted,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"lo_{i}").cast("string").alias("value"),
                (
                    ((F.col(f"c_{i}") == 0) & (F.col("n") > 0))
                    | ((F.col(f"c_{i}") == F.col("n")) & (F.col(f"lo_{i}") == F.col(f"hi_{i}")))
                ).alias("constant"),
            )
            for i, c in enumerate(names)
        ],
    )
    return levels.filter("constant").drop("constant")


def missing_dates(df: DataFrame, date: str, series: Sequence[str] = ()) -> DataFrame:
    """Calendar days between the first and last day (of each series) that have no row."""
    keys = [col(s) for s in series]
    days = df.select(*keys, F.to_date(col(date)).alias("missing_date")).distinct()
    span = days.groupBy(*keys).agg(F.min("missing_date").alias("lo"), F.max("missing_date").alias("hi"))
    calendar = span.filter("lo IS NOT NULL").select(*keys, F.explode(F.sequence("lo", "hi")).alias("missing_date"))
    return join_null_safe(calendar, days, [*series, "missing_date"], "left_anti")


def date_gaps(df: DataFrame, date: str, series: Sequence[str] = ()) -> DataFrame:
    """Missing calendar days as intervals: (series, ``first_missing``, ``last_missing``, ``days``).

    Each present day is compared with the next one, so a gap of any length is one row and no
    calendar is made. The window runs over distinct days only, at most one row per day of a series.
    """
    keys = [col(s) for s in series]
    days = df.select(*keys, F.to_date(col(date)).alias("__day")).where("__day IS NOT NULL").distinct()
    following = F.lead("__day").over(Window.partitionBy(*keys).orderBy("__day"))
    missing = F.datediff("__next", "__day") - 1
    return days.withColumn("__next", following).where(missing > 0).select(
        *keys,
        F.date_add("__day", 1).alias("first_missing"),
        F.date_sub("__next", 1).alias("last_missing"),
        missing.cast("long").alias("days"),
    )


def expand_gaps(gaps: DataFrame) -> DataFrame:
    """One row per missing day of ``date_gaps``, as ``missing_dates`` gives them."""
    kept = [col(c) for c in gaps.columns if c not in ("first_missing", "last_missing", "days")]
    return gaps.select(*kept, F.explode(F.sequence("first_missing", "last_missing")).alias("missing_date"))


def date_coverage(df: DataFrame, date: str, series: Sequence[str] = ()) -> DataFrame:
    """First and last day, days expected, present and missing, and whether none is missing."""
    keys = [col(s) for s in series]
    days = df.select(*keys, F.to_date(col(date)).alias("day")).distinct()
    spans = days.groupBy(*keys).agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("day").alias("present")
    )
    expected = F.datediff("last_day", "first_day") + 1
    return spans.withColumns(
        {
            "expected": expected.cast("long"),
            "missing": (expected - F.col("present")).cast("long"),
            "is_complete": expected == F.col("present"),
        }
    )


def removal_report(before: DataFrame, steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``(step, rows, removed)`` for a chain of row-removing steps."""
    names = ["input", *[name for name, _ in steps]]
    counts = [frame.agg(_rows()).scalar() for frame in (before, *[frame for _, frame in steps])]
    one = before.sparkSession.range(1).select(*[c.alias(f"n_{i}") for i, c in enumerate(counts)])
    return rows_from(
        one,
        [
            F.struct(
                F.lit(name).alias("step"),
                F.col(f"n_{i}").alias("rows"),
                (F.col(f"n_{max(i - 1, 0)}") - F.col(f"n_{i}")).alias("removed"),
            )
            for i, name in enumerate(names)
        ],
    )
