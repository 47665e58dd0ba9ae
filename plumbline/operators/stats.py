"""Counts, rates, histograms, densities, correlations and model reports."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.columns import col, join_few
from plumbline.functions.calendar import month_name, week_ending_monday, weekday_name

# Bins of the temperature and error histograms, and points of the density grid.
TEMPERATURE_BINS = 20
ERROR_BINS = 30
GRID_POINTS = 100

#: Rows of a batch that meet the density grid at a time.
ROWS_AT_ONCE = 20_000
#: Most columns of a confusion matrix whose classes are found in the data.
MOST_CLASSES = 1_000


def weekly_counts(df: DataFrame, ts: str, group: str, fill_gaps: bool = False) -> DataFrame:
    """``(week, group, n)``: rows per week ending Monday, zero where a group has none.

    Weeks without any row are absent unless ``fill_gaps``. Rows without a week or a group
    count nowhere. Everything after the first aggregation works on one row per (week, group).
    """
    counted = df.where(col(ts).isNotNull() & col(group).isNotNull()).groupBy(week_ending_monday(col(ts)).alias("week"), col(group).alias(group)).agg(
        F.count(F.lit(1)).alias("n")
    )
    span = counted.agg(F.struct(F.min("week").alias("lo"), F.max("week").alias("hi"))).scalar()
    # The weeks are bounded by the calendar; the groups are never gathered.
    weeks = F.sequence(span["lo"], span["hi"], F.expr("interval 7 days")) if fill_gaps else counted.agg(F.collect_set("week")).scalar()
    frame = counted.select(col(group)).distinct().select(F.explode(weeks).alias("week"), col(group))
    return frame.join(counted, ["week", group], "left").select("week", group, F.coalesce("n", F.lit(0)).alias("n"))


def month_weekday_mean(df: DataFrame, ts: str) -> DataFrame:
    """Mean over the years of the yearly row count per (month, weekday)."""
    when = col(ts)
    yearly = df.groupBy(
        F.month(when).alias("month_no"),
        month_name(when).alias("month"),
        F.weekday(when).alias("day_no"),
        weekday_name(when).alias("day"),
        F.year(when).alias("year"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return yearly.groupBy("month_no", "month", "day_no", "day").agg(F.avg("n").alias("mean_yearly_count"))


def rate_per_day(df: DataFrame, flag: str, ts: str) -> DataFrame:
    """Rows, distinct days and rows per day for each value of ``flag``.

    Counting per (flag, day) first keeps the distinct count a plain count of groups.
    """
    daily = df.groupBy(col(flag).alias(flag), F.to_date(col(ts)).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    totals = daily.groupBy(col(flag)).agg(F.sum("n").alias("total"), F.count("day").alias("days"))
    return totals.withColumn("per_day", F.try_divide(F.col("total"), F.col("days")))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(col(column).alias(column)).agg(F.count(F.lit(1)).alias("n"))


def lump_rare_levels(df: DataFrame, column: str, more_than: int = 100, other: str = "secondary_st") -> DataFrame:
    """Keep levels with more than ``more_than`` rows, replace the rest by ``other``.

    The frequent levels come back by a join without a hint: adaptive execution broadcasts
    them when they are small and splits the partition of a hot level when they are not.
    """
    frequent = value_counts(df, column).filter(col("n") > more_than).select(col(column), F.lit(True).alias("__frequent"))
    joined = df.join(frequent, column, "left")
    kept = F.when(col("__frequent"), col(column)).otherwise(F.lit(other))
    return joined.withColumn(column, kept).drop("__frequent").select(*df.columns)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``(bin, lower, upper, n)`` of ``bins`` equal bins from minimum to maximum; NULLs are left out."""
    value = col(column).cast("double")
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, width = span.getField("lo"), (span.getField("hi") - span.getField("lo")) / F.lit(bins)
    place = F.when(width > 0, F.least(F.floor((value - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    placed = df.filter(col(column).isNotNull()).select(place.alias("bin"))
    counted = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).filter(lo.isNotNull())
    return frame.join(counted, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("lower"),
        (lo + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def density(df: DataFrame, column: str, points: int = GRID_POINTS) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum.

    The bandwidth is std * n ** (-1/5). A task sums the kernels of its batches over the
    grid, so what leaves it is one partial sum per grid point.
    """
    value = col(column).cast("double")
    shape = df.agg(
        F.struct(
            F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"), F.stddev_samp(value).alias("std")
        )
    ).scalar()
    lo, step = shape.getField("lo"), (shape.getField("hi") - shape.getField("lo")) / F.lit(points - 1)
    bandwidth = shape.getField("std") * F.pow(shape.getField("n").cast("double"), F.lit(-0.2))
    rows = df.filter(col(column).isNotNull()).select(value.alias("x"), lo.alias("lo"), step.alias("step"), bandwidth.alias("h"))

    def masses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            for start in range(0, len(frame), ROWS_AT_ONCE):
                part = frame.iloc[start : start + ROWS_AT_ONCE]
                grid = part["lo"].iloc[0] + np.arange(points) * part["step"].iloc[0]
                gap = (grid[None, :] - part["x"].to_numpy()[:, None]) / part["h"].iloc[0]
                mass = np.exp(-0.5 * gap * gap).sum(axis=0)
                total = mass if total is None else total + mass
        if total is not None:
            yield pd.DataFrame({"point": np.arange(points, dtype=np.int32), "mass": total})

    sums = rows.mapInPandas(masses, "point int, mass double").groupBy("point").agg(F.sum("mass").alias("mass"))
    scale = shape.getField("n") * bandwidth * F.lit(math.sqrt(2 * math.pi))
    return sums.select("point", (lo + F.col("point") * step).alias("x"), (F.col("mass") / scale).alias("density"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, corr)``: Pearson correlation of every pair over its complete rows, both triangles.

    A task sums the products of all pairs as one matrix product per batch, of columns
    shifted by their means so that the sums stay small; one row per pair leaves it. NaN
    counts as missing. Without two different values the correlation is NULL.
    """
    names = list(columns)
    means = df.agg(F.struct(*[F.avg(col(c)).alias(f"m_{i}") for i, c in enumerate(names)])).scalar()
    shifted = df.select(*[(col(c).cast("double") - means.getField(f"m_{i}")).alias(f"c_{i}") for i, c in enumerate(names)])
    left, right = np.triu_indices(len(names))

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((6, len(names), len(names)))
        for frame in frames:
            raw = frame.to_numpy(dtype=float)
            known = ~np.isnan(raw)
            x, has = np.where(known, raw, 0.0), known.astype(float)
            squares = x * x
            sums += [has.T @ has, x.T @ has, has.T @ x, squares.T @ has, has.T @ squares, x.T @ x]
        cells = {name: sums[i][left, right] for i, name in enumerate(("n", "x", "y", "xx", "yy", "xy"))}
        yield pd.DataFrame({"pair": np.arange(len(left), dtype=np.int32), **cells})

    parts = shifted.mapInPandas(products, "pair int, n double, x double, y double, xx double, yy double, xy double")
    total = parts.groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    spread = (F.col("n") * F.col("xx") - F.col("x") ** 2) * (F.col("n") * F.col("yy") - F.col("y") ** 2)
    found = total.select("pair", F.try_divide(F.col("n") * F.col("xy") - F.col("x") * F.col("y"), F.sqrt(spread)).alias("corr"))
    pairs = F.array(*[F.struct(F.lit(names[i]).alias("a"), F.lit(names[j]).alias("b")) for i, j in zip(left, right)])
    pair = F.get(pairs, F.col("pair"))
    both = F.array(
        F.struct(pair.getField("a").alias("a"), pair.getField("b").alias("b")),
        F.struct(pair.getField("b").alias("a"), pair.getField("a").alias("b")),
    )
    return found.select(F.inline(F.array_distinct(both)), "corr")


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population standard deviation; a constant column becomes 0."""
    row = df.agg(
        F.struct(
            *[F.avg(col(c)).alias(f"m_{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(col(c)).alias(f"s_{i}") for i, c in enumerate(columns)],
        )
    ).scalar()

    def scaled(i: int, c: str) -> Column:
        spread = row.getField(f"s_{i}")
        return (col(c) - row.getField(f"m_{i}")) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)

    return df.withColumns({c: scaled(i, c) for i, c in enumerate(columns)})


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """n, mse, rmse, mae and r2 (per group)."""
    error = col(label) - col(prediction)
    sums = df.groupBy(*[col(b) for b in by]).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(col(label)).alias("__variance"),
    )
    return sums.select(
        *by,
        "n",
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("__variance"))).alias("r2"),
    )


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(col(label).alias("label"), col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((col(label) == col(prediction)).cast("double")).alias("accuracy"))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(class, precision, recall, f1, support)``; a ratio without a base is 0."""
    counted = confusion_counts(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    roles = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")),
    )
    per_class = counted.select(F.inline(roles)).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    precision, recall = ratio(F.col("hits"), F.col("predicted")), ratio(F.col("hits"), F.col("support"))
    return per_class.select(
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(F.col("hits") * 2, F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence[str] | None = None) -> DataFrame:
    """One row per true class, NULL included, and one count column per predicted class.

    With given ``classes`` all other predictions are counted in a last column ``other``.
    Without, the classes found are the columns, at most ``MOST_CLASSES``.
    """
    counted = confusion_counts(df, label, prediction)
    names = classes
    if names is None:
        found = counted.select(F.explode(F.array("label", "prediction")).alias("c")).distinct().orderBy("c")
        names = [row[0] for row in found.limit(MOST_CLASSES + 1).collect()]
        if len(names) > MOST_CLASSES:
            raise ValueError(f"more than {MOST_CLASSES} classes")
    cells = [F.sum(F.when(F.col("prediction").eqNullSafe(c), F.col("n")).otherwise(0)).alias(str(c)) for c in names]
    if classes is not None:
        listed = F.coalesce(F.col("prediction").isin(*classes), F.lit(False))
        cells.append(F.sum(F.when(~listed, F.col("n")).otherwise(0)).alias("other"))
    return counted.groupBy("label").agg(*cells)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(class, n, weight)`` with the balanced weight n / (classes * n of the class)."""
    counted = value_counts(df.select(col(label).alias("class")), "class")
    whole = counted.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    return counted.withColumn("weight", whole.getField("n") / (whole.getField("k") * F.col("n")))


def add_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(col("class").alias(label), F.col("weight").alias(name))
    return join_few(df, weights, [label])


def save_results(results: Mapping[str, DataFrame], root: str, mode: str = "overwrite") -> dict[str, str]:
    """Write each analysis result below ``root`` as parquet and return the paths."""
    paths = {}
    for name, frame in results.items():
        paths[name] = f"{root.rstrip('/')}/{name}"
        frame.write.mode(mode).parquet(paths[name])
    return paths
