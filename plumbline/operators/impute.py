"""Imputation of missing values.

Fill values that hold for the whole table are scalar subqueries: the frame stays lazy,
and the value reaches the tasks as a literal instead of through a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from plumbline.columns import col, join_few, join_null_safe, numeric_columns, string_columns, total_order
from plumbline.functions.categories import UNKNOWN
from plumbline.operators.ordered import Layout, neighbours
from plumbline.operators.selection import medians


def interpolate(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str] | None = None,
    series: Sequence[str] = (),
    *,
    fallback: float | None = None,
    next_anchor: str = "nearest",
    layout: Layout | None = None,
) -> DataFrame:
    """Fill NULLs by the mean of the previous and the next non-NULL value.

    The mean is unweighted however long the gap is. At the ends of a series the one
    existing neighbour is used, and ``fallback`` when the series has no value at all.
    ``next_anchor="series_end"`` takes the last non-NULL value of the whole series in place
    of the next one. Filled columns are doubles. Other columns break ties of ``order``.
    """
    if next_anchor not in ("nearest", "series_end"):
        raise ValueError("next_anchor must be 'nearest' or 'series_end'")
    names = numeric_columns(df, exclude=[*order, *series]) if columns is None else list(columns)
    if not names:
        return df
    near = neighbours(df, names, order, series, layout=layout)
    following = {c: col(f"__next_{c}") for c in names}
    extra = []
    if next_anchor == "series_end":
        position = F.struct(*[col(o) for o in total_order(df, order, series)])
        ends = df.groupBy(*[col(s) for s in series]).agg(
            *[F.max_by(col(c), F.when(col(c).isNotNull(), position)).alias(f"__end_{i}") for i, c in enumerate(names)]
        )
        extra = [f"__end_{i}" for i in range(len(names))]
        if series:
            near = join_few(near, ends, series)
        else:
            row = ends.select(F.struct(*extra)).scalar()
            near = near.withColumns({e: row.getField(e) for e in extra})
        following = {c: col(f"__end_{i}") for i, c in enumerate(names)}

    def filled(c: str) -> Column:
        before, after = col(f"__prev_{c}"), following[c]
        options = [col(c).cast("double"), (before + after) / F.lit(2.0), before.cast("double"), after.cast("double")]
        if fallback is not None:
            options.append(F.lit(float(fallback)))
        return F.coalesce(*options)

    return near.withColumns({c: filled(c) for c in names}).drop(
        *[f"__{side}_{c}" for c in names for side in ("prev", "next")], *extra
    )


def level_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(column, level, n)`` of all listed text columns in one pass; NULL is a level."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).alias("level")) for c in columns])
    keys = [col(b) for b in by]
    return df.select(*keys, F.inline(pairs)).groupBy(*keys, "column", "level").agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(column, mode)``: the most frequent level, NULL included; ties go to the smaller one."""
    rank = F.struct((-F.col("n")).alias("n"), F.col("level").isNull().alias("missing"), F.col("level"))
    counted = level_counts(df, columns, by)
    return counted.groupBy(*[col(b) for b in by], "column").agg(F.min_by("level", rank).alias("mode"))


def rank_levels(df: DataFrame, column: str) -> DataFrame:
    """Levels of a column with their count and dense rank by count."""
    counted = df.groupBy(col(column).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    # Only distinct counts are ranked: k of them need k * (k + 1) / 2 rows, so they are few.
    sizes = counted.select("n").distinct()
    ranked = sizes.withColumn("rank", F.dense_rank().over(Window.orderBy(F.desc("n"))))
    return counted.join(ranked, "n").select("level", "n", "rank")


def impute_mode(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), fallback: str = UNKNOWN
) -> DataFrame:
    """Fill text columns with their mode; where NULL is the mode, with ``fallback``."""
    names = string_columns(df, exclude=by) if columns is None else list(columns)
    if not names:
        return df
    found = modes(df, names, by)
    entries = F.map_from_entries(F.collect_list(F.struct("column", F.coalesce("mode", F.lit(fallback)))))
    if by:
        table = found.groupBy(*[col(b) for b in by]).agg(entries.alias("__modes"))
        joined = join_few(df, table, by)
        fills = {c: F.coalesce(col(c), col("__modes").getItem(c), F.lit(fallback)) for c in names}
        return joined.withColumns(fills).drop("__modes")
    table = found.agg(entries).scalar()
    return df.withColumns({c: F.coalesce(col(c), table.getItem(c), F.lit(fallback)) for c in names})


def impute_numeric(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    strategy: str = "median",
    default: float = 0.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Fill numeric columns with their median or mean; an empty column with ``default``.

    Medians are exact and selected by narrowing histograms, see ``selection``: jobs run at once.
    """
    if strategy not in ("median", "mean"):
        raise ValueError("strategy must be 'median' or 'mean'")
    names = numeric_columns(df, exclude=by) if columns is None else list(columns)
    if not names:
        return df
    fields = [f"__fill_{i}" for i in range(len(names))]
    if strategy == "median":
        found = medians(df, names, by)
    else:
        found = df.groupBy(*[col(b) for b in by]).agg(*[F.avg(col(c)).alias(f) for c, f in zip(names, fields)])
    if by:
        joined = join_null_safe(df, found, by) if strategy == "median" else join_few(df, found, by)
        fills = {f: col(f) for f in fields}
    else:
        row = found.select(F.struct(*fields)).scalar()
        joined, fills = df, {f: row.getField(f) for f in fields}
    return joined.withColumns(
        {c: F.coalesce(col(c).cast("double"), fills[f], F.lit(float(default))) for c, f in zip(names, fields)}
    ).drop(*fields)


def impute_group_mean(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Fill with the mean of the row's group; a group without a value stays NULL.

    The means are aggregated on the map side and joined back, so that a group holding
    much of the table is never sorted in one task.
    """
    fields = [f"__mean_{i}" for i in range(len(columns))]
    means = df.groupBy(*[col(b) for b in by]).agg(*[F.avg(col(c)).alias(f) for c, f in zip(columns, fields)])
    joined = join_few(df, means, by)
    return joined.withColumns({c: F.coalesce(col(c).cast("double"), col(f)) for c, f in zip(columns, fields)}).drop(*fields)
