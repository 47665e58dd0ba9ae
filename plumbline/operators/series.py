"""Time-series operators: outliers, wide pivots and daily roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from plumbline.columns import col, ordering, rows_from, total_order
from plumbline.operators.ordered import WHOLE, Layout, number_rows, with_halo

BLOCK_ROWS = 100_000
#: Most columns that a pivot finds by itself.
MOST_COLUMNS = 1_000


def _quantile(sorted_values: Column, size: Column, q: float) -> Column:
    """Discrete quantile: the smallest value whose rank reaches ``q``."""
    return F.get(sorted_values, (F.ceil(size * F.lit(q)) - 1).cast("int"))


def detect_outliers(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    series: Sequence[str] = (),
    *,
    window: int = 7,
    factor: float = 7.5,
    layout: Layout | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Flag increases above Q3 + factor * IQR of the last ``window`` increases.

    Adds ``increase_<c>`` (difference to the previous row, 0 where unknown) and
    ``is_outlier_<c>`` for every column in one pass. The quartiles are exact: the frame is
    collected and sorted, which is bounded by ``window`` and cheaper than a sketch per row.
    """
    layout = layout or WHOLE
    if layout.split:
        base = number_rows(df, order, series, name="__position", layout=layout)
        # One row more than the frame: the first increase of the frame needs its predecessor.
        base = with_halo(base, "__position", max(block_rows, window + 1), window)
        ordered = Window.partitionBy(*[col(s) for s in [*series, "__block"]]).orderBy("__position")
    else:
        base = df
        ordered = Window.partitionBy(*[col(s) for s in series]).orderBy(*ordering(total_order(df, order, series)))
    rolling = ordered.rowsBetween(-(window - 1), Window.currentRow)

    steps = base.withColumns(
        {f"increase_{c}": F.coalesce(col(c) - F.lag(col(c)).over(ordered), F.lit(0.0)) for c in columns}
    )
    frames = steps.withColumns(
        {f"__frame_{c}": F.sort_array(F.collect_list(col(f"increase_{c}")).over(rolling)) for c in columns}
    )
    flags = {}
    for c in columns:
        frame = col(f"__frame_{c}")
        q1, q3 = _quantile(frame, F.size(frame), 0.25), _quantile(frame, F.size(frame), 0.75)
        flags[f"is_outlier_{c}"] = col(f"increase_{c}") > q3 + F.lit(factor) * (q3 - q1)
    out = frames.withColumns(flags).drop(*[f"__frame_{c}" for c in columns])
    if layout.split:
        out = out.filter(~col("__halo")).drop("__halo", "__block", "__position")
    return out


def outliers_per_row(df: DataFrame, columns: Sequence[str], tie_break: Sequence[str], top: int | None = 5) -> DataFrame:
    """Rows with their number of outliers, the ``top`` rows first by count."""
    total = sum((col(f"is_outlier_{c}").cast("int") for c in columns[1:]), col(f"is_outlier_{columns[0]}").cast("int"))
    counted = df.withColumn("total_outliers", total)
    if top is None:
        return counted
    return counted.orderBy(col("total_outliers").desc(), *ordering(tie_break)).limit(top)


def outliers_per_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(parameter, total_outliers, outlier_pct)``, most outliers first."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.sum(col(f"is_outlier_{c}").cast("long")), F.lit(0)).alias(f"o_{i}") for i, c in enumerate(columns)],
    )
    report = rows_from(
        counts,
        [
            F.struct(
                F.lit(c).alias("parameter"),
                F.col(f"o_{i}").alias("total_outliers"),
                F.round(F.try_divide(F.col(f"o_{i}") * 100.0, F.col("n")), 2).alias("outlier_pct"),
            )
            for i, c in enumerate(columns)
        ],
    )
    return report.orderBy(F.desc("total_outliers"), "parameter")


def pivot_wide(
    df: DataFrame,
    index: Sequence[str],
    key: str,
    value: str,
    tie_break: Sequence[str],
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Long observations to one column per ``key``: the first value by ``tie_break``.

    With ``values`` no job is needed to find the columns, and a value that never occurs
    still gets its (all-NULL) column; without, more than ``MOST_COLUMNS`` values are an error. One fixed-width tie-break column keeps the
    aggregation on hash maps; several need a sort per task.
    """
    if values is None:
        names = df.select(col(key)).distinct().filter(col(key).isNotNull()).orderBy(col(key))
        values = [row[0] for row in names.limit(MOST_COLUMNS + 1).collect()]
        if len(values) > MOST_COLUMNS:
            raise ValueError(f"more than {MOST_COLUMNS} values of {key}: name those to keep")
    position = col(tie_break[0]) if len(tie_break) == 1 else F.struct(*ordering(tie_break))
    return df.groupBy(*[col(i) for i in index]).agg(
        *[F.min_by(col(value), F.when(col(key) == v, position)).alias(str(v)) for v in values]
    )


def daily_rollup(
    df: DataFrame,
    ts: str,
    columns: Sequence[str],
    series: Sequence[str] = (),
    *,
    digits: int = 4,
    counter: str = "hourly_readings",
) -> DataFrame:
    """Rounded daily mean per column and the number of readings."""
    return df.groupBy(*[col(s) for s in series], F.to_date(col(ts)).alias(ts)).agg(
        *[F.round(F.avg(col(c)), digits).alias(c) for c in columns],
        F.count(col(ts)).alias(counter),
    )
