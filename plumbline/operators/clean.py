"""Removal of rows and columns.

Operators that drop columns run one aggregation whose single result row, as wide as the
schema, comes to the driver: the output schema depends on it. Each has a report twin that
stays lazy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from plumbline.columns import col, ordering, rows_from
from plumbline.functions.categories import UNKNOWN
from plumbline.operators.ordered import latest
from plumbline.operators.profile import constant_columns, nulls


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of each key by ``order``.

    The rank filter is applied before the shuffle as well, so each task sends one row per
    key however often the key repeats.
    """
    rank = F.row_number().over(Window.partitionBy(*[col(k) for k in keys]).orderBy(*ordering(order)))
    return df.withColumn("__rank", rank).filter(col("__rank") == 1).drop("__rank")


def null_share(columns: Sequence[str]) -> Column:
    """Share of the listed columns that are NULL in a row."""
    return sum((col(c).isNull().cast("int") for c in columns), F.lit(0)) / F.lit(len(columns))


def drop_sparse_rows(df: DataFrame, limit: float = 0.7, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows whose share of NULLs is below ``limit``."""
    return df.filter(null_share(df.columns if columns is None else columns) < F.lit(limit))


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def drop_constant_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns with a single level (NULL being a level)."""
    found = [row["column"] for row in constant_columns(df).select("column").collect()]
    return df.drop(*[c for c in found if c not in keep])


def sparse_columns(df: DataFrame, limit: float) -> DataFrame:
    """``(column, null_ratio, is_sparse)``: sparse above ``limit``, not at it."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n"), *[nulls(c).alias(f"m_{i}") for i, c in enumerate(df.columns)]
    )
    ratio = lambda i: F.try_divide(F.col(f"m_{i}"), F.col("n"))
    return rows_from(
        counted,
        [
            F.struct(
                F.lit(c).alias("column"),
                ratio(i).alias("null_ratio"),
                F.coalesce(ratio(i) > F.lit(limit), F.lit(False)).alias("is_sparse"),
            )
            for i, c in enumerate(df.columns)
        ],
    )


def drop_sparse_columns(df: DataFrame, limit: float) -> DataFrame:
    return df.drop(*[row["column"] for row in sparse_columns(df, limit).filter("is_sparse").collect()])


def unstable_columns(
    df: DataFrame,
    ts: str,
    series: Sequence[str] = (),
    *,
    recent: int = 730,
    share: float = 0.2,
    tie_break: Sequence[str] = (),
    exclude: Sequence[str] = (),
) -> DataFrame:
    """``(column, nulls, is_unstable)`` over the latest ``recent`` rows (of each series).

    The bound is ``recent * share`` NULLs even when fewer rows exist.
    """
    names = [c for c in df.columns if c not in {ts, *series, *exclude}]
    keys = [col(s) for s in series]
    if not names:
        none = [F.lit("").alias("column"), F.lit(0).cast("long").alias("nulls"), F.lit(False).alias("is_unstable")]
        return df.select(*keys, *none).limit(0)
    counted = latest(df, recent, ts, series, tie_break).groupBy(*keys).agg(
        *[nulls(c).alias(f"m_{i}") for i, c in enumerate(names)]
    )
    verdicts = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"m_{i}").alias("nulls"),
                (F.col(f"m_{i}") > F.lit(recent * share)).alias("is_unstable"),
            )
            for i, c in enumerate(names)
        ]
    )
    return counted.select(*keys, F.inline(verdicts))


def drop_unstable_columns(df: DataFrame, ts: str, **options) -> DataFrame:
    """Drop columns with too many NULLs in the latest rows of a single series."""
    report = unstable_columns(df, ts, **options)
    return df.drop(*[row["column"] for row in report.filter("is_unstable").collect()])


def token_columns(df: DataFrame, token: str = UNKNOWN, limit: float = 0.5, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, token_ratio, is_dropped)``: the share of rows that hold ``token``."""
    names = [f.name for f in df.schema if f.dataType.typeName() == "string"] if columns is None else list(columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(col(c) == token).alias(f"t_{i}") for i, c in enumerate(names)]
    )
    ratio = lambda i: F.try_divide(F.col(f"t_{i}"), F.col("n"))
    return rows_from(
        counted,
        [
            F.struct(
                F.lit(c).alias("column"),
                ratio(i).alias("token_ratio"),
                F.coalesce(ratio(i) > F.lit(limit), F.lit(False)).alias("is_dropped"),
            )
            for i, c in enumerate(names)
        ],
    )


def drop_token_columns(df: DataFrame, token: str = UNKNOWN, limit: float = 0.5) -> DataFrame:
    return df.drop(*[row["column"] for row in token_columns(df, token, limit).filter("is_dropped").collect()])
