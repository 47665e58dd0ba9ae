"""Denial constraints: flags, ratios and repair."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.columns import all_of, any_of, col, rows_from


@dataclass(frozen=True)
class Constraint:
    """A rule every row should satisfy, and the columns to blank when it does not."""

    name: str
    expr: Column
    columns: tuple[str, ...] = ()

    @property
    def flag(self) -> str:
        return f"check_{self.name}"


def add_flags(df: DataFrame, constraints: Sequence[Constraint], combined: str = "all_valid") -> DataFrame:
    """One boolean column per rule plus their conjunction, in three-valued logic."""
    flagged = df.withColumns({c.flag: c.expr for c in constraints})
    return flagged.withColumn(combined, all_of(col(c.flag) for c in constraints))


def _satisfied(condition: Column) -> Column:
    """Rows where the condition is TRUE; NULL counts as failed."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def consistency(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """One row: rows, rows that satisfy every rule, and their share."""
    valid = all_of(c.expr for c in constraints)
    counted = df.select(valid.alias("valid")).agg(F.count(F.lit(1)).alias("rows"), _satisfied(F.col("valid")).alias("valid_rows"))
    return counted.withColumn("consistency", F.try_divide(F.col("valid_rows"), F.col("rows")))


def constraint_report(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """``(constraint, satisfied, unknown, ratio)`` for every rule, in one pass.

    ``unknown`` counts rows where the rule is NULL; they do not count as satisfied.
    """
    flags = df.select(*[c.expr.alias(f"f_{i}") for i, c in enumerate(constraints)])
    counted = flags.agg(
        F.count(F.lit(1)).alias("n"),
        *[_satisfied(F.col(f"f_{i}")).alias(f"s_{i}") for i in range(len(constraints))],
        *[F.count_if(F.col(f"f_{i}").isNull()).alias(f"u_{i}") for i in range(len(constraints))],
    )
    return rows_from(
        counted,
        [
            F.struct(
                F.lit(c.name).alias("constraint"),
                F.col(f"s_{i}").alias("satisfied"),
                F.col(f"u_{i}").alias("unknown"),
                F.try_divide(F.col(f"s_{i}"), F.col("n")).alias("ratio"),
            )
            for i, c in enumerate(constraints)
        ],
    )


def enforce_filter(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Repair by removal: keep the rows for which every rule is TRUE."""
    for constraint in constraints:
        df = df.filter(constraint.expr)
    return df


def enforce_null(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Repair by blanking: a rule that is not TRUE blanks its columns.

    Rules apply in order and see what earlier rules blanked. The columns of one rule are
    blanked together.
    """
    for constraint in constraints:
        if constraint.columns:
            df = df.withColumns({c: F.when(constraint.expr, col(c)) for c in constraint.columns})
    return df


def blank_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Blank negative values and nothing else."""
    return df.withColumns({c: F.when(~(col(c) < 0), col(c)) for c in columns}) if columns else df


def recompute_sum(df: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    """Replace ``total`` by the sum of its parts, NULL when a part is missing.

    Applies only when the total and all parts exist as columns.
    """
    if not {total, *parts} <= set(df.columns):
        return df
    return df.withColumn(total, sum((col(p) for p in parts[1:]), col(parts[0])))


def recode_unlisted(df: DataFrame, column: str, allowed: Sequence[str], other: str = "Unknown") -> DataFrame:
    """Any value outside ``allowed``, and NULL, becomes ``other``."""
    return df.withColumn(column, F.when(col(column).isin(*allowed), col(column)).otherwise(F.lit(other)))


def any_missing(columns: Sequence[str]) -> Column:
    return any_of(col(c).isNull() for c in columns)
