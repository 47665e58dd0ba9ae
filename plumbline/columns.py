"""Small helpers for addressing columns by name and by type."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import cut_lineage

#: Most rows of a side that is broadcast.
FEW = 100_000


def col(name: str) -> Column:
    """The column called exactly ``name``, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def ordering(order: Sequence[str | Column]) -> list[Column]:
    return [col(o) if isinstance(o, str) else o for o in order]


def rows_from(row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn one aggregated row into one row per struct."""
    return row.select(F.inline(F.array(*structs)))


def orderable(kind: T.DataType) -> bool:
    """Whether values of a type can be sorted."""
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def total_order(df: DataFrame, order: Sequence[str], series: Sequence[str] = ()) -> list[str]:
    """``order`` and every other column that can be sorted: rows that still tie are equal,
    so every form of an ordered operator, and every run, gives the same result."""
    first = [*order, *series]
    return [*order, *(f.name for f in df.schema if f.name not in first and orderable(f.dataType))]


def join_few(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join aggregates of few groups back without moving ``left``.

    ``right`` is written and counted: up to ``FEW`` rows are broadcast, so that a key with a
    few hot levels is never shuffled on. A longer ``right`` is joined like any other.
    """
    small = cut_lineage(right)
    return join_null_safe(left, F.broadcast(small) if small.limit(FEW + 1).count() <= FEW else small, keys, how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL; key columns come from the left side.

    No broadcast hint: adaptive execution measures both sides and broadcasts, or splits
    skewed partitions, by their real size.
    """
    if not keys:
        raise ValueError("at least one key")
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    condition = all_of(col(k).eqNullSafe(col(f"__right_{k}")) for k in keys)
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])
