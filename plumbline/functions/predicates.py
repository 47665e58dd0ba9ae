"""Predicates that denial constraints are built from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.columns import all_of, any_of, col
from plumbline.functions.convert import parse_date


def all_non_negative(columns: Sequence[str]) -> Column:
    """TRUE when no listed column is negative; a NULL makes the result NULL."""
    return all_of(col(c) >= 0 for c in columns)


def any_present(columns: Sequence[str]) -> Column:
    return any_of(col(c).isNotNull() for c in columns)


def below_or_missing(name: str, limit: float) -> Column:
    return (col(name) < F.lit(limit)) | col(name).isNull()


def not_less_or_missing(left: str, right: str) -> Column:
    return (col(left) >= col(right)) | col(left).isNull() | col(right).isNull()


def one_of_or_unknown(name: str, values: Sequence) -> Column:
    """Membership in a list that also holds NULL: TRUE when listed, never FALSE."""
    return F.when(col(name).isin(*values), True)


def one_of_or_missing(name: str, values: Sequence) -> Column:
    """TRUE for a listed value or NULL, FALSE for any other value."""
    return col(name).isNull() | col(name).isin(*values)


def integer_between(name: str, low: int, high: int) -> Column:
    """Range check of a code kept as text; text that is no integer gives NULL."""
    return col(name).try_cast("int").between(low, high)


def matches(name: str, pattern: str) -> Column:
    return col(name).rlike(pattern)


def implies(premise: Column, conclusion: Column) -> Column:
    return ~premise | conclusion


def sum_identity(total: str, parts: Sequence[str], tolerance: float) -> Column:
    """The total equals the sum of its parts, or any of them is missing."""
    summed = sum((col(p) for p in parts[1:]), col(parts[0]))
    missing = any_of(col(c).isNull() for c in [total, *parts])
    return missing | (F.abs(col(total) - summed) < F.lit(tolerance))


def valid_date(name: str, fmt: str = "yyyy-MM-dd") -> Column:
    return parse_date(col(name), fmt).isNotNull()
