"""What the data-set plans share."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.columns import col, join_few
from plumbline.functions.categories import lookup
from plumbline.operators import profile
from plumbline.operators.clean import unstable_columns
from plumbline.operators.rules import Constraint, consistency, constraint_report
from plumbline.sources.schemas import STATIONS

TIME = "datetime_iso"


@dataclass
class Trusted:
    """Cleaned rows and the quality reports around them; all frames are lazy."""

    data: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)


def station_of(identifier: Column, source: int) -> Column:
    """Station name of a source identifier; ``source`` is its place in ``STATIONS``."""
    return lookup(identifier, {ids[source]: name for name, ids in STATIONS.items()})


def assess(
    df: DataFrame,
    keys: Sequence[str],
    as_of: Column | None = None,
    update_rate: float = 12,
    distinct: str = "approx",
) -> dict[str, DataFrame]:
    """Profile, completeness, timeliness, redundancy and constant columns of a table.

    Distinct values are estimated in the same pass unless ``distinct="exact"`` asks for the
    shuffle of all values that an exact count needs.
    """
    now = F.current_date() if as_of is None else as_of
    scores = profile.timeliness(df, TIME, now, update_rate)
    return {
        "profile": profile.profile(df, distinct=distinct),
        "column_completeness": profile.column_completeness(df),
        "relation_completeness": profile.relation_completeness(df),
        "timeliness": scores,
        "relation_timeliness": profile.relation_timeliness(scores),
        "redundancy": profile.redundancy(df, keys),
        "constant_columns": profile.constant_columns(df),
    }


def assess_rules(df: DataFrame, rules: Sequence[Constraint]) -> dict[str, DataFrame]:
    return {"consistency": consistency(df, rules), "constraints": constraint_report(df, rules)}


def blank_unstable(df: DataFrame, series: str, exclude: Sequence[str]) -> DataFrame:
    """Blank, per station, the columns that are mostly NULL in its latest rows.

    In one table for all stations a column cannot be dropped for one of them.
    """
    names = [c for c in df.columns if c not in {TIME, series, *exclude}]
    if not names:
        return df
    report = unstable_columns(df, TIME, [series], exclude=exclude).filter("is_unstable")
    marks = report.groupBy(col(series)).agg(F.collect_list("column").alias("__unstable"))
    joined = join_few(df, marks, [series])
    unstable = lambda c: F.coalesce(F.array_contains("__unstable", c), F.lit(False))
    return joined.withColumns({c: F.when(~unstable(c), col(c)) for c in names}).drop("__unstable")
