"""Date-joined views kept up to date by the periods that changed.

A row of such a view depends on one day of every input: the left rows of the day, the rows
they meet, and the copies that UNION or DISTINCT removes. So what landed, late or corrected
rows included, changes the view in the periods of its days only. Those periods are computed
anew from the same days of the inputs, which is exact where a right row that lands late
turns NULLs into values, and replace the stored ones. A refresh that is run again, or again
after it was killed half-way, gives the same view.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.columns import any_of, col
from plumbline.session import cut_lineage

#: The partition column of a stored view: the first day of the period.
PERIOD = "view_period"
GRAINS = ("day", "week", "month", "year")


def period_of(day: Column, grain: str) -> Column:
    """First day of the period of a day; a row without a day has the period NULL."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    return F.to_date(day) if grain == "day" else F.trunc(F.to_date(day), grain)


def touched_periods(changes: Mapping[str, tuple[DataFrame, str]], grain: str) -> list[date | None]:
    """Periods with a changed row in any input, in order; as many as there are periods, never rows."""
    days = [frame.select(period_of(col(day), grain).alias(PERIOD)) for frame, day in changes.values()]
    found = {r[0] for frame in days for r in frame.distinct().collect()}
    return sorted(found, key=lambda p: (p is not None, p or date.min))


def end_of(first: date, grain: str) -> date:
    """The first day after a period."""
    if grain in ("day", "week"):
        return first + timedelta(days=1 if grain == "day" else 7)
    months = first.month if grain == "month" else 12
    return date(first.year + months // 12, months % 12 + 1, 1)


def within(day: Column, periods: list[date | None], grain: str) -> Column:
    """Rows of the given periods: bounds on the column itself, one pair per run of periods, that scans can push down."""
    spans: list[list[date]] = []
    for first in (p for p in periods if p is not None):
        if spans and spans[-1][1] == first:
            spans[-1][1] = end_of(first, grain)
        else:
            spans.append([first, end_of(first, grain)])
    parts = [(day >= F.lit(low)) & (day < F.lit(high)) for low, high in spans]
    return any_of([*parts, *([day.isNull()] if None in periods else [])])


def refresh_view(
    spark: SparkSession,
    path: str,
    build: Callable[..., DataFrame],
    inputs: Mapping[str, tuple[DataFrame, str]],
    changes: Mapping[str, tuple[DataFrame, str]],
    day: str,
    grain: str = "month",
) -> DataFrame:
    """Bring the view at ``path`` up to date; returns (period, rows_before, rows_after) of what was rewritten.

    ``build`` makes the view from the frames of ``inputs``, given by name; each comes with the
    column that holds its day. ``changes`` has the rows that landed since the last refresh, of any
    of the inputs; a corrected row whose day moved is listed under both days. ``day`` is the day of
    a view row. Only the touched periods of the inputs are read, and only they are written.
    """
    periods = touched_periods(changes, grain)
    empty = spark.createDataFrame([], f"{PERIOD} date, rows_before long, rows_after long")
    if not periods:
        return empty
    slices = {name: frame.where(within(col(own), periods, grain)) for name, (frame, own) in inputs.items()}
    before = counts(stored(spark, path, periods))
    rows = cut_lineage(build(**slices).withColumn(PERIOD, period_of(col(day), grain)))
    after = counts(rows)
    if outside := [p for p in after if p not in periods]:
        raise ValueError(f"the view has rows of {outside}, which its inputs do not touch")
    rows.write.mode("overwrite").partitionBy(PERIOD).option("partitionOverwriteMode", "dynamic").parquet(path)
    for gone in [p for p in before if p not in after]:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PERIOD}={gone or '__HIVE_DEFAULT_PARTITION__'}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return spark.createDataFrame([(p, before.get(p, 0), after.get(p, 0)) for p in periods], empty.schema)


def stored(spark: SparkSession, path: str, periods: list[date | None]) -> DataFrame:
    """The partition column of the stored rows of some periods."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], f"{PERIOD} date")
    known = [F.lit(p) for p in periods if p is not None]
    wanted = [col(PERIOD).isin(known)] * bool(known) + [col(PERIOD).isNull()] * (None in periods)
    return spark.read.schema(f"{PERIOD} date").parquet(path).where(any_of(wanted))


def counts(rows: DataFrame) -> dict[date | None, int]:
    return {r[PERIOD]: r["n"] for r in rows.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("n")).collect()}


def read_view(spark: SparkSession, path: str) -> DataFrame:
    """The stored view without its partition column."""
    return spark.read.parquet(path).drop(PERIOD)
