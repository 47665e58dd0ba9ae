"""Ordered work over series: neighbours and row positions.

A window partitioned by series sorts a whole series in one task. That is the cheapest plan
while every series is small, and impossible when one series holds a third of the table. So
each operator here has two exact forms, and the caller's ``layout`` says which one runs:

* **plain** (``WHOLE``, the default but in ``chronological_split``): one window per series;
* **split** (``Layout(True, chunks)``): rows are range-partitioned by (series, order) into
  chunks of even size, the window runs inside (series, chunk), and one small row per
  (series, chunk) carries what a chunk must know about the chunks before and after it.

Nothing switches by the size of the data. Both forms, and any order of the input, agree, as
all other columns break ties. The chunk number is written to the shared checkpoint folder
before use, so a lost executor cannot renumber rows half-way; (series, chunk) is one struct
that is never NULL, so that the window, the edges and the join share one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from plumbline.columns import col, join_few, ordering, total_order
from plumbline.session import cut_lineage

CHUNK = "__chunk"
GROUP_LIMIT = 1000
PARTS = 256
#: Rows of a chunk, about.
CHUNK_ROWS = 200_000


@dataclass(frozen=True)
class Layout:
    """Whether series are split over tasks, and into how many chunks the table is cut at least;
    more are made where a chunk would hold more than ``CHUNK_ROWS`` rows."""

    split: bool
    chunks: int = 1


WHOLE = Layout(False)
SPLIT = Layout(True)


def chunked(
    df: DataFrame, series: Sequence[str], order: Sequence[str], layout: Layout = SPLIT
) -> tuple[DataFrame, DataFrame]:
    """Add (series, chunk number) as one struct; chunks are ordered within a series and of even size.

    Returns the rows as written, for aggregates, and dealt by chunk to as many tasks as there are
    chunks, for windows: what a task holds does not grow with the table.
    """
    chunks = max(layout.chunks, -(-df.count() // CHUNK_ROWS))
    ranged = df.repartitionByRange(chunks, *ordering([*series, *order]))
    place = F.struct(*[col(s).alias(f"s_{i}") for i, s in enumerate(series)], F.spark_partition_id().alias("n"))
    written = cut_lineage(ranged.withColumn(CHUNK, place))
    return written, written.repartition(chunks, col(CHUNK))


def _series_window(series: Sequence[str]):
    return Window.partitionBy(*[col(s) for s in series])


def _chunks_of_series(series: Sequence[str], backward: bool = False):
    """A window over the chunks of a series, up to the one before (or, backward, behind) the row's."""
    number = F.col(f"{CHUNK}.n")
    window = Window.partitionBy(*[F.col(f"{CHUNK}.s_{i}") for i in range(len(series))])
    return window.orderBy(number.desc() if backward else number).rowsBetween(Window.unboundedPreceding, -1)


def _descending(order: Sequence[str]) -> list[Column]:
    return [col(o).desc_nulls_last() for o in order]


def neighbours(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    series: Sequence[str] = (),
    *,
    sides: Sequence[str] = ("prev", "next"),
    layout: Layout | None = None,
) -> DataFrame:
    """Add ``__prev_<c>`` and ``__next_<c>``: the nearest non-NULL value before and after.

    Ties of ``order`` are broken by the other columns. The value after a row is read from a
    descending window: a frame that is open towards the end would be recomputed per row.
    """
    layout = layout or WHOLE
    names = {side: {c: f"__{side}_{c}" for c in columns} for side in sides}
    total = total_order(df, order, series)
    base, dealt = chunked(df, series, order, layout) if layout.split else (df, df)
    inside = Window.partitionBy(CHUNK) if layout.split else _series_window(series)
    windows = {"prev": inside.orderBy(*ordering(total)), "next": inside.orderBy(*_descending(total))}

    def nearest(c: str, side: str) -> Column:
        return F.last(col(c), ignorenulls=True).over(windows[side].rowsBetween(Window.unboundedPreceding, -1))

    local = dealt.withColumns({names[side][c]: nearest(c, side) for side in sides for c in columns})
    if not layout.split:
        return local

    position = F.struct(*ordering(total))
    ends = {"prev": F.max_by, "next": F.min_by}
    edges = base.groupBy(CHUNK).agg(
        *[
            ends[side](col(c), F.when(col(c).isNotNull(), position)).alias(f"__{side}_end_{i}")
            for side in sides
            for i, c in enumerate(columns)
        ]
    )
    # One row per (series, chunk): as many as there are chunks, plus one per series.
    carried = edges.select(
        CHUNK,
        *[
            F.last(f"__{side}_end_{i}", ignorenulls=True).over(_chunks_of_series(series, side == "next")).alias(f"__{side}_far_{i}")
            for side in sides
            for i in range(len(columns))
        ],
    )
    joined = local.join(carried, CHUNK, "left")
    filled = {
        names[side][c]: F.coalesce(col(names[side][c]), col(f"__{side}_far_{i}")) for side in sides for i, c in enumerate(columns)
    }
    return joined.withColumns(filled).select(*[col(c) for c in [*df.columns, *filled]])


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    series: Sequence[str] = (),
    *,
    name: str = "position",
    layout: Layout | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in its series, as a long."""
    layout = layout or WHOLE
    total = ordering(total_order(df, order, series))
    if not layout.split:
        window = _series_window(series).orderBy(*total)
        return df.withColumn(name, F.row_number().over(window).cast("long"))
    base, dealt = chunked(df, series, order, layout)
    sizes = base.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(CHUNK, F.coalesce(F.sum("__n").over(_chunks_of_series(series)), F.lit(0)).alias("__offset"))
    numbered = dealt.withColumn("__inside", F.row_number().over(Window.partitionBy(CHUNK).orderBy(*total)))
    placed = numbered.join(offsets, CHUNK).withColumn(name, (col("__offset") + col("__inside")).cast("long"))
    return placed.select(*[col(c) for c in [*df.columns, name]])


def with_halo(df: DataFrame, position: str, rows: int, lookback: int, block: str = "__block") -> DataFrame:
    """Cut numbered rows into blocks and copy the last ``lookback`` rows into the next block.

    A window per (series, block) then sees everything a frame of ``lookback`` rows needs.
    Copies carry ``__halo`` = true and are to be dropped after the window.
    """
    if rows <= lookback:
        raise ValueError("a block must be longer than the look-back")
    home = F.floor((col(position) - 1) / rows)
    in_tail = (col(position) - 1) % rows >= rows - lookback
    targets = F.when(in_tail, F.array(home, home + 1)).otherwise(F.array(home))
    spread = df.withColumn(block, F.explode(targets))
    return spread.withColumn("__halo", col(block) != home)


def order_violations(
    df: DataFrame,
    ts: str,
    series: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    *,
    name: str = "ordered",
    layout: Layout | None = None,
) -> DataFrame:
    """Add ``name``: the time is later than that of the previous row; NULL for the first row."""
    order = [ts, *tie_break]
    layout = layout or WHOLE
    if not layout.split:
        window = _series_window(series).orderBy(*ordering(total_order(df, order, series)))
        return df.withColumn(name, col(ts) > F.lag(col(ts)).over(window))
    # NULL times sort first, so the nearest earlier non-NULL time is the previous row's.
    near = neighbours(df, [ts], order, series, sides=["prev"], layout=layout)
    return near.withColumn(name, col(ts) > col(f"__prev_{ts}")).drop(f"__prev_{ts}")


def latest(df: DataFrame, n: int, ts: str, series: Sequence[str] = (), tie_break: Sequence[str] = ()) -> DataFrame:
    """The latest ``n`` rows, per series when one is given; other columns break remaining ties.

    Up to ``GROUP_LIMIT`` rows Spark itself keeps only ``n`` rows per series and map task.
    Beyond that, rows are first thinned per (series, hash): a row that is not among the
    latest ``n`` of its part is not among the latest ``n`` of its series.
    """
    ties = total_order(df, [ts, *tie_break], series)[1:]
    order = [col(ts).desc_nulls_last(), *[col(t).asc_nulls_first() for t in ties]]
    if not series:
        return df.orderBy(*order).limit(n)

    def first_rows(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
        rank = F.row_number().over(_series_window(keys).orderBy(*order))
        return frame.withColumn("__rank", rank).filter(col("__rank") <= n).drop("__rank")

    if n > GROUP_LIMIT:
        part = F.pmod(F.xxhash64(*[col(c) for c in [ts, *ties]]), F.lit(PARTS))
        df = first_rows(df.withColumn("__part", part), [*series, "__part"]).drop("__part")
    return first_rows(df, series)


def chronological_split(
    df: DataFrame,
    ts: str,
    tie_break: Sequence[str],
    series: Sequence[str] = (),
    *,
    train: float = 0.85,
    validation: float = 0.15,
    layout: Layout | None = None,
) -> DataFrame:
    """Add ``part``: the first int(n*train) rows train, the next int(n*validation) validate.

    A row left over by the two truncations gets NULL. Series are split unless ``layout`` says
    otherwise: few series, such as areas, each hold much of a table.
    """
    numbered = number_rows(df, [ts, *tie_break], series, name="__position", layout=layout or SPLIT)
    keys = list(series)
    total = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__total"))
    if keys:
        sized = join_few(numbered, total, keys)
    else:
        sized = numbered.withColumn("__total", total.scalar())
    train_end = F.floor(col("__total") * F.lit(train))
    valid_end = train_end + F.floor(col("__total") * F.lit(validation))
    part = F.when(col("__position") <= train_end, "train").when(col("__position") <= valid_end, "validation")
    return sized.withColumn("part", part).drop("__position", "__total")
