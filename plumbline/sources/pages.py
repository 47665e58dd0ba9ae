"""Landed API pages as a data source that opens only the pages a query can need.

A page is a JSON document ``{"response": {"data": [records]}}`` of one area, and its name says
which area and which days it holds. The source lists the folder, drops the pages that pushed
filters on area and day rule out, and packs the others into tasks of even size. Filters stay
with Spark as well, as a page is kept or dropped as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.columns import col

FORMAT = "landed_pages"
#: Fixed value: most records of a page.
PAGE_RECORDS = 5_000
#: Bytes of pages that one task reads; a larger page is a task by itself.
TASK_BYTES = 64 << 20
#: Name of the column, where the schema has it, that tells the page of a record.
PAGE = "_page"
#: What a page name holds for an area or a day that is NULL.
NO_VALUE = "-"


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")


@dataclass(frozen=True)
class Page:
    """Area and day bounds of a page, from its name; None for records without."""

    name: str
    size: int

    def _part(self, i: int) -> str | None:
        text = self.name.removesuffix(".json").split("_")[i]
        return None if text == NO_VALUE else unquote(text)

    @property
    def area(self) -> str | None:
        return self._part(0)

    @property
    def days(self) -> tuple[str | None, str | None]:
        return self._part(1), self._part(2)


@dataclass
class Wanted:
    """What pushed filters ask of a page: areas, and the first and last day."""

    areas: set[str] | None = None
    first: str = ""
    last: str = "~"
    pushed: list[str] = field(default_factory=list)

    def take(self, asked: Filter, area: str, day: str) -> None:
        """Narrow by a filter, if it is one on area or day that a page can be judged by."""
        if not isinstance(asked, (EqualTo, EqualNullSafe, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
            return
        values = asked.value if isinstance(asked, In) else [asked.value]
        if any(v is None for v in values):
            return
        if asked.attribute == (area,) and isinstance(asked, (EqualTo, EqualNullSafe, In)):
            own = {str(v) for v in values}
            self.areas = own if self.areas is None else self.areas & own
        elif asked.attribute == (day,) and all(isinstance(v, (date, datetime, str)) for v in values):
            # ISO days sort like text; a bound within a day keeps the day.
            days = [str(v)[:10] for v in values]
            if not isinstance(asked, (LessThan, LessThanOrEqual)):
                self.first = max(self.first, min(days, default="~"))
            if not isinstance(asked, (GreaterThan, GreaterThanOrEqual)):
                self.last = min(self.last, max(days, default=""))
        else:
            return
        self.pushed.append(repr(asked))

    def has(self, page: Page) -> bool:
        low, high = page.days
        in_area = self.areas is None or page.area in self.areas
        open_range = (self.first, self.last) == ("", "~")
        return in_area and (open_range or (low is not None and low <= self.last and high >= self.first))


@dataclass
class Pages(InputPartition):
    names: list[str]


class PageSource(DataSource):
    """Options: ``path``; ``area`` and ``day``, the columns that page names describe."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PageReader(schema, self.options["path"], self.options["area"], self.options["day"], int(self.options.get("taskbytes", TASK_BYTES)))


class PageReader(DataSourceReader):
    def __init__(self, schema: T.StructType, path: str, area: str, day: str, task_bytes: int):
        self.schema, self.path, self.area, self.day, self.task_bytes = schema, path, area, day, task_bytes
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for asked in filters:
            self.wanted.take(asked, self.area, self.day)
            yield asked

    def pages(self) -> list[Page]:
        """The pages that the pushed filters leave, by name."""
        files, folder = filesystem(self.path)
        listed = files.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True))
        known = [Page(f.base_name, f.size) for f in listed if f.is_file and f.base_name.endswith(".json")]
        return sorted((p for p in known if self.wanted.has(p)), key=lambda p: p.name)

    def partitions(self) -> Sequence[InputPartition]:
        tasks, size = [Pages([])], 0
        for page in self.pages():
            if tasks[-1].names and size + page.size > self.task_bytes:
                tasks.append(Pages([]))
                size = 0
            tasks[-1].names.append(page.name)
            size += page.size
        return tasks

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        files, folder = filesystem(self.path)
        arrow = to_arrow_schema(self.schema)
        for name in partition.names:
            with files.open_input_stream(f"{folder}/{name}") as page:
                records = json.load(page).get("response", {}).get("data") or []
            columns = {f.name: [r.get(f.name) for r in records] if f.name != PAGE else [name] * len(records) for f in arrow}
            typed = {f.name: pa.array([None if v is None else str(v) for v in columns[f.name]], pa.string()) for f in arrow}
            yield pa.RecordBatch.from_arrays([typed[f.name].cast(f.type) for f in arrow], schema=arrow)


def scan_pages(spark: SparkSession, path: str, schema: T.StructType, area: str, day: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Records of the pages at ``path`` by a declared schema of texts, numbers, booleans and dates.

    Filters on ``area`` (equality, IN) and ``day`` (equality, IN, bounds) choose the pages. Spark
    pushes filters to Python sources only where its setting says so; it is set here. A
    field that a record lacks is NULL, an empty page has no records, and a value that does
    not fit its type is an error. ``_page`` in the schema tells the page.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageSource)
    reader = spark.read.format(FORMAT).schema(schema)
    return reader.options(area=area, day=day, taskBytes=str(task_bytes)).load(path)


def land_pages(records: DataFrame, path: str, area: str, day: str, page_records: int = PAGE_RECORDS) -> None:
    """Write records as pages of one area each, in the order of their days, named by what they hold.

    A task writes a page when it is full or the area changes, so it holds one page at a
    time. Names follow from the task and the page, so a task that runs again writes the same
    pages over. ``day`` is a date; other columns become text.
    """
    files, folder = filesystem(path)
    files.create_dir(folder, recursive=True)
    line = F.to_json(F.struct(*[col(c).cast("string").alias(c) for c in records.columns]))
    ordered = records.repartitionByRange(col(area), col(day)).sortWithinPartitions(area, day)
    rows = ordered.select(col(area).cast("string").alias("area"), F.to_date(col(day)).cast("string").alias("day"), line.alias("line"))

    def shown(value: str | None) -> str:
        return NO_VALUE if value is None else quote(value, safe="").replace("_", "%5F").replace("-", "%2D" if value == NO_VALUE else "-")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, waiting = TaskContext.get().partitionId(), 0, []
        own, place = filesystem(path)

        def flush() -> None:
            nonlocal number, waiting
            # NULL days come first; a page with any is not judged by its days.
            low, high = (None, None) if waiting[0][1] is None else (waiting[0][1], waiting[-1][1])
            name = f"{shown(waiting[0][0])}_{shown(low)}_{shown(high)}_{part:05d}-{number:05d}.json"
            with own.open_output_stream(f"{place}/{name}", compression=None) as out:
                out.write(('{"response":{"data":[' + ",\n".join(w[2] for w in waiting) + "]}}").encode())
            number, waiting = number + 1, []

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("area", "day", "line"))):
                if waiting and (len(waiting) >= page_records or row[0] != waiting[0][0] or (row[1] is None) != (waiting[0][1] is None)):
                    flush()
                waiting.append(row)
        if waiting:
            flush()
        yield pa.RecordBatch.from_pydict({"pages": pa.array([number], pa.int64())})

    rows.mapInArrow(write, "pages long").agg(F.sum("pages")).collect()
