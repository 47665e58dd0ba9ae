"""The page source: which pages are opened, odd names and values, and tasks of bounded size."""

import glob
import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.columns import col
from plumbline.sources import pages

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("area", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("note", T.StringType()),
        T.StructField(pages.PAGE, T.StringType()),
    ]
)
AREAS = ["Long Beach", "a_b/c", "-", "é", None]


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages"))
    rows = [(i, AREAS[i % 5], None if i % 11 == 0 else date(2024, 1, 1) + timedelta(days=i // 10), f'"{i}"\n{{' if i % 3 else None) for i in range(900)]
    frame = spark.createDataFrame(rows, "id long, area string, day date, note string")
    pages.land_pages(frame, path, "area", "day", 20)
    return path, rows


def scan(spark, path, **options):
    return pages.scan_pages(spark, path, SCHEMA, "area", "day", **options)


def test_all_records_come_back(spark, landed, rows):
    path, given = landed
    assert rows(scan(spark, path).drop(pages.PAGE)) == sorted(given, key=repr)
    assert all(len(n.split("_")) == 4 for n in os.listdir(path))


@pytest.mark.parametrize(
    "condition",
    [
        "area = 'a_b/c' AND day BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
        "area IN ('-', 'é') AND day > DATE '2024-03-01'",
        "area = '-' AND day = DATE '2024-02-02'",
        "day < DATE '2024-01-03'",
    ],
)
def test_pages_outside_are_not_opened(spark, landed, rows, tmp_path, condition):
    """Every page that holds no record asked for, and whose name says so, is made unreadable."""
    path, given = landed
    frame = scan(spark, path)
    expected = rows(frame.select("id", "area", "day").join(frame.where(condition).select("id"), "id"))
    needed = {r[0] for r in frame.where(condition).select(pages.PAGE).distinct().collect()}
    assert 0 < len(needed) < len(os.listdir(path))
    for name in os.listdir(path):
        text = open(f"{path}/{name}").read() if name in needed else "not JSON"
        (tmp_path / name).write_text(text)
    assert rows(scan(spark, str(tmp_path)).where(condition).select("id", "area", "day")) == expected
    with pytest.raises(Exception, match="JSONDecodeError"):
        scan(spark, str(tmp_path)).collect()


def test_filters_that_cannot_judge_a_page_are_left_to_spark(spark, landed, rows):
    path, given = landed
    kept = scan(spark, path).where(col("area").isNull() | (col("day") > F.lit("2024-03-20").cast("date"))).select("id")
    assert rows(kept) == sorted([(i,) for i, a, d, _ in given if a is None or (d and d > date(2024, 3, 20))], key=repr)
    assert scan(spark, path).where("day IS NULL").count() == sum(d is None for _, _, d, _ in given)
    assert scan(spark, path).where("area = 'elsewhere'").count() == 0


def test_tasks_of_bounded_size(spark, landed):
    path, _ = landed
    reader = pages.PageReader(SCHEMA, path, "area", "day", 4_000)
    tasks = reader.partitions()
    assert sorted(n for t in tasks for n in t.names) == sorted(os.listdir(path))
    for task in tasks:
        assert len(task.names) == 1 or sum(os.path.getsize(f"{path}/{n}") for n in task.names) <= 4_000
    assert scan(spark, path, task_bytes=4_000).rdd.getNumPartitions() == len(tasks)


def test_empty_folders_pages_and_missing_fields(spark, tmp_path):
    assert scan(spark, str(tmp_path)).count() == 0
    (tmp_path / "x_2024-01-01_2024-01-01_0-0.json").write_text('{"response":{"data":[{"id":5}]}}')
    (tmp_path / "x_2024-01-01_2024-01-01_0-1.json").write_text('{"response":{"data":[]}}')
    (tmp_path / "x_2024-01-01_2024-01-01_0-2.json").write_text("{}")
    assert [tuple(r) for r in scan(spark, str(tmp_path)).drop(pages.PAGE).collect()] == [(5, None, None, None)]
    assert len(glob.glob(f"{tmp_path}/*.json")) == 3
