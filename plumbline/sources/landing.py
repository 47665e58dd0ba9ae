"""Landing steps: range extracts, month pruning and compaction."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.columns import col
from plumbline.functions.convert import COMPACT_DATE, parse_date


def extract_range(df: DataFrame, columns: Sequence[str], day: str, start: date, end: date) -> DataFrame:
    """Chosen columns of the rows dated within [start, end], with the date parsed.

    ``day`` is yyyyMMdd text, which sorts like the dates it names: the range is filtered on
    the text so that the filter reaches the parquet scan, where a parsed date would stop it.
    """
    low, high = start.strftime("%Y%m%d"), end.strftime("%Y%m%d")
    inside = df.select(*[col(c) for c in columns]).filter(col(day).between(low, high))
    return inside.withColumn("parsed_date", parse_date(col(day), COMPACT_DATE)).filter(col("parsed_date").isNotNull())


def copy_range(df: DataFrame, path: str, columns: Sequence[str], day: str, start: date, end: date) -> None:
    """Extract a range and land it as parquet at ``path``."""
    extract_range(df, columns, day, start, end).write.mode("overwrite").parquet(path)


def area_between(df: DataFrame, area: str, value: str, ts: str, start, end, limit: int | None = None) -> DataFrame:
    """Rows of one area within a closed time range, at most ``limit`` when one is asked for."""
    found = df.filter((col(area) == value) & col(ts).between(F.lit(start), F.lit(end)))
    return found if limit is None else found.limit(limit)


def write_compacted(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite") -> None:
    """Few, evenly sized files per partition value.

    The rebalance hint lets adaptive execution merge small partitions and split one that
    holds much of the data, where a plain repartition by key would give it to one task.
    Only the partitions present in ``df`` are replaced, so a rerun does not duplicate rows.
    """
    balanced = df.hint("rebalance", *[col(p) for p in partition_by])
    writer = balanced.write.mode(mode).partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


#: Journal of a compaction that is being switched in; readers skip names with an underscore.
JOURNAL = "_compaction.json"


def compact_small_files(spark: SparkSession, path: str, partition_by: Sequence[str], small_bytes: int = 32 << 20) -> int:
    """Merge the small files of each partition of a parquet table; returns how many files were replaced.

    Files are chosen by their size before any row is read: only files under ``small_bytes`` are
    opened, and of those only in partitions that have more than one. Larger files keep their name
    and bytes. Merged files are written aside; a journal then names what goes and what
    comes, and a call after a killed one finishes its journal first, so rows are neither lost
    nor doubled. No other job may read or write the table between journal and end.
    """
    replaced = _finish_compaction(spark, path)
    size, name = col("_metadata").getField("file_size"), col("_metadata").getField("file_path")
    small = spark.read.option("mergeSchema", True).parquet(path).where(size < small_bytes)
    keys = [col(p) for p in partition_by]
    # A row per small file: metadata that the driver needs to switch them.
    listed = small.select(*keys, name.alias("__file")).distinct()
    several = listed.groupBy(*keys).agg(F.collect_list("__file").alias("__files")).where(F.size("__files") > 1).collect()
    if not several:
        return replaced
    old = sorted(f for row in several for f in row["__files"])
    files = F.broadcast(spark.createDataFrame([(f,) for f in old], "__old string"))
    rows = small.withColumn("__file", name).join(files, col("__file") == col("__old"), "left_semi").drop("__file")
    aside = f"{path.rstrip('/')}/_merged"
    rows.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*partition_by).parquet(aside)
    _write_text(spark, f"{path}/{JOURNAL}", json.dumps(old))
    return replaced + _finish_compaction(spark, path)


def _finish_compaction(spark: SparkSession, path: str) -> int:
    """Do what the journal of a compaction says, from wherever it stopped."""
    hadoop, place = spark._jvm.org.apache.hadoop.fs, f"{path.rstrip('/')}"
    journal, aside = hadoop.Path(f"{place}/{JOURNAL}"), hadoop.Path(f"{place}/_merged")
    files = journal.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(journal):
        return 0
    opened = files.open(journal)
    old = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8"))
    opened.close()
    for name in old:
        files.delete(hadoop.Path(spark._jvm.java.net.URI(name)), False)
    root = files.makeQualified(aside).toUri().getPath()
    found = files.listFiles(aside, True) if files.exists(aside) else None
    while found is not None and found.hasNext():
        merged = found.next().getPath()
        if merged.getName().startswith("part-"):
            target = hadoop.Path(place + merged.toUri().getPath().removeprefix(root))
            files.mkdirs(target.getParent())
            if not files.rename(merged, target):
                raise RuntimeError(f"could not move {merged} to {target}")
    files.delete(aside, True)
    files.delete(journal, False)
    return len(old)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file aside and rename it, so that it is there as a whole or not at all."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    aside, place = hadoop.Path(f"{path}.writing"), hadoop.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(aside, place):
        raise RuntimeError(f"could not write {path}")


def with_month(df: DataFrame, ts: str) -> DataFrame:
    """Add ``year`` and ``month``, the partition columns of a landing table."""
    return df.withColumns({"year": F.year(col(ts)), "month": F.month(col(ts))})


def scan_months(
    spark: SparkSession, path: str, ts: str, start: date, end: date, schema: T.StructType | None = None
) -> DataFrame:
    """Rows within [start, end] of a table partitioned by year and month.

    With a ``schema`` (partition columns included) no footer is read to infer one.

    The month condition uses partition columns only, so other months are not listed as
    input; the time condition then trims the first and the last month.
    """
    months = (col("year") * 12 + col("month")).between(start.year * 12 + start.month, end.year * 12 + end.month)
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path).filter(months)
    return rows.filter((col(ts) >= F.lit(start)) & (col(ts) < F.date_add(F.lit(end), 1)))
