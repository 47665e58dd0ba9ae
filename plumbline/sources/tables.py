"""Table input and output: catalog tables, views and optional JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from plumbline.columns import col
from plumbline.operators.observed import RowCounts

# Rows per JDBC batch and fetch.
JDBC_ROWS = 10_000


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Write a catalog table, created from the frame's schema when missing.

    ``append`` adds rows. ``overwrite`` with ``partition_by`` replaces only the partitions
    present in ``df``, so a rerun of one period does not duplicate it.
    """
    spark, table = df.sparkSession, name.lower()
    if mode == "overwrite" and partition_by and spark.catalog.tableExists(table):
        # A catalog insert follows the session's mode; a write to the table's place has its own.
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
        rows = df.select(*[col(c) for c in spark.table(table).columns])
        rows.write.mode(mode).partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic").parquet(place)
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
        return
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Replace a catalog table by ``df``, dealt and sorted by ``keys`` into ``buckets``, and read it.

    Joins and groupings of such tables on the same keys and number of buckets need no shuffle.
    One task writes one file per bucket. Choose the number once for all tables that meet, by the
    largest: a bucket should be sorted in the memory of a task, a few hundred MB; a table of
    100 TB asks for some 200,000. A bucket holds all rows of its keys.
    """
    table = name.lower()
    dealt = df.repartition(buckets, *[col(k) for k in keys]).sortWithinPartitions(*[col(k) for k in keys])
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.read.table(table)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name.lower())


def write_if_any(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> bool:
    """Write as ``write_table`` unless the frame is empty; returns whether it had rows.

    Rows are counted while they are written, by one job. A table that is new or replaced as a
    whole is written aside and takes its name only if it has rows; appending nothing, or
    replacing the partitions of nothing, changes no row.
    """
    spark, table, counter = df.sparkSession, name.lower(), RowCounts()
    watched = counter.watch("rows", df)
    if spark.catalog.tableExists(table) and (mode == "append" or partition_by):
        write_table(watched, table, mode, partition_by, path)
        return counter.counts()["rows"] > 0
    tag = uuid.uuid4().hex
    aside, folder = f"{table}_{tag}", None if path is None else f"{path.rstrip('/')}-{tag}"
    write_table(watched, aside, "overwrite", partition_by, folder)
    wrote = counter.counts()["rows"] > 0
    if wrote:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    if folder is None:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {table}" if wrote else f"DROP TABLE {aside}")
        return wrote
    spark.sql(f"DROP TABLE {aside}")
    source, target = spark._jvm.org.apache.hadoop.fs.Path(folder), spark._jvm.org.apache.hadoop.fs.Path(path)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not wrote:
        files.delete(source, True)
        return False
    files.delete(target, True)
    if not files.rename(source, target):
        raise RuntimeError(f"could not move {folder} to {path}")
    if not partition_by:
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
        return True
    # Which columns are partitions is read from the folders.
    spark.catalog.createTable(table, path=path, source="parquet")
    spark.catalog.recoverPartitions(table)
    return True


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Register a named view and return it as a frame."""
    df.createOrReplaceTempView(name.lower())
    return df.sparkSession.table(name.lower())


def jdbc_read_options(
    url: str, table: str, partition: tuple[str, object, object, int] | None = None, **extra: str
) -> dict[str, str]:
    """Reader options; ``partition`` = (column, lower, upper, parts) reads in parallel."""
    options = {"url": url, "dbtable": table.lower(), "fetchsize": str(JDBC_ROWS), **extra}
    if partition:
        column, lower, upper, parts = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A database table; filters and columns are pushed down to it."""
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, **extra: str) -> None:
    options = {"url": url, "dbtable": table.lower(), "batchsize": str(JDBC_ROWS), **extra}
    df.write.format("jdbc").options(**options).mode("append").save()
