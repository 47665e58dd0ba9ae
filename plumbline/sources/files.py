"""File scans with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.columns import col
from plumbline.sources.schemas import page_schema, with_corrupt_column

CORRUPT = "_corrupt_record"


def scan_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Parquet files of a folder by a declared schema: no inference, missing columns are NULL."""
    return spark.read.schema(schema).parquet(*([path] if isinstance(path, str) else path))


def scan_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """JSON by a declared schema; a record that does not fit keeps its text in ``_corrupt_record``.

    ``multi_line`` reads each file as one document (an array of records). Such a file is
    one task's work, so large landings should hold one record per line instead.
    """
    reader = spark.read.schema(with_corrupt_column(schema, CORRUPT))
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("multiLine", multi_line).json(path)


def corrupt_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(metric, n)``: all records, corrupt ones, and sound ones without their first field.

    Long form keeps the first field in the scan; a scan of the corrupt column alone is refused.
    """
    first = next(c for c in df.columns if c not in {CORRUPT, *by})
    keys, corrupt = [col(b) for b in by], col(CORRUPT).isNotNull()
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(corrupt).alias("corrupt"),
        F.count_if(~corrupt & col(first).isNull()).alias("keyless"),
    )
    metrics = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("n")) for m in ("records", "corrupt", "keyless")])
    return counted.select(*keys, F.inline(metrics))


def records_from_pages(pages: DataFrame, text: str, record: T.StructType) -> DataFrame:
    """Records of landed API pages, one JSON document per row, as one frame.

    An empty page contributes nothing and costs nothing: earlier pages are kept.
    """
    parsed = pages.select(F.from_json(col(text), page_schema(record)).alias("page"))
    return parsed.select(F.inline("page.response.data"))


def keep_records(records: DataFrame, equal: dict[str, str], drop: Sequence[str]) -> DataFrame:
    """Records whose fields equal the given values, without the fields no longer needed."""
    for name, value in equal.items():
        records = records.filter(col(name) == value)
    return records.drop(*drop)
