"""Archives: tar.gz files that hold csv.gz members."""

from __future__ import annotations

import gzip
import io
import tarfile
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_FRAME = 50_000
FAULTS = (tarfile.TarError, OSError, EOFError, UnicodeDecodeError, ValueError)


def open_stream(path: str):
    """A file as a stream, wherever Spark found it."""
    uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
    filesystem, name = pyarrow.fs.FileSystem.from_uri(uri)
    return filesystem.open_input_stream(name, compression=None)


def unpack_archives(archives: DataFrame) -> DataFrame:
    """``(archive, member, content, error)``: the still compressed members of ``archives(path)``.

    An archive is streamed by its task, member by member, and never held whole. A damaged
    archive adds one row with ``error`` set; members read before the fault remain.
    """

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                try:
                    with open_stream(path) as stream, tarfile.open(fileobj=stream, mode="r|gz") as archive:
                        for member in archive:
                            if member.isfile():
                                data = archive.extractfile(member).read()
                                yield pd.DataFrame([(path, member.name, data, None)], columns=fields)
                except FAULTS as fault:
                    yield pd.DataFrame([(path, None, None, repr(fault))], columns=fields)

    fields = ["archive", "member", "content", "error"]
    return archives.select("path").mapInPandas(
        unpack, "archive string, member string, content binary, error string"
    )


def parse_members(members: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of csv.gz members as stripped text, in bounded frames; faults keep their row."""
    columns = schema.names
    out = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "archive", "member", "error"]])

    def fault_row(archive: str, member: str | None, text: str) -> pd.DataFrame:
        values = {"archive": archive, "member": member, "error": text}
        return pd.DataFrame({c: pd.Series([values.get(c)], dtype=object) for c in out.names})

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, member, content, error in batch.itertuples(index=False):
                if error is not None:
                    yield fault_row(archive, member, error)
                    continue
                try:
                    with gzip.open(io.BytesIO(content), "rt", encoding="utf-8", newline="") as text:
                        for rows in pd.read_csv(
                            text, dtype=str, keep_default_na=False, escapechar="\\", chunksize=ROWS_PER_FRAME
                        ):
                            missing = {c: None for c in columns if c not in rows}
                            text_only = rows.apply(lambda s: s.str.strip()).assign(**missing)
                            yield text_only[columns].assign(archive=archive, member=member, error=None)
                except FAULTS as fault:
                    yield fault_row(archive, member, repr(fault))

    return members.select("archive", "member", "content", "error").mapInPandas(parse, out)


def parse_archives(archives: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of all members of ``archives(path)``.

    Unpacking an archive is one task's work, parsing is not: members are spread over the
    cluster by name first, so one archive that holds much of the data does not hold it up.
    """
    members = unpack_archives(archives).repartition("archive", "member")
    return parse_members(members, schema)


def scan_archives(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the archives in a folder, of any size: Spark only lists the files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.gz").load(path)
    return parse_archives(files.select("path"), schema)


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("error").isNull()).drop("archive", "member", "error")


def archive_errors(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("error").isNotNull()).select("archive", "member", "error")
