"""Scans, landing steps and table input/output, as round trips of the given tables."""

from __future__ import annotations

import gzip
import io
import tarfile
import uuid
from collections.abc import Iterator
from datetime import date

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.checks import standins as st
from plumbline.checks.registry import query, table
from plumbline.columns import col
from plumbline.functions.convert import flatten_struct
from plumbline.session import scratch_path
from plumbline.sources import archive, files, landing, pages, schemas, tables
from plumbline.sources.upsert import KeyedTable

ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
ORDER_COLUMNS = "o_orderkey:i o_custkey:i o_orderstatus:s o_totalprice:f o_orderdate:t o_orderpriority:s"


@query("scan_parquet", ORDER_COLUMNS, "SELECT * FROM orders")
def scan_parquet(spark, sf):
    return files.scan_parquet(spark, f"{sf}/orders.parquet", ORDERS)


@query(
    "scan_json",
    "dr_no:s time_occ:s date_occ:d vict_sex:s premis_desc:s latitude:s longitude:s corrupt:b",
    f"""SELECT dr_no, time_occ, date_occ, vict_sex, premis_desc, rpt_dist_no AS latitude, area AS longitude,
    FALSE AS corrupt FROM {st.select("accidents")}""",
)
def scan_json(spark, sf):
    """Accidents written as JSON arrays of nested records, read back as multi-line files."""
    rows = st.frame(spark, sf, "accidents")
    place = F.struct(
        col("rpt_dist_no").alias("latitude"), col("area").alias("longitude"), F.lit("").alias("human_address")
    )
    nested = rows.drop("latitude", "longitude").withColumn("location_1", place)
    path = scratch_path(spark, "scan_json")
    as_documents(nested).write.option("maxRecordsPerFile", 1).text(path)
    read = files.scan_json(spark, path, schemas.ACCIDENTS)
    return flatten_struct(read, "location_1").withColumn("corrupt", col(files.CORRUPT).isNotNull())


@query(
    "corrupt_records",
    "o_orderstatus:s metric:s n:i",
    """SELECT o_orderstatus, 'records' AS metric, COUNT(*) AS n FROM orders GROUP BY 1
    UNION ALL SELECT o_orderstatus, 'corrupt', COUNT(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') FROM orders GROUP BY 1
    UNION ALL SELECT o_orderstatus, 'keyless', 0 FROM orders GROUP BY 1""",
)
def corrupt_records(spark, sf):
    """One JSON record per line, those of one priority cut short; reported per status folder."""
    orders = table(spark, sf, "orders")
    line = F.to_json(F.struct(*[col(c) for c in orders.columns]))
    cut = F.when(col("o_orderpriority") == "4-NOT SPECIFIED", F.regexp_replace(line, "}$", "")).otherwise(line)
    path = scratch_path(spark, "corrupt_records")
    orders.select("o_orderstatus", cut.alias("value")).write.partitionBy("o_orderstatus").text(path)
    schema = T.StructType([f for f in ORDERS if f.name != "o_orderstatus"])
    return files.corrupt_report(files.scan_json(spark, path, schema, multi_line=False), ["o_orderstatus"])


def as_documents(records: DataFrame, prefix: str = "[", suffix: str = "]") -> DataFrame:
    """One JSON document per batch of records: bounded by the Arrow batch size, no shuffle."""
    lines = records.select(F.to_json(F.struct(*[col(c) for c in records.columns])).alias("line"))

    def join_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"document": [prefix + ",\n".join(batch["line"]) + suffix]})

    return lines.mapInPandas(join_lines, "document string")


def write_archives(df: DataFrame, path: str) -> None:
    """One tar.gz archive of one csv.gz member per batch of rows, written by the tasks."""
    columns, uri = df.columns, path if ":" in path else f"file://{path}"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            member = gzip.compress(batch[columns].to_csv(index=False, escapechar="\\").encode())
            buffer = io.BytesIO()
            with tarfile.open(fileobj=buffer, mode="w:gz") as archive:
                info = tarfile.TarInfo(f"part-{part}-{number}.csv.gz")
                info.size = len(member)
                archive.addfile(info, io.BytesIO(member))
            filesystem, folder = pyarrow.fs.FileSystem.from_uri(uri)
            filesystem.create_dir(folder, recursive=True)
            with filesystem.open_output_stream(f"{folder}/part-{part}-{number}.tar.gz", compression=None) as out:
                out.write(buffer.getvalue())
            yield pd.DataFrame({"archives": [1]})

    df.mapInPandas(pack, "archives long").count()


EVENT_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in ("event_id", "ts", "user_id", "event_type", "value")])


@query("scan_archive", "event_id:i ts:s user_id:i event_type:s value:f", """SELECT event_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value FROM events""")
def scan_archive(spark, sf):
    """Events packed into tar.gz archives of csv.gz members, with padded text, and parsed again."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")
    events = table(spark, sf, "events").select(
        "event_id", stamp, "user_id", F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("event_type"), "value"
    )
    path = scratch_path(spark, "archives")
    write_archives(events, path)
    return archive.good_rows(archive.scan_archives(spark, path, EVENT_TEXT))


@query(
    "landing_range_extract",
    "station:s day:s quantity:f tax:i parsed_date:d",
    f"""SELECT station, strftime(datetime_iso, '%Y%m%d') AS day, quantity, tax, datetime_iso AS parsed_date
    FROM {st.select("weather_source")} WHERE datetime_iso BETWEEN DATE '1997-03-15' AND DATE '1999-02-10'""",
)
def landing_range_extract(spark, sf):
    """A table with its dates as text, the range taken from it by a pushed filter, and the landed copy."""
    rows = st.frame(spark, sf, "weather_source").withColumn("day", F.date_format("datetime_iso", "yyyyMMdd"))
    source, landed = scratch_path(spark, "text-dates"), scratch_path(spark, "landed")
    rows.drop("datetime_iso").write.parquet(source)
    columns = ["station", "day", "quantity", "tax"]
    landing.copy_range(spark.read.parquet(source), landed, columns, "day", date(1997, 3, 15), date(1999, 2, 10))
    return spark.read.parquet(landed)


RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("period", "type-name", "timezone", "timezone-description", "value", "key")])


@query(
    "json_explode_filter",
    "period:d timezone:s value:f key:i",
    """SELECT CAST(ts AS DATE) AS period, 'Pacific' AS timezone, value, CAST(json_extract(props, '$.k') AS BIGINT) AS key
    FROM events WHERE event_type = 'purchase' AND user_id < 500""",
)
def json_explode_filter(spark, sf):
    """Events as API pages; wanted records kept, service fields dropped."""
    events = table(spark, sf, "events").select(
        F.to_date("ts").cast("string").alias("period"),
        F.when(col("event_type") == "purchase", "Demand").otherwise(col("event_type")).alias("type-name"),
        F.when(col("user_id") < 500, "Pacific").otherwise("Eastern").alias("timezone"),
        F.lit("a time zone").alias("timezone-description"),
        col("value").cast("string").alias("value"),
        F.get_json_object("props", "$.k").alias("key"),
    )
    pages = as_documents(events, '{"response":{"total":"1","data":[', "]}}")
    records = files.records_from_pages(pages, "document", RECORD)
    return files.keep_records(records, {"type-name": "Demand", "timezone": "Pacific"}, ["type-name", "timezone-description"])


@query(
    "area_date_filter",
    ORDER_COLUMNS,
    """SELECT * FROM orders WHERE o_orderstatus = 'F'
    AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-06-30'""",
)
def area_date_filter(spark, sf):
    orders = table(spark, sf, "orders")
    low, high = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1998-06-30").cast("timestamp_ntz")
    return landing.area_between(orders, "o_orderstatus", "F", "o_orderdate", low, high)


@query(
    "month_pruned_scan",
    ORDER_COLUMNS,
    "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-11-20' AND DATE '1997-02-05'",
)
def month_pruned_scan(spark, sf):
    path = scratch_path(spark, "months")
    landing.write_compacted(landing.with_month(table(spark, sf, "orders"), "o_orderdate"), path, ["year", "month"])
    return landing.scan_months(spark, path, "o_orderdate", date(1996, 11, 20), date(1997, 2, 5))


@query(
    "compact_partitions",
    "l_orderkey:i l_linenumber:i l_quantity:f l_returnflag:s year:i l_shipdate:t",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, YEAR(l_shipdate) AS year, l_shipdate FROM lineitem",
)
def compact_partitions(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    path = scratch_path(spark, "compact")
    landing.write_compacted(lines.withColumn("year", F.year("l_shipdate")), path, ["l_returnflag", "year"])
    return spark.read.parquet(path)


#: Rows of the table for each task that writes its large files, and its small ones.
LARGE_ROWS, SMALL_ROWS = 1_000_000, 200_000


@query(
    "compact_small_files",
    "l_orderkey:i l_linenumber:i l_quantity:f l_returnflag:s l_shipdate:t",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem",
)
def compact_small_files(spark, sf):
    """A table of large and many small files per partition, of which the small ones are merged.

    One large file per partition and six small ones, more where a task would write more than
    ``LARGE_ROWS`` or ``SMALL_ROWS`` rows.
    """
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    path = scratch_path(spark, "small")
    late = col("l_linenumber") > 4
    n, key = lines.count(), ["l_orderkey", "l_linenumber"]
    lines.where(~late).repartition(-(-n // LARGE_ROWS) or 1, *key).write.partitionBy("l_returnflag").parquet(path)
    lines.where(late).repartition(max(6, -(-n // SMALL_ROWS)), *key).write.mode("append").partitionBy("l_returnflag").parquet(path)
    large = max(size for (size,) in spark.read.parquet(path).select("_metadata.file_size").distinct().collect())
    landing.compact_small_files(spark, path, ["l_returnflag"], large // 2)
    return spark.read.parquet(path)


@query("table_roundtrip", ORDER_COLUMNS, "SELECT * FROM orders")
def table_roundtrip(spark, sf):
    name = f"Orders_{uuid.uuid4().hex}"
    tables.write_if_any(table(spark, sf, "orders"), name, path=scratch_path(spark, "table"))
    return tables.read_table(spark, name)


@query(
    "upsert_orders",
    "o_orderkey:i o_orderstatus:s o_totalprice:f landed:i",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 AND late THEN o_totalprice + 1
      ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 7 = 0 THEN 3 WHEN late THEN 2 ELSE 1 END AS landed
    FROM (SELECT *, o_orderdate >= TIMESTAMP '2000-01-01' AS late FROM orders)""",
)
def upsert_orders(spark, sf):
    """Four batches by key: early rows, late rows, corrections, and older corrections that change nothing.

    The corrections land twice, and once more under their own name after the others.
    """
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    late = col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    raised = orders.withColumn("o_totalprice", col("o_totalprice") + 1)
    keyed = KeyedTable(spark, scratch_path(spark, "keyed"), ["o_orderkey", "o_orderstatus"], ["o_orderstatus"])
    corrections = raised.where("o_orderkey % 7 = 0").withColumn("landed", F.lit(3))
    keyed.upsert(orders.where(~late).withColumn("landed", F.lit(1)), "early", "landed")
    keyed.upsert(corrections.where(~late), "corrections", "landed")
    keyed.upsert(corrections.where(~late), "corrections", "landed")
    keyed.upsert(raised.where(late & (col("o_orderkey") % 5 == 0)).unionByName(orders.where(late & (col("o_orderkey") % 5 > 0))).withColumn("landed", F.lit(2)), "late", "landed")
    keyed.upsert(orders.where(col("o_orderkey") % 14 == 0).withColumn("landed", F.lit(0)), "older", "landed")
    keyed.upsert(corrections, "corrections of all", "landed")
    return keyed.read()


@query(
    "upsert_partition",
    "o_orderkey:i o_totalprice:f",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def upsert_partition(spark, sf):
    """One partition of a keyed table; the folders of the others are not listed."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    keyed = KeyedTable(spark, scratch_path(spark, "keyed"), ["o_orderkey", "o_orderstatus"], ["o_orderstatus"])
    for batch in (0, 1):
        keyed.upsert(orders.where(col("o_orderkey") % 2 == batch), str(batch))
    return keyed.read(o_orderstatus="F")


PAGED = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField(pages.PAGE, T.StringType()),
    ]
)


def paged_orders(spark, sf):
    """Orders landed as API pages of 400 records, read back through the page source."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    path = scratch_path(spark, "pages")
    pages.land_pages(orders, path, "o_orderstatus", "day", 400)
    return pages.scan_pages(spark, path, PAGED, "o_orderstatus", "day")


@query(
    "landed_pages",
    "o_orderkey:i o_orderstatus:s day:d o_totalprice:f",
    """SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'""",
)
def landed_pages(spark, sf):
    """One area and half a year: pages of other areas and days are not opened."""
    days = col("day").between(F.lit("1996-01-01").cast("date"), F.lit("1996-06-30").cast("date"))
    return paged_orders(spark, sf).where((col("o_orderstatus") == "F") & days)


@query(
    "landed_pages_listed",
    "o_orderstatus:s n:i total:f first_day:d last_day:d",
    """SELECT o_orderstatus, COUNT(*) AS n, SUM(ROUND(o_totalprice * 100)) / 100 AS total, CAST(MIN(o_orderdate) AS DATE) AS first_day,
    CAST(MAX(o_orderdate) AS DATE) AS last_day FROM orders WHERE o_orderstatus IN ('O', 'P')
    AND CAST(o_orderdate AS DATE) > DATE '1998-03-31' GROUP BY 1""",
)
def landed_pages_listed(spark, sf):
    """A list of areas and an open range, aggregated."""
    kept = paged_orders(spark, sf).where(col("o_orderstatus").isin("O", "P") & (col("day") > F.lit("1998-03-31").cast("date")))
    cents = F.sum(F.round(col("o_totalprice") * 100).cast("bigint")) / 100
    return kept.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), cents.alias("total"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )
