"""Scans, landing steps and tables on files written by the test."""

import gzip
import io
import os
import tarfile
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import checks
from plumbline.plans import accidents, energy, weather
from plumbline.session import cut_lineage, fix_partitions, scratch_path, shared_dir
from plumbline.sources import archive, files, landing, schemas, tables


def write_archive(path, members):
    with tarfile.open(path, "w:gz") as out:
        for name, content in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(content)
            out.addfile(info, io.BytesIO(content))


def csv_member(*lines):
    header = "location_id,sensors_id,location,datetime,lat,lon,parameter,units,value"
    return gzip.compress("\n".join([header, *lines]).encode())


def test_archives_keep_good_rows_and_name_faults(spark, tmp_path):
    good = csv_member('8679, 1 ,"Pier, 5",2024-01-01T09:00:00-08:00,33.7,-118.2,pm25,ug, 12.5', "8679,1,x,y,,,co,ppm,")
    write_archive(tmp_path / "a.tar.gz", {"d/one.csv.gz": good, "d/two.csv.gz": b"not gzip"})
    (tmp_path / "b.tar.gz").write_bytes(b"broken")
    (tmp_path / "ignored.txt").write_text("x")
    read = archive.scan_archives(spark, str(tmp_path), schemas.AIR_LONG)
    found = archive.good_rows(read).collect()
    assert sorted((r.sensors_id, r.location, r.value, r.lat) for r in found) == [("1", "Pier, 5", "12.5", "33.7"), ("1", "x", "", "")]
    faults = {(os.path.basename(r.archive), r.member) for r in archive.archive_errors(read).collect()}
    assert faults == {("a.tar.gz", "d/two.csv.gz"), ("b.tar.gz", None)}


def test_multi_line_json_and_corrupt_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"dr_no": "1",\n "location_1": {"latitude": "34.0"}},\n {"dr_no": "2"}]')
    (tmp_path / "b.json").write_text('[{"dr_no": ')
    read = files.scan_json(spark, f"{tmp_path}/*.json", schemas.ACCIDENTS)
    report = {r.metric: r.n for r in files.corrupt_report(read).collect()}
    assert report == {"records": 3, "corrupt": 1, "keyless": 0}
    sound = read.filter(F.col(files.CORRUPT).isNull())
    assert sorted((r.dr_no, r.location_1.latitude if r.location_1 else None) for r in sound.collect()) == [("1", "34.0"), ("2", None)]


def test_pages_keep_what_came_before_an_empty_page(spark):
    full = '{"response":{"total":"2","data":[{"period":"2024-01-01","type-name":"Demand","timezone":"Pacific","value":"5"},' \
        '{"period":"2024-01-01","type-name":"Forecast","timezone":"Pacific","value":"6"}]}}'
    pages = spark.createDataFrame([(full,), ('{"response":{"total":"2","data":[]}}',), ("{}",)], "page string")
    kept = energy.land_energy(files.records_from_pages(pages, "page", schemas.ENERGY_RECORD)).collect()
    assert [(r.period, r.value) for r in kept] == [("2024-01-01", "5")]
    assert "type-name" not in kept[0].asDict()


def test_range_filter_on_text_dates_reaches_the_scan(spark, plan, tmp_path):
    path = str(tmp_path / "weather")
    raw = spark.createDataFrame(
        [("S", d, "0700", "TMAX", 1) for d in ("20240101", "20240215", "20240301", "2024021x")],
        "STATION string, DATE string, OBS_TIME string, ELEMENT string, DATA_VALUE long",
    )
    raw.write.parquet(path)
    read = files.scan_parquet(spark, path, schemas.WEATHER_LONG).drop("parsed_date")
    out = landing.extract_range(read, ["STATION", "DATE", "DATA_VALUE"], "DATE", date(2024, 1, 15), date(2024, 2, 28))
    assert [r.parsed_date for r in out.collect()] == [date(2024, 2, 15)]
    text = plan(out)
    assert "GreaterThanOrEqual(DATE,20240115)" in text
    assert "ReadSchema: struct<STATION:string,DATE:string,DATA_VALUE:bigint>" in text


def test_month_scan_prunes_partitions_and_reruns_replace(spark, plan, tmp_path):
    path = str(tmp_path / "events")
    events = spark.range(120).select(F.col("id"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id as int))").alias("ts"))
    for _ in range(2):
        landing.write_compacted(landing.with_month(events, "ts"), path, ["year", "month"])
    assert spark.read.parquet(path).count() == 120
    found = landing.scan_months(spark, path, "ts", date(2024, 2, 10), date(2024, 3, 5))
    assert found.count() == 25
    assert "PartitionFilters: [isnotnull(year" in plan(found)
    per_month = [len([f for f in os.listdir(d) if f.endswith(".parquet")]) for d, _, _ in os.walk(path) if "month=" in d]
    assert per_month and max(per_month) == 1


def test_tables_append_overwrite_and_skip_empty(spark, tmp_path):
    frame = spark.range(4).select("id", (F.col("id") % 2).alias("part"))
    assert tables.write_if_any(frame, "Mixed_Case", path=str(tmp_path / "t"))
    assert tables.read_table(spark, "MIXED_case").count() == 4
    tables.write_table(frame, "mixed_case", mode="append", path=str(tmp_path / "t"))
    assert tables.read_table(spark, "mixed_case").count() == 8
    assert not tables.write_if_any(frame.filter("id > 9"), "never_written")
    assert not spark.catalog.tableExists("never_written")
    tables.write_table(frame, "parts", partition_by=["part"], path=str(tmp_path / "p"))
    tables.write_table(frame.filter("part = 1").withColumn("id", F.col("id") + 100), "parts", partition_by=["part"])
    assert sorted((r.id, r.part) for r in tables.read_table(spark, "parts").collect()) == [(0, 0), (2, 0), (101, 1), (103, 1)]


def test_jdbc_options():
    options = tables.jdbc_read_options("jdbc:x", "Trusted", ("id", 0, 100, 8), user="u")
    assert options["dbtable"] == "trusted" and options["fetchsize"] == "10000" and options["numPartitions"] == "8"
    assert "partitionColumn" not in tables.jdbc_read_options("jdbc:x", "t")


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake_session(master, configured):
    context = FakeContext(master)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured or default))


def test_shared_dir_comes_from_the_session():
    named = fake_session("spark://host:7077", "hdfs:///shared")
    assert shared_dir(named) == "hdfs:///shared" and named.sparkContext.folder == "hdfs:///shared"
    assert scratch_path(named, "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError):
        shared_dir(fake_session("spark://host:7077", None))
    local = fake_session("local[2]", None)
    assert shared_dir(local) == shared_dir(local) == local.sparkContext.folder


def test_cut_lineage_leaves_no_shuffle(spark, plan):
    frame = spark.range(5).select(F.col("id").alias("a-b"), F.lit("x").alias("c d"), F.lit(1.5).alias("e.f")).repartition(2)
    cut = cut_lineage(frame)
    assert "Exchange" not in plan(cut) and cut.columns == frame.columns
    assert sorted(map(tuple, cut.collect())) == [(i, "x", 1.5) for i in range(5)]
    assert "ReadSchema: struct<a-b:bigint>" in plan(cut.select("a-b"))
    assert fix_partitions(frame).rdd.getNumPartitions() == 2


def test_weather_format_from_landing_files(spark):
    raw = spark.createDataFrame(
        [
            ("USW00023129", "20240101", "0700", "TMAX", 250),
            ("USW00023129", "20240101", "0800", "TMAX", 999),
            ("USW00023129", "20240101", None, "PRCP", None),
            ("USW00023129", "2024-01-02", "0700", "TMAX", 251),
            ("USC00049785", "20240101", "0700", "SNOW", 3),
        ],
        "STATION string, DATE string, OBS_TIME string, ELEMENT string, DATA_VALUE long",
    )
    found = weather.format_weather(raw, ["TMAX", "TMIN", "PRCP", "SNOW"]).orderBy("station").collect()
    assert [(r.station, r.TMAX, r.TMIN, r.PRCP, r.SNOW) for r in found] == [
        ("long_beach", 25.0, None, None, None),
        ("reseda", None, None, None, 3),
    ]


def test_accident_format_handles_malformed_fields(spark):
    place = T.Row(latitude="34.1", longitude="west", human_address="")
    base = dict.fromkeys(schemas.ACCIDENTS.names)
    records = [
        {**base, "dr_no": "1", "time_occ": "0540", "mocodes": "3004  3026", "vict_age": "x", "vict_sex": "X", "vict_descent": "X",
         "location": "SATICOY      ST", "premis_desc": "N/A", "location_1": place},
        {**base, "dr_no": "2", "time_occ": "9999", "vict_sex": "F", "vict_descent": "E"},
    ]
    frame = spark.createDataFrame([T.Row(**r) for r in records], schemas.ACCIDENTS)
    frame = frame.withColumn("date_occ", F.lit("2019-04-11").cast("timestamp"))
    first, second = accidents.format_accidents(frame).orderBy("dr_no").collect()
    assert (first.latitude, first.longitude, first.vict_age) == (34.1, None, None)
    assert str(first.datetime_iso) == "2019-04-11 05:40:00" and first.date_occ == date(2019, 4, 11)
    assert (first.vict_sex, first.vict_descent, first.location, first.premis_desc) == ("Unknown", "Unknown", "SATICOY_ST", None)
    assert first.mocodes == ["3004", "3026"] and second.mocodes == []
    assert second.datetime_iso is None and second.vict_descent is None


def test_bucketed_tables_meet_without_a_shuffle(spark, plan):
    for name in ("view_air_energy_weather_bucketed", "view_weather_energy_bucketed"):
        text = plan(checks.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "SortMergeJoin" in text and "Exchange" not in text


def test_bucketed_tables_are_replaced_and_keep_all_rows(spark, tmp_path, rows):
    frame = spark.createDataFrame([(None, 1), ("a", 2), ("a", 2), ("b", None)], "`k k` string, v long")
    for _ in range(2):
        stored = tables.write_bucketed(frame, "In_Buckets", ["k k"], 4, str(tmp_path / "b"))
    assert rows(stored) == rows(frame)
    assert tables.write_bucketed(frame.limit(0), "in_buckets", ["k k"], 4, str(tmp_path / "b")).count() == 0
    spark.sql("DROP TABLE in_buckets")
