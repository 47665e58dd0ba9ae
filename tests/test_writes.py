"""Counts taken in flight, the empty gate by one job, and compaction of small files only."""

import os
import time

import pytest
from pyspark.sql import functions as F

from plumbline import session
from plumbline.checks import source_queries
from plumbline.columns import col
from plumbline.operators import clean, observed, profile
from plumbline.sources import landing, tables


@pytest.fixture
def jobs(spark):
    """How many jobs a call runs."""

    def count(call):
        group = f"count-{os.urandom(4).hex()}"
        spark.sparkContext.setJobGroup(group, "counted")
        try:
            call()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    return count


def test_counts_in_flight_are_those_of_the_report(spark, tmp_path, rows):
    frame = spark.range(300).select((col("id") % 90).alias("k"), F.when(col("id") % 4 > 0, 1).alias("a"), F.when(col("id") % 3 > 0, 1).alias("b"))
    for given in (frame, frame.limit(0), frame.where("k < 0"), frame.where("false")):
        counter = observed.RowCounts()
        unique = counter.watch("duplicates", clean.dedup(counter.watch("input", given), ["k"], ["a", "b"]))
        counter.watch("sparse", clean.drop_sparse_rows(unique, 0.5, ["a", "b"])).write.mode("overwrite").parquet(str(tmp_path / "out"))
        plain = clean.dedup(given, ["k"], ["a", "b"])
        steps = [("duplicates", plain), ("sparse", clean.drop_sparse_rows(plain, 0.5, ["a", "b"]))]
        assert rows(counter.removals(spark)) == rows(profile.removal_report(given, steps))


def test_the_gate_runs_what_a_write_runs(spark, tmp_path, jobs):
    frame = spark.range(50).select("id", (col("id") % 2).alias("part"))
    gated = jobs(lambda: tables.write_if_any(frame.repartition(2), "gated", path=str(tmp_path / "g")))
    assert gated == jobs(lambda: frame.repartition(2).write.parquet(str(tmp_path / "plain")))
    assert os.listdir(tmp_path) != [] and spark.table("gated").count() == 50


@pytest.mark.parametrize("options", [{}, {"partition_by": ["part"]}, {"mode": "append"}])
@pytest.mark.parametrize("placed", [True, False])
def test_empty_frames_change_nothing(spark, tmp_path, rows, options, placed):
    name = f"gate_{len(options)}_{placed}_{options.get('mode', 'o')}"
    options = options | ({"path": str(tmp_path / "t")} if placed else {})
    frame = spark.range(6).select("id", (col("id") % 2).alias("part"))
    nothing = (frame.where("id > 9"), frame.where("false"), frame.limit(0))
    for empty in nothing:
        assert not tables.write_if_any(empty, name, **options) and not spark.catalog.tableExists(name)
    try:
        assert tables.write_if_any(frame, name, **options)
        for empty in nothing:
            assert not tables.write_if_any(empty, name, **options)
            assert rows(spark.table(name)) == [(i, i % 2) for i in range(6)]
        again = frame.where("part = 1").withColumn("id", col("id") + 100)
        assert tables.write_if_any(again, name, **options)
        old = [(i, i % 2) for i in range(6)] if "mode" in options else [(i, 0) for i in (0, 2, 4)] if "partition_by" in options else []
        assert rows(spark.table(name).select("id", "part")) == sorted([*old, (101, 1), (103, 1), (105, 1)], key=repr)
        if placed:
            assert sorted(os.listdir(tmp_path)) == ["t"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def parts(path):
    return {f"{d}/{f}": (os.path.getsize(f"{d}/{f}"), os.stat(f"{d}/{f}").st_mtime_ns) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def small_table(spark, path):
    frame = spark.range(4_000).select("id", F.when(col("id") % 3 > 0, F.concat(F.lit("a b/"), col("id") % 3)).alias("p p"), F.sha2(col("id").cast("string"), 256).alias("t"))
    frame.where("id < 3000").repartition(1).write.partitionBy("p p").parquet(path)
    frame.where("id >= 3000 AND `p p` IS NOT NULL").repartition(5).write.mode("append").partitionBy("p p").parquet(path)
    frame.where("id >= 3000 AND `p p` IS NULL").repartition(1).write.mode("append").partitionBy("p p").parquet(path)


def test_only_small_files_are_merged(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    small_table(spark, path)
    wanted, before = rows(spark.read.parquet(path).select("id", "t", "p p")), parts(path)
    limit = max(s for s, _ in before.values()) // 2
    large = {f: s for f, s in before.items() if s[0] >= limit}
    assert len(large) == 3 and len(before) == 14
    assert landing.compact_small_files(spark, path, ["p p"], limit) == 10
    after = parts(path)
    assert large.items() <= after.items()
    # Two merged files came, and the lone small file of the third partition stayed.
    assert len(after) == 6 and len(before.keys() & after.keys()) == 4
    assert rows(spark.read.parquet(path).select("id", "t", "p p")) == wanted
    assert landing.compact_small_files(spark, path, ["p p"], 100) == 0 and parts(path) == after
    assert not [n for n in os.listdir(path) if n.startswith("_") and n != "_SUCCESS"]


@pytest.mark.parametrize("moment", ["journal", "delete", "switch"])
def test_a_killed_compaction_is_finished(spark, tmp_path, rows, monkeypatch, moment):
    path = str(tmp_path / "t")
    small_table(spark, path)
    wanted, before = rows(spark.read.parquet(path).select("id", "t", "p p")), parts(path)
    limit = max(s for s, _ in before.values()) // 2

    def killed(*_):
        raise KeyboardInterrupt

    finish = landing._finish_compaction
    with monkeypatch.context() as patched:
        if moment == "journal":
            patched.setattr(landing, "_write_text", killed)
        else:
            patched.setattr(landing, "_finish_compaction", lambda s, p: finish(s, p) if not os.path.exists(f"{p}/{landing.JOURNAL}") else killed())
        with pytest.raises(KeyboardInterrupt):
            landing.compact_small_files(spark, path, ["p p"], limit)
    if moment == "switch":
        first = next(f for f, s in before.items() if s[0] < limit and "HIVE" not in f)
        os.remove(first)
    assert landing.compact_small_files(spark, path, ["p p"], limit) == 10
    assert rows(spark.read.parquet(path).select("id", "t", "p p")) == wanted


def test_files_to_compact_are_written_by_many_tasks(spark, monkeypatch, rows, tmp_path):
    """Neither the large nor the small files of the query go through a fixed number of tasks."""
    path = str(tmp_path / "lineitem.parquet")
    lines = spark.range(4_000).select(
        col("id").alias("l_orderkey"), (col("id") % 7 + 1).alias("l_linenumber"), F.rand(1).alias("l_quantity"), F.lit("A").alias("l_returnflag"), F.current_timestamp().alias("l_shipdate")
    )
    lines.write.parquet(path)
    monkeypatch.setattr(source_queries, "LARGE_ROWS", 1_000)
    monkeypatch.setattr(source_queries, "SMALL_ROWS", 400)
    written = []

    def compact(session, place, *_):
        written.extend(parts(place))
        return landing_step(session, place, *_)

    landing_step = landing.compact_small_files
    monkeypatch.setattr(landing, "compact_small_files", compact)
    found = source_queries.compact_small_files(spark, str(tmp_path))
    assert len(written) == 4 + 10
    assert rows(found, "l_orderkey", "l_linenumber") == rows(spark.read.parquet(path), "l_orderkey", "l_linenumber")


def test_cut_lineage_leaves_no_shuffle_files(spark):
    def files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in manager.getAllFiles().mkString(",").split(",") if "shuffle_" in f}

    before, setting = files(), spark.conf.get(session.SHUFFLE_CLEANUP, None)
    counted = session.cut_lineage(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count())
    joined = session.cut_lineage(counted.join(counted.withColumnRenamed("count", "n").hint("merge"), "k"))
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == setting
    assert joined.agg(F.sum("n")).first()[0] == 10_000
