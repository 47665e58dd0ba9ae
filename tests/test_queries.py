"""Every registered query against its SQL, and the shape of its plan."""

import os

import __spark_entry__ as entry
import compare
import pytest
from pyspark.sql import functions as F

from plumbline import checks
from plumbline.columns import join_few
from plumbline.operators import impute, ordered, stats
from plumbline.operators.ordered import Layout
from plumbline.session import scratch_scope, shared_dir

SF_DIR = "/root/testdata/sf0.01"
#: Fits of full size: they agree with their SQL too, but take minutes.
MODEL_FITS = {"gbt_regression", "rf_classifier"}
NAMES = [n for n in checks.queries() if n not in MODEL_FITS]


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, connection, name):
    with scratch_scope(spark):
        assert compare.difference(spark, connection, SF_DIR, name) is None


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith("trusted") and "chain" not in n and n != "feature_importance"])
def test_plan_has_no_cross_join(spark, plan, name):
    text = plan(checks.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_every_query_has_sql():
    assert set(checks.oracle_sql()) == set(checks.queries())
    assert set(checks.queries()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_few_groups_never_move_the_big_side(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("g"), F.col("id").cast("double").alias("v"))
        frames = [
            impute.impute_numeric(big, ["v"], "mean", by=["g"]),
            impute.impute_group_mean(big, ["v"], ["g"]),
            stats.add_class_weight(big, "g"),
            join_few(big, big.groupBy("g").agg(F.max("v").alias("m")), ["g"]),
        ]
        for frame in frames:
            text = plan(frame)
            assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_split_form_has_one_shuffle_of_the_rows(spark, plan):
    frame = spark.range(1000).select("id", (F.col("id") % 3).alias("s"), F.col("id").cast("double").alias("v"))
    filled = ordered.neighbours(frame, ["v"], ["id"], ["s"], layout=Layout(True, 4))
    text = plan(filled)
    assert text.count("hashpartitioning(__chunk") <= 2  # the rows once, their edges once


def test_scratch_tables_go_with_their_scope(spark, tmp_path):
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    with scratch_scope(spark):
        checks.queries()["impute_interpolate_split"](spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "out"))
        assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) > before
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) == before
