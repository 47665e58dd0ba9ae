"""Exact selection against sorted rows: odd values, ties, groups, and no task that holds a group."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plumbline.columns import col
from plumbline.operators import impute, ordered, selection, series


def rank_key(x):
    return (x is not None, isinstance(x, float) and math.isnan(x), x if x is not None and x == x else 0)


def chosen(frame, ranks, order, by=()):
    keys = [col(b) for b in by]
    groups = frame.select(*keys).distinct() if by else frame.sparkSession.range(1).select()
    listed = F.explode(F.array(*[F.lit(r) for r in ranks])).alias("__which")
    targets = groups.select(*keys, listed).withColumn("__rank", col("__which").cast("long"))
    return selection.kth_rows(frame, targets, order, by).collect()


@pytest.mark.parametrize("bits", [3, 13])
@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("double", [0.0, -0.5, 1e308, -1e308, 5e-324, float("inf"), float("-inf"), float("nan"), None, 2.5]),
        ("long", [0, -1, 2**63 - 1, -(2**63), 2**53, 2**53 + 1, None, 7]),
        ("string", ["", "a", "ab", "abc", "b", "\u00e9", "\U0001f600", "zz", None, "abd", "ab\u0000"]),
        ("boolean", [True, False, None]),
    ],
)
def test_every_rank_of_odd_values(spark, monkeypatch, bits, kind, values):
    monkeypatch.setattr(selection, "BIN_BITS", bits)
    monkeypatch.setattr(selection, "ENOUGH", 1)
    dice = random.Random(bits)
    drawn = values + [dice.choice(values) for _ in range(30)]
    frame = spark.createDataFrame([(v,) for v in drawn], f"v {kind}")
    wanted = sorted(drawn, key=rank_key)
    found = {r["__which"]: r for r in chosen(frame, range(0, len(drawn) + 2), ["v"])}
    assert sorted(found) == list(range(1, len(drawn) + 1))
    for rank, row in found.items():
        value = wanted[rank - 1]
        value = int(value) if kind == "boolean" and value is not None else value
        assert row["__k0"] == value or (value != value and row["__k0"] != row["__k0"])
        first = min(i for i, w in enumerate(wanted) if rank_key(w) == rank_key(wanted[rank - 1]))
        assert (row["__rank"], row["__same"]) == (rank - first, sum(rank_key(w) == rank_key(wanted[rank - 1]) for w in wanted))


def test_ranks_by_several_columns_and_groups(spark):
    dice = random.Random(3)
    rows = [(dice.choice(["x", "y", None]), dice.choice([1.5, None, -2.0]), dice.choice("abc"), i) for i in range(400)]
    frame = spark.createDataFrame(rows, "`a b` string, v double, t string, id long")
    for row in chosen(frame, [1, 7, 100], ["v", "t", "id"], ["a b"]):
        own = sorted((r for r in rows if r[0] == row["a b"]), key=lambda r: (rank_key(r[1]), r[2], r[3]))
        assert (row["__k0"], row["__k1"], row["__k2"]) == own[row["__which"] - 1][1:]


@pytest.mark.parametrize("series", [[], ["s"]])
def test_cut_is_the_split_by_positions(spark, rows, series):
    dice = random.Random(9)
    drawn = [(dice.choice(["p", "q", None]), dice.choice([None, 1, 2, 3]), dice.choice(["k", "l", None]), i, None) for i in range(333)]
    frame = spark.createDataFrame(drawn, "s string, t long, k string, id long, other map<string,int>")
    cut = selection.chronological_cut(frame, "t", ["k"], series, train=0.6, validation=0.3)
    split = ordered.chronological_split(frame, "t", ["k"], series, train=0.6, validation=0.3)
    assert rows(cut, "id", "part") == rows(split, "id", "part")
    assert cut.columns == split.columns


def test_cuts_of_few_rows(spark, rows):
    frame = spark.createDataFrame([(1, 5)], "t long, id long")
    assert rows(selection.chronological_cut(frame, "t", ["id"]), "part") == [(None,)]
    assert selection.chronological_cut(frame.limit(0), "t", ["id"]).count() == 0
    alike = spark.createDataFrame([(1, 1)] * 10, "t long, id long")
    assert rows(selection.chronological_cut(alike, "t", ["id"], train=0.5), "part") == [("train",)] * 10


def test_medians(spark, rows):
    frame = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", None), (None, 9.0), (None, None)], "g string, `v.v` double")
    assert rows(impute.impute_numeric(frame, by=["g"], default=-1.0)) == [("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", -1.0), (None, 9.0), (None, 9.0)]


def test_no_task_holds_a_group(spark, plan):
    frame = spark.range(50_000).select((col("id") % 3).alias("g"), F.rand(1).alias("v"), "id")
    for made in (selection.chronological_cut(frame, "v", ["id"]), impute.impute_numeric(frame, ["v"], by=["g"]), selection.quantiles(frame, ["v"], [0.5])):
        text = plan(made)
        assert "SinglePartition" not in text and "percentile" not in text and "Window" not in text


def test_pivots_refuse_to_find_endless_columns(spark, monkeypatch):
    frame = spark.range(6).select((col("id") % 2).alias("t"), col("id").cast("string").alias("k"), "id")
    assert len(series.pivot_wide(frame, ["t"], "k", "id", ["id"]).columns) == 7
    monkeypatch.setattr(series, "MOST_COLUMNS", 5)
    with pytest.raises(ValueError, match="more than 5 values of k"):
        series.pivot_wide(frame, ["t"], "k", "id", ["id"])


def test_a_long_series_is_split_over_tasks(spark, rows, monkeypatch, plan):
    """Without a layout too, and into more chunks than asked for where they would be long."""
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 100)
    frame = spark.range(2_000).select("id", (F.col("id") % 500).alias("t"), F.lit("a").alias("s"))
    split = ordered.chronological_split(frame, "t", ["id"], ["s"])
    whole = ordered.chronological_split(frame, "t", ["id"], ["s"], layout=ordered.WHOLE)
    assert rows(split) == rows(whole)
    assert "hashpartitioning(__chunk" in plan(split) and "hashpartitioning(s#" not in plan(split)
    written, dealt = ordered.chunked(frame, ["s"], ["t", "id"], ordered.Layout(True, 3))
    assert dealt.rdd.getNumPartitions() == 20
    assert written.groupBy(ordered.CHUNK).count().agg(F.max("count")).first()[0] < 300
