"""Keyed tables: corrections, reruns, kills, untouched partitions."""

import os
import random

import pytest

from plumbline.sources.upsert import KeyedTable

SCHEMA = "`k 1` long, day string, v double, at int"


def keyed(spark, path):
    return KeyedTable(spark, str(path), ["k 1", "day"], ["day"])


def files_of(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path / "data") for n in names}


def test_batches_against_a_dictionary(spark, tmp_path, rows):
    dice, known, table = random.Random(1), {}, keyed(spark, tmp_path)
    for batch in range(4):
        drawn = [(dice.choice([None, *range(30)]), dice.choice(["a", "b/c d", None, "é"]), dice.random(), dice.randrange(5)) for _ in range(60)]
        for k, day, v, at in drawn:
            old = known.get((k, day))
            if old is None or (at, batch, v) >= (old[1], old[2], old[0]):
                known[k, day] = (v, at, batch)
        assert table.upsert(spark.createDataFrame(drawn, SCHEMA), f"week {batch}", "at")
    assert rows(table.read()) == sorted(((k, d, v, at) for (k, d), (v, at, _) in known.items()), key=repr)
    own = [(k, d, v, at) for (k, d), (v, at, _) in known.items() if d == "b/c d"]
    assert rows(table.read(day="b/c d")) == sorted(own, key=repr)
    assert {r[1] for r in table.read(day=None).collect()} == {None}


def test_killed_and_repeated_runs(spark, tmp_path, rows, monkeypatch):
    table = keyed(spark, tmp_path)
    table.upsert(spark.createDataFrame([(1, "a", 1.0, 1), (2, "b", 2.0, 1)], SCHEMA), "one")
    before = files_of(tmp_path)
    batch = spark.createDataFrame([(1, "a", 9.0, 1), (3, "a", 3.0, 1)], SCHEMA)

    def killed(self, manifest):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(KeyedTable, "_switch", killed)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(batch, "two")
    assert rows(table.read()) == [(1, "a", 1.0, 1), (2, "b", 2.0, 1)]
    assert table.upsert(batch, "two") and not table.upsert(batch, "two")
    wanted = [(1, "a", 9.0, 1), (2, "b", 2.0, 1), (3, "a", 3.0, 1)]
    assert rows(table.read()) == wanted
    # Only the touched partition was written; the files of the others are as they were.
    after = files_of(tmp_path)
    assert before.items() <= after.items()
    gone = table.remove_unused()
    assert "manifests/0000000001.json" in gone and rows(table.read()) == wanted
    manifest = table.manifest()
    assert sorted(s["folder"] for s in manifest["slots"].values()) == ["data/0000000001-one", "data/0000000002-two"]


def test_a_second_writer_is_refused(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(spark.createDataFrame([(1, "a", 1.0, 1)], SCHEMA), "one")
    old = table.manifest()
    table.upsert(spark.createDataFrame([(2, "a", 1.0, 1)], SCHEMA), "two")
    with pytest.raises(RuntimeError, match="another batch"):
        table._switch(old | {"version": 2})


def test_readers_keep_what_they_began_with(spark, tmp_path, rows):
    table = keyed(spark, tmp_path)
    table.upsert(spark.createDataFrame([(1, "a", 1.0, 1)], SCHEMA), "one")
    begun = table.read()
    table.upsert(spark.createDataFrame([(1, "a", 2.0, 1)], SCHEMA), "two")
    assert rows(begun) == [(1, "a", 1.0, 1)] and rows(table.read()) == [(1, "a", 2.0, 1)]


def test_empty_batches_and_other_columns(spark, tmp_path):
    table = keyed(spark, tmp_path)
    with pytest.raises(ValueError, match="nothing was written"):
        table.read()
    empty = spark.createDataFrame([], SCHEMA)
    assert table.upsert(empty, "none") and table.read().count() == 0
    with pytest.raises(ValueError, match="not those of the table"):
        table.upsert(empty.drop("v"), "less")
    with pytest.raises(ValueError, match="among the keys"):
        KeyedTable(spark, str(tmp_path), ["k 1"], ["day"])
