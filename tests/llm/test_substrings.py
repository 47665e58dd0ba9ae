"""Repeated passages against all windows counted."""

import random

import brute
import numpy as np
import pytest

from plumbline.llm import substrings

SF = "/root/testdata/sf0.01"


def own_rows(found):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found.collect()), key=repr)


def expected(rows, window):
    return sorted(((i, *found) for (i, _), found in zip(rows, brute.without_repeats([t for _, t in rows], window))), key=repr)


def passages(seed: int) -> list[tuple[int, str | None]]:
    """Texts that share passages of all lengths, periodic ones, copies, and a passage in half of them."""
    dice = random.Random(seed)
    def words(n, of=400):
        return [f"w{dice.randrange(of)}" for _ in range(n)]
    pool, hot = [words(n) for n in (4, 5, 6, 7, 9, 14, 30)], words(20)
    rows = []
    for i in range(80):
        text = []
        for _ in range(dice.randint(0, 6)):
            text += words(dice.randint(0, 8)) + dice.choice(pool)[dice.randint(0, 2) :]
        if i % 2:
            text += words(2) + hot
        rows.append((i, dice.choice([" ", "  ", "\n"]).join(text)))
    rows += [(100, "a " * 40), (101, "a b " * 9), (102, None), (103, ""), (104, " \t"), (105, rows[3][1]), (3, rows[3][1]), (3, "x y z")]
    rows += [(None, rows[5][1]), (None, None), (106, "é " * 4 + " ".join(hot)), (107, "a b \x1c c " * 7)]
    return rows


@pytest.mark.parametrize("most_places", [3, 10_000])
@pytest.mark.parametrize(("window", "gram"), [(7, 3), (7, 7), (8, 1)])
def test_all_repeated_windows_go(spark, monkeypatch, most_places, window, gram):
    monkeypatch.setattr(substrings, "MOST_PLACES", most_places)
    rows = passages(window + gram)
    frame = spark.createDataFrame([(i, t, 1, "k", 0) for i, t in rows], "doc_id long, text string, row int, anchor string, n long")
    assert own_rows(substrings.substring_duplicates(frame, window, gram)) == expected(rows, window)


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert own_rows(substrings.substring_duplicates(frame)) == expected(rows, 35)


def test_blocks_are_parsed_across_batches(spark):
    rows = passages(11)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        assert own_rows(substrings.substring_duplicates(frame, 7, 3)) == expected(rows, 7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_texts_without_repeats_keep_columns_and_spaces(spark):
    long_one = " ".join(f"u{k}" for k in range(50))
    rows = [(1, "a  b", "x"), (2, long_one + " tail", "y"), (3, "head " + long_one, "z"), (4, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    found = substrings.drop_repeated_passages(frame)
    assert found.columns == frame.columns
    assert sorted(map(tuple, found.collect())) == [(1, "a  b", "x"), (2, "tail", "y"), (3, "head", "z"), (4, None, None)]
    assert substrings.drop_repeated_passages(frame.limit(0)).count() == 0


def test_factors_end_where_the_reference_ends():
    windows = np.array([1, 2, 3, 9, 1, 2, 8, 3, 1, 2, 3])
    piece = np.array([0, 0, 0, 0, 1, 1, 1, 1, 2, 2, 2])
    starts, lengths = substrings.factors(np.zeros(11, dtype=np.int64), windows, piece)
    assert list(zip(starts.tolist(), lengths.tolist())) == [(0, 2), (2, 1), (4, 2), (7, 1), (8, 3)]


def test_least_places_are_the_first():
    dice = np.random.default_rng(2)
    values = dice.integers(0, 6, 300).astype(np.uint64)
    for width in (1, 2, 5, 8, 24):
        wanted = [k + int(values[k : k + width].argmin()) for k in range(301 - width)]
        assert substrings.least_places(values, width).tolist() == wanted
