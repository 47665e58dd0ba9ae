"""Spelling variants against every single edit of every word."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from plumbline.llm import spellings

SF = "/root/testdata/sf0.01"


def found(frame, least=5):
    return {r[0]: tuple(r[1:]) for r in spellings.group_variants(frame, least_count=least).collect()}


@pytest.mark.parametrize(("seed", "letters"), [(1, "ab"), (2, "abcdé"), (3, "aaab")])
def test_small_alphabets(spark, seed, letters):
    """Few letters: chunks that stand at many places, and ties of counts."""
    dice = random.Random(seed)
    pool = ["".join(dice.choice(letters) for _ in range(dice.randint(5, 9))) for _ in range(120)]
    rows = [(i, " ".join(dice.choice(pool[: dice.choice([3, 12, 120])]) for _ in range(60))) for i in range(40)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (50, None), (51, ""), (52, "Ab" * 3000 + " " + "x" * 30_000)]
    frame = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    wanted = brute.spellings(rows, spellings.TYPO_EVERY, 2)
    assert found(frame, 2) == wanted
    assert any(form for form, *_ in wanted.values())


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs) == brute.spellings(rows, spellings.TYPO_EVERY, 5)


def test_empty_tables(spark):
    assert spellings.group_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chains_end_at_their_root(spark):
    links = [(f"w{k}", f"w{k + 1}") for k in range(20)] + [("a", "w20"), ("b", "w3")]
    ends = {r["word"]: r["root"] for r in spellings.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert ends == {word: "w20" for word, _ in links}


def test_one_edit_leaves_a_pair_of_chunks(spark):
    dice = random.Random(6)
    pairs = []
    for _ in range(400):
        word = "".join(dice.choice("abc") for _ in range(dice.randint(6, 13)))
        k, kind = dice.randrange(len(word) + 1), dice.choice("idr")
        other = {"i": word[:k] + "x" + word[k:], "d": word[:k] + word[k + 1 :], "r": word[:k] + "y" + word[k + 1 :]}[kind]
        pairs.append((word, other))
    frame = spark.createDataFrame(pairs, "a string, b string").where(F.levenshtein("a", "b") == 1)
    length = F.length("a")
    shared = F.arrays_overlap(spellings.chunk_pairs(F.col("a"), length), spellings.chunk_pairs(F.col("b"), length))
    assert frame.where(~shared).count() == 0
