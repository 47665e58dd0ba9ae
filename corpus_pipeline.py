"""A corpus pipeline of text operators: each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import catalog, decontaminate, exact_dedup, jaccard_join, toxicity
from plumbline.llm.common import table
from plumbline.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic, by a model learned from the labels."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(~toxicity.toxic_rows(docs, model))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, up to white space, the document with the smallest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by Jaccard similarity, the document with the smallest id."""
    return jaccard_join.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not repeat the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return catalog.token_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", tokenize),
]

#: The toxicity scores have no SQL form; the tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token digests of the documents that all stages keep.

    A NULL or empty text is scored like any text, and of several one stays; repeated rows
    count as copies. An empty table gives no rows. Each stage is written before the next reads it.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
