"""Exact deduplication against a persistent index of digests."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import broadcast_up_to, normalised_digest, row_key
from plumbline.session import cut_lineage, scratch_path

#: A digest held by more than one row in HOT_SHARE counts as hot. At most HOT_SHARE digests
#: can be hot, which bounds the broadcast of them.
HOT_SHARE = 1024
#: Rows of keys that are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 2_000_000


class DigestIndex:
    """Digests of all texts seen so far, in a table bucketed and sorted by digest.

    The table lies at ``path``, which all executors must reach, and outlives the session:
    a later session opens the same path. Appending writes new files only.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, doc_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        )

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, entries: DataFrame) -> None:
        """Add (digest, doc_id) rows; each bucket gets one new sorted file."""
        (
            entries.select("digest", "doc_id")
            .repartition(self.buckets, "digest")
            .write.bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .mode("append")
            .saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)

    def add(self, docs: DataFrame) -> DataFrame:
        """Decide on each row of ``docs`` and append the digests that are new.

        One row per input row: doc_id, keep_id (the row of equal text that stays: the one
        in the index, or else the smallest doc_id of this batch), group_size (rows of this
        batch with that text), kept, text_sha256, n_first (rows of this batch with that text
        that carry keep_id: above 1 only where rows are repeated), key. A NULL text counts as empty. A NULL
        doc_id is never the smallest; if a text has only such rows, keep_id is NULL and
        they count as kept. An empty table gives an empty result. Other columns are ignored.
        """
        key = row_key(F.col("doc_id"), F.col("text")).alias("key")
        rows = cut_lineage(docs.select("doc_id", key, normalised_digest(F.col("text")).alias("digest")))
        per_id = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
        order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
        groups = cut_lineage(
            per_id.groupBy("digest").agg(
                F.min_by("doc_id", order).alias("first_id"),
                F.min_by("n", order).alias("n_first"),
                F.sum("n").alias("group_size"),
            )
        )
        fresh = groups.hint("merge").join(self.entries(), "digest", "left_anti")
        self.append(fresh.select("digest", F.col("first_id").cast("bigint").alias("doc_id")))
        known = self.entries().select("digest", F.col("doc_id").alias("keep_id"))
        decided = groups.join(known.hint("merge"), "digest").drop("first_id")
        hot_size = rows.count() / HOT_SHARE
        is_hot = F.col("group_size") > hot_size
        hot = F.broadcast(decided.where(is_hot))
        result = rows.join(hot, "digest").unionByName(
            rows.join(F.broadcast(groups.where(is_hot).select("digest")), "digest", "left_anti").join(decided.where(~is_hot), "digest")
        )
        return result.select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "n_first",
            "key",
        )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Decisions for a corpus by itself, through a new index in the shared folder."""
    spark = docs.sparkSession
    return DigestIndex(spark, scratch_path(spark, "digests")).add(docs)


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``.

    Of repeated rows, equal in id and normalised text, one stays.
    """
    decided = exact_duplicates(docs)
    return without_rows(
        docs,
        dropped=decided.where("NOT kept").select("key"),
        repeated=decided.where("kept AND n_first > 1").select("key"),
        same=normalised_digest(F.col("text")),
    )


def without_rows(docs: DataFrame, dropped: DataFrame, repeated: DataFrame, same: Column) -> DataFrame:
    """``docs`` without rows of the ``dropped`` keys, and with one row of each doc_id and ``same`` of the ``repeated`` ones."""
    dropped = broadcast_up_to(cut_lineage(dropped.select(F.col("key").alias("__gone")).distinct()), BROADCAST_ROWS)
    repeated = broadcast_up_to(cut_lineage(repeated.select(F.col("key").alias("__gone")).distinct()), BROADCAST_ROWS)
    keyed = docs.withColumn("__key", row_key(F.col("doc_id"), F.col("text")))
    left = keyed.join(dropped, F.col("__key") == F.col("__gone"), "left_anti")
    once = left.join(repeated, F.col("__key") == F.col("__gone"), "left_anti").drop("__key")
    again = left.join(repeated, F.col("__key") == F.col("__gone"), "left_semi").drop("__key")
    again = again.withColumn("__same", same).dropDuplicates(["doc_id", "__same"]).drop("__same")
    return once.unionByName(again)


SQL = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, digest AS text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS digest FROM documents)
WINDOW same AS (PARTITION BY digest)
"""
