"""What the text operators share: words, digests, tables, and broadcasts of a checked size."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a word is. Letters and digits of ASCII and every character beyond it.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed value: white space.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text; of a NULL text none."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def normalised_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of white space as one space; NULL counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "), 256))


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that name a row by its id and its text, so that rows which share an id stay apart.

    Rows that agree in both are the same document and get the same results.
    """
    shown = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.concat(shown, F.lit(" "), F.coalesce(text, F.lit("")))))


def broadcast_up_to(small: DataFrame, most_rows: int) -> DataFrame:
    """``small`` with a broadcast hint if it has at most ``most_rows`` rows, else as it is.

    ``small`` should be a written table, as it is counted. Without the hint the join
    shuffles, and adaptive execution splits its skewed partitions.
    """
    return F.broadcast(small) if small.limit(most_rows + 1).count() <= most_rows else small
