"""Benchmark decontamination through a distributed positional inverted index.

The index holds postings (term, document, position) of the corpus with the words around
each position. Of each benchmark window only the rarest term is looked up, by corpus
counts; its list is shifted by the term's place in the window and intersected, word by
word outwards, with what the window asks for at each offset. Native DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import broadcast_up_to, row_key, words
from plumbline.session import cut_lineage

#: Words of a window, and the share of hit words (one in ...) that contaminates.
WINDOW = 13
SHARE = 20
#: Most rows of benchmark terms, or places of them, that are broadcast; beyond it the joins shuffle.
BROADCAST_ROWS = 200_000
#: A proximity match holds this share of the different words around a rarest term.
NEAR_SHARE = 0.8


def token_table(docs: DataFrame) -> DataFrame:
    """Written once, read by each pass: key, doc_id, n_words, and the words in order."""
    keyed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), words(F.col("text")).alias("words"))
    return cut_lineage(keyed.withColumn("n_words", F.size("words").cast("long")))


def item_contents(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The different word sequences of the items (content, words), and (content, item_id)."""
    keyed = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    keyed = cut_lineage(keyed.where(F.size("words") > 0).withColumn("content", F.unhex(F.md5(F.array_join("words", " ")))))
    return keyed.groupBy("content").agg(F.first("words").alias("words")), keyed.select("content", "item_id").distinct()


def term_counts(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of ``terms`` occurs in the whole corpus."""
    small = broadcast_up_to(cut_lineage(terms), BROADCAST_ROWS)
    found = tokens.select(F.explode("words").alias("term")).join(small, "term", "left_semi")
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def around(seq: str, pos: str) -> tuple[Column, Column]:
    """The words before position ``pos`` (from 0), nearest first, and those behind it."""
    before = F.expr(f"reverse(slice({seq}, greatest({pos} - {WINDOW - 2}, 1), least({pos}, {WINDOW - 1})))")
    return before, F.expr(f"slice({seq}, {pos} + 2, {WINDOW - 1})")


def rarest_places(contents: DataFrame, tokens: DataFrame) -> DataFrame:
    """For each window its rarest term: (content, term, place, before, behind, needed).

    ``needed`` is the number of words of a window: 13, or all words of a shorter item.
    Neighbouring windows share their rarest term, so there are far fewer rows than windows.
    """
    contents = cut_lineage(contents)
    places = contents.select("content", "words", F.posexplode("words").alias("place", "term"))
    counts = term_counts(tokens, places.select("term").distinct())
    window = Window.partitionBy("content").orderBy("place").rowsBetween(0, WINDOW - 1)
    rank = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("place"), F.col("term"))
    ranked = places.drop("words").join(counts, "term", "left").withColumn("rarest", F.min(rank).over(window))
    sizes = contents.select("content", "words", F.least(F.size("words"), F.lit(WINDOW)).alias("needed"))
    chosen = (
        ranked.join(sizes.select("content", "needed", F.size("words").alias("n_item")), "content")
        .where(F.col("place") <= F.col("n_item") - F.col("needed"))
        .select("content", F.col("rarest.place").alias("place"), F.col("rarest.term").alias("term"))
        .distinct()
    )
    before, behind = around("words", "place")
    return cut_lineage(
        chosen.join(sizes, "content").select("content", "term", "place", "needed", before.alias("before"), behind.alias("behind"))
    )


def postings(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored positional index over ``terms``: (term, key, pos, before, behind)."""
    before, behind = around("words", "pos")
    places = tokens.select("key", "words", F.posexplode("words").alias("pos", "term"))
    found = places.join(broadcast_up_to(terms, BROADCAST_ROWS), "term", "left_semi")
    return cut_lineage(found.select("term", "key", "pos", before.alias("doc_before"), behind.alias("doc_behind")))


def run_length(ours: str, theirs: str) -> Column:
    """How many words agree from the first on."""
    same = f"zip_with({ours}, {theirs}, (a, b) -> a <=> b)"
    return F.expr(f"CASE WHEN array_position({same}, false) > 0 THEN array_position({same}, false) - 1 ELSE size({ours}) END")


def matches(index: DataFrame, places: DataFrame) -> DataFrame:
    """Lists shifted and intersected: (key, content, first, last, exact), where not ``exact`` is a proximity match."""
    joined = index.join(broadcast_up_to(places, BROADCAST_ROWS), "term")
    theirs = F.array_distinct(F.concat("before", F.array("term"), "behind"))
    ours = F.concat("doc_before", F.array("term"), "doc_behind")
    aligned = joined.select(
        "key",
        "content",
        "needed",
        "pos",
        run_length("doc_before", "before").alias("left"),
        run_length("doc_behind", "behind").alias("right"),
        (F.size(F.array_intersect(theirs, ours)) >= NEAR_SHARE * F.size(theirs)).alias("near"),
    )
    exact = F.col("left") + F.col("right") + 1 >= F.col("needed")
    found = aligned.withColumn("exact", exact).where("exact OR near")
    return found.select(
        "key", "content", (F.col("pos") - F.col("left")).alias("first"), (F.col("pos") + F.col("right")).alias("last"), "exact"
    ).distinct()


def covered(found: DataFrame) -> DataFrame:
    """Words of each document inside any of its matched stretches."""
    stretches = found.groupBy("key", "first").agg(F.max("last").alias("last"))
    earlier = Window.partitionBy("key").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    start = F.greatest(F.col("first"), F.coalesce(F.max("last").over(earlier) + 1, F.lit(0)))
    counted = stretches.withColumn("n", F.greatest(F.lit(0), F.col("last") - start + 1))
    return counted.groupBy("key").agg(F.sum("n").cast("long").alias("n_hit"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """How much of each document repeats benchmark items.

    One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and
    n_near (items with a proximity match). Rows equal in id and text get equal results; rows
    that share an id but not the text are judged each by its text. A NULL or empty text has
    no words and is clean; NULL, empty or repeated items are skipped or count each by its
    id. Empty tables give no rows, or clean ones. Other columns are ignored.
    """
    tokens = token_table(docs)
    contents, members = item_contents(benchmark)
    places = rarest_places(contents, tokens)
    index = postings(tokens, cut_lineage(places.select("term").distinct()))
    found = cut_lineage(matches(index, places))
    exact = found.where("exact")
    item_rows = found.groupBy("key", "content").agg(F.max("exact").alias("exact")).join(members, "content")
    items = (
        item_rows.groupBy("key", "item_id")
        .agg(F.max("exact").alias("exact"))
        .groupBy("key")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item_id")))).alias("ids"),
            F.count(F.lit(1)).alias("n_near"),
        )
    )
    hits = items.join(covered(exact), "key", "left")
    return (
        tokens.select("doc_id", "key", "n_words")
        .join(hits, "key", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
            F.coalesce((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")), F.lit(False)).alias("contaminated"),
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "key",
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are clean, with the columns of ``docs``."""
    bad = contamination(docs, benchmark).where("contaminated").select(F.col("key").alias("__bad")).distinct()
    bad = broadcast_up_to(cut_lineage(bad), BROADCAST_ROWS)
    return docs.join(bad, row_key(F.col("doc_id"), F.col("text")) == F.col("__bad"), "left_anti")


SQL = r"""
WITH abc AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS hi, 'abcdefghijklmnopqrstuvwxyz' AS lo),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), hi, lo), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents, abc),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
             regexp_extract_all(translate(coalesce(text, ''), hi, lo), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark, abc),
il AS (SELECT item_id, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS gram
       FROM (SELECT item_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS s FROM il)),
dw AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS gram
       FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS s
             FROM d, (SELECT DISTINCT n FROM iw))),
m AS (SELECT doc_id, s, n, item_id FROM dw JOIN iw USING (n, gram)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY 1),
k AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
      FROM m GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)
"""
