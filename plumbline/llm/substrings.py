"""Removal of repeated passages by relative Lempel-Ziv parsing against reference blocks.

The corpus is its own reference, cut into blocks so that whatever repeats meets in one
block: every window of 35 words belongs to the anchor with the smallest hash among its runs
of 12 words, equal windows have equal anchors, and a block holds all text around its anchors.
A document is thus factored against every block that can hold a factor of it; anchors found
at one place of the corpus are dropped first, by counts.

In a block the windows are indexed. Each stretch of text is factored greedily: from a window
with another place in the reference, the factor goes on as long as the reference does. Where
it ends, and at each window up to the next factor, the index is asked anew, so that what
straddles a boundary is found too. All factors are at least a window long; their words go.

Windows are compared by two independent 64-bit hashes, the anchor's and their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import broadcast_up_to, row_key
from plumbline.llm.portions import portions
from plumbline.session import cut_lineage

#: Fixed value: words of a window.
WINDOW = 35
#: Words of an anchor.
GRAM = 12
#: An anchor at more places is no block: its windows are spread over all tasks.
MOST_PLACES = 1_000
#: A key held by more than one row in HOT_SHARE is joined by broadcast; at most HOT_SHARE keys can be.
HOT_SHARE = 1024
#: Most rows of anchors that are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
#: Odd multipliers of the rolling hashes.
WINDOW_BASE, ANCHOR_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that leaves no order."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Hash of every run of ``size`` numbers, by differences of a running sum modulo 2**64."""
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(hashes), base)]))
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(hashes), np.uint64(pow(int(base), -1, 1 << 64)))]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(hashes * power[:-1])])
    return mixed((total[size:] - total[:-size]) * back[: len(hashes) - size + 1])


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value among each ``width`` neighbours, by doubling."""

    def better(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[left] <= values[right], left, right)

    n, place, size = len(values) - width + 1, np.arange(len(values)), 1
    while 2 * size <= width:
        place = better(place[:-size], place[size:])
        size *= 2
    return better(place[:n], place[width - size :][:n])


class Windows:
    """The windows of some texts and their anchors: one entry per piece, the windows in a row of one anchor place."""

    def __init__(self, texts: list[bytes], window: int, gram: int):
        self.words = [text.split() for text in texts]
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        n = int(sizes.sum())
        self.anchor = self.doc = self.start = self.size = np.zeros(0, dtype=np.int64)
        if n < window:
            return
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(self.words)), dtype=np.uint64, count=n)
        doc = np.repeat(np.arange(len(texts)), sizes)
        first = np.cumsum(sizes) - sizes
        grams = rolling(mixed(hashes), gram, ANCHOR_BASE)
        at = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
        place = least_places(grams, window - gram + 1)[at]
        new = np.flatnonzero(np.diff(place, prepend=-1))
        self.hashes = rolling(hashes, window, WINDOW_BASE)[at].view(np.int64)
        self.anchor = grams[place[new]].view(np.int64)
        self.doc = doc[at[new]]
        self.start = at[new] - first[self.doc]
        self.first = new
        self.size = np.diff(new, append=len(at))


def row_id() -> Column:
    return row_key(F.col("doc_id"), F.col("text")).alias("row")


def texts_of(batch: pa.RecordBatch) -> list[bytes]:
    return [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]


def summaries(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(row, doc_id, content, n_words, anchors): the digest of the words joined by one space, and an anchor per place."""
    schema = "row binary, content binary, n_words long, anchors array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for start, end in portions(texts):
                found = Windows(texts[start:end], window, gram)
                cuts = np.searchsorted(found.doc, np.arange(end - start + 1))
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": batch.column("row").slice(start, end - start),
                        "content": pa.array([hashlib.sha256(b" ".join(w)).digest() for w in found.words], pa.binary()),
                        "n_words": pa.array([len(w) for w in found.words], pa.int64()),
                        "anchors": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found.anchor)),
                        "doc_id": batch.column("doc_id").slice(start, end - start),
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", row_id(), "text").mapInArrow(run, f"{schema}, doc_id {kind}")


def split_join(left: DataFrame, right: DataFrame, keys: list[str], is_hot: Column, most_rows: int) -> DataFrame:
    """Inner join; the hot keys of ``right``, if few enough, by broadcast and the others by shuffle."""
    hot = broadcast_up_to(cut_lineage(right.where(is_hot)), most_rows)
    others = left.join(hot.select(*keys), keys, "left_anti").join(right.where(~is_hot), keys)
    return left.join(hot, keys).unionByName(others)


def repeated_anchors(references: DataFrame) -> DataFrame:
    """(row, cold, hot): of each reference document its anchors that stand at several places of the corpus."""
    places = cut_lineage(references.select("row", F.explode("anchors").alias("anchor")))
    counts = places.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = cut_lineage(counts.select("anchor", (F.col("n") > MOST_PLACES).alias("hot")))
    found = split_join(places, repeated, ["anchor"], F.col("hot"), BROADCAST_ROWS)
    listed = F.collect_set(F.when(~F.col("hot"), F.col("anchor"))), F.collect_set(F.when(F.col("hot"), F.col("anchor")))
    return found.groupBy("row").agg(listed[0].alias("cold"), listed[1].alias("hot"))


def pieces(docs: DataFrame, wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, row, start, hot, windows): the windows around the wanted anchors, packed as 64-bit numbers."""
    schema = "anchor long, row binary, start int, hot boolean, windows binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            lists = {name: batch.column(name) for name in ("cold", "hot")}
            for start, end in portions(texts):
                found = Windows(texts[start:end], window, gram)
                cuts = np.searchsorted(found.doc, np.arange(end - start + 1))
                kept, hot = np.zeros(len(found.anchor), dtype=bool), np.zeros(len(found.anchor), dtype=bool)
                for k in range(end - start):
                    own = slice(cuts[k], cuts[k + 1])
                    hot[own] = np.isin(found.anchor[own], lists["hot"][start + k].values.to_numpy())
                    kept[own] = hot[own] | np.isin(found.anchor[own], lists["cold"][start + k].values.to_numpy())
                chosen = np.flatnonzero(kept)
                packed = [found.hashes[a : a + n].tobytes() for a, n in zip(found.first[chosen], found.size[chosen])] if len(chosen) else []
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": found.anchor[chosen],
                        "row": batch.column("row").take(pa.array(found.doc[chosen] + start)),
                        "start": found.start[chosen].astype(np.int32),
                        "hot": hot[chosen],
                        "windows": pa.array(packed, pa.binary()),
                    }
                )

    joined = docs.select(row_id(), "text").join(wanted, "row")
    return joined.select("row", "text", "cold", "hot").mapInArrow(run, schema)


def factors(anchor: np.ndarray, windows: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and length, in windows, of the factors of a block's text.

    ``piece`` numbers the stretch of each window. A window's reference is the first other
    place of the block with that window; a factor ends where the next reference is not the
    next place.
    """
    n = len(windows)
    order = np.lexsort((windows, anchor))
    same = np.zeros(n, dtype=bool)
    same[1:] = (anchor[order[1:]] == anchor[order[:-1]]) & (windows[order[1:]] == windows[order[:-1]])
    group = np.cumsum(~same) - 1
    heads = np.flatnonzero(~same)
    counts = np.diff(heads, append=n)
    earliest = order[heads]
    second = order[np.minimum(heads + 1, n - 1)]
    reference, repeated = np.empty(n, dtype=np.int64), np.empty(n, dtype=bool)
    reference[order] = np.where(order == earliest[group], second[group], earliest[group])
    repeated[order] = counts[group] > 1
    goes_on = np.zeros(n, dtype=bool)
    goes_on[1:] = repeated[1:] & repeated[:-1] & (piece[1:] == piece[:-1]) & (reference[1:] == reference[:-1] + 1)
    starts = np.flatnonzero(repeated & ~goes_on)
    covered = np.concatenate([[0], np.cumsum(repeated)])
    return starts, np.diff(covered[starts], append=covered[-1])


def block_spans(parts: DataFrame) -> DataFrame:
    """(row, start, n): factors of the pieces of anchors with few places, block by block."""

    def parse(block: pa.Table) -> pa.RecordBatch:
        block = block.combine_chunks()
        anchor, start = block["anchor"].to_numpy(), block["start"].to_numpy()
        row = np.frombuffer(b"".join(block["row"].to_pylist()), dtype=np.int64).reshape(-1, 2)
        # Rows of the table that are repeated as a whole are one place.
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = (np.diff(anchor) != 0) | (np.diff(start) != 0) | (np.diff(row, axis=0) != 0).any(axis=1)
        packed = [w for w, k in zip(block["windows"].to_pylist(), new, strict=True) if k]
        anchor, start, rows = anchor[new], start[new], block["row"].filter(pa.array(new))
        size = np.array([len(w) // 8 for w in packed])
        piece = np.repeat(np.arange(len(packed)), size)
        first, length = factors(anchor[piece], np.frombuffer(b"".join(packed), dtype=np.int64), piece)
        place = first - (np.cumsum(size) - size)[piece[first]] + start[piece[first]]
        found = {"row": rows.take(pa.array(piece[first])).combine_chunks(), "start": place.astype(np.int32), "n": length.astype(np.int32)}
        return pa.RecordBatch.from_pydict(found, schema=pa.schema([("row", pa.binary()), ("start", pa.int32()), ("n", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            anchor = batch.column("anchor").to_numpy()
            if not len(anchor):
                continue
            # Anchors come in order: those before the last one of the batch are complete.
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if cut == 0 and waiting and waiting[-1].column("anchor")[-1].as_py() != anchor[0]:
                yield parse(pa.Table.from_batches(waiting))
                waiting = []
            elif cut:
                yield parse(pa.Table.from_batches([*waiting, batch.slice(0, cut)]))
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield parse(pa.Table.from_batches(waiting))

    dealt = parts.select("anchor", "row", "start", "windows").repartition("anchor").sortWithinPartitions("anchor", "row", "start")
    return dealt.mapInArrow(run, "row binary, start int, n int")


def hot_spans(parts: DataFrame) -> DataFrame:
    """(row, start, n): the same for anchors with many places.

    Pieces of equal windows are one form with a number of places, so copies are compared
    once. The windows of the forms are counted by partial aggregates: no task holds the text
    around an anchor. What repeats in a form, as runs of windows, goes back to its places.
    """
    form = F.unhex(F.md5("windows")).alias("form")
    places = cut_lineage(parts.select("anchor", form, "row", "start", "windows").distinct())
    forms = cut_lineage(places.groupBy("anchor", "form", "windows").agg(F.count(F.lit(1)).alias("n_places")))
    offsets = F.expr("sequence(0, CAST(octet_length(windows) DIV 8 AS INT) - 1)")
    each = forms.select("anchor", "form", "n_places", F.explode(offsets).alias("k"), "windows")
    window = F.substring("windows", F.lit(1) + 8 * F.col("k"), F.lit(8))
    each = cut_lineage(each.select("anchor", window.alias("window"), "form", "k", "n_places"))
    counts = cut_lineage(each.groupBy("anchor", "window").agg(F.sum("n_places").alias("n"), F.count(F.lit(1)).alias("n_forms")).where("n > 1"))
    found = split_join(each, counts, ["anchor", "window"], F.col("n_forms") > each.count() / HOT_SHARE, HOT_SHARE)
    held = found.groupBy("anchor", "form", "n_places").agg(F.sort_array(F.collect_list("k")).alias("ks"))
    runs = F.expr(
        "zip_with(filter(ks, k -> NOT array_contains(ks, k - 1)), filter(ks, k -> NOT array_contains(ks, k + 1)),"
        " (first, last) -> struct(first, last - first + 1 AS n))"
    )
    repeated = cut_lineage(held.select("anchor", "form", "n_places", runs.alias("runs")))
    is_hot = F.col("n_places") > places.count() / HOT_SHARE
    back = split_join(places.drop("windows"), repeated, ["anchor", "form"], is_hot, HOT_SHARE)
    return back.select("row", "start", F.explode("runs").alias("run")).select(
        "row", (F.col("start") + F.col("run.first")).alias("start"), F.col("run.n").cast("int").alias("n")
    )


def drop_words(docs: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """(row, n_removed, kept): the words of each document outside the windows that ``spans`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for text, starts, lengths in zip(texts_of(batch), batch.column("starts"), batch.column("lengths")):
                words = text.split()
                first = starts.values.to_numpy()
                depth = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(depth, first, 1)
                np.add.at(depth, first + lengths.values.to_numpy() + window - 1, -1)
                left = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
                removed.append(len(words) - len(left))
                kept.append(b" ".join([words[k] for k in left]).decode())
            yield pa.RecordBatch.from_pydict(
                {"row": batch.column("row"), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.string())}
            )

    listed = spans.groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("found"))
    joined = docs.select(row_id(), "text").join(listed, "row")
    given = joined.select("row", "text", F.col("found.start").alias("starts"), F.col("found.n").alias("lengths"))
    return given.mapInArrow(run, "row binary, n_removed long, kept string")


def decisions(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(row, doc_id, content, n_words, n_copies, n_removed, kept), one row per input row.

    ``kept`` is NULL where no word goes. Documents of equal words are one reference
    document: they only have to be found alike, and all their windows repeat.
    """
    rows = cut_lineage(summaries(docs, window, gram))
    contents = cut_lineage(rows.groupBy("content").agg(F.count(F.lit(1)).alias("n_copies"), F.min("row").alias("row")))
    references = rows.where(F.size("anchors") > 0).join(contents.select("row"), "row", "left_semi").dropDuplicates(["row"])
    parts = cut_lineage(pieces(docs, repeated_anchors(references), window, gram))
    spans = block_spans(parts.where("NOT hot")).unionByName(hot_spans(parts.where("hot")))
    single = contents.where("n_copies = 1").select("row")
    dropped = cut_lineage(drop_words(docs, spans.join(single, "row", "left_semi"), window))
    is_hot = F.col("n_copies") > rows.count() / HOT_SHARE
    counted = split_join(rows.drop("anchors"), contents.drop("row"), ["content"], is_hot, HOT_SHARE)
    repeated = (F.col("n_copies") > 1) & (F.col("n_words") >= window)
    return counted.join(dropped, "row", "left").select(
        "row",
        "doc_id",
        "content",
        "n_words",
        "n_copies",
        F.when(repeated, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(repeated, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )


def substring_duplicates(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """How many words of each document stand in windows that also start elsewhere.

    One row per input row: doc_id, n_words, n_removed, kept_sha256 (the words that stay,
    joined by one space), n_copies (rows of equal words). NULL counts as no text; texts with
    fewer words than a window keep all. Repeated rows are repeats of one another; rows that
    share an id but not the text are judged each by its text. An empty table gives no rows.
    Other columns are ignored.
    """
    kept = F.when(F.col("kept").isNull(), F.lower(F.hex("content"))).otherwise(F.sha2("kept", 256))
    return decisions(docs, window, gram).select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"), "n_copies")


def drop_repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``; texts without any stay as they are."""
    changed = decisions(docs, window, gram).where("kept IS NOT NULL")
    changed = changed.select(F.col("row").alias("__row"), F.col("kept").alias("__kept")).dropDuplicates(["__row"])
    joined = docs.join(changed, row_id() == F.col("__row"), "left")
    return joined.withColumn("text", F.coalesce("__kept", "text")).select(*[joined[c] if c != "text" else F.col("text") for c in docs.columns])


SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (SELECT rid, s, md5(array_to_string(w[s:s + {WINDOW - 1}], ' ')) AS h
  FROM (SELECT rid, w, unnest(range(1, CAST(len(w) - {WINDOW - 2} AS BIGINT))) AS s FROM d)),
repeated AS (SELECT rid, s FROM (SELECT rid, s, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1),
gone AS (SELECT rid, list(DISTINCT p) AS places FROM (SELECT rid, unnest(range(s, s + {WINDOW})) AS p FROM repeated) GROUP BY rid),
kept AS (SELECT d.rid, string_agg(word, ' ' ORDER BY p) AS kept FROM
  (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) AS d
  ANTI JOIN (SELECT rid, unnest(places) AS p FROM gone) AS g ON d.rid = g.rid AND d.p = g.p GROUP BY d.rid)
SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)
"""
