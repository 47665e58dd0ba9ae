"""Exact Jaccard join on word shingles in the metric space of sets.

Two sets at Jaccard distance 1/4 or less share one of the first quarter of their shingles in
any common order, so the first regions are those of single shingles, in an order that puts
frequent shingles last: what lies within the radius of a set is replicated to its regions. Within
a region, documents are pivots: distances to pivots are computed exactly, everything within the radius of
a pivot is one component with it, and large regions split into the Voronoi cells of
several pivots. A set is replicated to a cell if, by the triangle inequality, a partner may live
there; cells are joined recursively until all their sets are connected or few are left.

A pair is refuted without its sets where the parities of both sets differ in too
many places: each place that differs stands for a shingle that only one of them has.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import md5
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import broadcast_up_to, row_key
from plumbline.llm.components import components
from plumbline.llm.exact_dedup import without_rows
from plumbline.llm.portions import give_back, portions
from plumbline.session import cut_lineage

#: Words of a shingle; sets link at intersection / union >= 75 / 100.
SHINGLE = 5
LEAST = 75
#: The Jaccard distance of a link at most, with room for rounding.
RADIUS = 1 - LEAST / 100 + 1e-9
#: The order: a shingle is frequent from this count on, and at most one shingle in so many
#: occurrences can be, which bounds the list of frequent ones.
FREQUENT = 16
FREQUENT_SHARE = 1_000_000
#: Rows of ids and shingles that are broadcast; beyond it the joins shuffle.
BROADCAST_ROWS = 2_000_000
#: Regions up to this size are compared pair by pair, and so are larger ones if hardly any
#: member is outside their largest component; the rest get so many pivots first.
SMALL = 1024
PIVOTS = 32
#: Shingles that a task counts at a time.
COUNTED = 4_000_000
#: Members of a region that meet as rows of a join; more meet as blocks of about so many.
FEW = 16
BLOCK = 1024

MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


#: Bytes of text that are hashed at a time, and of a word that is hashed by table.
PORTION = 250_000
SHORT_WORD = 32
#: Whether a byte is white space, its lower case, and a random number for each byte and place of a word.
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
RANDOM = np.random.default_rng(1).integers(0, 1 << 64, (SHORT_WORD, 256), dtype=np.uint64).ravel()
GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of some text, and where they start."""
    given = np.frombuffer(raw, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(BLANK[given], prepend=True, append=True))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    lower, hashes = LOWER[given], np.empty(len(starts), dtype=np.uint64)
    short = lengths <= SHORT_WORD
    if short.any():
        sizes = lengths[short]
        first = np.cumsum(sizes) - sizes
        place = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
        hashes[short] = np.add.reduceat(RANDOM[(place << 8) | lower[np.repeat(starts[short], sizes) + place]], first)
    for k in np.flatnonzero(~short):
        hashes[k] = xxhash.xxh3_64_intdigest(lower[starts[k] : starts[k] + lengths[k]].tobytes())
    return hashes, starts


def shingles_of_words(hashes: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """Per text with so many words its distinct shingles, sorted; of fewer words than a shingle
    has, the whole sequence."""
    size = max(0, len(hashes) - SHINGLE + 1)
    mixed = hashes[:size] * MIX[0]
    for k in range(1, SHINGLE):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX[k] + hashes[k : size + k]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * MIX[1]
    mixed ^= mixed >> np.uint64(31)
    at = 0
    for n in counts.tolist():
        if n >= SHINGLE:
            found = np.sort(mixed[at : at + n - SHINGLE + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif n:
            yield np.array([xxhash.xxh3_64_intdigest(hashes[at : at + n].tobytes(), seed=n)], dtype=np.uint64)
        else:
            yield np.empty(0, dtype=np.uint64)
        at += n


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """The set of shingles of each text, as sorted 64-bit hashes."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    for start, end in portions(coded, PORTION):
        if end - start == 1 and len(coded[start]) > PORTION:
            # A long text is cut between words.
            found, at = [], 0
            while at < len(coded[start]):
                gap = GAP.search(coded[start], at + PORTION)
                stop = gap.end() if gap else len(coded[start])
                found.append(word_hashes(coded[start][at:stop])[0])
                at = stop
            hashes = np.concatenate(found)
            yield from shingles_of_words(hashes, np.array([len(hashes)]))
        else:
            hashes, starts = word_hashes(b"\n".join(coded[start:end]))
            bounds = np.cumsum([len(c) + 1 for c in coded[start:end]])
            yield from shingles_of_words(hashes, np.diff(np.searchsorted(starts, bounds), prepend=0))


def parity(shingles: np.ndarray) -> bytes:
    """One bit per place: whether an odd number of shingles falls there. Two to four times as
    many places as shingles, a power of two, so that parities of different sizes can be folded.
    Sets without a common shingle are then told to be at least 0.6 apart."""
    places = 1 << max(6, int(len(shingles) - 1).bit_length() + 1)
    counts = np.bincount((shingles >> np.uint64(20) & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the shingles that only one of two sets has."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def repeated_values(sets: Iterable[np.ndarray], most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each run of sets with up to ``most`` values together (COUNTED), the values that several hold, and
    in how many. One buffer holds a run and is sorted in place; a larger set stands alone and repeats nothing."""
    most = COUNTED if most is None else most
    buffer, size = np.empty(most, dtype=np.uint64), 0
    for values in chain(sets, [None]):
        if values is None or size + len(values) > most:
            run = buffer[:size]
            run.sort()
            # Where equal values begin, if there is a second one, and where the next value does.
            same = np.concatenate([[False], run[1:] == run[:-1], [False]]) if size else np.zeros(1, dtype=bool)
            edges = np.flatnonzero(same[1:] != same[:-1])
            starts, ends = edges[::2], edges[1::2] + 1
            yield run[starts], ends - starts
            size = 0
        if values is not None and len(values) <= most:
            buffer[size : size + len(values)] = values
            size += len(values)


def local_counts(texts: DataFrame) -> DataFrame:
    """(shingle, n): documents with a shingle, as far as a portion of a task has it twice."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        give_back()  # what an earlier stage left in this worker
        total = 0

        def sets() -> Iterator[np.ndarray]:
            nonlocal total
            for frame in frames:
                for found_set in shingle_sets(frame["text"]):
                    total += len(found_set)
                    yield found_set

        for values, times in repeated_values(sets()):
            yield pd.DataFrame({"shingle": values.view(np.int64), "n": times})
        yield pd.DataFrame({"shingle": pd.array([None], dtype="Int64"), "n": [total]})
        give_back()

    return texts.select("text").mapInPandas(count, "shingle long, n long")


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent shingles and their counts. They only shape the order; any order is exact."""
    sums = cut_lineage(local_counts(docs).groupBy("shingle").agg(F.sum("n").alias("n")))
    total = sums.where("shingle IS NULL").agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    found = sums.where(F.col("shingle").isNotNull() & (F.col("n") >= max(FREQUENT, total // FREQUENT_SHARE))).toPandas()
    values = found["shingle"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], found["n"].to_numpy(dtype=np.int64)[order]


def regions_of(shingles: np.ndarray, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles whose regions a set belongs to: the first n - ceil(0.75 n) + 1 in the order."""
    needed = len(shingles) + LEAST * len(shingles) // -100 + 1
    at = np.searchsorted(values, shingles)
    at[at == len(values)] = 0
    often = values[at] == shingles if len(values) else np.zeros(len(shingles), dtype=bool)
    first = shingles[~often][:needed]
    if len(first) < needed:
        rest = shingles[often]
        ordered = rest[np.lexsort((rest, counts[at[often]]))]
        first = np.concatenate([first, ordered[: needed - len(first)]])
    return first


def set_rows(docs: DataFrame, frequent: Broadcast) -> DataFrame:
    """Per row: doc_id, key, set_id, n, parity, and the regions of its set. No set_id without words."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values, counts = frequent.value
        for frame in frames:
            for start in range(0, len(frame), 1_000):
                part = frame.iloc[start : start + 1_000]
                sets = list(shingle_sets(part["text"]))
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"],
                        "key": part["key"],
                        "set_id": [md5(s.tobytes()).digest() if len(s) else None for s in sets],
                        "n": [len(s) for s in sets],
                        "parity": [parity(s) if len(s) else None for s in sets],
                        "regions": [regions_of(s, values, counts).view(np.int64) if len(s) else [] for s in sets],
                    }
                )
                del part, sets
            del frame
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    return keyed.mapInPandas(run, f"doc_id {kind}, key binary, set_id binary, n long, parity binary, regions array<long>")


class Join:
    """The distinct sets of a corpus and the ways to compare them."""

    def __init__(self, docs: DataFrame, small: int = SMALL, pivots: int = PIVOTS):
        self.small, self.pivots = small, pivots
        self.docs = docs.select("doc_id", "text")
        frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(self.docs))
        self.rows = cut_lineage(set_rows(self.docs, frequent))
        given = self.rows.where("set_id IS NOT NULL")
        self.sets = cut_lineage(
            given.groupBy("set_id").agg(
                F.min("doc_id").alias("least_id"), F.min("key").alias("key"), F.max("n").alias("n"), F.max("parity").alias("parity")
            )
        )

    def first_regions(self) -> DataFrame:
        """(region, id, n, own): members of the regions of single shingles, merged where they are much alike.

        A member is at home in the regions of the first n - ceil(6/7 n) + 1 of its shingles: of two sets that
        link, the smaller has the first shingle that both have there, since both have 6/7 of the smaller.
        """
        home = F.expr(f"n * {100 - LEAST} div {100 + LEAST} + 1")
        given = self.rows.where("set_id IS NOT NULL").select(set_name("set_id").alias("id"), home.alias("home"), F.posexplode("regions").alias("at", "region"))
        members = cut_lineage(shared_regions(given.select("region", "id", (F.col("at") < F.col("home")).alias("own"))))
        named = self.sets.select(set_name("set_id").alias("name"), F.col("set_id"), "n")
        return cut_lineage(members.join(named, F.col("id") == F.col("name")).select("region", F.col("set_id").alias("id"), "n", "own"))

    def shingles_of(self, ids: DataFrame) -> DataFrame:
        """(set_id, shingles) of some sets, taken from the texts again."""
        wanted = cut_lineage(ids.join(self.sets, ids["id"] == self.sets["set_id"]).select("set_id", F.col("key").alias("wanted")))
        keyed = self.docs.select("text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
        texts = keyed.join(broadcast_up_to(wanted, BROADCAST_ROWS), F.col("key") == F.col("wanted")).select("set_id", "text")

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield pd.DataFrame({"set_id": frame["set_id"], "shingles": [s.tobytes() for s in shingle_sets(frame["text"])]})
            give_back()

        return cut_lineage(texts.mapInPandas(run, "set_id binary, shingles binary").dropDuplicates(["set_id"]))

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """(a, b, bound, possible): the least distance that sizes and parities allow, and
        whether it leaves room for a link."""
        facts = self.sets.select("set_id", "n", "parity")
        a = facts.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("parity").alias("parity_a"))
        b = facts.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("parity").alias("parity_b"))
        known = pairs.join(a, "a").join(b, "b")

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                least = np.array([least_difference(x, y) for x, y in zip(frame["parity_a"], frame["parity_b"], strict=True)], dtype=np.int64)
                n_a, n_b = frame["n_a"].to_numpy(dtype=np.int64), frame["n_b"].to_numpy(dtype=np.int64)
                least = np.maximum(least, np.abs(n_a - n_b))
                # Of a difference d, intersection / union is (n_a + n_b - d) / (n_a + n_b + d).
                kept = 100 * (n_a + n_b - least) >= LEAST * (n_a + n_b + least)
                yield pd.DataFrame({"a": frame["a"], "b": frame["b"], "bound": 2 * least / (n_a + n_b + least), "possible": kept})
            give_back()

        return known.mapInPandas(run, "a binary, b binary, bound double, possible boolean")

    def possible(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b) those that sizes and parities do not refute."""
        return self.bounded(pairs).where("possible").select("a", "b")

    def compare(self, pairs: DataFrame) -> DataFrame:
        """(a, b, distance, linked) of each pair, from the whole sets."""
        pairs = cut_lineage(pairs.distinct())
        sets = self.shingles_of(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        a = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("set_a"))
        b = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("set_b"))
        both = pairs.join(b, "b").join(a, "a")

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                shared, union = [], []
                for x, y in zip(frame["set_a"], frame["set_b"], strict=True):
                    x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                    shared.append(len(np.intersect1d(x, y, assume_unique=True)))
                    union.append(len(x) + len(y) - shared[-1])
                shared, union = np.array(shared, dtype=np.int64), np.array(union, dtype=np.int64)
                yield pd.DataFrame(
                    {"a": frame["a"], "b": frame["b"], "distance": 1 - shared / union, "linked": 100 * shared >= LEAST * union}
                )
            give_back()

        return cut_lineage(both.mapInPandas(run, "a binary, b binary, distance double, linked boolean"))

    def links(self) -> DataFrame:
        """(a, b) of linked sets, enough to connect all sets that links connect.

        Not every link is listed: pairs already connected are not compared.
        """
        members = self.first_regions()
        centres = members.groupBy("region").agg(F.min("id").alias("b"))
        around = cut_lineage(members.join(centres, "region").where("id <> b").withColumnRenamed("id", "a"))
        known = self.distances(around.select("a", "b").distinct())
        edges = cut_lineage(known.where("linked").select("a", "b"))
        rest = self.unsettled(self.beyond_centres(around, known), edges)
        step, pivots = 0, self.pivots
        while True:
            sized = cut_lineage(self.sized(rest))
            found = self.compare(self.possible_within(sized.where("few"))).where("linked").select("a", "b")
            edges = cut_lineage(edges.unionByName(found))
            large = sized.where("NOT few").drop("few", "other", "others")
            if large.isEmpty():
                return edges
            found, cells = self.split(large, step, pivots)
            edges = cut_lineage(edges.unionByName(found))
            rest = self.unsettled(cells, edges)
            step, pivots = step + 1, 2 * pivots

    def distances(self, pairs: DataFrame) -> DataFrame:
        """(a, b, distance, linked) of distinct pairs; the distance of a pair that sizes and
        parities refute is its lower bound, which is more than the radius."""
        bounds = cut_lineage(self.bounded(pairs))
        measured = self.compare(bounds.where("possible").select("a", "b"))
        return cut_lineage(
            bounds.join(measured, ["a", "b"], "left").select(
                "a", "b", F.coalesce("distance", "bound").alias("distance"), F.coalesce("linked", F.lit(False)).alias("linked")
            )
        )

    def beyond_centres(self, around: DataFrame, known: DataFrame) -> DataFrame:
        """Members that may still have a partner in their region which its centre does not link them to.

        The centre has met everyone and leaves. What it links is one component; of that, by
        the triangle inequality, only members matter that some member beyond the radius can
        be within the radius of.
        """
        placed = cut_lineage(around.join(known, ["a", "b"]))
        outside = placed.where("NOT linked").groupBy("region").agg(F.min("distance").alias("nearest"))
        left = placed.join(outside, "region").where(~F.col("linked") | (F.col("distance") + RADIUS >= F.col("nearest")))
        return left.select("region", F.col("a").alias("id"), "n", "own")

    def unsettled(self, members: DataFrame, edges: DataFrame) -> DataFrame:
        """Members with the roots of their components, of regions that hold more than one component."""
        roots = components(edges)
        rooted = members.join(roots, F.col("id") == F.col("node"), "left").select(
            "region", "id", "n", "own", F.coalesce("root", "id").alias("root")
        )
        rooted = cut_lineage(rooted)
        spans = rooted.groupBy("region").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        return cut_lineage(merged_regions(rooted.join(spans.select("region"), "region")))

    def sized(self, members: DataFrame) -> DataFrame:
        """Members with the size ``m`` of their region, whether they are outside its largest
        component, and whether the region has few such others: then these can meet everyone."""
        parts = members.groupBy("region", "root").agg(F.count(F.lit(1)).alias("m"))
        main = parts.groupBy("region").agg(F.max(F.struct("m", "root")).alias("main"), F.sum("m").alias("m"))
        others = F.col("m") - F.col("main.m")
        few = (others <= self.small // 8) | (others * F.col("m") <= 4 * self.small * self.small)
        return members.join(main, "region").select(
            "region", "id", "n", "own", "root", "m", others.alias("others"), few.alias("few"), (F.col("root") != F.col("main.root")).alias("other")
        )

    def possible_within(self, regions: DataFrame) -> DataFrame:
        """Pairs (a, b) of regions that are not connected yet and that sizes and parities do not refute."""
        small, large = regions.where(F.col("m") <= FEW), regions.where(F.col("m") > FEW)
        return self.possible(self.pairs_within(small)).unionByName(self.possible_in_blocks(large))

    def possible_in_blocks(self, regions: DataFrame) -> DataFrame:
        """The same from blocks of members: a block outside the largest component meets every block of the region,
        so that rows grow with pairs of blocks and only pairs that are left become rows. In a region of one block
        (``alone``) a member is sent once."""
        known = regions.join(self.sets.select(F.col("set_id").alias("id"), "parity"), "id")
        own_blocks, all_blocks = (F.ceil(F.col(c) / BLOCK) for c in ("others", "m"))
        hashed = F.xxhash64("id", F.lit(2))
        facts = ["region", "id", "n", "own", "root", "parity"]
        alone = ((own_blocks == 1) & (all_blocks == 1)).alias("alone")
        a = known.where(F.col("other") & ~alone).select(
            *facts, alone, F.lit(True).alias("first"), F.pmod(hashed, own_blocks).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), all_blocks - 1)).alias("j")
        )
        b = known.select(
            *facts, alone, (F.col("other") & alone).alias("first"), F.explode(F.sequence(F.lit(0).cast("long"), own_blocks - 1)).alias("i"), F.pmod(hashed, all_blocks).alias("j")
        )
        met = a.unionByName(b)
        return met.groupBy("region", "i", "j").applyInPandas(possible_pairs, "a binary, b binary").distinct()

    def pairs_within(self, regions: DataFrame) -> DataFrame:
        """Pairs of regions that are not connected yet and may be of close size. One of a
        pair is outside the largest component of the region."""
        a = regions.where("other").select(
            "region", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"), F.col("own").alias("own_a")
        )
        b = regions.select("region", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"), F.col("own").alias("own_b"))
        pairs = a.join(b, "region").where("root_a <> root_b AND (own_a OR own_b)").where(close_sizes("n_a", "n_b"))
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def split(self, large: DataFrame, step: int, pivots: int) -> tuple[DataFrame, DataFrame]:
        """The links of large regions to their pivots, and the cells around them.

        The pivots have met every member then and leave. A member within the radius of a
        pivot lives in the cell of the nearest one. It, and any other member, is replicated
        to each cell that may hold a partner of it: by the triangle inequality, no farther
        from the pivot than the cell's farthest inhabitant plus the radius. Inhabitants are connected by
        their pivot; of them only those stay that may be a partner of someone from outside. Members without a cell
        go on as one region.
        """
        # The same sets are chosen in each region, so that pairs repeat and are compared once.
        order = F.pmod(F.xxhash64("id", F.lit(step)), F.lit(1 << 20))
        first = large.groupBy("region").agg(F.min(F.struct(order.alias("order"), F.col("id"))).alias("first"))
        chosen = large.join(first, "region").where((order * F.col("m") < pivots * (1 << 20)) | (F.col("id") == F.col("first.id")))
        chosen = cut_lineage(chosen.select("region", F.col("id").alias("b")))
        met = large.join(chosen, "region").where("id <> b").select("region", F.col("id").alias("a"), "b", "n")
        known = self.distances(met.select("a", "b").distinct())
        ordinary = met.join(chosen.withColumnRenamed("b", "a"), ["region", "a"], "left_anti")
        placed = cut_lineage(ordinary.join(known, ["a", "b"]).select("region", "a", "b", "n", "distance", "linked"))
        homes = placed.where("linked").groupBy("region", "a").agg(F.min(F.struct("distance", "b")).alias("home"))
        homes = cut_lineage(homes.select("region", "a", F.col("home.b").alias("home")))
        cells = placed.join(homes, ["region", "a"], "left").withColumn("own", F.col("b").eqNullSafe(F.col("home")))
        reach = cells.where("own").groupBy("region", "b").agg(F.max("distance").alias("high"))
        inside = cells.join(reach, ["region", "b"]).where(F.col("own") | (F.col("distance") <= F.col("high") + RADIUS))
        inside = cut_lineage(inside)
        outside = inside.where("NOT own").groupBy("region", "b").agg(F.min("distance").alias("nearest"))
        inside = inside.join(outside, ["region", "b"]).where(~F.col("own") | (F.col("distance") + RADIUS >= F.col("nearest")))
        cell = F.xxhash64("region", "b", F.lit(step)).alias("region")
        homeless = placed.join(homes, ["region", "a"], "left_anti").select("region", "a", "n").distinct()
        alone = F.xxhash64("region", F.lit(step)).alias("region")
        left = inside.select(cell, F.col("a").alias("id"), "n", "own").unionByName(
            homeless.select(alone, F.col("a").alias("id"), "n", F.lit(True).alias("own"))
        )
        return known.where("linked").select("a", "b"), left


def possible_pairs(block: pd.DataFrame) -> pd.DataFrame:
    """(a, b) of the rows of a block that are ``first`` and its others, or all if it is ``alone``, without the pairs that
    are connected or refuted."""
    block = block.assign(root=pd.factorize(block["root"])[0], size=block["parity"].map(len))
    found_a, found_b = [], []
    for size, a in block[block["first"]].groupby("size"):
        for other in (size // 2, size, 2 * size):
            b = block[(~block["first"] | block["alone"]) & (block["size"] == other)]
            if b.empty:
                continue
            least = least_differences(folded(a["parity"], min(size, other)), folded(b["parity"], min(size, other)))
            n_a, n_b = a["n"].to_numpy(np.int64)[:, None], b["n"].to_numpy(np.int64)[None, :]
            least = np.maximum(least, np.abs(n_a - n_b))
            kept = 100 * (n_a + n_b - least) >= LEAST * (n_a + n_b + least)
            kept &= a["root"].to_numpy()[:, None] != b["root"].to_numpy()[None, :]
            kept &= a["own"].to_numpy(bool)[:, None] | b["own"].to_numpy(bool)[None, :]
            x, y = np.nonzero(kept)
            found_a.extend(a["id"].to_numpy()[x])
            found_b.extend(b["id"].to_numpy()[y])
    pairs = [(x, y) if x < y else (y, x) for x, y in zip(found_a, found_b, strict=True)]
    return pd.DataFrame({"a": [x for x, _ in pairs], "b": [y for _, y in pairs]})


def folded(parities: pd.Series, size: int) -> np.ndarray:
    """Parities of one length as rows of 64-bit words, folded to ``size`` bytes."""
    rows = np.frombuffer(b"".join(parities), dtype=np.uint64).reshape(len(parities), -1)
    while rows.shape[1] * 8 > size:
        rows = rows[:, : rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2 :]
    return rows


def least_differences(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``least_difference`` of every row of ``x`` and every row of ``y``."""
    found = np.zeros((len(x), len(y)), dtype=np.int64)
    for k in range(x.shape[1]):
        found += np.bitwise_count(x[:, k, None] ^ y[None, :, k])
    return found


def set_name(set_id: str) -> Column:
    """An even number for a set. Sets that share one meet in more regions than they need, which is as exact."""
    return F.xxhash64(set_id).bitwiseAND(F.lit(-2))


def shared_regions(postings: DataFrame) -> DataFrame:
    """(region, id, own) of the regions that hold several of the even numbers ``id``, one of them at home.

    Regions with the same two min-hashes of their members become one. Postings move once: what counts the
    members of a region and what keeps them read the same exchange.
    """
    # 48 bits name a region, the last bytes of a row, so that the exchange is packed tighter; regions that fall together are one.
    region = F.col("region").bitwiseAND(F.lit((1 << 48) - 1)).alias("region")
    packed = postings.select(F.col("id").bitwiseOR(F.col("own").cast("long")).alias("marked"), region).repartition("region")
    member, own = F.col("marked").bitwiseAND(F.lit(-2)), F.col("marked").bitwiseAND(F.lit(1)) == 1
    facts = packed.groupBy("region").agg(
        F.min(member).alias("low"), F.max(member).alias("high"), F.max(own).alias("own"),
        F.min(F.xxhash64(member)).alias("x"), F.min(F.xxhash64(member, F.lit(1))).alias("y"),
    )
    kept = facts.where("low <> high AND own").select("region", F.xxhash64("x", "y").alias("merged"))
    members = packed.join(kept.hint("shuffle_hash"), "region")
    return members.groupBy(F.col("merged").alias("region"), member.alias("id")).agg(F.max(own).alias("own"))


def merged_regions(members: DataFrame) -> DataFrame:
    """Regions with much the same members, by two min-hashes of them, as one region.

    A union of regions holds every pair that one of them holds, and near copies share many
    shingles, so that the same sets meet in many regions otherwise.
    """
    least = members.groupBy("region").agg(F.min(F.xxhash64("id")).alias("x"), F.min(F.xxhash64("id", F.lit(1))).alias("y"))
    keyed = members.join(least, "region").withColumn("region", F.xxhash64("x", "y"))
    return keyed.groupBy("region", "id").agg(F.max("n").alias("n"), F.max("own").alias("own"), F.max("root").alias("root"))


def close_sizes(a: str, b: str) -> Column:
    """Whether two sizes allow a link at all."""
    return 100 * F.least(a, b) >= LEAST * F.greatest(a, b)


def near_duplicates(docs: DataFrame, small: int = SMALL, pivots: int = PIVOTS) -> DataFrame:
    """Components of documents linked by Jaccard similarity of their word shingles.

    One row per input row: doc_id, n_shingles, component_id (the smallest doc_id that links
    reach, its own included), key (names the row) and component (names the component). Documents with equal sets are linked. NULL and texts
    without words have no shingles and stay alone: component_id is their doc_id. NULL ids are never the
    smallest. Rows equal in id and text get equal results. Other columns are ignored.
    ``small`` and ``pivots`` shape the recursion, not the result.
    """
    join = Join(docs, small, pivots)
    roots = components(join.links())
    rooted = join.sets.join(roots, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "least_id", F.coalesce("root", "set_id").alias("root")
    )
    rooted = cut_lineage(rooted)
    smallest = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    decided = rooted.join(smallest, "root").select("set_id", "component_id", "root")
    return join.rows.join(decided, "set_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "key",
        F.coalesce("root", "key").alias("component"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``: of each component the one
    with the smallest doc_id (NULL last). Documents without words stay; repeated rows count once."""
    found = cut_lineage(near_duplicates(docs).select("doc_id", "key", "component"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("key"))
    first = found.groupBy("component").agg(F.min(order).alias("first")).select("component", F.col("first.key").alias("first_key"))
    judged = found.join(first, "component")
    counted = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return without_rows(
        docs, dropped=judged.where("key <> first_key").select("key"), repeated=counted.select("key"), same=F.coalesce("text", F.lit(""))
    )


# All pairs that share a shingle, and their reach: for small tables.
SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS k FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * shared >= 75 * (s.n + t.n - shared)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT doc_id, b FROM reach JOIN edges ON a = other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
