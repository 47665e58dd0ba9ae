"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are words and word beginnings whose presence depends on the label; every text also has one
background term, so that texts without any such term are like each other. Examples with equal
vectors are one entry with counts per label. Entries stand in an inverted index of blocks with
the largest weight of each term per block; blocks are scored by descending bound until the
bound falls below the k-th neighbour, so the neighbours are exact.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm import common
from plumbline.llm.common import broadcast_up_to
from plumbline.llm.portions import Remembered, give_back, portions
from plumbline.session import cut_lineage

#: Labelled rows per class that a fit reads at most, in expectation (chosen by a hash of doc_id).
MOST_PER_CLASS = 6_000
#: Terms kept, least labelled texts that hold one, and lengths of the word beginnings.
TERMS = 600
LEAST_TEXTS = 6
BEGINNINGS = (4, 5, 6, 7)
#: Neighbours, entries of a block, the weight of the background term.
NEIGHBOURS = 25
BLOCK = 64
BACKGROUND = 1.5

WORD = re.compile(common.WORD)


def held_out(doc_id: Column) -> Column:
    """Documents kept apart: the remainder of crc32 of the id as text by 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def terms_of(word: str) -> list[str]:
    """The word itself, and its beginnings where they are shorter."""
    return [word, *("^" + word[:n] for n in BEGINNINGS if len(word) > n)]


@dataclass
class Terms:
    """The chosen terms with their IDF; turns texts into sparse vectors."""

    idf: dict[str, float]
    number: dict[str, int] = field(init=False)
    weight: np.ndarray = field(init=False)
    known: Remembered = field(init=False)

    def __post_init__(self):
        self.number = {term: n for n, term in enumerate(self.idf)}
        self.weight = np.array([*self.idf.values()], dtype=float)
        self.known = Remembered(200_000)

    def hits(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            found = tuple(n for t in terms_of(word) if (n := self.number.get(t)) is not None)
            self.known.put(word, found)
        return found

    def counts(self, text: str) -> Counter[int]:
        """How often each chosen term occurs in the whole text."""
        counted: Counter[int] = Counter()
        for word, times in Counter(WORD.findall(text.lower())).items():
            for n in self.hits(word):
                counted[n] += times
        return counted

    def vector(self, text: str) -> tuple[tuple[int, float], ...]:
        """Unit vector as (term, weight), the background term last; weights are rounded so
        that equal texts, and texts with equal counts, share a vector."""
        counted = sorted(self.counts(text).items())
        weights = [(n, (1 + math.log(c)) * self.weight[n]) for n, c in counted]
        weights.append((len(self.number), BACKGROUND))
        norm = math.sqrt(sum(w * w for _, w in weights))
        return tuple((n, round(w / norm, 5)) for n, w in weights)


class Neighbours:
    """Block-max inverted index over the entries: vectors with the labels of their examples."""

    def __init__(self, vectors: list[tuple[tuple[int, float], ...]], toxic: np.ndarray, clean: np.ndarray, size: int):
        # Entries with the same heaviest term stand together, which makes the bounds tight.
        order = sorted(range(len(vectors)), key=lambda k: (max(vectors[k], key=lambda e: e[1])[0], vectors[k]))
        self.vectors = [vectors[k] for k in order]
        self.toxic, self.clean = toxic[order].astype(float), clean[order].astype(float)
        self.dense = np.zeros((len(order), size + 1), dtype=np.float32)
        for k, vector in enumerate(self.vectors):
            for n, w in vector:
                self.dense[k, n] = w
        self.starts = np.arange(0, len(order), BLOCK)
        self.block_max = np.maximum.reduceat(self.dense, self.starts, axis=0) if len(order) else self.dense

    def nearest(self, vector: tuple[tuple[int, float], ...]) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines of the nearest examples, as many entries as hold NEIGHBOURS
        examples, with all entries as near as the last."""
        terms = np.array([n for n, _ in vector])
        weights = np.array([w for _, w in vector], dtype=np.float32)
        bounds = self.block_max[:, terms] @ weights
        rows, cosines, held, floor = [], [], 0.0, -1.0
        for b in np.argsort(-bounds, kind="stable"):
            if held >= NEIGHBOURS and bounds[b] < floor - 1e-6:
                break
            start = self.starts[b]
            block = slice(start, min(start + BLOCK, len(self.vectors)))
            rows.append(np.arange(block.start, block.stop))
            cosines.append(self.dense[block][:, terms] @ weights)
            every = np.concatenate(cosines)
            found = np.concatenate(rows)
            order = np.argsort(-every, kind="stable")
            sums = np.cumsum((self.toxic + self.clean)[found[order]])
            held = sums[-1]
            if held >= NEIGHBOURS:
                floor = every[order[np.searchsorted(sums, NEIGHBOURS)]]
        every, found = np.concatenate(cosines), np.concatenate(rows)
        near = every >= floor - 1e-6
        order = np.lexsort((found[near], -every[near]))
        return found[near][order], every[near][order]

    def vote(self, vector: tuple[tuple[int, float], ...], rates: tuple[float, float], leave_out: int | None = None) -> float:
        """Share of the toxic votes; a vote falls with the distance, and classes count as in the labels."""
        rows, cosines = self.nearest(vector)
        toxic, clean = self.toxic[rows].copy(), self.clean[rows].copy()
        if leave_out is not None:
            own = np.flatnonzero((toxic if leave_out else clean) * np.array([self.vectors[r] == vector for r in rows]))
            (toxic if leave_out else clean)[own[:1]] -= 1
        near = np.exp(-8.0 * (1.0 - cosines))
        yes, no = (near * toxic).sum() / rates[1], (near * clean).sum() / rates[0]
        return float((yes + 0.05) / (yes + no + 0.1 / min(rates)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def calibrate(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the votes, by Newton steps."""
    x = logit(votes)
    slope, shift = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
        error, curve = weights * (p - labels), weights * p * (1 - p)
        gradient = np.array([(error * x).sum() + 1e-3 * (slope - 1), error.sum()])
        hessian = np.array([[(curve * x * x).sum() + 1e-3, (curve * x).sum()], [(curve * x).sum(), curve.sum() + 1e-9]])
        step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        slope, shift = slope - float(np.clip(step[0], -1, 1)), shift - float(np.clip(step[1], -2, 2))
    return max(slope, 0.05), shift


@dataclass
class Model:
    """All that a task needs; its size is bounded by the examples and terms of the fit."""

    terms: Terms
    neighbours: Neighbours | None
    rates: tuple[float, float]
    slope: float
    shift: float
    prior: float

    def scores(self, texts: list[str], seen: Remembered) -> list[tuple[float, tuple]]:
        """Calibrated score and vector of each text; equal vectors are looked up once."""
        found = []
        for text in texts:
            vector = self.terms.vector(text)
            score = seen.get(vector)
            if score is None:
                score = self.score(vector)
                seen.put(vector, score)
            found.append((score, vector))
        return found

    def score(self, vector: tuple) -> float:
        if self.neighbours is None:
            return self.prior
        x = logit(np.array([self.neighbours.vote(vector, self.rates)]))[0]
        return float(1 / (1 + np.exp(-(self.slope * x + self.shift))))

    def evidence(self, vector: tuple, most: int = 3) -> list[str]:
        """The heaviest terms that the text shares with its nearest examples."""
        names = list(self.terms.idf)
        heavy = sorted((e for e in vector if e[0] < len(names)), key=lambda e: (-e[1], e[0]))
        return [names[n] for n, _ in heavy[:most]]


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, float], float]:
    """(doc_id, text, toxic) of a bounded choice of labelled rows outside the held-out fold, the share
    chosen per class, and the share of toxic rows."""
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rates = {label: min(1.0, most / n) for label, n in sizes.items()}
    part = F.pmod(F.xxhash64("__id"), F.lit(1_000_003))
    chosen = marked.where(part < F.when(F.col("toxic") == 1, rates.get(1, 1.0)).otherwise(rates.get(0, 1.0)) * 1_000_003)
    total = sum(sizes.values())
    # The choice is bounded by ``most``; the check guards against its spread.
    chosen = broadcast_up_to(cut_lineage(chosen), 4 * most)
    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("__id"))
    examples = cut_lineage(rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic"))
    return examples, rates, sizes.get(1, 0) / total if total else 0.5


def choose_terms(examples: DataFrame, rates: dict[int, float]) -> list[str]:
    """The terms whose presence depends most on the label: largest signed root of the
    log-likelihood ratio, toxic side only (what tells a clean text is that it has none)."""

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}
        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                counted[toxic].update({t for w in set(WORD.findall(text.lower())) for t in terms_of(w)})
        terms = sorted(counted[0].keys() | counted[1].keys())
        for k in range(0, len(terms), 20_000):
            some = terms[k : k + 20_000]
            yield pd.DataFrame({"term": some, "toxic": [counted[1][t] for t in some], "clean": [counted[0][t] for t in some]})
        del counted, terms
        give_back()

    partly = examples.select("text", "toxic").mapInPandas(held, "term string, toxic long, clean long")
    sums = partly.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    n = examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    n_toxic = max(1, sum(r["n"] for r in n if r["toxic"] == 1))
    n_clean = max(1, sum(r["n"] for r in n if r["toxic"] == 0))
    p, q = F.col("a") / n_toxic, F.col("b") / n_clean
    mean = (F.col("a") + F.col("b")) / (n_toxic + n_clean)
    gain = F.col("a") * F.log(p / mean) + F.when(F.col("b") > 0, F.col("b") * F.log(q / mean)).otherwise(0.0)
    ranked = sums.where((F.col("a") + F.col("b") >= LEAST_TEXTS) & (p > 3 * q)).withColumn("gain", F.round(gain, 9))
    best = ranked.where("gain > 6").orderBy(F.desc("gain"), "term").limit(TERMS)
    return sorted(r["term"] for r in best.select("term").collect())


def inverse_frequencies(docs: DataFrame, chosen: list[str]) -> dict[str, float]:
    """IDF of the chosen terms over all documents."""

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, total, rows = Terms(dict.fromkeys(chosen, 1.0)), np.zeros(len(chosen), dtype=np.int64), 0
        for frame in frames:
            rows += len(frame)
            for text in frame["text"]:
                found = {n for w in set(WORD.findall((text or "").lower())) for n in terms.hits(w)}
                total[list(found)] += 1
        yield pd.DataFrame({"term": [*chosen, None], "n": [*total.tolist(), rows]})
        del terms
        give_back()

    counted = docs.select("text").mapInPandas(held, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.collect()}
    total = found.pop(None, 0)
    return {t: math.log((1 + total) / (1 + found.get(t, 0))) + 0.1 for t in chosen}


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_PER_CLASS) -> Model:
    """Learn from labelled rows outside the held-out fold; ``most`` bounds the examples per class.

    The driver holds the chosen terms and the vectors of the examples, both bounded.
    Without examples of both classes the score is the share of toxic labels (0.5 without
    any labels).
    """
    examples, rates, prior = labelled(docs, labels, most)
    spark = docs.sparkSession
    if set(rates) != {0, 1}:
        return Model(Terms({}), None, (1.0, 1.0), 1.0, 0.0, prior)
    chosen = choose_terms(examples, rates)
    terms = Terms(inverse_frequencies(docs, chosen))
    idf = spark.sparkContext.broadcast(terms.idf)

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Terms(idf.value)
        for frame in frames:
            found = [own.vector(t) for t in frame["text"]]
            yield pd.DataFrame(
                {"term": [[n for n, _ in v] for v in found], "weight": [[w for _, w in v] for v in found], "toxic": frame["toxic"]}
            )

    made = examples.mapInPandas(vectors, "term array<int>, weight array<double>, toxic int")
    entries = made.groupBy("term", "weight").agg(F.sum("toxic").alias("yes"), F.sum(1 - F.col("toxic")).alias("no")).toPandas()
    pairs = [tuple(zip(map(int, t), map(float, w), strict=True)) for t, w in zip(entries["term"], entries["weight"], strict=True)]
    shares = (rates[0], rates[1])
    index = Neighbours(pairs, entries["yes"].to_numpy(), entries["no"].to_numpy(), len(terms.idf))
    votes, marks, weights = [], [], []
    for k, vector in enumerate(index.vectors):
        for label, n in ((1, index.toxic[k]), (0, index.clean[k])):
            if n:
                votes.append(index.vote(vector, shares, leave_out=label))
                marks.append(label)
                weights.append(n / shares[label])
    slope, shift = calibrate(np.array(votes), np.array(marks), np.array(weights))
    return Model(terms, index, shares, slope, shift, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` as (doc_id, text, score, evidence).

    One row per input row, repeated rows included; NULL counts as empty and is scored by
    the background like any text without a chosen term. ``score`` is the calibrated share
    of toxic among the nearest examples, ``evidence`` the heaviest chosen terms of the text. Other columns are
    ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, seen = shared.value, Remembered(100_000)
        for frame in frames:
            texts = ["" if t is None else t for t in frame["text"]]
            for start, end in portions(texts):
                found = own.scores(texts[start:end], seen)
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].iloc[start:end],
                        "score": [s for s, _ in found],
                        "evidence": [own.evidence(v) for _, v in found],
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, score double, evidence array<string>")


def rejections(model: Model, least: float, batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Whether each text scores ``least`` or more, by bounded portions; what a task took it gives back."""
    seen = Remembered(100_000)
    for batch in batches:
        texts = ["" if t is None else t for t in batch]
        found = np.zeros(len(texts), dtype=bool)
        for start, end in portions(texts):
            found[start:end] = [s >= least for s, _ in model.scores(texts[start:end], seen)]
        yield pd.Series(found, index=batch.index)
    model.terms.known = Remembered(model.terms.known.most)
    del seen
    give_back()


def toxic_rows(docs: DataFrame, model: Model, least: float = 0.5) -> Column:
    """For a filter: whether the text of a row scores ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def rejected(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from rejections(shared.value, least, batches)

    return rejected(F.col("text"))
