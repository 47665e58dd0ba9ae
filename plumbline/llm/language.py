"""Language identification of mixed texts: script ranges, word scores, Viterbi over words.

A word's score per language is the log-likelihood of its character n-grams and of the word
itself, hashed into a table of fixed size. The ranges of its script leave only languages
that write in it. Viterbi with a penalty for each switch labels spans of words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.portions import Remembered, portions

#: Runs of letters (and of the rare numerals that count as such; see ``Model.word``).
WORD = re.compile(r"[^\W\d_]+")
#: First and last code points of scripts, from the Unicode block list.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("latin", 0x1E00, 0x1EFF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
#: Size of the hashed table, longest n-gram, documents per language that a fit reads at most
#: (in expectation: chosen by a hash of doc_id), penalty of a switch, cost of a foreign script.
BUCKETS = 1 << 17
LONGEST = 4
MOST_PER_LANGUAGE = 4_000
SWITCH = 14.0
FOREIGN = 30.0


def held_out(doc_id: Column) -> Column:
    """Documents kept apart: the remainder of crc32 of the id as text by 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def script_of(word: str) -> int:
    """The number of the script of a word's first letter; 0 for any other."""
    c = ord(word[0])
    return next((n for n, (_, low, high) in enumerate(SCRIPTS, 1) if low <= c <= high), 0)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words, and where each word's begin."""
    coded = [np.frombuffer(f"^{w}$".encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for w in words]
    lengths = np.array([len(c) for c in coded])
    flat = np.concatenate(coded).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(flat))
    found, whose, code = [], [], np.zeros(len(flat), dtype=np.uint64)
    for n in range(1, LONGEST + 1):
        code = code * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
        code[: len(flat) - n + 1] += flat[n - 1 :] * np.uint64(0xC2B2AE3D27D4EB4F)
        whole = left >= n
        mixed = code[whole]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        found.append((mixed >> np.uint64(40)) % np.uint64(BUCKETS))
        whose.append(owner[whole])
    found.append(np.array([crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in words], dtype=np.uint64))
    whose.append(np.arange(len(words)))
    whose = np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return np.concatenate(found)[order].astype(np.int64), np.searchsorted(whose[order], np.arange(len(words)))


class Model:
    """Scores of n-gram buckets per language, and the languages of each script."""

    def __init__(self, languages: list[str], table: np.ndarray, scripts: np.ndarray):
        self.languages, self.table, self.scripts = languages, table, scripts
        self.rows: list[np.ndarray] = []
        self.known = Remembered(200_000)

    def score(self, words: list[str]) -> np.ndarray:
        """Per word and language: log-likelihood against the best language, never below -FOREIGN."""
        buckets, starts = grams([w.lower() for w in words])
        sums = np.add.reduceat(self.table[buckets], starts, axis=0)
        used = self.scripts[[script_of(w) for w in words]]
        sums = np.where(used, sums, -np.inf)
        best = sums.max(axis=1, keepdims=True)
        relative = np.where(np.isfinite(best), sums - np.where(np.isfinite(best), best, 0), 0.0)
        return np.maximum(relative, -FOREIGN)

    def word_scores(self, words: set[str]) -> dict[str, np.ndarray | None]:
        """Scores of the different words of a portion; None for what has no letter."""
        found, fresh = {}, []
        for word in words:
            known = self.known.get(word)
            if known is not None:
                found[word] = known
            elif any(c.isalpha() for c in word):
                fresh.append(word)
            else:
                found[word] = None
        if fresh:
            for word, row in zip(fresh, self.score(fresh), strict=True):
                found[word] = row
                self.known.put(word, row)
        return found

    def label(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """Spans of each text: (first word, last word, language, letters)."""
        cut = [WORD.findall(t) for t in texts]
        scores = self.word_scores(set().union(*cut))
        cut = [[w for w in words if scores[w] is not None] for words in cut]
        used = [n for n, words in enumerate(cut) if words]
        if not used:
            return [[] for _ in texts]
        number = {w: n for n, w in enumerate({w for words in cut for w in words})}
        rows = np.array([scores[w] for w in number])
        sizes = np.array([len(cut[n]) for n in used])
        ends = np.cumsum(sizes)
        own = [np.fromiter(map(number.__getitem__, cut[n]), dtype=np.int64, count=len(cut[n])) for n in used]
        flat = rows[np.concatenate(own)]
        best, single = constant_paths(flat, sizes)
        spans: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        mixed = []
        for k, n in enumerate(used):
            if single[k]:
                spans[n] = [(0, len(cut[n]) - 1, int(best[k]), sum(map(len, cut[n])))]
            else:
                mixed.append(k)
        paths = viterbi([flat[ends[k] - sizes[k] : ends[k]] for k in mixed])
        for k, path in zip(mixed, paths, strict=True):
            words = cut[used[k]]
            bounds = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
            spans[used[k]] = [
                (a, b - 1, int(path[a]), sum(len(w) for w in words[a:b])) for a, b in zip(bounds, bounds[1:], strict=False)
            ]
        return spans


def constant_paths(scores: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best single language of each text, and whether surely no switch can beat it.

    A path with k stretches in other languages has k - 1 switches at least, and one at least
    if it is not the worse constant path. So if no stretch in any other language gains more than half a
    penalty against the best one, no such path gains anything.
    """
    starts = np.cumsum(sizes) - sizes
    best = np.add.reduceat(scores, starts, axis=0).argmax(axis=1)
    text = np.repeat(np.arange(len(sizes)), sizes)
    chosen = scores[np.arange(len(scores)), best[text]].astype(np.float64)
    # Sums of each text lie below those of the text before it, so that running minima start anew.
    below = text * -(float(FOREIGN) * 2 * sizes.max())
    sure = np.ones(len(sizes), dtype=bool)
    for lang in range(scores.shape[1]):
        gain = scores[:, lang] - chosen
        sums = np.cumsum(gain)
        sums -= np.repeat(sums[starts] - gain[starts], sizes)
        before = np.minimum.accumulate(sums - gain + below) - below
        sure &= np.maximum.reduceat(sums - before, starts) <= SWITCH / 2
    return best, sure


def viterbi(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Best language of each word, all texts in step; the longest come first as others end."""
    if not texts:
        return []
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) for k in order])
    offsets = np.cumsum(sizes) - sizes
    flat = np.concatenate([texts[k] for k in order])
    back = np.zeros(flat.shape, dtype=np.int16)
    own = np.arange(flat.shape[1], dtype=np.int16)
    state = flat[offsets].copy()
    alive = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    for t in range(1, sizes[0]):
        n = alive[t]
        current = state[:n]
        top = current.argmax(axis=1)
        switch = current[np.arange(n), top][:, None] - SWITCH
        stay = current >= switch
        back[offsets[:n] + t] = np.where(stay, own, top[:, None].astype(np.int16))
        state[:n] = np.where(stay, current, switch) + flat[offsets[:n] + t]
    path = np.zeros(len(flat), dtype=np.int16)
    last = state.argmax(axis=1).astype(np.int16)
    for t in range(sizes[0] - 1, -1, -1):
        n = alive[t] if t else len(sizes)
        at = offsets[:n] + t
        path[at] = last[:n]
        last[:n] = back[at, last[:n]]
    found: list[np.ndarray] = [np.empty(0)] * len(texts)
    for k, start, size in zip(order, offsets, sizes, strict=True):
        found[k] = path[start : start + size]
    return found


def fit(docs: DataFrame, most: int = MOST_PER_LANGUAGE) -> Model:
    """Learn from rows with a text and a lang outside the held-out fold.

    About ``most`` documents per language are read, chosen by a hash of their ids; what comes to the driver are
    counts per hashed n-gram and language, a table of fixed size.
    """
    usable = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    number = {lang: n for n, lang in enumerate(languages)}
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS) + 1, 0), dtype=bool))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, most / sizes[lang]))])
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share[F.col("lang")] * 1_000_003)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((BUCKETS + len(SCRIPTS) + 1, len(languages)))
        for frame in frames:
            for lang, part in frame.groupby("lang"):
                words = Counter(w for t in part["text"] for w in WORD.findall(t.lower()))
                if words:
                    buckets, starts = grams(list(words))
                    times = np.array(list(words.values()), dtype=float)
                    repeat = np.diff([*starts, len(buckets)])
                    table[:BUCKETS, number[lang]] += np.bincount(buckets, np.repeat(times, repeat), BUCKETS)
                    script = np.array([script_of(w) for w in words])
                    table[BUCKETS:, number[lang]] += np.bincount(script, times, len(SCRIPTS) + 1)
        bucket, lang = np.nonzero(table)
        yield pd.DataFrame({"bucket": bucket, "lang": lang, "n": table[bucket, lang]})

    counted = sample.select("lang", "text").mapInPandas(count, "bucket int, lang int, n double")
    totals = counted.groupBy("bucket", "lang").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((BUCKETS + len(SCRIPTS) + 1, len(languages)))
    table[totals["bucket"], totals["lang"]] = totals["n"]
    ngrams, scripts = table[:BUCKETS], table[BUCKETS:]
    logs = np.log((ngrams + 0.5) / (ngrams.sum(axis=0) + 0.5 * BUCKETS))
    used = scripts >= 0.01 * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, (logs / LONGEST).astype(np.float32), used)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, score, spans) of each row.

    One row per input row, repeated rows included. ``spans`` has first and last word (words
    are runs of letters, from 0), language and letters. ``lang`` is the language with most
    letters (ties: the first by name) and ``score`` its share of the letters; NULL and texts without a
    letter are ``und`` with score 0, and so is every text if nothing could be learned. Words of a script
    that no language writes have no say; if there are only such words, the first language by
    name is named. Columns other than doc_id and text are ignored.
    """
    languages, table, scripts = model.languages, model.table, model.scripts

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(languages, table, scripts)
        for frame in frames:
            texts = ["" if t is None else t for t in frame["text"]]
            for start, end in portions(texts):
                found = own.label(texts[start:end]) if languages else [[] for _ in range(start, end)]
                names, scores = [], []
                for spans in found:
                    letters = np.zeros(max(1, len(languages)))
                    for _, _, lang, n in spans:
                        letters[lang] += n
                    names.append(languages[int(letters.argmax())] if spans else "und")
                    scores.append(float(letters.max() / letters.sum()) if spans else 0.0)
                shown = [[{"first": a, "last": b, "lang": languages[x]} for a, b, x, _ in spans] for spans in found]
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[start:end], "lang": names, "score": scores, "spans": shown})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang string, score double, spans array<struct<first:long,last:long,lang:string>>"
    return docs.select("doc_id", "text").mapInPandas(run, schema)
