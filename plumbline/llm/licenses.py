"""License scans through a positional index of rare words.

Templates are indexed by word and position. A template counts only if its key phrase stands in
a file; for those, all licence words of the file are looked up. Every posting proposes (template,
offset), the offsets that several words agree on are aligned, with shifts where words were put in
or left out, and the key phrase must stand in the alignment. Coverage is weighted by the IDF, which
is counted over the whole corpus first.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import common

#: Phrases that name a licence wherever their words stand consecutively.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Opening words of public licence texts: label, mandatory key phrase, text.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction"),
    ("apache-2", "apache license",
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("gpl", "gnu general public license",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation"),
    ("mpl-2", "mozilla public license",
     "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at"),
    ("isc", "permission to use copy modify and or distribute",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "free and unencumbered software",
     "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "attribution noncommercial",
     "this work is licensed under a creative commons attribution noncommercial license"),
    ("cc-by", "creative commons attribution",
     "this work is licensed under a creative commons attribution 4 0 international license"),
)
#: Words of an alignment that must agree, the words that a part of a template may be shifted by,
#: and the share of a template's words that makes a label.
AGREE = 3
SHIFT = 8
COVERED = 0.7

WORD = re.compile(common.WORD)
LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


@dataclass(frozen=True)
class Found:
    n_words: int
    places: list[tuple[int, str]]
    added: list[str]
    score: float


class Templates:
    """The positional index of the templates: word -> (template, position)."""

    def __init__(self, idf: dict[str, float]):
        self.idf = idf
        self.words = [text.split(" ") for _, _, text in TEMPLATES]
        self.index: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, words in enumerate(self.words):
            for place, word in enumerate(words):
                self.index[word].append((n, place))

    def scan(self, text: str) -> Found:
        words = WORD.findall(text.translate(LOWER))
        if not words:
            return Found(0, [], [], 0.0)
        line = " " + " ".join(words) + " "
        places = sorted((at, label) for phrase, label in PHRASES.items() for at in phrase_places(line, phrase))
        added, score = [], 1.0 if places else 0.0
        keys = {n: found for n, (_, key, _) in enumerate(TEMPLATES) if (found := list(phrase_places(line, key)))}
        for n, offset in self.alignments(words, keys) if keys else []:
            covered, start, end = self.coverage(words, n, offset)
            if covered < COVERED:
                continue
            label, key, _ = TEMPLATES[n]
            if any(start <= at and at + key.count(" ") < end for at in keys[n]):
                added.append(label)
                score = max(score, covered)
        return Found(len(words), places, added, score)

    def alignments(self, words: list[str], keys: dict[int, list[int]]) -> list[tuple[int, int]]:
        """(template, offset) on which enough postings agree, of templates whose key phrase the file has."""
        postings = {word: [(n, place) for n, place in found if n in keys] for word, found in self.index.items()}
        postings = {word: found for word, found in postings.items() if found}
        votes: Counter[tuple[int, int]] = Counter()
        for at, word in enumerate(words):
            if word in postings:
                votes.update((n, at - place) for n, place in postings[word])
        return sorted(a for a, n in votes.items() if n >= AGREE)

    def coverage(self, words: list[str], n: int, offset: int) -> tuple[float, int, int]:
        """Share of the template's words, by IDF, at their relative position, and where they begin
        and end. Runs of AGREE words or more may be shifted against the offset."""
        wanted = self.words[n]
        found = {place: offset + place for place in places_at(words, wanted, offset)}
        for offset_there in sorted(range(offset - SHIFT, offset + SHIFT + 1), key=lambda o: abs(o - offset)):
            run: list[int] = []
            for place in [*places_at(words, wanted, offset_there), len(wanted) + 1]:
                if run and place != run[-1] + 1:
                    if len(run) >= AGREE:
                        found = {p: offset_there + p for p in run} | found
                    run = []
                run.append(place)
        weights = [self.idf.get(word, 1.0) for word in wanted]
        return sum(weights[p] for p in found) / sum(weights), min(offset, *found.values()), max(offset + len(wanted), 1 + max(found.values()))


def places_at(words: list[str], wanted: list[str], offset: int) -> list[int]:
    """The places of a template whose words stand in the file at the offset."""
    return [p for p in range(max(0, -offset), min(len(wanted), len(words) - offset)) if words[offset + p] == wanted[p]]


def phrase_places(line: str, phrase: str) -> Iterator[int]:
    """Word positions at which the phrase stands; ``line`` has a space around every word."""
    wanted, at, words, counted = f" {phrase} ", line.find(f" {phrase} "), 0, 0
    while at >= 0:
        words += line.count(" ", counted, at)
        counted = at
        yield words
        at = line.find(wanted, at + 1)


def inverse_frequencies(docs: DataFrame) -> dict[str, float]:
    """IDF of the templates' words over all documents; at most one row per such word."""
    vocabulary = sorted({w for _, _, text in TEMPLATES for w in text.split(" ")})
    held = F.array_intersect(common.words(F.col("text")), F.array(*[F.lit(w) for w in vocabulary]))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    found = {r["word"]: r["n"] for r in counts.collect()}
    total = docs.select("doc_id").count()
    return {w: math.log((1 + total) / (1 + found.get(w, 0))) + 1e-3 for w in vocabulary}


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licences that each document names or holds.

    One row per input row, repeated rows included: doc_id, n_words, places
    (array of word position and label of each base phrase, by position), base_labels and labels
    (sorted, without repeats; labels also has those found by alignment), score (1 with a
    base phrase, else the covered share of the best template). NULL counts as empty: no
    words, empty lists, score 0. Other columns are ignored.
    """
    idf = inverse_frequencies(docs)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates = Templates(idf)
        for frame in frames:
            found = [templates.scan(t or "") for t in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n_words": [f.n_words for f in found],
                    "places": [[{"word": at, "label": label} for at, label in f.places] for f in found],
                    "base_labels": [sorted({label for _, label in f.places}) for f in found],
                    "labels": [sorted({label for _, label in f.places} | set(f.added)) for f in found],
                    "score": [f.score for f in found],
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_words long, places array<struct<word:long,label:string>>, "
        "base_labels array<string>, labels array<string>, score double"
    )
    return docs.select("doc_id", "text").mapInPandas(run, schema)


def license_digests(scanned: DataFrame) -> DataFrame:
    starts = F.col("places.word")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
