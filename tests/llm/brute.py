"""Plain Python versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from string import ascii_lowercase, ascii_uppercase

LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Sets:
    """Union-find that keeps the smallest member as root."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def near(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id), all pairs compared."""
    sets, joined = {i: shingles(t) for i, t in rows}, Sets()
    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                joined.join(a, b)
    return {i: (len(s), joined.find(i)) for i, s in sets.items()}


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def contamination(docs, items) -> dict[int, tuple]:
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(13, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[k : k + size])].add(str(item))
    found = {}
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    names |= windows[tuple(w[k : k + size])]
        found[doc] = (len(w), len(hit), len(names), digest(",".join(sorted(names))), bool(hit) and 20 * len(hit) >= len(w))
    return found


def phrases(text: str | None, known: dict[str, str]) -> tuple:
    w = words(text)
    places = []
    for phrase, label in known.items():
        wanted = phrase.split(" ")
        places += [(k, label) for k in range(len(w) - len(wanted) + 1) if w[k : k + len(wanted)] == wanted]
    starts = [k for k, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(w), len(places), min(starts, default=None), max(starts, default=None), labels


def components(edges) -> dict:
    joined = Sets()
    for a, b in edges:
        joined.join(a, b)
    return {x: joined.find(x) for x in list(joined.parent)}


def line_classes(rows: list[tuple[int, str | None]], normal, similar) -> Counter:
    """doc_id -> lines that go, all pairs of lines compared."""
    contents, places = {}, []
    for doc, text in sorted(rows):
        for line in (text or "").split("\n"):
            if normal(line):
                contents.setdefault(normal(line), len(contents))
                places.append((doc, contents[normal(line)]))
    joined, every = Sets(), list(contents)
    for a, x in enumerate(every):
        for b in range(a):
            if similar(x, every[b]):
                joined.join(a, b)
    gone, seen = Counter(), set()
    for doc, n in places:
        gone[doc] += joined.find(n) in seen
        seen.add(joined.find(n))
    return gone


def clustering(rows, clusters: int, rounds: int, dimensions: int) -> list[tuple]:
    """(vec_id, cluster, distance, inertia of the cluster, inertia) in whole numbers."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(1024 * x) for x in v]))
    hashed = sorted(((digest(f"3:{i}") if i is not None else "~"), v) for i, v in kept)
    centroids = [v for _, v in hashed[:clusters]]

    def assign():
        found = []
        for _, v in kept:
            found.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)))
        return found

    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    total = Counter()
    for d, k in found:
        total[k] += d
    return [(i, k, d, total[k], sum(total.values()), centroids[k]) for (i, _), (d, k) in zip(kept, found)]


def without_repeats(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    """Words, removed words and digest of the kept words of each text, all windows counted."""
    split = [SPACED.findall(t or "") for t in texts]
    seen = Counter(tuple(w[k : k + window]) for w in split for k in range(len(w) - window + 1))
    found = []
    for w in split:
        gone = {p for k in range(len(w) - window + 1) if seen[tuple(w[k : k + window])] > 1 for p in range(k, k + window)}
        found.append((len(w), len(gone), digest(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return found


def spellings(rows: list[tuple[int | None, str | None]], typo_every: int, least: int) -> dict[str, tuple]:
    """word -> (form, root, n, n_near, form_n), every single edit of every word looked up."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= least}
    letters, near, form = {c for w in n for c in w}, {}, {}
    for w in n:
        cuts = [(w[:k], w[k:]) for k in range(len(w) + 1)]
        edits = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters}
        edits |= {a + c + b[1:] for a, b in cuts if b for c in letters}
        near[w] = {x for x in edits if x in n and x != w}
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    found = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        found[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return found
