"""Bounded portions of texts for the Python side of an operator."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa

#: Characters and rows that a task works on at a time.
MOST_CHARS = 4_000_000
MOST_ROWS = 1_000


def portions(texts: list[str], chars: int = MOST_CHARS, rows: int = MOST_ROWS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of bounded size; a longer text stands alone."""
    start = size = 0
    for k, text in enumerate(texts):
        if k > start and (size + len(text) > chars or k - start >= rows):
            yield start, k
            start, size = k, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def give_back() -> None:
    """Return what a task has freed to the system: Spark keeps the worker for the stages that follow."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


class Remembered:
    """Bounded look-up that forgets what was not asked for since the last filling."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def of(self, keys: set) -> dict:
        """The values of those keys that are known."""
        young, old = self.young, self.old  # filling up below replaces both
        found = {k: young[k] for k in keys if k in young}
        for key in keys & old.keys():
            if key not in found:
                found[key] = self.put(key, old[key])
        return found

    def put_all(self, found: dict) -> None:
        """Put many values, as ``put`` does one by one."""
        items = iter(found.items())
        for _ in range(0, len(found), max(1, self.most)):
            self.young.update(islice(items, self.most - len(self.young)))
            if len(self.young) >= self.most:
                self.young, self.old = dict(islice(items, self.most)), self.young

    def put(self, key, value):
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        self.young[key] = value
        return value
