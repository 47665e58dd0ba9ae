"""Byte-level BPE: encoding and decoding by recursive queries on token-position rows.

Each task opens a DuckDB database in memory with the merge table, and closes it at its end. The words of a batch that
the task has not met yet become rows (piece, position, token); a recursive query joins
neighbouring tokens with the merge table and contracts, in every piece, the leftmost pair of
minimum rank until no pair is left. An ordered aggregation gives the ids and their bytes.
Spark deals the texts to the tasks; no row depends on another, so nothing is shuffled.
"""

from __future__ import annotations

import base64
import gc
import heapq
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from plumbline.llm.portions import Remembered, give_back, portions

#: Fixed value: what the pattern of the tokenizers means by white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Fixed value: the first character after the Latin letters whose properties are old in all versions of Unicode.
BEYOND_LATIN = "\u0250"
#: Stretches and pieces whose ids a task remembers, and the longest stretch (characters) among them.
REMEMBERED = 150_000
SHORT_STRETCH = 40
#: Rows that one recursive query makes at most: half the square of the length of each piece. A longer piece stands alone.
ROWS_AT_ONCE = 1_000_000
#: Pieces of more bytes, as a run of blanks or dashes can be, are contracted with a heap, in the same order:
#: rows that grow with the square of their length would not fit a worker.
LONG_PIECE = 4_000

#: A database in memory, which never writes beside the worker.
DATABASE = {"threads": 1, "memory_limit": "400MB", "temp_directory": ""}
#: Characters that are encoded, and bytes of ids that are decoded, at a time.
CODED_AT_ONCE = 2_000_000
DECODED_AT_ONCE = 1_000_000

# The best pair of a piece is the least number of rank (28 bits), place in the batch (22 bits) and length of the left token.
CONTRACT = """
WITH RECURSIVE state AS (
  SELECT 0 AS step, piece, pos, tok, next_tok, next_pos FROM start
  UNION ALL
  SELECT step + 1, s.piece, s.pos,
         CASE WHEN s.pos = spot THEN merged ELSE tok END,
         CASE WHEN s.pos = spot THEN beyond_tok WHEN s.next_pos = spot THEN merged ELSE s.next_tok END,
         CASE WHEN s.pos = spot THEN beyond_pos ELSE s.next_pos END
  FROM state s JOIN (
    SELECT b.piece, (best >> 35)::INTEGER AS merged, spot, r.pos AS gone, r.next_tok AS beyond_tok, r.next_pos AS beyond_pos
    FROM (SELECT piece, best, ((best >> 13) & 4194303)::INTEGER AS spot, (((best >> 13) & 4194303) + (best & 8191))::INTEGER AS gone
          FROM (SELECT piece, min((merged::BIGINT << 35) | (pos::BIGINT << 13) | (next_pos - pos)) AS best
                FROM state JOIN merges ON pair = (tok::BIGINT << 32) | next_tok GROUP BY piece)) b
    JOIN state r ON r.pos = b.gone
  ) b ON s.piece = b.piece
  WHERE s.pos <> gone
),
final AS (
  SELECT piece, pos, tok FROM state JOIN (SELECT piece, max(step) AS step FROM state GROUP BY piece) USING (piece, step)
)
SELECT piece, tok FROM final ORDER BY pos
"""

DECODE = """
SELECT text, list(bytes ORDER BY pos) AS parts FROM token_rows JOIN vocabulary ON id = tok GROUP BY text ORDER BY text
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def ranges(kind: str) -> str:
    """All characters of a Unicode property, as ranges for a character class."""
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    found = (m.group() for m in regex.finditer(rf"\p{{{kind}}}+", everything))
    return "".join(re.escape(run[0]) + "-" + re.escape(run[-1]) for run in found)


class Coder:
    """The vocabulary of one file in one task, with the merge table derived from it."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        # The pattern's \s is the Unicode property; the module's also takes four separators.
        self.pieces = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))
        self.gap = re.compile(f"[{WHITE}] | [{WHITE}]")
        # One look-up for both: a piece by itself is a stretch of one piece.
        self.known = Remembered(REMEMBERED)
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self.db = duckdb.connect(config=DATABASE)
        pair = (np.array(left, dtype=np.int64) << 32) | np.array(right, dtype=np.int64)
        self.db.register("given", pa.table({"pair": pair, "merged": np.array(merged, dtype=np.int32)}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.unregister("given")

    def plain(self, text: str) -> bool:
        """Whether no match of the pattern crosses a cut at single spaces between words."""
        return not (self.gap.search(text) or text[:1] == " " or text[-1:] == " ")

    def contract(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids of each piece that is not a token itself."""
        lengths = np.array([len(p) for p in pieces])
        joined = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        places = np.arange(len(joined) + 1, dtype=np.int32)
        tokens = np.append(self.first[joined], np.int32(0))
        last = np.zeros(len(joined), dtype=bool)
        last[np.cumsum(lengths) - 1] = True
        start = {
            "piece": np.repeat(np.arange(len(pieces), dtype=np.int32), lengths),
            "pos": places[:-1],
            "tok": tokens[:-1],
            "next_tok": pa.array(tokens[1:], mask=last),
            "next_pos": pa.array(places[1:], mask=last),
        }
        self.db.register("start", pa.table(start))
        result = self.db.sql(CONTRACT).to_arrow_table().combine_chunks()
        self.db.unregister("start")
        ids = result["tok"].to_numpy().astype("<u4").tobytes()
        at = 0
        for n in (4 * np.bincount(result["piece"].to_numpy(), minlength=len(pieces))).tolist():
            yield ids[at : at + n]
            at += n

    def contract_long(self, piece: bytes) -> list[int]:
        """The same contraction for one long piece, with a heap instead of rounds."""
        tokens = self.first[np.frombuffer(piece, dtype=np.uint8)].tolist()
        parts: list[bytes | None] = [bytes([b]) for b in piece]
        after = [*range(1, len(parts)), -1]
        before = list(range(-1, len(parts) - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                rank = self.ranks.get(parts[i] + parts[after[i]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, parts[i], parts[after[i]]))

        for i in range(len(parts)):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            if parts[i] is not left or after[i] < 0 or parts[after[i]] is not right:
                continue
            gone = after[i]
            parts[i], parts[gone], tokens[i] = left + right, None, rank
            after[i] = after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [t for t, part in zip(tokens, parts, strict=True) if part is not None]

    def code(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of each piece; the new ones are contracted."""
        coded = self.known.of(pieces)
        short, raws, found = [], [], {}
        for piece in pieces - coded.keys():
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                found[piece] = self.pack([rank])
            elif len(raw) > LONG_PIECE:
                coded[piece] = self.pack(self.contract_long(raw))
            else:
                short.append(piece), raws.append(raw)
        # Pieces of one length need about as many rounds.
        lengths = np.array([len(raw) for raw in raws], dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        rows = np.cumsum(lengths[order] ** 2 // 2)
        start = 0
        while start < len(short):
            made = rows[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(rows, made + ROWS_AT_ONCE, side="right")))
            some = order[start:end].tolist()
            found.update(zip([short[k] for k in some], self.contract([raws[k] for k in some]), strict=True))
            start = end
        coded.update(found)
        self.known.put_all({piece: ids for piece, ids in found.items() if len(piece) <= SHORT_STRETCH})
        return coded

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()

    def stretches(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct stretches of plain texts, the number of each in order, and where each text starts."""
        words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        numbers = coded.indices.to_numpy().copy()
        distinct = coded.dictionary.to_pylist()
        # The first word of a text has no blank before it.
        firsts = [distinct[n] for n in numbers[bounds[:-1]]]
        numbers[bounds[:-1]] = np.arange(len(distinct), len(distinct) + len(firsts))
        return [" " + word for word in distinct] + firsts, numbers, bounds

    def ids_of(self, stretches: list[str]) -> dict[str, bytes]:
        """Ids of each stretch; a word of Latin letters, with or without its blank, is a piece by itself."""
        distinct = set(stretches)
        known = self.known.of(distinct)
        fresh = distinct - known.keys()
        words = {s for s in fresh if s[s[:1] == " " :].isalpha() and (s.isascii() or max(s) < BEYOND_LATIN)}
        mixed = {s: self.pieces.findall(s) for s in fresh - words}
        coded = self.code(words.union(*mixed.values()))
        joined = {s: b"".join([coded[p] for p in own]) for s, own in mixed.items()}
        known.update(joined)
        self.known.put_all({s: ids for s, ids in joined.items() if len(s) <= SHORT_STRETCH and s not in coded})
        known.update((word, coded[word]) for word in words)
        return known

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Of each text the ids as little-endian 32-bit integers."""
        plain = [self.plain(text) for text in texts]
        some = [text for text, cut in zip(texts, plain, strict=True) if cut]
        stretches, numbers, bounds = self.stretches(some) if some else ([], np.zeros(0, int), np.zeros(1, int))
        others = [self.pieces.findall(text) for text, cut in zip(texts, plain, strict=True) if not cut]
        known = self.ids_of([*stretches, *(s for own in others for s in own)])
        ids = pa.array([known[s] for s in stretches], pa.large_binary()).take(pa.array(numbers))
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset :][bounds] if some else bounds
        data = memoryview(ids.buffers()[2] or b"")
        runs = iter(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
        rest = iter(others)
        for cut in plain:
            if cut:
                start, end = next(runs)
                yield bytes(data[start:end])
            else:
                yield b"".join([known[s] for s in next(rest)])


class Decoder:
    """The vocabulary of one file in one task: ids and their bytes, and nothing that only encoding needs."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.db = duckdb.connect(config=DATABASE)
        vocabulary = {"id": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array(list(ranks), pa.binary())}
        self.db.register("given", pa.table(vocabulary))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.db.unregister("given")

    def decode(self, coded: list[bytes]) -> Iterator[bytes]:
        """The bytes of each row of ids, in the order of the positions."""
        sizes = np.array([len(ids) // 4 for ids in coded], dtype=np.int64)
        token_rows = {
            "text": np.repeat(np.arange(len(coded), dtype=np.int32), sizes),
            "pos": np.arange(sizes.sum(), dtype=np.int64),
            "tok": np.frombuffer(b"".join(coded), dtype="<u4").astype(np.int32),
        }
        self.db.register("token_rows", pa.table(token_rows))
        result = self.db.sql(DECODE).to_arrow_table().combine_chunks()
        self.db.unregister("token_rows")
        parts = result["parts"].combine_chunks()
        if len(parts.values) != sizes.sum():
            raise ValueError("an id is not in the vocabulary")
        # The bytes of all tokens stand one behind the other; a text is a stretch of them.
        tokens = parts.values.cast(pa.large_binary())
        ends = np.frombuffer(tokens.buffers()[1], dtype=np.int64)[tokens.offset :]
        bounds = ends[parts.offsets.to_numpy()] if len(parts) else []
        stretches = {text: (bounds[k], bounds[k + 1]) for k, text in enumerate(result["text"].to_pylist())}
        data = memoryview(tokens.buffers()[2] or b"")
        for n in range(len(coded)):
            start, end = stretches.get(n, (0, 0))
            yield bytes(data[start:end])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of each row: token ids as little-endian unsigned 32-bit integers in one binary value.

    One row per input row, repeated rows included. NULL counts as empty, and an empty text
    has no ids. Special tokens are ordinary text. Other columns are ignored.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Coder(path, pattern)
        for frame in frames:
            texts = ["" if t is None else t for t in frame["text"]]
            for start, end in portions(texts, CODED_AT_ONCE):
                gc.disable()  # a portion makes no cycles, and millions of objects to walk through
                ids = list(own.encode(texts[start:end]))
                gc.enable()
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[start:end], "ids": ids})
        own.db.close()
        del own
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) from (doc_id, ids): an ordered aggregation over token-position rows.

    One row per input row. NULL ids count as none; an id that the vocabulary lacks is an error.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Decoder(path)
        for frame in frames:
            coded = [ids or b"" for ids in frame["ids"]]
            for start, end in portions(coded, DECODED_AT_ONCE):
                rows = frame.iloc[start:end]
                yield pd.DataFrame({"doc_id": rows["doc_id"], "ids": rows["ids"], "decoded": list(own.decode(coded[start:end]))})
        own.db.close()
        del own
        give_back()

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInPandas(run, f"doc_id {kind}, ids binary, decoded binary")
