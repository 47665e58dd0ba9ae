"""Grouping of spelling variants by asymmetric q-chunks.

One word of a pair contributes its two disjoint chunks, the first and the last half of its
letters; the other contributes its positional grams of that size. One edit leaves a chunk
whole, and its place in the other word moves by the difference in length at most, so grams
are made at the places, within a shift of one, where a chunk of a word one letter shorter,
equal or longer can stand. So that words of one half do not all meet, a chunk goes with a
chunk of the rest: the rest holds the edit, and of its own two disjoint chunks one is whole.
What agrees in such a pair of chunks is verified letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import cut_lineage

#: A run of letters in UTF-8 after lower-casing A-Z (a-z, U+00C0 to U+00FF),
#: which runs lose a letter, shortest word, fewest occurrences, and how much commoner a form is.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
TYPO_EVERY = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
COMMONER = 5
#: Words that a task counts before it hands the counts on.
MOST_WORDS = 300_000


def without_letter(run: bytes, place: int) -> bytes:
    letters = run.decode()
    return (letters[:place] + letters[place + 1 :]).encode()


def count_words(docs: DataFrame, typo_every: int = TYPO_EVERY, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """(word, n): the runs of all texts of at least ``least_letters`` letters.

    A run loses the letter that its hash with the document names if ``typo_every`` divides
    the hash. Each task hands on counts, not occurrences. A NULL doc_id is hashed as ``null``.
    """

    def ready(counts: Counter) -> pa.RecordBatch:
        words = [word.decode() for word in counts]
        kept = [(word, n) for word, n in zip(words, counts.values(), strict=True) if len(word) >= least_letters]
        return pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in kept], pa.string()), "n": pa.array([n for _, n in kept], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                raw = (text.as_py() or "").encode().lower()
                start = zlib.crc32(f"{doc_id.as_py()}:".encode() if doc_id.is_valid else b"null:")
                for word, n in Counter(RUN.findall(raw)).items():
                    # Runs of fewer bytes have fewer letters, whatever they lose.
                    if len(word) >= least_letters:
                        h = zlib.crc32(word, start)
                        if h % typo_every == 0:
                            word = without_letter(word, h % len(word.decode()))
                        counts[word] += n
                if len(counts) >= MOST_WORDS:
                    yield ready(counts)
                    counts = Counter()
        yield ready(counts)

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def chunk_pairs(word: Column, length: Column) -> Column:
    """The letters that one edit of a word of ``length`` letters can leave, as four keys.

    With q letters in each half and r in each half of the rest: first half and the start of
    the rest, first half and the end of the rest, and both mirrored.
    """
    q = F.floor(length / 2).cast("int")
    r = F.floor((length - q) / 2).cast("int")

    def kept(first: Column, last: Column) -> Column:
        return F.concat(F.substring(word, F.lit(1), first), F.substring(word, F.length(word) - last + 1, last))

    none = F.lit(0)
    made = [kept(q + r, none), kept(q, r), kept(r, q), kept(none, q + r)]
    return F.array(*[F.xxhash64(F.lit(n), length, letters) for n, letters in enumerate(made)])


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all words of (word, n) exactly one inserted, deleted or replaced letter apart."""
    length = F.length("word")
    chunks = words.select("word", F.explode(chunk_pairs(F.col("word"), length)).alias("key"))
    others = words.select("word", "n", F.explode(F.array(length - 1, length, length + 1)).alias("length"))
    grams = others.select(
        F.col("word").alias("near"), F.col("n").alias("near_n"), F.explode(chunk_pairs(F.col("word"), F.col("length"))).alias("key")
    )
    met = chunks.join(grams, "key").where(F.levenshtein("word", "near", 1) == 1)
    return met.groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of (word, form); rounds double the steps.

    A form is commoner than its word, so chains end.
    """
    found = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = cut_lineage(found.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), "beyond"))
        found = moved.select("word", "root")
        if moved.where("beyond IS NOT NULL").isEmpty():
            return found


def group_variants(docs: DataFrame, least_count: int = LEAST_COUNT, commoner: int = COMMONER) -> DataFrame:
    """One row per word of at least ``least_count`` occurrences in all texts.

    Columns: word, form (of the words near it the commonest, if at least ``commoner`` times
    as common; ties: the first in code-point order; else NULL), root (the end of the chain
    of forms, or the word), n, n_near, form_n. NULL and empty texts have no words; repeated
    rows count each; an empty table gives no rows. Other columns are ignored.
    """
    words = cut_lineage(count_words(docs).where(F.col("n") >= least_count))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = cut_lineage(near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    joined = words.join(near, "word", "left")
    is_form = -F.col("best.less") >= commoner * F.col("n")
    judged = cut_lineage(
        joined.select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: Single bytes that stand for U+00C0 to U+00FF, as the distance of DuckDB counts bytes.
_LATIN = "".join(map(chr, range(0xC0, 0x100)))
_BYTES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~ "[: len(_LATIN)]

SQL = rf"""
WITH RECURSIVE entry AS (SELECT 0 AS bits, i, i AS c FROM range(256) t(i)
  UNION ALL SELECT bits + 1, i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM entry WHERE bits < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM entry WHERE bits = 8),
run AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents) GROUP BY ALL),
coded AS (SELECT run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda l: CASE WHEN unicode(l) < 128 THEN [unicode(l)::BIGINT] ELSE [195::BIGINT, unicode(l)::BIGINT - 64] END)) AS bytes
  FROM run WHERE length(run) >= {LEAST_LETTERS}),
hashed AS (SELECT run, n, xor(4294967295,
    list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h FROM coded, crc),
word AS (SELECT CASE WHEN h % {TYPO_EVERY} = 0
      THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word,
    sum(n)::BIGINT AS n FROM hashed GROUP BY 1 HAVING sum(n) >= {LEAST_COUNT}),
w AS MATERIALIZED (SELECT word, n, translate(word, '{_LATIN}', '{_BYTES}') AS shown FROM word WHERE length(word) >= {LEAST_LETTERS}),
near AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM w a, w b
  WHERE abs(length(a.word) - length(b.word)) <= 1 AND levenshtein(a.shown, b.shown) = 1),
best AS (SELECT word, count(*) AS n_near, min({{'less': -near_n, 'near': near}}) AS best FROM near GROUP BY 1),
form AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best.less >= {COMMONER} * w.n THEN best.near END AS form,
    CASE WHEN -best.less >= {COMMONER} * w.n THEN -best.less END AS form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, 0 AS steps FROM form
  UNION ALL SELECT chain.word, form.form, steps + 1 FROM chain JOIN form ON form.word = chain.root WHERE form.form IS NOT NULL)
SELECT word, form, max_by(root, steps) AS root, n, n_near, form_n FROM form JOIN chain USING (word) GROUP BY ALL
"""
