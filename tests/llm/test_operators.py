"""Text operators against plain Python versions, round trips and held-out accuracy."""

import hashlib
import random
import re
import string
import tracemalloc

import brute
import corpus_pipeline
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from conftest import prose

from plumbline.llm import byte_bpe, catalog, components, decontaminate, exact_dedup, html_text, jaccard_join, language, licenses, line_dedup
from plumbline.llm import portions, secrets, toxicity

SF = "/root/testdata/sf0.01"


def texts(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def family(dice: random.Random, vocabulary: list[str], size: int, copies: int, edits: int, drift: bool) -> list[str]:
    base = [dice.choice(vocabulary) for _ in range(size)]
    found = []
    for _ in range(copies):
        words = list(base)
        for _ in range(dice.randint(0, edits)):
            words[dice.randrange(len(words))] = dice.choice(vocabulary)
        base = words if drift else base
        found.append(" ".join(words))
    return found


@pytest.mark.parametrize(("small", "pivots"), [(256, 32), (4, 3)])
def test_jaccard_join_is_exact_however_regions_are_split(spark, small, pivots):
    dice = random.Random(5)
    vocabulary = [f"w{k}" for k in range(2_000)]
    rows = family(dice, vocabulary, 60, 25, 2, False) + family(dice, vocabulary, 60, 25, 1, True)
    shared = " ".join(dice.choice(vocabulary) for _ in range(40))
    rows += [shared + " " + " ".join(dice.choice(vocabulary) for _ in range(dice.randint(2, 12))) for _ in range(20)]
    rows += [rows[0], "", "a b", "A  b", "a b c"]
    numbered = list(enumerate(rows))
    frame = spark.createDataFrame(numbered, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(frame, small, pivots).collect()}
    assert found == brute.near(numbered)


def test_jaccard_join_on_documents(spark, documents):
    some = documents.where("doc_id < 300")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(some).collect()}
    assert found == brute.near(texts(some))


def test_parity_bounds_the_difference():
    dice = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(dice.integers(0, 1 << 62, dice.integers(1, 900), dtype=np.uint64))
        b = np.unique(np.concatenate([a[dice.random(len(a)) < 0.8], dice.integers(0, 1 << 62, 40, dtype=np.uint64)]))
        least = jaccard_join.least_difference(jaccard_join.parity(a), jaccard_join.parity(b))
        assert least <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    dice = random.Random(seed)
    edges = [(dice.randint(0, 60), dice.randint(0, 60)) for _ in range(40)] + [(100, k) for k in range(101, 160)] + [(k, k + 1) for k in range(200, 230)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == brute.components(edges)


def test_contamination(spark, corpus, benchmark_items):
    own = corpus.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    found = decontaminate.contamination(own, benchmark_items).collect()
    items = [(r["item_id"], r["text"]) for r in benchmark_items.where("item_id IS NOT NULL").collect()]
    wanted = brute.contamination(texts(own), items)
    for row in found:
        if row["doc_id"] != 13:
            assert tuple(row[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == wanted[row["doc_id"]]
    plan = decontaminate.contamination(own, benchmark_items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_proximity_without_the_exact_phrase(spark):
    phrase = [f"t{k}" for k in range(13)]
    moved = [*phrase[:6], phrase[7], phrase[6], *phrase[8:]]
    docs = spark.createDataFrame([(1, " ".join(phrase)), (2, " ".join(moved)), (3, prose(1, 30))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(phrase))], "item_id long, text string")
    found = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in decontaminate.contamination(docs, items).collect()}
    assert found == {1: (13, 1), 2: (0, 1), 3: (0, 0)}


def spans_by_regex(text):
    found = []
    for n, rule in enumerate(secrets.BASE + secrets.ADDED):
        for m in re.finditer(rule.pattern, text or "", rule.flags):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), n, m.end(), rule.kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def test_secret_spans(documents, corpus):
    for frame in (documents, corpus):
        given = dict(texts(frame))
        for row in secrets.scan_secrets(frame).collect():
            assert [(s["kind"], s["start"], s["end"]) for s in row["spans"]] == spans_by_regex(given[row["doc_id"]])


def test_trigram_queries():
    queries = {r.kind: secrets.trigram_query(r) for r in secrets.BASE}
    assert queries["hex"] is True
    assert queries["access"] == ("and", ("aki", "kia"))
    assert {"pas", "ssw", "sec", "tok", "pi_"} <= secrets.trigrams(queries["assign"])
    assert secrets.trigram_query(secrets.Rule("x", "ab?c+d")) is True
    assert secrets.trigram_query(secrets.Rule("x", "(abc|xyz)[0-9]+def")) == ("and", (("or", ("abc", "xyz")), "def"))


def test_secret_digests(spark):
    frame = spark.createDataFrame([(1, "é password: hunter2hunter2 " + "ab" * 16)], "doc_id long, text string")
    row = secrets.span_digests(secrets.scan_secrets(frame)).first()
    assert (row["n_assign"], row["n_access"], row["n_hex"]) == (1, 0, 1)
    assert row["spans"] == "assign:2:26,hex:27:59"
    assert row["base_sha256"] == brute.digest("assign:2:26,hex:27:59")


def test_main_text_of_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    given = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in html_text.main_text(pages).collect():
        article = given[row["page_id"]].split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " ").replace("<b>", "").replace("</b>", ""))
        cut = [" ".join(html_text.entities.unescape(p).split()) for p in parts]
        assert row["text"] == "\n\n".join(c for c in cut if c)


def test_boilerplate_without_markup_is_found_by_repetition(spark):
    notice = "all rights reserved by the people who made this small site in spring"
    rows = [(k, f"http://h.example/{k}", f"<div>{notice}</div><div>{prose(k, 30)}</div>") for k in range(6)]
    rows.append((6, "http://other.example/6", f"<div>{notice}</div>"))
    found = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {**{k: prose(k, 30) for k in range(6)}, 6: notice}


def test_the_same_notice_beside_different_articles_goes(spark):
    notice = "This notice of the house stands on every single page of it."
    rows = [(n, f"https://h.org/{n}", f"<div>{notice}</div><article><p>{prose(50 + n, 30)}</p></article>") for n in range(4)]
    rows += [(9, "https://i.org/1", rows[0][2]), (10, "https://i.org/2", rows[0][2])]
    found = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [found[n] for n in range(4)] == [prose(50 + n, 30) for n in range(4)]
    # Copies of a whole page tell nothing.
    assert found[9] == found[10] == f"{notice}\n\n{prose(50, 30)}"


def test_furniture_goes_and_the_title_stays():
    page = (
        '<body><header><p>site</p></header><nav>menu</nav><article><header><h1>T&eacute;</h1></header><p>a<p>b'
        '<div class="comments"><p>c</p></div><form>f</form><ul><li>1<li>2</ul><script>if(a<b){}</script></article>'
        '<aside>s</aside><div id="cookie-notice">n</div><footer>z</footer>'
    )
    kept = [t for t, kind in html_text.blocks(page) if kind == html_text.ARTICLE]
    assert kept == ["Té", "a", "b", "1", "2"]
    assert not [t for t, kind in html_text.blocks(page) if kind == html_text.OPEN]


def test_exact_dedup_index_grows_batch_by_batch(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    first = spark.createDataFrame([(5, "a  b"), (7, "a b"), (8, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(1, "a b"), (9, "d"), (10, "d")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in index.add(first).collect()} == {5: True, 7: False, 8: True}
    again = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in again.add(second).collect()} == {1: (5, False), 9: (9, True), 10: (9, False)}
    assert again.entries().count() == 3


def test_exact_dedup_keeps_one_of_repeated_rows(corpus):
    kept = exact_dedup.drop_exact_duplicates(corpus)
    seen = [" ".join(re.split(r"[\x20\x09-\x0D]+", t or "")) for _, t in texts(kept)]
    assert len(seen) == len(set(seen))


def test_licenses(documents, corpus):
    # Two rows share the NULL id, and a look-up by id cannot tell them apart.
    for frame in (documents, corpus.where("doc_id IS NOT NULL")):
        given = dict(texts(frame))
        for r in licenses.license_digests(licenses.scan_licenses(frame)).collect():
            base = (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
            assert base == brute.phrases(given[r["doc_id"]], licenses.PHRASES)
            assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
            assert 0 <= r["score"] <= 1


def test_license_templates_are_found_with_a_few_words_changed(spark):
    rows = [(n, prose(n, 50) + " " + text.replace("software", "program", 1) + " " + prose(n + 50, 20)) for n, (_, _, text) in enumerate(licenses.TEMPLATES)]
    rows.append((99, prose(7, 300)))
    found = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[99] == []
    for n, (label, key, text) in enumerate(licenses.TEMPLATES):
        if key in text.replace("software", "program", 1):
            assert label in found[n]


def test_a_file_that_holds_all_licenses_has_all_labels(spark):
    every = {label for label, _, _ in licenses.TEMPLATES}
    rows = [(0, " ".join(f"{prose(n, 20)} {text}" for n, (_, _, text) in enumerate(licenses.TEMPLATES)))]
    for n, (_, key, text) in enumerate(licenses.TEMPLATES):
        # One word put in near the middle, beside the key phrase.
        words = text.split(" ")
        first = text[: text.index(key)].count(" ")
        middle = len(words) // 2 if not first < len(words) // 2 <= first + key.count(" ") else first + key.count(" ") + 1
        rows.append((n + 1, " ".join([prose(n, 40), *words[:middle], "really", *words[middle:], prose(n + 30, 20)])))
    rows.append((99, prose(7, 300)))
    scanned = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r["doc_id"]: set(r["labels"]) for r in scanned}
    assert found[0] == every and found[99] == set()
    for n, (label, _, _) in enumerate(licenses.TEMPLATES):
        assert found[n + 1] == {label}, label


def test_toxicity_on_held_out_labels(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score(documents, toxicity.fit(documents, labels))
    rows = scored.join(labels, "doc_id").where(toxicity.held_out(scored["doc_id"])).collect()
    assert np.mean([(r["score"] >= 0.5) == (r["toxic"] == 1) for r in rows]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_block_max_neighbours_are_exact():
    dice = np.random.default_rng(4)
    vectors = set()
    while len(vectors) < 500:
        terms = sorted(dice.choice(30, dice.integers(1, 5), replace=False).tolist())
        weights = dice.random(len(terms) + 1)
        weights /= np.linalg.norm(weights)
        vectors.add(tuple(zip([*terms, 30], np.round(weights, 5).tolist(), strict=True)))
    vectors = sorted(vectors)
    index = toxicity.Neighbours(vectors, dice.integers(0, 3, 500), np.ones(500), 30)
    for vector in vectors[::25]:
        dense = np.zeros(31, dtype=np.float32)
        for n, w in vector:
            dense[n] = w
        every = index.dense @ dense
        rows, cosines = index.nearest(vector)
        held = np.cumsum((index.toxic + index.clean)[np.argsort(-every, kind="stable")])
        floor = np.sort(every)[::-1][np.searchsorted(held, toxicity.NEIGHBOURS)]
        assert set(rows.tolist()) == set(np.flatnonzero(every >= floor - 1e-6).tolist())


def test_language_on_held_out_documents(documents):
    found = language.identify(documents, language.fit(documents)).join(documents.select("doc_id", documents["lang"].alias("truth")), "doc_id")
    rows = found.where(language.held_out(found["doc_id"])).collect()
    assert np.mean([r["lang"] == r["truth"] for r in rows]) > 0.97


def test_language_spans_of_mixed_text(spark, documents):
    model = language.fit(documents)
    by_lang = {r["lang"]: r["text"] for r in documents.where("length(text) > 1500").dropDuplicates(["lang"]).collect()}
    mixed = spark.createDataFrame([(1, by_lang["en"][:1000] + " " + by_lang["fr"][:1000]), (2, "123 !"), (3, None), (4, "Привет мир")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in language.identify(mixed, model).collect()}
    assert {s["lang"] for s in found[1]["spans"]} == {"en", "fr"}
    assert (found[2]["lang"], found[3]["lang"], found[2]["score"]) == ("und", "und", 0.0)
    assert found[4]["lang"] in model.languages


def best_value(scores):
    state = scores[0].copy()
    for row in scores[1:]:
        state = np.maximum(state, state.max() - language.SWITCH) + row
    return state.max()


def test_viterbi_finds_the_best_path():
    dice = np.random.default_rng(1)
    for _ in range(40):
        some = []
        for _ in range(8):
            scores = -np.abs(dice.normal(0, dice.choice([1, 4]), (dice.integers(1, 50), 4)))
            scores[len(scores) // 2 :, dice.integers(4)] = 0
            some.append(scores)
        best, sure = language.constant_paths(np.concatenate(some), np.array([len(s) for s in some]))
        for scores, path, lang, constant in zip(some, language.viterbi(some), best, sure, strict=True):
            path = path.astype(int)
            value = scores[np.arange(len(path)), path].sum() - language.SWITCH * (np.diff(path) != 0).sum()
            assert value == pytest.approx(best_value(scores))
            if constant:
                assert scores[:, lang].sum() == pytest.approx(best_value(scores))


def test_line_dedup_recall(documents):
    some = documents.where("doc_id < 250")
    found = line_dedup.drop_repeated_lines(some).collect()
    wanted = brute.line_classes(texts(some), line_dedup.normal_line, line_dedup.similar)
    total = sum(wanted.values())
    assert sum(r["n_lines"] - r["n_kept"] for r in found) >= 0.95 * total
    assert all(r["n_lines"] - r["n_kept"] <= wanted[r["doc_id"]] for r in found)


def test_line_dedup_compares_large_groups_in_full(spark):
    dice = random.Random(9)
    letters = "".join(chr(c) for c in range(0x4E00, 0x5E00))
    drawn = lambda size: "".join(dice.choices(letters, k=size))
    template, rows = drawn(304), []
    # A family's lines are 0.77 alike, mostly by the template; lines of two families are 0.72 alike.
    for own in [drawn(10) for _ in range(200)]:
        rows += [template + own + drawn(47), template + own + drawn(47)]
    dice.shuffle(rows)
    numbered = list(enumerate(rows))
    bands = line_dedup.band_values(line_dedup.bands_of(rows))
    assert np.unique(bands, return_counts=True)[1].max() > 100
    wanted = brute.line_classes(numbered, line_dedup.normal_line, line_dedup.similar)
    assert sum(wanted.values()) == 200
    found = line_dedup.drop_repeated_lines(spark.createDataFrame(numbered, "doc_id long, text string")).collect()
    gone = {r["doc_id"]: r["n_lines"] - r["n_kept"] for r in found}
    assert all(n <= wanted[i] for i, n in gone.items())
    assert sum(gone.values()) >= 0.97 * 200


def test_tokens_are_those_of_the_library(spark, documents):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    dice = random.Random(1)
    odd = ["", " ", "  a  b ", "a\x1cb", "x" * 3000, "don't I'll\n\n x \t y", "日本語 １２³ ½", "<|endoftext|>", "a　 b", "\x85 z", "ab" * 500 + " q"]
    odd += ["x" * 5000, "-" * 4000 + " b", "日本語" * 700, "".join(dice.choice("abcdefghij") for _ in range(3500))]
    odd += ["".join(dice.choice("ab  \n\t'strellve.,!é日\x1c\U0001f600́ 1२") for _ in range(dice.randint(0, 60))) for _ in range(500)]
    frame = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    for given in (frame, documents.where("doc_id < 200")):
        expected = dict(texts(given))
        coded = byte_bpe.encode(given, path, public_tokenizers.PATTERN)
        for row in byte_bpe.decode(coded, path).collect():
            text = expected[row["doc_id"]]
            assert np.frombuffer(row["ids"], dtype="<u4").tolist() == known.encode_ordinary(text)
            assert bytes(row["decoded"]) == text.encode()


def test_a_wrong_id_shows_in_the_decoded_bytes(spark):
    given = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.encode(spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string"), *given).collect()
    ids = bytearray(coded[0]["ids"])
    assert coded[1]["ids"] == b""
    ids[0] ^= 1
    changed = spark.createDataFrame([(1, bytes(ids)), (2, bytes(coded[0]["ids"])), (3, None)], "doc_id long, ids binary")
    found = {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(changed, given[0]).collect()}
    assert found[1] != b"one two" and found[2] == b"one two" and found[3] == b""


def test_remembered_is_bounded():
    kept = portions.Remembered(3)
    for k in range(50):
        kept.put(k, k)
        assert kept.get(0) in (0, None) and len(kept.young) + len(kept.old) <= 6
    for k in range(50):
        asked = {k, k // 2, k // 3, 100 + k, *range(k)}
        there = asked & (kept.young.keys() | kept.old.keys())
        assert kept.of(asked) == {key: key for key in there}
        kept.put(k, k)
        assert len(kept.young) + len(kept.old) <= 6
        kept.put_all({key: key for key in range(k % 11)})
        assert kept.of({k % 11 - 1}) == ({k % 11 - 1: k % 11 - 1} if k % 11 else {})
        assert len(kept.young) + len(kept.old) <= 6


def test_pipeline_takes_effect_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    toxic = {r["doc_id"] for r in scored.where("score >= 0.5").collect()}
    left = stages["toxicity"](spark, docs, SF)
    rows = dict(texts(docs))
    expected = {i: t for i, t in rows.items() if i not in toxic}
    assert {i for i, _ in texts(left)} == set(expected)
    firsts = {}
    for i in sorted(expected):
        firsts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", expected[i]), i)
    expected = {i: expected[i] for i in firsts.values()}
    left = stages["exact dedup"](spark, left, SF)
    assert {i for i, _ in texts(left)} == set(expected)
    sets = {i: brute.shingles(t) for i, t in expected.items()}
    left = stages["n-gram Jaccard join"](spark, left, SF)
    kept = {i for i, _ in texts(left)}
    found = jaccard_join.near_duplicates(docs.where(docs["doc_id"].isin(list(expected)))).collect()
    assert kept == {r["component_id"] for r in found}
    assert len(kept) < len(sets)
    wanted = brute.contamination([(i, expected[i]) for i in kept], items)
    left = stages["benchmark decontamination"](spark, left, SF)
    clean = {i for i, v in wanted.items() if not v[4]}
    assert {i for i, _ in texts(left)} == clean
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    for row in stages["byte-level BPE"](spark, left, SF).collect():
        ids = np.array(known.encode_ordinary(expected[row["doc_id"]]), dtype="<u4")
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row["decoded_sha256"] == brute.digest(expected[row["doc_id"]])


def test_every_operator_is_registered():
    names = list(catalog.queries())
    assert [n.split("_")[0] for n in names] == [f"op{n}" for n in range(1, 14)]
    assert set(catalog.oracle_sql()) <= set(names)


def test_texts_of_pages_that_markup_decides_are_not_written(spark):
    notice = "all rights reserved by the people who made this small site in spring"
    rows = [(k, f"http://h.example/{k}", f"<article>{prose(k, 30)}</article><footer>{notice}</footer>") for k in range(4)]
    rows += [(k, f"http://h.example/{k}", f"<nav>a menu</nav><div>{notice}</div><div>{prose(k, 30)}</div>") for k in range(4, 7)] + [(7, None, "")]
    pages = spark.createDataFrame(rows + rows[:1] + rows[4:5], "page_id long, url string, html string")
    written = {r["page_id"]: r["blocks"] for r in html_text.parsed_pages(pages).collect()}
    assert [k for k in sorted(written) if written[k] is not None] == [4, 5, 6]
    assert [b["text"] for b in written[4]] == [None, notice, prose(4, 30)]
    found = sorted((r["page_id"], r["text"]) for r in html_text.main_text(pages).collect())
    assert found == sorted([(k, prose(k, 30)) for k in [*range(7), 0, 4]] + [(7, "")])


def test_shingle_sets_are_those_of_the_words():
    dice = random.Random(7)
    given = [None, "", " \t\n", "a b", "A  b", "É x", "é x", "x" * 40 + " B c d e", "X" * 40 + " b c d e f", "tail"]
    given += ["".join(dice.choice(["ab", "C", "é", "東", "q" * 40, " ", "\n", "\x0b", "\xa0", "1"]) for _ in range(dice.randint(0, 90))) for _ in range(400)]
    given.append(" ".join(f"w{dice.randrange(10**6)}" for _ in range(300_000)))
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    cut = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) for t in given]
    plain = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()} for w in cut]
    found = list(jaccard_join.shingle_sets(given))
    assert [len(f) for f in found] == [len(p) for p in plain]
    for x, y in [(dice.randrange(len(given)), dice.randrange(len(given))) for _ in range(3_000)]:
        assert len(np.intersect1d(found[x], found[y])) == len(plain[x] & plain[y])


def test_blocks_keep_the_pairs_that_parities_do_not_refute():
    dice = np.random.default_rng(5)
    base = [np.unique(dice.integers(0, 1 << 62, n, dtype=np.uint64)) for n in (20, 33, 140)]
    sets = [np.union1d(b[dice.random(len(b)) < 0.95], dice.integers(0, 1 << 62, k, dtype=np.uint64)) for b in base for k in range(12)]
    rows = [(f"{k:02}".encode(), len(s), bool(k % 3), f"{k % 5}".encode(), jaccard_join.parity(s)) for k, s in enumerate(sets)]
    frame = pd.DataFrame(rows, columns=["id", "n", "own", "root", "parity"])
    blocks = pd.concat([frame.assign(first=True)[::2], frame.assign(first=False)]).assign(alone=False)
    found = jaccard_join.possible_pairs(blocks)
    once = jaccard_join.possible_pairs(frame.assign(first=[k % 2 == 0 for k in range(len(frame))], alone=True))
    assert set(zip(found["a"], found["b"])) == set(zip(once["a"], once["b"]))
    expected = set()
    for x in rows[::2]:
        for y in rows:
            least = max(abs(x[1] - y[1]), jaccard_join.least_difference(x[4], y[4]))
            if x[3] != y[3] and (x[2] or y[2]) and 100 * (x[1] + y[1] - least) >= 75 * (x[1] + y[1] + least):
                expected.add((min(x[0], y[0]), max(x[0], y[0])))
    assert set(zip(found["a"], found["b"])) == expected
    assert len(expected) > 50


def test_regions_without_a_member_at_home_or_a_second_set_vanish(spark):
    postings = [(1, 10, True), (1, 10, True), (2, 10, False), (2, 12, False), (3, 10, True), (3, 12, False), (3, 12, False), (4, 10, False), (4, 12, True)]
    frame = spark.createDataFrame(postings, "region long, id long, own boolean")
    found = jaccard_join.shared_regions(frame).collect()
    assert sorted((r["id"], r["own"]) for r in found) == [(10, True), (12, True)]
    assert len({r["region"] for r in found}) == 1


def test_near_copies_that_do_not_link_are_compared_in_one_round(spark, monkeypatch):
    def never(*_):
        raise AssertionError("split")

    monkeypatch.setattr(jaccard_join.Join, "split", never)
    dice = random.Random(6)
    vocabulary = [f"w{k}" for k in range(3_000)]
    numbered = list(enumerate(family(dice, vocabulary, 80, 620, 7, False)))
    frame = spark.createDataFrame(numbered, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(frame).collect()}
    assert found == brute.near(numbered)


def test_toxic_rows_work_in_portions_and_give_memory_back(monkeypatch):
    sizes, given = [], []

    class Counted(toxicity.Model):
        def scores(self, texts, seen):
            sizes.append(len(texts))
            return super().scores(texts, seen)

    monkeypatch.setattr(toxicity, "give_back", lambda: given.append(True))
    model = Counted(toxicity.Terms({"bad": 2.0}), None, (1.0, 1.0), 1.0, 0.0, 0.7)
    found = list(toxicity.rejections(model, 0.5, iter([pd.Series(["bad day", None, ""] * 1_000), pd.Series([], dtype=object)])))
    assert [len(f) for f in found] == [3_000, 0]
    assert found[0].all()
    assert max(sizes) <= portions.MOST_ROWS
    assert given == [True]
    assert not model.terms.known.young


def test_lines_are_compared_by_their_shingles():
    dice = random.Random(8)
    base = [prose(k, 8) for k in range(6)] + ["ab", "abcd", "abcde", "é東 x"]
    lines = [b[:k] + c + b[k:] for b in base for c in ("", "x", "yy zz") for k in (0, len(b) // 2)]
    pairs = [(dice.choice(lines), dice.choice(lines)) for _ in range(3_000)] + [(x, y) for x in lines[:12] for y in lines[:12]]
    sets = {x: {x[k : k + 5] for k in range(max(1, len(x) - 4))} for x in lines}
    expected = [100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]) for x, y in pairs]
    assert line_dedup.similar([x for x, _ in pairs], [y for _, y in pairs]) == expected
    assert 100 < sum(expected) < len(expected) - 100


def test_shingles_are_counted_in_one_buffer(monkeypatch):
    dice, given = np.random.default_rng(9), []
    sets = [np.unique(dice.integers(0, 90, dice.integers(0, 40), dtype=np.uint64)) for _ in range(80)]
    for most in (1, 10, 60, 10_000):
        runs = [[]]
        for s in sets:
            if sum(map(len, runs[-1])) + len(s) > most:
                runs.append([])
            runs[-1].extend([s] if len(s) <= most else [])
        counted = [np.unique(np.concatenate([sets[0][:0], *run]), return_counts=True) for run in runs]
        found = list(jaccard_join.repeated_values(iter(sets), most))
        assert [(v.tolist(), n.tolist()) for v, n in found] == [(v[n > 1].tolist(), n[n > 1].tolist()) for v, n in counted]
    large = [np.arange(k, k + 10_000, dtype=np.uint64) for k in range(50)]
    tracemalloc.start()
    assert len(list(jaccard_join.repeated_values(iter(large), 500_000))) == 1
    # The buffer, where runs begin and end, and the result; four copies of all sets before.
    assert tracemalloc.get_traced_memory()[1] < 1.6 * sum(s.nbytes for s in large)
    tracemalloc.stop()


def test_tasks_of_the_jaccard_join_give_memory_back(monkeypatch):
    class Taken:
        """Stands for a frame: keeps the function that a task would run."""

        sparkSession = None

        def select(self, *columns):
            return self

        def mapInPandas(self, run, schema):
            self.run = run
            return self

    given, texts = [], Taken()
    monkeypatch.setattr(jaccard_join, "give_back", lambda: given.append(True))
    found = pd.concat(jaccard_join.local_counts(texts).run(iter([pd.DataFrame({"text": ["a b c d e f", None, "a b c d e g", "x"]})])))
    assert sorted(found["n"].tolist()) == [2, 5]
    assert found["shingle"].isna().sum() == 1
    assert given == [True, True]


def test_notices_inside_articles_are_found_by_repetition(spark, monkeypatch):
    notice = "Subscribe to our weekly letter and never miss a story of this small site again"
    line = "one passage that a few of the many pages of a host quote from each other here"
    article = lambda k, extra="": f"<article><h1>{prose(k, 4)}</h1><p>{prose(100 + k, 30)}</p><p>{extra}</p></article>"
    whole = lambda k, extra="": "\n\n".join(x for x in (prose(k, 4), prose(100 + k, 30), extra) if x)
    rows = [(k, f"http://h.example/{k}", article(k, notice) + "<nav>a menu</nav>") for k in range(5)]
    # Pages with an open block: their own article loses the notice as well, and so does the block.
    rows += [(k, f"http://h.example/{k}", article(k, notice) + f"<div>{prose(200 + k, 12)}</div><div>{notice}</div>") for k in (5, 6)]
    # A host whose pages quote each other, but too few of them; a host that holds one article five times; three pages only.
    rows += [(k, f"http://i.example/{k}", article(k, line if k < 13 else "")) for k in range(10, 20)]
    rows += [(k, f"http://j.example/{k}", article(30) + f"<footer>{k}</footer>") for k in range(30, 35)]
    rows += [(k, f"http://k.example/{k}", article(k, notice)) for k in (40, 41, 42)]
    # An excerpt of another page's article outside an article goes, a whole page that is one stays.
    rows += [(50, "http://l.example/50", article(50)), (51, "http://l.example/51", f"<div>{prose(150, 20)}</div><div>{prose(51, 20)}</div>")]
    rows += [(53, "http://m.example/53", article(53)), (52, "http://m.example/52", f"<div>{prose(153, 30)}</div>")]
    wanted = {k: whole(k) for k in range(5)} | {k: f"{whole(k)}\n\n{prose(200 + k, 12)}" for k in (5, 6)}
    wanted |= {k: whole(k, line if k < 13 else "") for k in range(10, 20)} | {k: whole(30) for k in range(30, 35)}
    wanted |= {k: whole(k, notice) for k in (40, 41, 42)} | {50: whole(50), 51: prose(51, 20), 52: prose(153, 30), 53: whole(53)}
    for counted, twice in ((html_text.COUNTED_CHARS, False), (700, True)):
        monkeypatch.setattr(html_text, "COUNTED_CHARS", counted)
        given = spark.createDataFrame(rows + rows * twice, "page_id long, url string, html string").repartition(3)
        found = html_text.main_text(given).collect()
        assert len(found) == len(rows) * (1 + twice)
        assert {r["page_id"]: r["text"] for r in found} == wanted


def test_prefixes_of_both_streams_and_their_spread():
    row = [("a b c d e f g h i", html_text.ARTICLE), ("x y", html_text.OPEN), ("z", html_text.FURNISHED)]
    assert [len(html_text.prefixes("h", row, article)) for article in (False, True)] == [1, 2]
    assert len(html_text.prefixes("", row, True)) == 0
    held = [np.array(x, dtype=np.int64) for x in ([1, 2, 9], [1, 3, 9], [4, 9], [5, 6])]
    pages, spread = html_text.spread_here([7, 7, 7, 8], held)
    assert pages == [3, None, None, 1]
    assert [s and [(x["prefix"], x["n"]) for x in s] for s in spread] == [[(1, 2), (9, 3)], None, None, [(5, 1), (6, 1)]]


def test_two_lines_are_compared_as_lists_of_lines_are():
    lines = ["ab", "abcd", "abcde", prose(1, 8), prose(1, 8) + "x", prose(1, 9), prose(2, 8)]
    pairs = [(x, y) for x in lines for y in lines]
    found = [line_dedup.similar(x, y) for x, y in pairs]
    assert found == line_dedup.similar([x for x, _ in pairs], [y for _, y in pairs])
    assert 0 < sum(found) < len(found)


def test_bands_do_not_depend_on_the_lines_taken_together(monkeypatch):
    lines = [prose(k, 1 + k % 9) for k in range(200)] + ["a", "abcde", "é東 x"]
    whole = line_dedup.bands_of(lines)
    runs = list(line_dedup.portions(lines, 300, len(lines)))
    assert len(runs) > 5
    assert [b for first, last in runs for b in line_dedup.bands_of(lines[first:last])] == whole
