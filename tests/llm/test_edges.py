"""NULLs, empty and long texts, repeated rows, empty tables, and clashing column names."""

import corpus_pipeline
import public_tokenizers
import pytest

from plumbline.llm import byte_bpe, decontaminate, exact_dedup, html_text, jaccard_join, language, licenses, line_dedup, secrets, substrings, toxicity

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

OPERATORS = {
    "ngram_jaccard": lambda docs, labels, items: jaccard_join.near_duplicates(docs),
    "decontaminate": lambda docs, labels, items: decontaminate.contamination(docs, items),
    "secrets": lambda docs, labels, items: secrets.scan_secrets(docs),
    "exact_dedup": lambda docs, labels, items: exact_dedup.exact_duplicates(docs),
    "licenses": lambda docs, labels, items: licenses.scan_licenses(docs),
    "toxicity": lambda docs, labels, items: toxicity.score(docs, toxicity.fit(docs, labels)),
    "language": lambda docs, labels, items: language.identify(docs, language.fit(docs)),
    "lines": lambda docs, labels, items: line_dedup.drop_repeated_lines(docs),
    "substrings": lambda docs, labels, items: substrings.substring_duplicates(docs),
    "byte_bpe": lambda docs, labels, items: byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row_whatever_it_holds(crowded, labels, benchmark_items, name):
    found = OPERATORS[name](crowded, labels, benchmark_items).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r["doc_id"]) for r in crowded.select("doc_id").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(crowded, labels, benchmark_items, name):
    assert OPERATORS[name](crowded.limit(0), labels.limit(0), benchmark_items.limit(0)).count() == 0


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_keep_the_columns_and_survive_odd_rows(spark, crowded, labels, benchmark_items, tmp_path, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark_items.write.parquet(f"{tmp_path}/benchmark.parquet")
    name, function = corpus_pipeline.STAGES[stage]
    kept = function(spark, crowded, str(tmp_path))
    rows = kept.collect()
    assert len(rows) <= crowded.count()
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert kept.columns == crowded.columns
    assert function(spark, crowded.limit(0), str(tmp_path)).count() == 0


def test_pages_of_any_kind(spark):
    rows = [
        (1, "http://a.example/x", "<article><p>one &amp; two</p><p>three<br>four</article><footer>f</footer>"),
        (1, "http://a.example/x", "<article><p>one &amp; two</p><p>three<br>four</article><footer>f</footer>"),
        (2, None, "<p>no host"),
        (3, "http://a.example/y", None),
        (4, "", ""),
        (None, "not an address", "plain text <b>only"),
        (5, "http://a.example/z", "<article>" + "<p>long text</p>" * 20_000 + "</article>"),
    ]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")
    found = {r["page_id"]: r for r in html_text.main_text(pages).collect()}
    assert html_text.main_text(pages).count() == 7
    assert found[1]["text"] == "one & two\n\nthree four"
    assert (found[2]["text"], found[3]["text"], found[4]["text"], found[None]["text"]) == ("no host", "", "", "plain text only")
    assert found[5]["n_chars"] == len("\n\n".join(["long text"] * 20_000))
    assert html_text.main_text(pages.limit(0)).count() == 0
