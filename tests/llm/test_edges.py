"""Empty tables, NULLs in every column, and the pipeline end to end."""

import pytest

import corpus_pipeline
from plume.llm import (compression_quality, decontaminate, html_extract, line_dedup, mixing, near_dup, quality_rules,
                       secret_scan, suffix_dedup, token_counts)
from plume.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BENCH = "item_id long, text string"


def operators(spark, docs):
    none = spark.createDataFrame([], BENCH)
    bench = spark.createDataFrame([(1, "a b c d e f g"), (2, None), (3, ""), (None, "h i j k l m"), (4, "x")], BENCH)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    return {
        "leaks": lambda: decontaminate.find_leaks(docs, bench),
        "no_leaks": lambda: decontaminate.drop_leaks(docs, none),
        "classify": lambda: compression_quality.classify(docs, labels),
        "substrings": lambda: suffix_dedup.repeat_report(docs),
        "lines": lambda: line_dedup.line_report(docs),
        "rules": lambda: quality_rules.quality_rules(docs),
        "rules_stage": lambda: quality_rules.keep_good(docs),
        "secrets": lambda: secret_scan.secret_scan(docs),
        "mix": lambda: mixing.mix(docs),
        "tokens": lambda: token_counts.token_counts(docs),
        "near": lambda: near_dup.near_dups(docs),
        "near_stage": lambda: near_dup.drop_near_dups(docs),
    }


NAMES = ["leaks", "no_leaks", "classify", "substrings", "lines", "rules", "rules_stage", "secrets", "mix", "tokens",
         "near", "near_stage"]


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, name):
    assert operators(spark, spark.createDataFrame([], DOCS))[name]().count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_nulls_everywhere(spark, name):
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, None, None), (None, "a b c d e f g", "en", None, 1),
            (3, "A b, c d e f g", None, "s", None), (3, "A b, c d e f g", None, "s", None)]
    got = operators(spark, spark.createDataFrame(rows, DOCS))[name]().collect()
    if name == "leaks":
        assert sorted((r.doc_id is None, r.item_id, r.edits) for r in got) == [(False, 1, 0), (False, 1, 0), (True, 1, 0)]
    elif name == "rules_stage":
        assert got == []  # all are shorter than the base rules ask for
    elif name == "near_stage":
        assert len(got) == 5  # of the two equal rows one
    else:
        assert len(got) == len(rows)


def test_pages_with_nulls(spark):
    pages = spark.createDataFrame([(1, "u", None), (None, None, "<p>Some text here.</p>"), (2, None, "")],
                                  "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_extract.extract_pages(pages).collect())
    assert got == [(0, "Some text here.", 15), (1, "", 0), (2, "", 0)]
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_columns_named_like_results(spark, name):
    """Extra columns with the names that operators use themselves change nothing."""
    clash = ["size", "taken", "score", "kept", "n_words", "n_tokens", "row", "key", "seed", "place", "draw", "rank",
             "block", "p", "node", "label", "h1", "line", "held_out", "predicted", "target", "metric", "bucket", "docs"]
    rows = [(i, f"some words of text number {i}, and then some more of them " * (1 + i % 9), "en", f"s{i % 3}", 9) for i in range(40)]
    plain = spark.createDataFrame(rows, DOCS)
    wide = spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows], DOCS + "".join(f", {c} string" for c in clash))
    got = operators(spark, wide)[name]()
    want = operators(spark, plain)[name]()
    assert [c for c in want.columns if c not in got.columns] == []
    kept = [c for c in want.columns if c != "_nd_k"]
    assert sorted(map(str, got.select(kept).collect())) == sorted(map(str, want.select(kept).collect()))


def test_very_long_texts(spark):
    """A text of two million words beside short ones: counted whole, linked by whole sets."""
    long = " ".join(f"w{i % 1009}x{i % 997}" for i in range(1_000_000))
    docs = spark.createDataFrame([(1, long, "en", "s", 0), (2, long + " end", "en", "s", 0), (3, "w0x0 w1x1", "en", "s", 0)], DOCS)
    assert sorted((r.doc_id, r.n_words) for r in token_counts.token_counts(docs).collect()) == \
        [(1, 1_000_000), (2, 1_000_001), (3, 2)]
    assert sorted((r.doc_id, r.component_id) for r in near_dup.near_dups(docs).collect()) == [(1, 1), (2, 1), (3, 3)]


def test_every_dealt_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")) == list(range(1, 14))


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.staged(stage(spark, docs, sf), f"test-{name}")
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.join(before, "doc_id", "left_anti").isEmpty()
    assert len(corpus_pipeline.STAGES) == 5
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.6 * sizes[0]
    assert docs.where("taken > 3 * size").isEmpty()
