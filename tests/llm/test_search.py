"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plume.llm import ranked_search
from plume.llm.queries import QUERIES

from . import brute

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, BENCH = "doc_id long, text string", "item_id long, text string"


def plain(docs, items):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    bags = [(d, Counter(TERM.findall((t or "").translate(brute.LOWER)))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, words = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item_id, text in items:
        scores = []
        for d, b, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // words
            scores.append((sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                               * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m))
                               for t in set(TERM.findall((text or "").translate(brute.LOWER))) if t in b), d))
        scores = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:10]
        out += [(item_id, k, d, s) for k, (s, d) in enumerate(scores, 1)]
    return sorted(out, key=str)


def result(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def messy():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "漢字", "x_y", "A-B", "9"]
    docs = [(i, " ".join(rnd.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rnd.randint(1, 30))))
            for i in range(120)]
    docs += [(200 + i, docs[3][1]) for i in range(40)] + [(3, docs[3][1]), (None, docs[3][1]), (150, None), (151, ""),
                                                          (152, " ;;\n"), (153, "w3 " * 50_000), (None, "w7"), (-5, "W7!")]
    items = [(1, "w1 w2 w2 W3"), (2, "été 漢字"), (3, None), (4, ""), (5, "nowhere"), (None, "w7 w9 x y"),
             (1, "w1 w2 w2 W3"), (6, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("cells", [1 << 22, 40])
def test_search_matches_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    docs, items = messy()
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], DOCS + ", m long, item_id string").repartition(5)
    assert result(ranked_search.search(d, spark.createDataFrame(items, BENCH))) == plain(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    from plume.llm import decontaminate
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 3)
    docs, items = messy()
    got = ranked_search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH))
    assert result(got) == plain(docs, items)


def test_equal_hashes_stay_two_classes(spark, monkeypatch):
    """With a constant hash the bags themselves still tell the classes apart."""
    monkeypatch.setattr(ranked_search.F, "xxhash64", lambda *c: ranked_search.F.lit(7).cast("long"))
    docs, items = messy()
    docs, items = docs[:40], items[:1]
    assert result(ranked_search.search_block(spark.createDataFrame(docs, DOCS), ranked_search.Items(items))) == \
        plain(docs, items)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert result(QUERIES["op12_ranked_search"](spark, sf)) == plain(docs, items)


def test_empty_tables(spark):
    some = spark.createDataFrame([(1, "a b")], DOCS)
    assert ranked_search.search(some.limit(0), spark.createDataFrame([(1, "a")], BENCH)).count() == 0
    assert ranked_search.search(some, spark.createDataFrame([], BENCH)).count() == 0
    assert result(ranked_search.search(some, spark.createDataFrame([(1, "a")], BENCH))) == plain([(1, "a b")], [(1, "a")])


def test_scores_are_exact_integers():
    w = np.array([24_000, 3], np.int64)
    got = ranked_search.score_classes(w, np.array([0, 2, 3]), np.array([0, 1, 1]), 2,
                                      np.array([(0 << 32) + 5, (1 << 32) + 2]), np.array([0, 1, 2]), np.array([10, 100]))
    a, b = 24_000 * (5_000_000_000 // 5080), 3 * (2_000_000_000 // 2800)
    assert got.tolist() == [[a, a], [0, b]]
