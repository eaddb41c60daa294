"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from plume.llm import spelling
from plume.llm.queries import QUERIES
from plume.llm.textbytes import column_bytes

from . import brute

RUN = re.compile("[A-Za-zÀ-ÿ]+")
DOCS = "doc_id long, text string"


def plain(docs):
    """(word, form, root, n, n_near, form_n) from every occurrence and every pair."""
    count = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    near = {w: [] for w in n}
    by_hole = {}
    for w in n:  # words one edit apart agree after one deletion in either or both
        for v in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by_hole.setdefault(v, []).append(w)
    for group in by_hole.values():
        for x in group:
            near[x] += [y for y in group if y != x and brute.one_edit(x, y)]
    near = {w: set(ys) for w, ys in near.items()}
    form = {}
    for w, ys in near.items():
        best = min(ys, key=lambda y: (-n[y], y), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def result(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def made_up_words(rnd, letters, lengths, how_many):
    words = {"".join(rnd.choice(letters) for _ in range(rnd.choice(lengths))) for _ in range(how_many)}
    for w in list(words):
        k = rnd.randrange(len(w))
        words |= {w[:k] + w[k + 1:], w[:k] + rnd.choice(letters) + w[k:], w[:k] + rnd.choice(letters) + w[k + 1:]}
    return sorted(words)


@pytest.mark.parametrize("most", [4096, 3])
def test_groups_match_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(spelling, "MAX_LIST", most)  # 3: lists are split down to one open code point
    rnd = random.Random(11)
    words = made_up_words(rnd, "abé", (5, 6, 7, 8), 60) + made_up_words(rnd, "abcdefghijklmnopqrstuvwxyzÀÿß", (6, 9, 14), 60)
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa"]
    texts = [" ".join(rnd.choices(words, weights=[rnd.choice((1, 6, 40)) for _ in words], k=120)) for _ in range(40)]
    texts += ["chains " * 700 + "chainss," * 130 + "chainsss;" * 26 + "chainssss1" * 5, "HELLOÉ helloÉ hellO" * 9, "q" * 300 + " "]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3]), (3, None), (None, ""), (7, " 12 ")]
    got = result(spelling.spelling_groups(
        spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS + ", word string, n long").repartition(3)))
    assert got == plain(docs)
    assert len(got) > 150 and any(root not in (w, form) for w, form, root, *_ in got)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(QUERIES["op13_spelling_variants"](spark, sf)) == plain(docs)


def test_empty_and_hopeless_tables(spark):
    assert spelling.spelling_groups(spark.createDataFrame([], DOCS)).count() == 0
    assert spelling.spelling_groups(spark.createDataFrame([(1, None), (2, "short few"), (None, "")], DOCS)).count() == 0


def test_checksums_of_any_length():
    rnd = random.Random(2)
    texts = ["".join(chr(rnd.randrange(97, 255)) for _ in range(k)) for k in (0, 1, 5, 63, 64, 65, 66, 500, 7, 64)]
    data, offsets = column_bytes(__import__("pyarrow").array(texts))
    seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(texts))], np.uint32)
    got = spelling.checksums(data, offsets[:-1], offsets[1:], seeds)
    assert got.tolist() == [zlib.crc32(f"{i}:{t}".encode()) for i, t in enumerate(texts)]


def test_every_pair_is_led_to_one_list_and_found():
    """Without Spark: the scan of one list of all words of two lengths finds all pairs one edit apart."""
    rnd = random.Random(4)
    for size in (6, 7, 10):
        words = sorted(w for w in set(made_up_words(rnd, "abc", (size, size + 1), 200)) if len(w) in (size, size + 1))
        lcps = [0] + [spelling.shared_prefix(x, y) for x, y in zip(words, words[1:])]
        for q in words:
            if len(q) == size:
                assert [words[i] for i in spelling.one_edit_away(q, words, lcps)] == \
                    [w for w in words if w != q and brute.one_edit(q, w)]
