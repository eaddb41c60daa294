"""Line, substring and near-duplicate removal against plain versions."""

import random

import pytest

from plume.llm import line_dedup, near_dup, suffix_dedup

from . import brute


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcdé 漢\U0001F600") for _ in range(rnd.randint(18, 40))) for _ in range(40)]

    def edited(s):
        s = list(s)
        for _ in range(rnd.choice([0, 0, 1, 1, 1, 2])):
            kind, p = rnd.random(), rnd.randrange(len(s))
            if kind < 0.34:
                s[p] = rnd.choice("abcdé")
            elif kind < 0.67:
                del s[p]
            else:
                s.insert(p, rnd.choice("abcdé"))
        return "".join(s)
    docs = [(i, "\n".join(edited(rnd.choice(base)) if rnd.random() < 0.8 else rnd.choice(["", "x"])
                          for _ in range(rnd.randint(0, 9)))) for i in range(120)]
    docs += [(500, None), (501, ""), (None, "abc\n" + base[0]), (502, "\n\n" + base[1] + "\n"),
             (502, "\n\n" + base[1] + "\n"), (503, base[2] * 3000)]
    rnd.shuffle(docs)
    want = brute.line_dedup(docs, line_dedup.MIN_CHARS)
    # extra columns, one of them named like a working column of the join
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, line int, place string")
    got = line_dedup.without_repeats(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == \
        sorted(((d, want[d, t]) for d, t in docs), key=str)


@pytest.fixture(scope="module")
def near_docs():
    rnd = random.Random(5)
    vocab = ["".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(1, 7))) for _ in range(900)]
    docs = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(1, 150)))) for i in range(120)]
    base = rnd.choices(vocab, k=240)
    for k in range(80):  # copies around the similarity bound, linked in chains
        w = base[:]
        for _ in range(rnd.randint(3, 24)):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        docs.append((5000 + k, " ".join(w)))
    docs += [(7000 + k, docs[7][1].upper()) for k in range(20)]
    docs += [(9000, None), (9001, ""), (9002, "One"), (9003, "one"), (9004, "  "), (None, docs[0][1]),
             (9005, "a b"), (9006, "A  b"), docs[3]]
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize("width", [2, 5])
def test_near_dups_match_brute_force(spark, near_docs, width):
    df = spark.createDataFrame(near_docs, "doc_id long, text string")
    rows = near_dup.near_dups(df, width).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str) == \
        brute.near_dups(near_docs, width)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)


def test_drop_near_dups_keeps_one_of_each_group(spark, near_docs):
    df = spark.createDataFrame([(*d, "k") for d in near_docs], "doc_id long, text string, kept string")
    got = near_dup.drop_near_dups(df)
    assert got.columns == df.columns
    once = list(dict.fromkeys(near_docs))  # of equal rows one stays
    want = [d for d, _, c in brute.near_dups(once, near_dup.WIDTH) if d is None or d == c]
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(want, key=str)


def test_one_of_equal_rows_stays(spark):
    t, u = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, t, "a"), (1, t, "a"), (1, t, "b"), (2, t.upper(), "a"), (3, u, "a"), (3, u, "a"), (4, None, "a"), (4, None, "a"),
            (None, t, "a"), (None, t, "a"), (5, "", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _x string")
    got = sorted(((r.doc_id, r.text) for r in near_dup.drop_near_dups(df).collect()), key=str)
    assert got == sorted([(1, t), (3, u), (4, None), (4, None), (None, t), (None, t), (5, "")], key=str)


def test_copies_are_known_by_their_originals(spark):
    """Texts without the lines they share with the first copy are still its copies."""
    rnd = random.Random(6)
    base = "\n".join(" ".join(f"w{rnd.randrange(500)}" for _ in range(20)) for _ in range(30))
    near = base.replace("w1", "x1", 2)
    other = "\n".join(" ".join(f"v{rnd.randrange(500)}" for _ in range(20)) for _ in range(30))
    schema = "doc_id long, text string, n int"
    originals = spark.createDataFrame([(1, base, 1), (2, near, 1), (3, base, 1), (4, other, 1), (5, base, 1), (6, "", 1)], schema)
    now = spark.createDataFrame([(2, near, 1), (3, "rest", 1), (4, other, 1), (4, other, 1), (5, "", 1), (6, "", 1),
                                 (7, near, 1), (None, near, 1)], schema)
    got = sorted((r.doc_id or 0, r.text) for r in near_dup.drop_copies(now, originals).collect())
    # 1 is not among the documents any more, so 2 stands for 3 and 5; 7 has no original
    assert got == sorted([(0, near), (2, near), (4, other), (6, ""), (7, near)])


def test_sequential_test_bounds_rise_with_the_values_compared():
    needs = near_dup.least_matches()
    assert [h for h, _ in needs] == [48, 96, 144, 192, 240]
    assert all(0 < m < 0.8 * h for h, m in needs)


def test_deep_shallow_sorts_and_measures():
    rnd = random.Random(2)
    for _ in range(60):
        texts = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.choice([0, 1, 5, 40, 60]))) for _ in range(20)]
        shared = bytes(rnd.choice(b"ab\0") for _ in range(50))
        texts += [shared[:rnd.randint(0, 50)] + x[:9] for x in texts]
        order, lcp = suffix_dedup.deep_shallow(texts)
        got = [texts[i] for i in order]
        assert got == sorted(texts) and sorted(order) == list(range(len(texts)))
        assert all(lcp[i] == suffix_dedup.common(got[i - 1], got[i]) for i in range(1, len(got)))


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_substring_dedup_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rnd = random.Random(2)
    vocab = ["".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(2, 9))) for _ in range(300)]

    def text(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))
    passages = [text(n) for n in (60, 80, 100, 300)]
    docs = []
    for i in range(90):
        t, kind = text(rnd.randint(5, 300)), rnd.random()
        if kind < 0.5:
            p = rnd.choice(passages)
            t += p[rnd.randint(0, len(p) // 3):rnd.randint(len(p) // 2, len(p))] + text(rnd.randint(0, 120))
        elif kind < 0.6 and docs:
            t = rnd.choice(docs)[1]
        elif kind < 0.65:
            t = "ab " * rnd.randint(50, 500)
        elif kind < 0.7:
            t += t
        docs.append((i, t))
    docs += [(1000, None), (1001, ""), (1002, "x" * 399), (1003, "y" * 400), (1004, "z" * 401), docs[5],
             (None, passages[3])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, seed int")
    got = sorted((tuple(r) for r in suffix_dedup.repeat_report(df).collect()), key=str)
    assert got == brute.substring_dedup(docs, suffix_dedup.LENGTH)
