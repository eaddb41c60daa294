"""Quality, secrets, extraction, mixing, tokens and decontamination against plain versions."""

import base64
import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plume.llm import (compression_quality, decontaminate, html_extract, mixing, quality_rules, secret_scan,
                       token_counts)
from plume.llm.textbytes import Powers, column_bytes, words

from . import brute

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---- quality rules

def test_quality_features_match_brute_force(spark, documents):
    texts = [r.text for r in documents.select("text").limit(80).collect()]
    texts += [None, "", " \n\t ", "a b a b a b a", "x\nx\n\ny\nx", "a b c " * 900, "\x0b\x0cé漢"]
    df = spark.createDataFrame([(i, t, None, "s") for i, t in enumerate(texts)], DOCS)
    rows = quality_rules.quality_rules(df).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows} == \
        {i: brute.quality_features(t) for i, t in enumerate(texts)}
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_cut_offs_adapt_to_their_group(spark):
    """Symbols that are normal in one source are outliers in another."""
    rnd = random.Random(1)

    def text(symbols):
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 7))) +
                        ("##" if rnd.random() < symbols else "") for _ in range(rnd.randint(60, 90)))
    rows = [(i, text(0.0), "en", "prose") for i in range(300)] + [(1000 + i, text(0.9), "en", "code") for i in range(300)]
    rows += [(5000, text(0.9), "en", "prose"), (5001, text(0.9), "en", "code"), (5002, text(0.0), None, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", kept string")
    good = quality_rules.keep_good(df)
    assert good.columns == df.columns
    ids = {r.doc_id for r in good.collect()}
    assert 5000 not in ids and {5001, 5002} <= ids and len(ids) >= 590


def test_sketch_quantiles_are_near_exact(spark):
    values = [random.Random(i).lognormvariate(0, 1) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(
        quality_rules._bucket(F.col("v")).alias("bucket"), "v").withColumn("mid", quality_rules._bucket_value())
    assert df.where(F.abs(F.col("mid") / F.col("v") - 1) > quality_rules.SKETCH_ERROR + 1e-9).count() == 0


def test_quality_stage_runs_no_python(documents):
    plan = quality_rules.keep_good(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- secrets

def test_secret_spans():
    ssh = base64.b64encode(OPENSSH).decode()
    der = bytes([0x30, 40, 0x02, 1, 0, 0x04, 35]) + b"q" * 35
    jwt = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=")
                   for x in (json.dumps({"alg": "HS256"}).encode(), b"{}", b"s" * 20))
    fake = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (b'{"no":1}', b"{}", b"s"))
    text = (f'é Api_Key : "abcdefgh" token=short AKIAABCDEFGHIJKL AKIAshort {"0f" * 16} '
            f"{ssh} {der.hex()} {base64.b64encode(der).decode()} {jwt} {fake} "
            f"-----BEGIN PRIVATE KEY-----\n{base64.b64encode(der).decode()}\n-----END PRIVATE KEY-----")
    base, more = secret_scan.scan(text)
    assert [(secret_scan.KINDS[k], text[s:e]) for s, k, e in sorted(base)][:3] == [
        ("assign", 'Api_Key : "abcdefgh'), ("access", "AKIAABCDEFGHIJKL"), ("hex", "0f" * 16)]
    kinds = sorted(secret_scan.KINDS[k] for _, k, _ in more)
    assert kinds == ["der", "der", "der", "jwt", "pem", "ssh"]
    assert not any(text[s:e] == fake for s, _, e in more)
    assert secret_scan.scan(None) == ([], []) and secret_scan.scan("") == ([], [])


SSH_KEY = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-ed25519", b"k" * 32))
OPENSSH = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) \
    + b"\0\0\0\1" + b"".join(len(x).to_bytes(4, "big") + x for x in (SSH_KEY, b"p" * 136))
DER_KEY = bytes([0x30, 0x82, 0, 200, 0x02, 1, 0, 0x04, 0x81, 194]) + bytes(range(32, 226))


@pytest.mark.parametrize("before", ["KEY=", 'key="', "https://h/p?k=", "a=b&k=", "x=="])
@pytest.mark.parametrize("kind, key", [
    ("ssh", base64.b64encode(OPENSSH).decode()), ("ssh", OPENSSH.hex()),
    ("der", base64.b64encode(DER_KEY).decode()), ("der", DER_KEY.hex()), ("der", DER_KEY.hex().upper()),
    ("jwt", ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (b'{"alg":"none"}', b"{}", b"s")))])
def test_secret_after_an_equals_sign(before, kind, key):
    assert [(secret_scan.KINDS[k], s, e) for s, k, e in secret_scan.confirmed_spans(f"{before}{key}\n")] == \
        [(kind, len(before), len(before) + len(key))]


@pytest.mark.parametrize("gap", ["\n", "\r\n", "\n    ", "\\n", "\\r\\n", "\\\\n", "\\\n"])
@pytest.mark.parametrize("width", [32, 64, 65, 70, 76])
@pytest.mark.parametrize("kind, key", [
    ("ssh", base64.b64encode(OPENSSH).decode()), ("ssh", OPENSSH.hex()),
    ("der", base64.b64encode(DER_KEY).decode()), ("der", DER_KEY.hex()), ("der", DER_KEY.hex().upper())])
def test_secret_keys_over_lines(gap, width, kind, key):
    lines = [key[i:i + width] for i in range(0, len(key), width)]
    for before, after in (("key: ", "\nword"), ('{"k": "', '"}'), (f"word{gap}", f"{gap}{'Q' * width}{gap}")):
        text = before + gap.join(lines) + after
        assert [(secret_scan.KINDS[k], s, e) for s, k, e in secret_scan.confirmed_spans(text)] == \
            [(kind, len(before), len(text) - len(after))]


@pytest.mark.parametrize("gap", ["\n", "\\n", "\\r\\n", "\\\\n"])
def test_secret_armour_with_escaped_breaks(gap):
    body = base64.b64encode(DER_KEY).decode()
    text = gap.join(["-----BEGIN PRIVATE KEY-----", *(body[i:i + 64] for i in range(0, len(body), 64)),
                     "-----END PRIVATE KEY-----", ""])
    account = f'{{"type": "service_account", "private_key": "{text}", "id": 1}}'
    assert [(secret_scan.KINDS[k], account[s:e] + gap) for s, k, e in secret_scan.confirmed_spans(account)] == [("pem", text)]


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")) + body


RSA = der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01"), der(5))
NUMBER = der(2, bytes(range(1, 129)))
BITS = der(3, b"\0" + bytes(range(100)))
PRIVATE = {"rsa": der(0x30, der(2, b"\0"), *[NUMBER] * 8), "ec": der(0x30, der(2, b"\1"), der(4, b"k" * 32)),
           "pkcs8": der(0x30, der(2, b"\0"), RSA, der(4, b"k" * 60)), "encrypted": der(0x30, RSA, der(4, b"k" * 64))}
PUBLIC = {"spki": der(0x30, RSA, BITS), "rsa": der(0x30, NUMBER, der(2, b"\1\0\1")),
          "certificate": der(0x30, der(0x30, der(2, b"\1"), RSA), RSA, BITS), "ssh": SSH_KEY}


def armour(label, body, head=""):
    text = base64.b64encode(body).decode()
    return "\n".join([f"-----BEGIN {label}-----", *([head] if head else []),
                      *(text[i:i + 64] for i in range(0, len(text), 64)), f"-----END {label}-----"])


@pytest.mark.parametrize("name", PRIVATE)
def test_private_keys_are_found_in_every_coding(name):
    key = PRIVATE[name]
    pem = armour("PRIVATE KEY", key)
    wrapped = base64.b64encode(pem.encode()).decode()
    for coded, kind in ((base64.b64encode(key).decode(), "der"), (base64.urlsafe_b64encode(key + b"").decode().rstrip("="), "der"),
                        (key.hex(), "der"), (pem, "pem"), (wrapped, "pem"), (pem.encode().hex(), "pem"),
                        ("\n".join(wrapped[i:i + 76] for i in range(0, len(wrapped), 76)), "pem")):
        text = f"tls.key: {coded}\nand on"
        found = [(secret_scan.KINDS[k], text[s:e]) for s, k, e in secret_scan.confirmed_spans(text)]
        assert (kind, coded) in found and all(c in coded for _, c in found)


def test_url_safe_keys_are_found():
    key = der(0x30, der(2, b"\0"), der(4, bytes([0xfb, 0xef, 0xff] * 20)))
    coded = base64.urlsafe_b64encode(key).decode().rstrip("=")
    assert set("-_") & set(coded)
    assert [(s, k, e) for s, k, e in secret_scan.confirmed_spans(f"k={coded}.")] == [(2, 5, 2 + len(coded))]


@pytest.mark.parametrize("name", PUBLIC)
def test_public_material_is_no_secret(name):
    key = PUBLIC[name]
    for coded in (base64.b64encode(key).decode(), key.hex(), armour("PUBLIC KEY", key), armour("CERTIFICATE", key),
                  base64.b64encode(armour("CERTIFICATE", key).encode()).decode()):
        assert secret_scan.confirmed_spans(f"ssh-ed25519 {coded} me@host\n") == []


def test_encrypted_armour_and_blank_token_headers():
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF00FF00FF00FF00FF00FF00FF00FF\n"
    text = armour("RSA PRIVATE KEY", b"c" * 160, head)
    for t in (text, text.replace("\n", "\\n")):
        assert secret_scan.confirmed_spans(f"x {t} y") == [(2, 3, 2 + len(t))]
    assert secret_scan.confirmed_spans(armour("RSA PRIVATE KEY", b"c" * 161, head)) == []
    assert secret_scan.confirmed_spans(armour("RSA PRIVATE KEY", b"c" * 160)) == []
    for header in (b'{ "alg" : "none" }', b'{\n "alg": "HS256"}', b'{"alg":"none"}'):
        token = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (header, b"{}", b"s"))
        assert secret_scan.confirmed_spans(f"Bearer {token}") == [(7, 4, 7 + len(token))]


def test_secret_scan_of_long_texts_and_clashing_columns(spark):
    key = base64.b64encode(PRIVATE["pkcs8"]).decode()
    text = "word " * 300_000 + key + " MAAA" * 100_000
    df = spark.createDataFrame([(1, text, "x", 9), (1, text, "y", 9), (2, None, None, None)],
                               "doc_id long, text string, spans string, n_hex int")
    got = sorted((r.doc_id, r.n_confirmed, r.spans) for r in secret_scan.secret_scan(df).collect())
    assert got == [(1, 1, f"der:1500000:{1_500_000 + len(key)}")] * 2 + [(2, 0, "")]


def test_secret_lines_that_are_no_key():
    broken = base64.b64encode(DER_KEY[:-1]).decode()  # one byte short
    text = "\n".join(broken[i:i + 64] for i in range(0, len(broken), 64))
    assert secret_scan.confirmed_spans(f"k={text}\n") == secret_scan.confirmed_spans(f"k={text}, word") == []


def test_secret_base_patterns_match_plain_ones(spark):
    import re
    rnd = random.Random(4)
    parts = ["password", "PASSWD", "api_key", "apikey", "token", "ſecret", "secret", '"', "'", " ", ":", "=",
             "abcd1234", "AKIA", "ABCDEFGH12345678", "0123456789abcdef" * 2, "-", "é", "\n"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(300)] + [None, ""]
    assign = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
                        r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secret_scan.secret_scan(df).collect()}
    for i, t in enumerate(texts):
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t or "") if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t or "") if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t or "") if len(m[0]) >= 32]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == j for _, k, _ in spans) for j in range(3)]


# ---- extraction

def test_extract_known_page():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body class="x">
    <header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a></ul></nav><!-- <p>no</p> -->
    <div class="cookie-notice">We use cookies, a lot of them.</div>
    <div id=main><article><h1>Head &amp; title</h1><p>First   paragraph,<br>with <b>bold</b> &eacute;.<p>Short.
    <ul><li>one</li><li>two</ul><form><p>Sign up here, please.</p></form>
    <div class="comments"><p>A reader says a lot here, at length, with commas, and more.</p></div></article></div>
    <aside><p>Read also this and that.</p></aside><footer>&copy; us</footer></body></html>"""
    assert html_extract.extract(page) == \
        "Head & title\n\nFirst paragraph, with bold é.\n\nShort.\n\none\n\ntwo"


def test_extract_without_semantic_tags():
    long = "A sentence, with marks, and then some more words to make it long enough. " * 4
    page = (f"<div class=top-menu><a href=1>a</a></div><div class=c9><h2>Title</h2><p>{long}</p><p>{long}</p></div>"
            "<div class=links><a href=2>Other page</a> <a href=3>More</a></div>")
    assert html_extract.extract(page) == "\n\n".join(["Title", long.strip(), long.strip()])


@pytest.mark.parametrize("inner", ["blockquote><p", "ul><li", "table><tr><td", "pre", "div class=x><div"])
@pytest.mark.parametrize("long", [1500, 3000, 20_000])
@pytest.mark.parametrize("outer", ["article", "main", "div class=c9"])
@pytest.mark.parametrize("at", [0, 7, 14])
def test_extract_keeps_paragraphs_beside_a_long_block(inner, long, outer, at):
    texts = [f"Paragraph {k}, with a mark, " + "and more words " * 12 + "to its end." for k in range(14)]
    more = ("A long block goes on, and on. " * 1000)[:long].strip()
    blocks = [f"<p>{t}</p>" for t in texts]
    ends = "".join(f"</{x.split()[0].strip('<>')}>" for x in reversed(inner.split(">")))
    blocks.insert(at, f"<{inner}>{more}{ends}")
    texts.insert(at, more)
    page = (f"<body><div class=top><a href=1>Home</a></div><{outer}><h1>Title</h1>{''.join(blocks)}<p>End.</p>"
            f"</{outer.split()[0]}><div class=end>All rights</div></body>")
    assert html_extract.extract(page) == "\n\n".join(["Title", *texts, "End."])


def test_extract_article_keeps_short_blocks():
    page = (f"<article><h1>Title</h1><section><p>{'Some words, more. ' * 300}</p></section><p>Short.</p>"
            "<dl><dt>term<dd>meaning</dl></article>")
    assert html_extract.extract(page).split("\n\n")[2:] == ["Short.", "term", "meaning"]


@pytest.mark.parametrize("wrap", ['div class="with-sidebar"', 'div class="no-comments"', 'div id="search-results-page"',
                                  'div class="page widget"', "section id=related", "form"])
@pytest.mark.parametrize("core", ["article", "main", 'div class="c1"'])
def test_extract_below_a_wrapper_with_a_furniture_name(wrap, core):
    texts = [f"Paragraph {k}, with a mark, " + "and more words " * 9 + "to its end." for k in range(5)]
    if wrap == "form" and core.startswith("div"):
        return  # a form without an article in it is a form
    page = (f"<body><div class=top-bar><a href=1>Home</a></div><{wrap}><{core}><h1>Title</h1>"
            + "".join(f"<p>{t}</p>" for t in texts) + f"</{core.split()[0]}><div class=comments><p>{texts[0]}</p></div>"
            f"</{wrap.split()[0]}><footer>All rights, reserved, for ever.</footer></body>")
    assert html_extract.extract(page) == "\n\n".join(["Title", *texts])


ARTICLE_WITH_LINKS = ("<article><h1>Title</h1>" + "".join(
    f"<p>Paragraph {k}, with a mark, and <a href=x>a link</a> in it, and then some more words.</p>" for k in range(6))
    + "<div class=z3><ul>" + "".join(f"<li><a href={k}>Another story that is told elsewhere {k}</a></li>" for k in range(5))
    + "</ul></div><p>End.</p></article>")


def test_path_ratios_decide_inside_an_article(monkeypatch):
    """A list of links without any telling name goes by its path's ratio alone."""
    texts = [f"Paragraph {k}, with a mark, and a link in it, and then some more words." for k in range(6)]
    assert html_extract.extract(ARTICLE_WITH_LINKS) == "\n\n".join(["Title", *texts, "End."])
    monkeypatch.setattr(html_extract, "path_ratios", lambda found: {b.path: (100.0, 1.0, 1.0) for b, _ in found})
    assert "Another story" in html_extract.extract(ARTICLE_WITH_LINKS)


def test_path_ratios_find_the_text_without_any_telling_tag_or_name(monkeypatch):
    texts = [f"Paragraph {k}, with a mark, " + "and more words " * 9 + "to its end." for k in range(6)]
    page = ("<body><div class=a1><div>Home</div><div>News</div><div>Sport</div></div><div class=b2><h2>Title</h2>"
            + "".join(f"<p>{t}</p>" for t in texts) + "</div><div class=c3><div>About</div><div>Terms</div>"
            "<div>Jobs</div></div></body>")
    assert html_extract.extract(page) == "\n\n".join(["Title", *texts])
    monkeypatch.setattr(html_extract, "path_ratios", lambda found: {b.path: (100.0, 1.0, 1.0) for b, _ in found})
    assert "Sport" in html_extract.extract(page)


def test_extract_leaves_a_comment_section_of_articles():
    long = "A sentence, with marks, and then some more words. " * 3
    page = (f"<article><p>{long}</p></article><section id=comments><article><p>{long}</p></article>"
            f"<article class=reply><p>{long}</p></article></section>")
    assert html_extract.extract(page) == long.strip()
    assert html_extract.extract(page[page.index("<section"):]) == long.strip()  # no other article: the first is it


def test_extract_repeated_rows_long_pages_and_clashing_columns(spark):
    long = "<article>" + "<p>Words, and words. </p>" * 60_000 + "</article>"
    rows = [(1, "u", long, "x", 1), (1, "u", long, "y", 2), (2, None, "<p>Some text here.</p>", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted((r.page_id, r.n_chars, r.text.count("Words")) for r in html_extract.extract_pages(df).collect())
    assert got == [(1, 60_000 * 19 - 2, 60_000), (1, 60_000 * 19 - 2, 60_000), (2, 15, 0)]


@pytest.mark.parametrize("page", [None, "", "   ", "<p", "<!-- open", "<script>x", "plain < text", "</p></div>",
                                  "<a title=\"open>x</a>", "<div><nav>all furniture"])
def test_extract_broken_pages(page):
    assert isinstance(html_extract.extract(page), str)


def test_extract_articles_of_the_table(spark):
    import html
    import re
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


# ---- mixing

def test_targets_by_hand(spark):
    """Words 10, 100, 100, 30; weights 5, 2, 1, 5 (NULL last): a is capped, the rest is reshared."""
    rows = [(1, "w " * 10, "en", "a"), (2, "w " * 100, "en", "b"), (3, "w " * 100, "en", "é"), (4, "w " * 30, "en", None)]
    sized = mixing.sizes(spark.createDataFrame(rows, DOCS))
    got = {r.source: (r.rank, r.target) for r in mixing.targets(sized).collect()}
    # total 240: caps 30 and 90 hold; the other 120 go 2 : 1
    assert got == {"a": (0, 30.0), "b": (1, 80.0), "é": (2, 40.0), None: (3, 90.0)}


def test_mix_meets_targets_and_is_repeatable(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 32)
    monkeypatch.setattr(mixing, "FAN_IN", 3)  # several levels of the tree
    rnd = random.Random(6)
    rows = [(i, "w " * int(rnd.lognormvariate(4, 1)), "en", rnd.choice(["a", "b", "c", None]))
            for i in range(900)] + [(None, None, None, "a"), (7, "", "en", "b"), (7, "w w", "en", "b"), (7, "w w", "en", "b")]
    df = spark.createDataFrame(rows, DOCS)
    first = mixing.mix(df).collect()
    assert sorted(map(str, first)) == sorted(map(str, mixing.mix(df.repartition(5)).collect()))
    assert len(first) == len(rows)
    by: dict = {}
    for r in first:
        assert r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        own = by.setdefault((r.target, r.source_size), [0, 0])  # two sources may share a target
        own[0] += r.taken
        own[1] += r["size"]
    assert len(by) == 4 and sum(t for t, _ in by) == pytest.approx(sum(n for _, n in by.values()))
    for (target, _), (taken, _) in by.items():
        assert abs(taken - target) <= 0.01 * target


def test_trade_is_fair_and_keeps_the_words():
    for p, s, q, t in ((0.3, 10, 0.6, 4), (0.9, 1, 0.2, 50), (0.5, 7, 0.5, 7)):
        up, down = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
        chance = down / (up + down)
        a, b = mixing.trade(p, s, q, t, 0.0), mixing.trade(p, s, q, t, 1 - 1e-12)
        for x, y in (a, b):
            assert x * s + y * t == pytest.approx(p * s + q * t)
            assert x in (0, 1) or y in (0, 1)
        assert chance * a[0] + (1 - chance) * b[0] == pytest.approx(p)


# ---- tokens

def test_automaton_is_greedy_longest_match():
    rnd = random.Random(1)
    for _ in range(80):
        letters, end = [97, 98, 99], token_counts.END
        vocab = {(x,) for x in letters} | {(x, end) for x in letters}
        vocab |= {tuple(rnd.choices(letters, k=rnd.randint(1, 5))) + ((end,) if rnd.random() < 0.4 else ())
                  for _ in range(rnd.randint(0, 12))}
        data = np.array(rnd.choices(letters, k=200), np.uint8)
        cuts = sorted(rnd.sample(range(1, 200), 25))
        start, stop = np.array([0, *cuts]), np.array([*cuts, 200])
        got = token_counts.Automaton(sorted(vocab)).count(data, start, stop)
        assert list(got) == [brute.greedy_pieces(data[a:b].tolist(), vocab, end) for a, b in zip(start, stop)]


def test_token_counts_of_the_table(spark, documents):
    vocab = set(token_counts.read_vocabulary())
    some = documents.limit(20).select("doc_id", "text").unionByName(
        spark.createDataFrame([(90001, None), (90002, ""), (90003, " \n "), (90004, "É x\U0001F600y")],
                              "doc_id long, text string"))
    want = {}
    for r in some.collect():
        ws = brute.words(r.text)
        want[r.doc_id] = (len(ws), sum(brute.greedy_pieces(w.translate(brute.LOWER).encode(), vocab, token_counts.END)
                                       for w in ws))
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.token_counts(some).collect()} == want


def test_words_of_batches():
    texts = ["a bc", None, "", " x\ty\n", "é ü z", "end"]
    data, offsets = column_bytes(pa.array(["skip", *texts])[1:])
    start, end, row = words(data, offsets)
    raw = data.tobytes()
    got = [[raw[s:e].decode() for s, e, r in zip(start, end, row) if r == i] for i in range(len(texts))]
    assert got == [brute.words(t) for t in texts]


# ---- decontamination

def test_word_distance():
    rnd = random.Random(8)
    for _ in range(200):
        a, b = (np.array(rnd.choices(range(4), k=rnd.randint(1, 9)), np.uint64) for _ in range(2))
        want = min(brute.edit_distance(a.tolist(), b.tolist()))
        for most in (1, 3, 9):
            assert decontaminate.distance(a, b, most) == min(want, most + 1)


def test_leaks_are_found_and_clean_texts_left(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rnd = random.Random(9)
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    vocab = " ".join(t for _, t in docs[:40]).split()
    bench = [(r.item_id, r.text) for r in items.collect()]
    planted = {}
    for k in range(150):
        item_id, text = rnd.choice(bench)
        w = text.split()
        n = len(decontaminate.sequence(*column_bytes(pa.array([text])), Powers())[0])
        for _ in range(rnd.randint(0, int(0.15 * n))):
            p = rnd.randrange(len(w))
            w[p:p + 1] = rnd.choice([[], [rnd.choice(vocab)], [w[p], rnd.choice(vocab)]])
        planted[10_000 + k] = item_id
        docs.append((10_000 + k, " ".join(rnd.choices(vocab, k=40) + [x.upper() if k % 7 == 0 and x.isascii() else x
                                                                      for x in w] + rnd.choices(vocab, k=40))))
    docs += [(20_000, None), (20_001, ""), (20_002, "word"), (None, bench[0][1])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, start_word int")
    found = {(r.doc_id, r.item_id): r.edits for r in decontaminate.find_leaks(df, items).collect()}
    assert all((d, i) in found for d, i in planted.items())
    norm = lambda t: " ".join((t or "").split())
    exact = {(d, i) for d, t in docs for i, b in bench if norm(b) in norm(t)}
    assert exact <= set(found)
    # everything found is within the bound by the plain edit distance
    texts = dict(docs)
    for (d, i), edits in found.items():
        if (d, i) not in exact and d not in planted:
            a = brute.words(dict(bench)[i].translate(brute.LOWER))
            b = brute.words(texts[d].translate(brute.LOWER))
            assert min(min(brute.edit_distance(a, b[s:s + 2 * len(a)])) for s in range(len(b))) <= 0.2 * len(a) + 2
    left = decontaminate.drop_leaks(df, items)
    assert left.columns == df.columns
    gone = {d for d, _ in found}
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((d for d, _ in docs if d not in gone), key=str)


@pytest.mark.parametrize("n", [5, 8, 10, 11, 14, 15, 20, 29, 60, 100, 200, 400])
@pytest.mark.parametrize("kinds", ["sid", "s", "i", "d"])
def test_recall_at_the_full_bound(documents, n, kinds):
    """Items with as many edits as the bound allows, in texts of the same words."""
    rnd = random.Random(n)
    vocab = " ".join(r.text for r in documents.select("text").limit(60).collect()).split()
    vocab = [v for v in vocab if v[0].isalnum()]
    count, most = 40 if n <= 100 else 10, decontaminate.allowed(n)
    items = [rnd.choices(vocab, k=n) for _ in range(count)]
    texts = []
    for item in items:
        w = list(item)
        for p in sorted(rnd.sample(range(n), most), reverse=True):
            kind = rnd.choice(kinds)
            w[p:p + 1] = [] if kind == "d" else [rnd.choice(vocab)] if kind == "s" else [w[p], rnd.choice(vocab)]
        texts.append(" ".join(rnd.choices(vocab, k=30) + w + rnd.choices(vocab, k=30)))
    bench = decontaminate.Benchmark(decontaminate.index_of([(i, " ".join(x)) for i, x in enumerate(items)]))
    w, bounds = decontaminate.sequence(*column_bytes(pa.array(texts)), Powers())
    found = {(row, i): (start, edits) for row, item, start, edits in bench.leaks(w, bounds) for i in bench.ids[item]}
    assert sum((i, i) in found for i in range(count)) >= 0.99 * count
    for (row, i), (start, edits) in found.items():
        text = w[bounds[row]:bounds[row + 1]][start:start + n + most].tolist()
        item = decontaminate.sequence(*column_bytes(pa.array([" ".join(items[i])])), Powers())[0].tolist()
        assert edits == min(brute.edit_distance(item, text)) <= most


def test_nothing_is_found_without_a_walk(documents):
    """The walks alone give the candidates: with keys that match nothing no item is found, not even a copy."""
    index = decontaminate.index_of([(1, "a b c d e f g h"), (2, " ".join(f"w{i}" for i in range(60)))])
    w, bounds = decontaminate.sequence(*column_bytes(pa.array([" ".join(f"w{i}" for i in range(60))])), Powers())
    assert [(i, d) for _, i, _, d in decontaminate.Benchmark(index).leaks(w, bounds)] == [(1, 0)]
    assert decontaminate.Benchmark({**index, "keys": index["keys"] + np.uint64(1)}).leaks(w, bounds) == []


def test_nearest_stretch():
    rnd = random.Random(4)
    for _ in range(200):
        a, b = (np.array(rnd.choices(range(4), k=rnd.randint(1, 9)), np.uint64) for _ in range(2))
        want = min(min(brute.edit_distance(a.tolist(), b[s:].tolist())) for s in range(len(b) + 1))
        for most in (1, 9):
            got = decontaminate.stretch(a, b, most)
            assert got is None if want > most else \
                got[0] == want == min(brute.edit_distance(a.tolist(), b[got[1]:].tolist()))


def test_long_texts_items_of_one_part_and_clashing_columns(spark):
    item = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, "x y " * 200_000 + item + " z" * 100_000, 5, "k"), (2, item[:-4], 6, None)],
                                 "doc_id long, text string, item_id int, edits string")
    bench = spark.createDataFrame([(9, item, "t")], "item_id long, text string, doc_id string")
    got = sorted(tuple(r) for r in decontaminate.find_leaks(docs, bench).collect())
    assert got == [(1, 9, 400_000, 50, 0), (2, 9, 0, 50, 1)]
    assert decontaminate.drop_leaks(docs, bench).count() == 0


# ---- compression classifier

def test_classifier_on_held_out_rows(spark):
    """Accuracy on labelled documents that the fit never saw."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = compression_quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert len(bad) >= 5 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted for r in good) >= 0.97 * len(good)
    pairs = [(g.score > b.score) + 0.5 * (g.score == b.score) for g in good for b in bad]
    assert sum(pairs) / len(pairs) >= 0.9


def test_classifier_never_learns_from_held_out_rows(spark, documents):
    labels = spark.createDataFrame([(r.doc_id, r.doc_id % 2) for r in documents.select("doc_id").collect()],
                                   "doc_id long, quality int")
    first = compression_quality.fit(documents, labels)
    flipped = labels.withColumn("quality", F.when(compression_quality.held_out(), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    assert compression_quality.fit(documents, flipped) == first


def test_classifier_scores_match_plain_ones(spark, documents):
    """Whole texts compressed piece by piece with either dictionary, one at a time."""
    import math

    import zstandard
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = compression_quality.fit(documents, labels)
    slope, offset = model["curve"]
    assert slope > 0
    params = zstandard.ZstdCompressionParameters.from_level(
        compression_quality.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    bad, good = (zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), compression_params=params)
                 for d in model["dicts"])

    def score(text):
        raw = (text or "").encode()
        parts = [raw[i:i + 4096] for i in range(0, len(raw), 4096)]
        v = (sum(len(bad.compress(p)) for p in parts) - sum(len(good.compress(p)) for p in parts)) / len(raw) if raw else 0.0
        return 1 / (1 + math.exp(-(slope * v + offset)))
    texts = [r.text for r in documents.select("text").limit(60).collect()] + [None, "", "é" * 9000]
    texts += texts[:2]  # repeated rows
    df = spark.createDataFrame([(i % 60, t, "x", 0.5) for i, t in enumerate(texts)],
                               "doc_id long, text string, score string, difference double")
    got = sorted((r.doc_id, round(r.score, 9)) for r in compression_quality.scores(df, model).collect())
    assert got == sorted((i % 60, round(score(t), 9)) for i, t in enumerate(texts))


def test_classifier_edge_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "é" * 50_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    rows = compression_quality.classify(docs, labels).collect()
    assert len(rows) == 4 and all(r.score == 0.5 and r.predicted == 1 for r in rows)


def test_classifier_replaces_picks_without_text_and_reads_long_texts(spark, monkeypatch):
    monkeypatch.setattr(compression_quality, "MAX_FIT_ROWS", 20)
    long = "".join(f"{i:08d}" for i in range(12_501))  # 100,008 bytes
    docs = [(i, ("", None, long, f"text {i}")[i % 4]) for i in range(400)]
    labels = spark.createDataFrame([(i, i // 4 % 2) for i in range(800)], "doc_id long, quality int")  # half absent
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = compression_quality.fit_rows(df, labels)
    assert [sum(q == k for _, q in rows) for k in (0, 1)] == [20, 20]
    raw, cut = long.encode(), compression_quality.PIECE
    spread = {t for t, _ in rows if len(t) > 100}
    assert len(spread) == 1 and {len(t) <= compression_quality.MAX_FIT_BYTES for t in spread} == {True}
    found = [raw.index(t) for t in compression_quality.pieces(spread.pop())]
    assert all(x % cut == 0 for x in found) and found == sorted(set(found))
    assert found[0] == 0 and found[-1] == (len(raw) - 1) // cut * cut and len(found) == 9
