"""Main text of web pages by tag-path ratios.

A page is read once into blocks: runs of text between block-level tags, each
with its root-to-leaf tag path (formatting tags are left out, so emphasised
words count with their paragraph).  Menus, footers, asides, forms, hidden and other
elements that are furniture by tag or role are left out, unless they hold the
page's article.  Over the rest:

1. per tag path, text length and punctuation are summed and divided by the
   path's number of blocks; text inside links does not count;
2. the two ratios are fused, ``length * sqrt(1 + punctuation)``, and brought to
   0..1 by ``v / (v + PROSE)``, so that one long block does not dwarf the others;
3. laid out in page order, smoothed with a Gaussian, and fused with the block's own
   value by the geometric mean: neighbours lend, but not to a block without text;
4. weighed by where the path lies: inside ``article`` or ``main``, or else inside
   the smallest element that holds ``CORE`` of the page's prose, the least sign of
   text is enough; outside it takes much; below elements whose class or id speaks
   of furniture (and that do not hold the article or the core) nearly everything;
5. a path is content if its mean weighed value reaches ``SHARE`` of the value of
   the page's median prose block, and if a fifth of its text at least is not
   inside links.  All blocks of content paths are the text, no others.

Class words are thus a prior on paths, not a filter; a wrapper like
``with-sidebar`` around an article changes nothing.  Pages are independent: one
Arrow pass, no shuffle.

Defined results: NULL or empty html, or a page without content, gives ''.
Unclosed tags are closed at the end of the page or by the next block that
cannot nest in them; an unclosed comment or script runs to the end.  Ties and
repeated rows need no care; extra columns are not read.
"""

from __future__ import annotations

import html as html_entities
import math
import re
from statistics import median

import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import small_batches

SHARE = 0.1       #: of the median prose block's value
PROSE = 80.0      #: fused value of a block of prose: about 57 code points with one mark
CORE = 0.7        #: of the page's prose
SMOOTHING = 1.0   #: standard deviation of the Gaussian, in blocks
LINKED = 0.2      #: least share of a path's text that is not inside links
#: weights of a path by its place
IN_ARTICLE, IN_CORE, NEUTRAL, OFF_CORE, OFF_ARTICLE, FURNITURE = 10.0, 4.0, 1.0, 0.2, 0.02, 0.01

TAG = re.compile(
    r"""<(?:!--|!|\?|(/?)([A-Za-z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*)>)""")
LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")
PUNCTUATION = re.compile(r"[.,;:!?…、。，？！¿¡]")
WORD_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
          "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp",
          "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
OUT_TAGS = {"nav", "footer", "aside", "form", "dialog", "menu"}
SKIP_TAGS = {"head", "template", "svg", "button", "select", "option", "object", "canvas", "audio", "video",
             "applet", "map", "datalist"} | RAW
OUT_ROLES = {"navigation", "contentinfo", "complementary", "search", "form", "alert", "alertdialog",
             "dialog", "menu", "menubar", "toolbar", "status"}
OUT_WORDS = {"ad", "ads", "advert", "advertisement", "advertising", "adsense", "adslot", "sponsor",
             "sponsored", "promo", "promotion", "banner", "menu", "nav", "navbar", "navigation",
             "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "masthead", "cookie", "cookies",
             "consent", "gdpr", "notice", "newsletter", "subscribe", "subscription", "signup", "login",
             "popup", "modal", "overlay", "comment", "comments", "respond", "reply", "replies", "disqus",
             "discussion", "share", "sharing", "social", "related", "recommended", "recommendations",
             "widget", "pagination", "pager", "toolbar", "search", "copyright", "skip", "disclaimer"}
TOP_WORDS = {"header", "topbar"}  #: furniture only outside an article
COMMENT_WORDS = {"comment", "comments", "reply", "replies"}
#: start tags that close an open paragraph, and those that close a sibling
CLOSES_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl",
            "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
            "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
            "table", "ul", "li", "dd", "dt"}
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in ATTRIBUTE.finditer(raw)} if raw.strip() else {}


def _label(tag: str, attrs: dict[str, str]) -> str:
    names = attrs.get("class", "").split()
    return f"{tag}.{'.'.join(sorted(names))}" if names else tag


class Element:
    """An open tag: its label, its place in the tree, and what its tag, role and names say."""

    __slots__ = ("tag", "label", "up", "skip", "out", "named", "article", "holds")

    def __init__(self, tag: str, attrs: dict[str, str], up: "Element | None"):
        inside = up is not None and up.article
        names = {w.lower() for key in ("class", "id") for w in WORD_PART.findall(attrs.get(key, ""))}
        role = attrs.get("role", "").lower()
        self.tag, self.label, self.up, self.holds = tag, _label(tag, attrs), up, False
        self.skip = tag in SKIP_TAGS or (up is not None and up.skip)
        self.out = (tag in OUT_TAGS or role in OUT_ROLES or (not inside and (tag == "header" or role == "banner"))
                    or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true"
                    or bool(re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I)))
        own = COMMENT_WORDS if tag in ("html", "body", "main", "article") else OUT_WORDS if inside else OUT_WORDS | TOP_WORDS
        self.named = tag not in INLINE and tag not in ("html", "body", "main") and bool(names & own)
        self.article = inside or tag == "main" or (tag == "article" and not self.named)

    def way(self):
        """This element and all it lies in, from the inside."""
        at = self
        while at is not None:
            yield at
            at = at.up


class Block:
    __slots__ = ("path", "owner", "text", "link")

    def __init__(self, path: str, owner: Element | None):
        self.path, self.owner = path, owner
        self.text, self.link = [], 0


def blocks(page: str) -> tuple[list[Block], list[Element]]:
    """The page's blocks of text in page order, and its article and main elements."""
    out: list[Block] = []
    articles: list[Element] = []
    stack: list[Element] = []
    current: Block | None = None
    at, size = 0, len(page)

    def close_upto(k: int) -> bool:
        block = any(e.tag not in INLINE for e in stack[k:])
        del stack[k:]
        return block

    def say(raw: str) -> None:
        nonlocal current
        if not raw or (stack and stack[-1].skip) or any(e.out and e.tag in INLINE for e in stack):
            return
        if current is None:
            if not raw.strip():
                return
            held = [e for e in stack if e.tag not in INLINE]
            current = Block("/".join(e.label for e in held), stack[-1] if stack else None)
            out.append(current)
        text = html_entities.unescape(raw)
        current.text.append(text)
        if any(e.tag == "a" for e in stack):
            current.link += len(text.strip())

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        m = TAG.match(page, lt) or LOOSE.match(page, lt)
        if m is None:  # a bare '<' is text
            say(page[at:lt + 1])
            at = lt + 1
            continue
        say(page[at:lt])
        if m.re is TAG and m[2] is None:  # comment, doctype or instruction
            ends = "-->" if page.startswith("<!--", lt) else ">"
            k = page.find(ends, lt + (4 if ends == "-->" else 2))
            at = size if k < 0 else k + len(ends)
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), -1)
            if k >= 0 and close_upto(k):
                current = None
            continue
        if tag == "br":
            say(" " if current is not None else "")
            continue
        if tag in CLOSES_P:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == "p"), -1)
            if k >= 0:
                close_upto(k)
        if tag in SIBLINGS:
            shut, bounds = SIBLINGS[tag]
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in bounds:
                    break
                if stack[i].tag in shut:
                    close_upto(i)
                    break
        if tag not in INLINE and tag not in ("img", "wbr", "input"):
            current = None
        if tag in VOID:
            continue
        if tag in RAW:
            k = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = size if k is None else k.end()
            current = None
            continue
        attrs = _attributes(m[3])
        if m[3].rstrip().endswith("/") and tag in ("svg", "path", "use"):
            continue
        up = stack[-1] if stack else None
        stack.append(Element(tag, attrs, up))
        if tag in ("article", "main") and not stack[-1].named:
            articles.append(stack[-1])
        if stack[-1].skip and not (up is not None and up.skip):
            current = None
    return out, articles


def _smooth(values: list[float]) -> list[float]:
    if not values:
        return values
    reach = max(1, math.ceil(2 * SMOOTHING))
    kernel = [math.exp(-(d * d) / (2 * SMOOTHING ** 2)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        near = [(values[i + d], kernel[d + reach]) for d in range(-reach, reach + 1) if 0 <= i + d < len(values)]
        out.append(sum(v * k for v, k in near) / sum(k for _, k in near))
    return out


def own_articles(articles: list[Element]) -> list[Element]:
    """The article and main elements, without those in a comment section if there are others."""
    outside = [e for e in articles if e.tag == "main" or not any(x.named for x in e.way())]
    return outside or articles


def path_ratios(found: list[tuple[Block, str]]) -> dict[str, tuple[float, float, float]]:
    """Per tag path: text outside links and punctuation per block, and the share of its text outside links."""
    totals: dict[str, list[float]] = {}
    for b, t in found:
        sums = totals.setdefault(b.path, [0, 0, 0, 0])
        sums[0] += max(0, len(t) - b.link)
        sums[1] += len(PUNCTUATION.findall(t))
        sums[2] += 1
        sums[3] += len(t)
    return {p: (length / n, marks / n, length / whole) for p, (length, marks, n, whole) in totals.items()}


def core(found: list[tuple[Block, str]], worth: list[float]) -> Element | None:
    """The smallest element that holds ``CORE`` of the worth of the page's prose blocks."""
    held: dict[Element, float] = {}
    for (b, _), v in zip(found, worth):
        if v and b.owner is not None:
            for e in b.owner.way():
                held[e] = held.get(e, 0) + v
    enough = [e for e, v in held.items() if v >= CORE * sum(worth) and e.tag not in INLINE and e.tag != "p"]
    return max(enough, key=lambda e: sum(1 for _ in e.way()), default=None)


def extract(page: str | None) -> str:
    """The page's main text: content blocks in order, joined by two line feeds."""
    if not page:
        return ""
    parts, articles = blocks(page)
    articles = own_articles(articles)
    for e in articles:
        for x in e.way():
            x.holds = True
    found = []
    for b in parts:
        t = " ".join("".join(b.text).split())
        if t and not (b.owner is not None and any(e.out and not e.holds for e in b.owner.way())):
            found.append((b, t))
    if not found:
        return ""
    ratios = path_ratios(found)
    fused = [ratios[b.path][0] * math.sqrt(1 + ratios[b.path][1]) for b, _ in found]
    prose = [f >= PROSE for f in fused]
    own = [f / (f + PROSE) for f in fused]
    values = [math.sqrt(v * near) for v, near in zip(own, _smooth(own))]
    least = SHARE * (median(v for v, p in zip(values, prose) if p) if any(prose) else max(values))
    inside = set(articles)
    semantic = any(b.owner is not None and not inside.isdisjoint(b.owner.way()) for b, _ in found)
    centre = None if semantic else core(found, [v if p else 0.0 for v, p in zip(own, prose)])
    if centre is not None:
        for x in centre.way():
            x.holds = True
    by_path: dict[str, list[float]] = {}
    for (b, _), v in zip(found, values):
        way = list(b.owner.way()) if b.owner is not None else []
        if any(e.named and not e.holds for e in way):
            weight = FURNITURE
        elif semantic:
            weight = OFF_ARTICLE if inside.isdisjoint(way) else IN_ARTICLE
        else:
            weight = NEUTRAL if centre is None else IN_CORE if centre in way else OFF_CORE
        by_path.setdefault(b.path, []).append(v * weight)
    chosen = {p for p, vs in by_path.items() if sum(vs) / len(vs) >= least and ratios[p][2] > LINKED}
    return "\n\n".join(t for b, t in found if b.path in chosen)


def extract_batches(batches):
    for batch in batches:
        texts = [extract(h.as_py()) for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, main text, its code points."""
    small_batches(pages.sparkSession)
    return pages.select(pages["page_id"].cast("long"), pages["url"].cast("string"), pages["html"].cast("string")) \
        .mapInArrow(extract_batches, "page_id long, url string, text string, n_chars long")
