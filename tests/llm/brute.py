"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def quality_features(text):
    text = text or ""
    w = words(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def one_edit(a, b):
    """Are the two texts at most one edit apart?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def line_dedup(docs, least):
    """(doc_id, text) -> text that is left."""
    seen, out = [], {}
    for doc_id, text in sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0)):
        kept = []
        for line in (text or "").split("\n"):
            if len(line) < least:
                kept.append(line)
                continue
            if not any(one_edit(line, s) for s in seen):
                kept.append(line)
            seen.append(line)
        out[doc_id, text] = None if text is None else "\n".join(kept)
    return out


def shingles(text, width):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def near_dups(docs, width):
    """Sorted (doc_id, shingles, component) by comparing all pairs that share a shingle."""
    sets = [shingles(t, width) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j < i).items():
            if None not in (docs[i][0], docs[j][0]) and 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            groups.setdefault(find(i), []).append(doc_id)
    return sorted(((d, len(s), None if d is None else min(groups[find(i)]))
                   for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def substring_dedup(docs, length):
    """Sorted (doc_id, bytes, removed, spans, digest) from a count of every window."""
    raws = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i:i + length] for _, b in raws for i in range(len(b) - length + 1))
    out = []
    for d, b in raws:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def greedy_pieces(word, vocabulary, end):
    """Longest-match pieces of a word; an end mark that no piece takes costs nothing."""
    symbols, n, i = (*word, end), 0, 0
    while i < len(symbols) and not (i == len(symbols) - 1 and (end,) not in vocabulary):
        j = len(symbols)
        while symbols[i:j] not in vocabulary:
            j -= 1
        n, i = n + 1, j
    return n


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row
