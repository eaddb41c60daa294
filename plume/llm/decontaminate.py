"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and benchmark items become word sequences (runs of non-white-space, ASCII
punctuation trimmed at both ends, A-Z lower-cased).  A document leaks an item of
n words if some stretch of it is within ``k = floor(MAX_EDITS * n)`` word edits
of the item.  An item of up to ``PART_WORDS`` words is one part, a longer one is cut into even
parts of at most so many words.  Of k edits in an item some part of m words gets
``floor(MAX_EDITS * m)`` at most, whatever the cut, so parts are searched with their
own bound and no item length needs other means.  Every word position of every whole
text is a possible start of a part-sized window; per Arrow batch:

1. *count filter* (loses nothing): within k edits of a part, a window of m words
   shares at least ``m - 1 - 2k`` word pairs with it, so windows with fewer pairs
   known to parts of that length are out;
2. *embedding and LSH*: a CGK random walk copies the current word and moves on or
   stays by a random bit of (repetition, step, word).  Sequences within edit
   distance d become strings that differ in O(d^2) places, wherever the edits
   are.  Each of ``REPEATS`` walks is sampled at ``SAMPLES`` steps; a part is a
   candidate of the windows that share all samples of one walk.  Only such
   candidates go on: nothing is found without a walk.  Target recall 0.99 at the
   full bound, which holds a part of few words with one or two edits; measured by
   the tests for items of 5 to 400 words;
3. *verification*: a candidate puts its item at a place in the document; the
   stretches around such places are compared with the whole item by exact
   word-level edit distance, start and end free.

Equal windows of a batch are embedded once, equal stretches verified once.  The
benchmark is a stated query set: it is broadcast as plain arrays, in blocks of at
most ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` bytes, and all documents pass each
block.  No shuffle at all.

Defined results: NULL and empty texts leak nothing.  Items without text or with
fewer than ``MIN_WORDS`` words are no evidence and never match.  Items of equal
words match together.  Rows that repeat are checked each; extra columns are not
read by the search and kept by ``drop_leaks``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_batches
from .textbytes import Powers, PrefixHash, byte_codes, column_bytes, mix64, row_slices, words

MAX_EDITS = 0.2        #: edits per item word
MIN_WORDS = 5
PART_WORDS = 14        #: longest part; two edits at most
REPEATS = 48
SAMPLES = 2
STRIDE = 2             #: walk steps per item word
SEED = 0x5DEECE66D
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 64 << 20
FILTER_BITS = 22
WINDOWS_AT_ONCE = 1 << 14

K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
PUNCT = np.zeros(256, bool)
PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
PAD = np.uint64(0)


def sequence(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, row bounds in words) of the rows in data."""
    start, end, row = words(data, offsets)
    if len(start):
        solid = np.append(np.flatnonzero(~PUNCT[data]), len(data))
        first = solid[np.searchsorted(solid, start)]
        last = solid[np.maximum(np.searchsorted(solid, end) - 1, 0)] + 1
        ok = first < end
        start, end, row = first[ok], last[ok], row[ok]
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    return PrefixHash(data, powers, byte_codes(True)).ranges(start, end), bounds


def pairs(w: np.ndarray) -> np.ndarray:
    return mix64(w[:-1] * K1 + w[1:] * K2) if len(w) > 1 else np.zeros(0, np.uint64)


def allowed(n: int) -> int:
    return int(MAX_EDITS * n + 1e-9)


def walk_keys(padded: np.ndarray, start: np.ndarray, end: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Keys (repetition x window) of the sampled walks over the windows padded[start:end].

    ``length`` is the item size a window stands for: it sets the sampled steps
    and is part of the key.  Past its end a window reads PAD.
    """
    rng = np.random.default_rng(SEED)
    at_share = rng.random((REPEATS, SAMPLES))
    salts = rng.integers(1, 1 << 63, REPEATS, dtype=np.uint64)[:, None]
    picks = (at_share[:, :, None] * (STRIDE * length)).astype(np.int64)
    seen = np.zeros((REPEATS, SAMPLES, len(start)), np.uint64)
    at = np.zeros((REPEATS, len(start)), np.int64)
    for step in range(int(picks.max(initial=-1)) + 1):
        place = start + at
        symbol = np.where(place < end, padded[np.minimum(place, len(padded) - 1)], PAD)
        for k in range(SAMPLES):
            np.copyto(seen[:, k], symbol, where=picks[:, k] == step)
        at += (mix64(symbol ^ mix64(salts + np.uint64(step))) & np.uint64(1)).astype(np.int64)
    key = mix64(salts + length.astype(np.uint64) * K2)
    for k in range(SAMPLES):
        key = mix64(key * K1 + seen[:, k])
    return key


def last_row(item: np.ndarray, text: np.ndarray, most: int, free: bool) -> np.ndarray | None:
    """Least word edits from ``item`` to text[s:j] for every j, with s = 0 or free; None if all exceed ``most``.

    The usual table, one row per item word; a row's left-to-right dependence is
    a running minimum, so each row is a few array steps.
    """
    m = len(text)
    column = np.arange(m + 1)
    row = np.zeros(m + 1, np.int64) if free else column
    for i, word in enumerate(item, 1):
        best = np.empty(m + 1, np.int64)
        best[0] = i
        best[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(best - column) + column
        if row.min() > most:
            return None
    return row


def distance(item: np.ndarray, window: np.ndarray, most: int) -> int:
    """Least word edits from ``item`` to a prefix of ``window``; above ``most``: most + 1."""
    row = last_row(item, window, most, False)
    return most + 1 if row is None else int(row.min())


def stretch(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int] | None:
    """(edits, start) of the stretch of ``text`` nearest to ``item``: the first to end, of those the shortest."""
    held = set(text.tolist())
    if sum(word not in held for word in item.tolist()) > most:  # a word that the text does not have is an edit
        return None
    row = last_row(item, text, most, True)
    if row is None:
        return None
    edits, end = int(row.min()), int(row.argmin())
    back = last_row(item[::-1], text[:end][::-1], most, False)
    return edits, end - int(np.flatnonzero(back == edits)[0])


def part_bounds(n: int) -> np.ndarray:
    """Where an item of n words is cut into parts."""
    count = -(-n // PART_WORDS)
    return np.arange(count + 1) * n // count


def index_of(items: list[tuple[int, str]]) -> dict:
    """A block of items as plain arrays: sequences, parts, known pairs by part length, keys of the walks."""
    data, offsets = column_bytes(pa.array([t for _, t in items], pa.string()))
    hashes, bounds = sequence(data, offsets, Powers())
    by_words: dict[bytes, list] = {}
    for k, (item_id, _) in enumerate(items):
        w = hashes[bounds[k]:bounds[k + 1]]
        if len(w) >= MIN_WORDS:
            by_words.setdefault(w.tobytes(), [w, []])[1].append(item_id)
    own = [v[0] for v in by_words.values()]
    cuts = [part_bounds(len(w)) for w in own]
    parts = [(i, a, b) for i, c in enumerate(cuts) for a, b in zip(c[:-1].tolist(), c[1:].tolist())]
    known: dict[int, list] = {}
    for i, a, b in parts:
        known.setdefault(b - a, []).append(pairs(own[i][a:b]))
    size = np.array([len(w) for w in own], np.int64)
    first = np.cumsum(size) - size
    part = np.array(parts, np.int64).reshape(-1, 3)
    start, length = first[part[:, 0]] + part[:, 1], part[:, 2] - part[:, 1]
    flat = np.append(np.concatenate(own), PAD) if own else np.zeros(1, np.uint64)
    keys = walk_keys(flat, start, start + length, length)
    holder = np.broadcast_to(np.arange(len(parts)), keys.shape).ravel()
    order = np.argsort(keys.ravel(), kind="stable")
    return {"items": own, "ids": [sorted(v[1], key=lambda x: (x is None, x)) for v in by_words.values()],
            "part_item": part[:, 0], "part_offset": part[:, 1],
            "known": {n: np.unique(np.concatenate(v)) for n, v in sorted(known.items())},
            "keys": keys.ravel()[order], "key_parts": holder[order]}


class Benchmark:
    """Searches an index of items; built in each Python worker from the broadcast arrays."""

    def __init__(self, index: dict):
        self.items, self.ids = index["items"], index["ids"]
        self.part_item, self.part_offset = index["part_item"], index["part_offset"]
        self.keys, self.key_parts = index["keys"], index["key_parts"]
        self.known_by_length = index["known"]
        self.known = np.unique(np.concatenate(list(self.known_by_length.values()))) if self.items \
            else np.zeros(0, np.uint64)
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[(self.known >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def known_pairs(self, w: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of the word pairs inside rows that the benchmark has."""
        p = pairs(w)
        some = np.flatnonzero(self.maybe[(p >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        some = some[np.isin(p[some], self.known)]
        across = bounds[(bounds > 0) & (bounds < len(w))] - 1  # pairs of two rows
        some = some[~np.isin(some, across)]
        return some, p[some]

    def windows(self, w: np.ndarray, bounds: np.ndarray):
        """(row, start, end, length) of the part-sized windows with enough known pairs."""
        places, values = self.known_pairs(w, bounds)
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        found = []
        for n, known in self.known_by_length.items():
            k = allowed(n)
            least = n - 1 - 2 * k
            at = places[np.isin(values, known)]
            if len(at) < least:
                continue
            # a window that starts in [last - n + 2, first] holds the `least` pairs from first to last
            first, last = at[:len(at) - least + 1], at[least - 1:]
            ok = (last - first <= n - 2) & (row[first] == row[last])
            first, last = first[ok], last[ok]
            low = np.maximum(last - n + 2, bounds[row[first]])
            size = first - low + 1
            s = np.unique(np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum()))
            end = np.minimum(s + n, bounds[1:][row[s]])
            s, end = s[end - s >= n - k], end[end - s >= n - k]
            found.append((row[s], s, end, np.full(len(s), n)))
        return [np.concatenate(c) for c in zip(*found)] if found else None

    def candidates(self, w: np.ndarray, bounds: np.ndarray, sums: np.ndarray, down: np.ndarray):
        """(row, item, place of the item's first word) of every window that shares a sampled walk with a part."""
        none = np.zeros(0, np.int64)
        found = self.windows(w, bounds) if len(w) > 1 and self.items else None
        if found is None:
            return none, none, none
        row, s, end, length = found
        # equal windows are embedded once
        same = mix64(mix64((sums[end] - sums[s]) * down[s] + (end - s).astype(np.uint64)) + length.astype(np.uint64))
        _, first, which = np.unique(same, return_index=True, return_inverse=True)
        padded, hits = np.append(w, PAD), [np.zeros((0, 2), np.int64)]
        for lo in range(0, len(first), WINDOWS_AT_ONCE):
            f = first[lo:lo + WINDOWS_AT_ONCE]
            keys = walk_keys(padded, s[f], end[f], length[f])
            left = np.searchsorted(self.keys, keys, "left")
            rep, j = np.nonzero(self.keys[np.minimum(left, len(self.keys) - 1)] == keys)
            left = left[rep, j]
            size = np.searchsorted(self.keys, keys[rep, j], "right") - left
            to = np.repeat(left - np.cumsum(size) + size, size) + np.arange(size.sum())
            hits.append(np.unique(np.stack([lo + np.repeat(j, size), self.key_parts[to]], axis=1), axis=0))
        window, part = np.concatenate(hits).T
        # spread to all windows equal to the embedded one
        order = np.argsort(which, kind="stable")
        begin = np.searchsorted(which[order], np.arange(len(first) + 1))
        size = begin[window + 1] - begin[window]
        m = order[np.repeat(begin[window] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        part = np.repeat(part, size)
        return row[m], self.part_item[part], s[m] - self.part_offset[part]

    def leaks(self, w: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, start word, edits) per leaked pair: the nearest stretch at a candidate's place, first on ties."""
        up, down = Powers().upto(len(w) + 1)
        sums = np.zeros(len(w) + 1, np.uint64)
        np.cumsum(w * up[:len(w)], out=sums[1:])
        row, item, place = self.candidates(w, bounds, sums, down)
        order = np.lexsort((place, item, row))
        row, item, place = row[order], item[order], place[order]
        n = np.array([len(x) for x in self.items] or [0], np.int64)[item]
        new = np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > n[1:]))[:len(row)]
        head = np.flatnonzero(new)  # places of an item within its own length are one stretch of text
        tail = np.append(head[1:], len(row))[:len(head)] - 1
        out, known = {}, {}
        for r, i, a, b in zip(row[head].tolist(), item[head].tolist(), place[head].tolist(), place[tail].tolist()):
            size, most = len(self.items[i]), allowed(len(self.items[i]))
            lo = max(int(bounds[r]), a - most)
            hi = max(lo, min(int(bounds[r + 1]), b + size + 2 * most))
            key = ((int(sums[hi]) - int(sums[lo])) * int(down[lo]) % (1 << 64), hi - lo, i)
            if key not in known:
                known[key] = stretch(self.items[i], w[lo:hi], most)
            if known[key] is not None:
                edits, at = known[key]
                if (r, i) not in out or edits < out[r, i][1]:
                    out[r, i] = lo + at - int(bounds[r]), edits
        return [(r, i, start, edits) for (r, i), (start, edits) in out.items()]


def blocks_of(benchmark: DataFrame):
    """The benchmark in bounded blocks of (item_id, text)."""
    items = benchmark.select("item_id", benchmark["text"].cast("string").alias("text")).where("text is not null")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    n = max(1, -(-size["n"] // BLOCK_ITEMS), -(-size["b"] // BLOCK_BYTES))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        yield sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[1], r[0] is None, r[0]))


def _search(bench: Benchmark, column):
    """(row, item, start, edits) over all rows of an Arrow column."""
    data, offsets = column_bytes(column)
    powers = Powers()
    for lo, hi in row_slices(offsets):
        part = data[offsets[lo]:offsets[hi]]
        w, bounds = sequence(part, offsets[lo:hi + 1] - offsets[lo], powers)
        for row, item, start, edits in bench.leaks(w, bounds):
            yield lo + row, item, start, edits


def _bench(held: dict) -> Benchmark:
    """The searcher of a broadcast index, built once per Python worker."""
    if "bench" not in held:
        held["bench"] = Benchmark(held)
    return held["bench"]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per leaked (document, item): doc_id, item_id, start_word, n_words, edits."""
    out = None
    small_batches(docs.sparkSession)
    slim = docs.select("doc_id", docs["text"].cast("string"))
    schema = "doc_id long, item_id long, start_word long, n_words long, edits long"
    for items in blocks_of(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index_of(items))

        def run(batches, sent=sent):
            bench = _bench(sent.value)
            for batch in batches:
                rows = [(row, i, start, len(bench.items[item]), edits)
                        for row, item, start, edits in _search(bench, batch.column(1)) for i in bench.ids[item]]
                ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array([r[c] for r in rows], pa.int64()) for c in range(1, 5)]],
                    names=["doc_id", "item_id", "start_word", "n_words", "edits"])

        found = slim.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with the columns of ``docs``."""
    small_batches(docs.sparkSession)
    place = docs.columns.index("text")
    for items in blocks_of(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index_of(items))

        def run(batches, sent=sent):
            bench = _bench(sent.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, *_ in _search(bench, batch.column(place)):
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
