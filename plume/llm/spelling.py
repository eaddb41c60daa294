"""Spelling variants: words one edit apart, each led to the commonest spelling.

*Words.*  Maximal runs of letters (ASCII and U+00C0 to U+00FF) of whole texts, A-Z
lower-cased, found as byte runs of Arrow buffers.  Where ``TYPO`` divides the
crc32 of ``<doc_id>:<run>``, the code point at crc32 mod length is deleted.  All
checksums of a batch advance together, byte by byte.  Words of ``MIN_LENGTH`` code
points and ``MIN_COUNT`` occurrences or more are the vocabulary; each batch
counts its words first, each task after it, and one row per word and task is
shuffled.

*Near words.*  Two words are near if exactly one code point was inserted,
deleted or replaced.  The vocabulary is compared by dynamic programming over
sorted lists: a query's banded edit matrix (three cells a row) is carried down a
sorted list, the rows of a prefix that a word shares with the word before it are
taken over, and where a prefix is already more than one edit away all words that
share it are skipped.

The lists are made small without losing a pair.  Of two near words, the shorter
one of L code points, either the first ``L // 2`` agree or the last
``L - L // 2`` do; so a word goes to the lists of its own L and of L - 1 (it may
be the longer one), under its first and its last part.  A list with more than
``MAX_LIST`` words is split the same way again in the middle that is still open,
level by level, until at most one open code point is left; such a list is
bounded by the alphabet.  A pair is reported only in the list that its common
prefix leads to, hence once.  Lists are read one at a time; each gives one row per
word that has near words: their number and the commonest.

*Forms and roots.*  A word's form is its commonest near word if that is at
least ``RATIO`` times as common; counts grow along forms, so following them ends,
and pointers are doubled until none moves (chains are shorter than log_5 of the
largest count).

Defined results: NULL and empty texts have no words; a NULL doc_id is spelt as
nothing in the checksum; equal rows count each; ties of n go to the smaller word
by code points.  Extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_batches, staged
from .textbytes import column_bytes, lower_bytes, row_slices, run_strings, runs

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
TYPO = 199
MAX_LIST = 4096
LIST_ROWS = 100_000      #: list entries a task, about
CRC_AT_ONCE = 64         #: bytes of a word; longer ones are summed one by one
LAST = "\U0010FFFF"

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
LEAD = 0xC3              #: first byte of U+00C0 to U+00FF in UTF-8


def crc_table() -> np.ndarray:
    """The byte table of CRC-32 from its polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """crc32 of each data[start:end], continued from ``seed``."""
    table, length = crc_table(), end - start
    order = np.argsort(-length, kind="stable")
    state = (seed[order] ^ np.uint32(0xFFFFFFFF)).astype(np.uint32)
    at, n = start[order], length[order]
    long = int(np.searchsorted(-n, -CRC_AT_ONCE, "left"))  # longer ones first
    for k in range(min(CRC_AT_ONCE, int(n[long:].max(initial=0)))):
        live = int(np.searchsorted(-n, -k, "left"))
        s = state[long:live]
        state[long:live] = table[(s ^ data[at[long:live] + k]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
    out = np.empty(len(start), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[:long]:
        out[i] = zlib.crc32(data[start[i]:end[i]].tobytes(), int(seed[i]))
    return out


def batch_words(data: np.ndarray, offsets: np.ndarray, ids: list) -> tuple[pa.Array, pa.Array]:
    """(words, counts) of the rows in data, long enough ones only."""
    data = lower_bytes(data)
    lead = data == LEAD
    inside = LETTER[data] | lead
    inside[1:] |= lead[:-1] & ((data[1:] & 0xC0) == 0x80)
    start, end, row = runs(inside, offsets)
    leads = np.append(0, np.cumsum(lead))
    length = end - start - (leads[end] - leads[start])
    some = length >= MIN_LENGTH
    inside[inside] = np.repeat(some, end - start)
    start, end, row, length = start[some], end[some], row[some], length[some]
    seeds = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in ids], np.uint32)
    crc = checksums(data, start, end, seeds[row])
    words = run_strings(data, inside, start, end)
    hit = crc % np.uint32(TYPO) == 0
    cut = []
    for i in np.flatnonzero(hit & (length > MIN_LENGTH)):
        word = data[start[i]:end[i]].tobytes().decode()
        k = int(crc[i]) % len(word)
        cut.append((word[:k] + word[k + 1:]).encode())
    words = pa.concat_arrays([words.filter(pa.array(~hit)), pa.array(cut, pa.large_binary())])
    found = pc.value_counts(words)
    return found.field(0), found.field(1)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and common enough."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            ids = batch.column(0).to_pylist()
            for lo, hi in row_slices(offsets):
                words, counts = batch_words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], ids[lo:hi])
                yield pa.RecordBatch.from_arrays([words.cast(pa.large_string()).cast(pa.string()), counts.cast(pa.int64())],
                                                 names=["word", "n"])

    found = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")) \
        .mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# ---- lists -----------------------------------------------------------------

LIST = ["size", "a", "b", "part"]  #: shorter length, shared first and last code points, hash of both parts


def split(rows: DataFrame) -> DataFrame:
    """Every (word, n, size, a, b) under the first and the last half of its open middle.

    Equal hashes of different parts only put two lists together: pairs are compared anyway.
    """
    half = F.floor((F.col("size") - F.col("a") - F.col("b")) / 2).cast("int")
    first = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"))
    last = F.struct(F.col("a").alias("a"), (F.col("size") - F.col("a") - half).alias("b"))
    out = rows.select("word", "n", "size", F.explode(F.array(first, last)).alias("s")).select("word", "n", "size", "s.*")
    part = F.xxhash64(F.substring("word", F.lit(1), F.col("a")), F.right("word", F.col("b")))
    return out.withColumn("part", part)


def lists(words: DataFrame) -> DataFrame:
    """Rows (word, n) by the lists in which they are compared; lists of one word are left out."""
    length = F.char_length("word")
    rows = split(words.select("word", "n", F.explode(F.array(length - 1, length)).alias("size"),
                              F.lit(0).alias("a"), F.lit(0).alias("b")).where(F.col("size") >= MIN_LENGTH))
    out = None
    while True:  # each level halves the open middle of the lists that are too long
        rows = staged(rows, "spelling-rows")
        sizes = staged(rows.groupBy(*LIST).count().where("count > 1"), "spelling-sizes")
        too_long = (F.col("count") > MAX_LIST) & (F.col("size") - F.col("a") - F.col("b") > 1)
        ready = rows.join(sizes.where(~too_long).drop("count"), LIST, "left_semi")
        out = ready if out is None else out.unionByName(ready)
        more = sizes.where(too_long).drop("count")
        if more.isEmpty():
            return out
        rows = split(rows.join(more, LIST, "left_semi"))


def led_to(a: int, b: int, size: int, shared: int) -> bool:
    """Does the way of a pair with ``shared`` common first code points pass the list (a, b)?"""
    x = y = 0
    while x + y < a + b:
        half = (size - x - y) // 2
        if shared >= x + half:
            x += half
        else:
            y = size - x - half
    return (x, y) == (a, b)


def shared_prefix(x: str, y: str) -> int:
    n = min(len(x), len(y))
    for i in range(n):
        if x[i] != y[i]:
            return i
    return n


def one_edit_away(query: str, words: list[str], lcps: list[int]) -> list[int]:
    """Places in the sorted ``words`` of those exactly one edit from ``query``.

    Row d of the matrix belongs to a word's first d code points and has the cells of the query's first
    d - 1, d and d + 1; ``lcps[i]`` is what words[i] shares with words[i - 1].  Words have the query's
    length or one code point more.
    """
    n, text = len(query), query + "\0\0\0"
    rows, found, i, size = [(2, 0, 1)], [], 0, len(words)
    while i < size:
        word = words[i]
        d, end = len(rows) - 1, len(word)
        left, same, right = rows[d]
        while d < end:
            c = word[d]
            low = same + 1
            if d and left + (text[d - 1] != c) < low:
                low = left + (text[d - 1] != c)
            mid = min(same + (text[d] != c), right + 1, low + 1)
            high = min(right + (text[d + 1] != c), mid + 1)
            left, same, right = low, mid, high
            d += 1
            rows.append((left, same, right))
            if left > 1 and same > 1 and right > 1:
                break
        else:
            if -1 <= n - end <= 1 and (left, same, right)[n - end + 1] == 1:
                found.append(i)
            i += 1
            if i < size:
                del rows[lcps[i] + 1:]
            continue
        i = bisect_left(words, word[:d] + LAST, i + 1)
        if i < size:
            del rows[lcps[i] + 1:]
    return found


def near_in_list(words: list[str], counts: list[int], size: int, a: int, b: int) -> dict[str, list]:
    """word -> [near words, -n of the commonest, it] for the pairs that belong to this list."""
    turned = b > a
    order = sorted((w[::-1] if turned else w, n) for w, n in zip(words, counts))
    keys = [w for w, _ in order]
    lcps = [0] + [shared_prefix(x, y) for x, y in zip(keys, keys[1:])]
    out: dict[str, list] = {}

    def add(word, other, n):
        best = out.setdefault(word, [0, 0, other])
        best[0] += 1
        if best[0] == 1 or (-n, other) < (best[1], best[2]):
            best[1:] = -n, other
    for query, own in order:
        if len(query) != size:
            continue
        for i in one_edit_away(query, keys, lcps):
            x, y = (query[::-1], keys[i][::-1]) if turned else (query, keys[i])
            if led_to(a, b, size, shared_prefix(x, y)):
                add(x, y, order[i][1])
                if len(y) > size:  # a longer word asks nothing here
                    add(y, x, own)
    return out


NEAR = "word string, near long, less long, other string"


def _list_batches(batches):
    """Rows come ordered by list; one list is held at a time."""
    def flush(key, words, counts):
        found = near_in_list(words, counts, key[0], key[1], key[2]) if len(words) > 1 else {}
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), *[pa.array([v[k] for v in found.values()], t) for k, t in
             enumerate((pa.int64(), pa.int64(), pa.string()))]], names=["word", "near", "less", "other"])
    key, words, counts = None, [], []
    for batch in batches:
        for word, n, *at in zip(*(c.to_pylist() for c in batch.columns)):
            if at != key:
                if len(words) > 1:
                    yield flush(key, words, counts)
                key, words, counts = at, [], []
            words.append(word)
            counts.append(n)
    if len(words) > 1:
        yield flush(key, words, counts)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, and the commonest near word (other, other_n)."""
    work = staged(lists(words), "spelling-lists")
    parts = max(int(work.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-work.count() // LIST_ROWS))
    dealt = work.select("word", "n", *LIST).repartition(parts, *LIST).sortWithinPartitions(*LIST)
    return (dealt.mapInArrow(_list_batches, NEAR).groupBy("word")
            .agg(F.sum("near").alias("n_near"), F.min(F.struct("less", "other")).alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("other_n"), F.col("best.other").alias("other")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): pointers doubled until none moves."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        at = staged(at, "spelling-roots")
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if at.join(onward, "root", "left_semi").isEmpty():
            return at
        at = at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def spelling_groups(docs: DataFrame) -> DataFrame:
    """One row per vocabulary word: word, form, root, n, n_near, form_n."""
    words = staged(vocabulary(docs), "spelling-words")
    has_form = F.col("other_n") >= RATIO * F.col("n")
    out = staged(words.join(near_words(words), "word", "left")
                 .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(has_form, F.col("other")).alias("form"), F.when(has_form, F.col("other_n")).alias("form_n")),
                 "spelling-forms")
    led = roots(out.where("form is not null"))
    return out.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
