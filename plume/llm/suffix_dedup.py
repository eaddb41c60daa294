"""Exact substring deduplication by deep-shallow suffix sorting.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else in the corpus is removed.  Sorting all suffixes of all texts would shuffle
many times the corpus, so suffixes are sorted at *anchors* only, and nothing is
lost by it:

1. The anchor of a window (``LENGTH`` bytes) is its ``SEED``-byte string of least
   hash, leftmost on ties.  It depends on the window's bytes alone, so equal
   windows have their anchor at the same place within.  Neighbouring windows
   mostly share an anchor; per anchor one row goes on: the hash of its string,
   the range of its windows, and the hash of its *context*, all bytes of those
   windows.
2. Anchors whose string occurs once hold no repeated window.  Equal contexts
   (128-bit hash) repeat in all their windows: copies are settled by counting,
   however many there are, and one context stands for all of them.
3. What is left are anchors with equal strings and different contexts: a
   repeat begins or ends there.  The suffixes from the anchor on, and the
   reversed prefixes before it, are put in order by deep-shallow sorting:
   multikey quicksort on 8-byte symbols to ``SHALLOW`` bytes, and blind tries for
   the groups that still agree.  The order and its common-prefix lengths give
   each suffix's class at any depth, and two windows ``o`` bytes left of their
   anchors are equal if their prefixes agree to depth ``o`` and their suffixes
   to depth ``LENGTH - o``.
4. Repeated windows become byte ranges per document, which are merged and cut.

Contexts are dealt by their anchor string and sorted in bounded chunks.  A
string with more than ``HOT`` different contexts is dealt on: all windows that start
lo to hi bytes before the anchor share the bytes from lo before it to ``LENGTH``
- hi after it, so the range of starts is halved and each half dealt by the hash
of what its windows share, until a group is small enough to be sorted or its
range is one window, which then is equal in the whole group.  No group is ever
larger than ``HOT`` when it is sorted, and no pair of equal windows is parted.

Texts are written once, with a row id, as a table bucketed by that id; the two
joins that bring places back to texts (cutting contexts, cutting repeats) read
the buckets where they are.  Texts are shuffled once at any size.

Defined results: NULL and empty texts have 0 bytes and the digest of no bytes;
texts shorter than ``LENGTH`` stay whole.  Matches never cross documents, and
repeats within a document count.  Rows that repeat are copies like any others.
Extra columns are kept by ``remove_repeats``; working columns start with
``_sd_``.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plume.session import scratch_path

from .tables import small_batches, staged
from .textbytes import Powers, PrefixHash, byte_codes, column_bytes, mix64, row_slices

LENGTH = 400
SEED = 200
SHALLOW = 32
HOT = 4096
CHUNK = 16_384           #: contexts sorted at once, at least
PER_TASK = 65_536        #: contexts of a task, about
MAX_BUCKETS = 100_000     #: Spark's own limit
PLACE_BITS = 24          #: places in a slice; longer texts are cut into overlapping segments


# ---- anchors ---------------------------------------------------------------

def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values: per block from both ends, then one comparison."""
    n = len(values)
    padded = np.full(-(-n // width) * width, 0xFFFFFFFFFFFFFFFF, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray, offsets: np.ndarray, powers: Powers):
    """(row, seed hash, context hash, anchor, first window, last window, end of run, run) of all anchors.

    Places count from the start of ``data``.  A run of neighbouring anchors with
    equal strings and contexts (a text of short period) is one entry.
    """
    if len(data) < LENGTH:
        return None
    codes = byte_codes(False)
    seeds = PrefixHash(data, powers, codes)
    at = np.arange(len(data) - SEED + 1)
    hashes = seeds.ranges(at, at + SEED)
    place = np.uint64((1 << PLACE_BITS) - 1)
    packed = (mix64(hashes ^ np.uint64(0x5851F42D4C957F2D)) & ~place) | at.astype(np.uint64)
    least = (_least(packed, LENGTH - SEED + 1) & place).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(least)]
    window = np.flatnonzero(np.arange(len(least)) + LENGTH <= offsets[1:][row])
    if not len(window):
        return None
    anchor = least[window]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    a, lo, hi = anchor[first], window[first], window[last]
    contexts = PrefixHash(data, powers, mix64(codes ^ np.uint64(0x14057B7EF767814F)))
    context = mix64(contexts.ranges(lo, hi + LENGTH) + (a - lo).astype(np.uint64))
    seed, r = hashes[a], row[lo]
    starts = np.ones(len(a), bool)
    starts[1:] = (seed[1:] != seed[:-1]) | (context[1:] != context[:-1]) | (r[1:] != r[:-1])
    s = np.flatnonzero(starts)
    e = np.append(s[1:], len(a)) - 1
    return r[s], seed[s], context[s], a[s], lo[s], hi[s], hi[e], e - s + 1


def _segments(offsets: np.ndarray):
    """Row slices; a row longer than a slice's places comes in overlapping segments (row, from, to)."""
    most = (1 << PLACE_BITS) - 1
    for lo, hi in row_slices(offsets):
        size = int(offsets[hi] - offsets[lo])
        if size <= most:
            yield lo, hi, int(offsets[lo]), int(offsets[hi])
        else:
            step = most - LENGTH + 1
            for start in range(0, max(1, size - LENGTH + 1), step):
                yield lo, hi, int(offsets[lo]) + start, min(int(offsets[hi]), int(offsets[lo]) + start + most)


ANCHORS = "seed long, context long, _sd_k long, anchor long, lo long, hi long, run_end long, n long"


def _anchor_batches(batches):
    powers = Powers()
    names = ["seed", "context", "_sd_k", "anchor", "lo", "hi", "run_end", "n"]
    for batch in batches:
        data, offsets = column_bytes(batch.column("text"))
        keys = batch.column("_sd_k")
        for lo, hi, start, end in _segments(offsets):
            bounds = np.clip(offsets[lo:hi + 1], start, end) - start
            found = anchors(data[start:end], bounds, powers)
            if found is None:
                continue
            row, seed, context, a, first, last, run_end, n = found
            base = offsets[lo + row] - start  # places from the start of the text
            cols = [seed.view(np.int64), context.view(np.int64), keys.take(pa.array(lo + row)),
                    a - base, first - base, last - base, run_end - base, n]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=names)


# ---- deep-shallow sorting --------------------------------------------------

def common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    lo, hi = 0, n  # x[:lo] == y[:lo], x[:hi] != y[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if x[lo:mid] == y[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def blind_trie(ids: list[int], texts: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of ``ids`` by text and the common-prefix length of each with its predecessor (first: 0).

    Inner nodes hold only the depth at which their texts part and a child per
    byte there (-1 where a text ends).  An insertion walks down blindly, by the
    bytes at those depths alone, compares once with any text below, and adds its
    leaf at the depth where the two part.
    """
    def leaf(i):
        return [-1, [i], None]

    def byte(t, d):
        return t[d] if d < len(t) else -1

    root = leaf(ids[0])
    for i in ids[1:]:
        t, node, path = texts[i], root, []
        while node[0] >= 0:
            path.append(node)
            child = node[2].get(byte(t, node[0]))
            node = child if child is not None else next(iter(node[2].values()))
        other = texts[node[1][0]]
        depth = common(t, other)
        if depth == len(t) == len(other):
            node[1].append(i)
            continue
        above = None
        for k, inner in enumerate(path):
            if inner[0] >= depth:
                node = inner
                above = path[k - 1] if k else None
                break
        else:
            above = path[-1] if path else None
        if node[0] == depth:
            node[2][byte(t, depth)] = leaf(i)
            continue
        joint = [depth, None, {byte(other, depth): node, byte(t, depth): leaf(i)}]
        if above is None:
            root = joint
        else:
            above[2][byte(t, above[0])] = joint
    order, lcp = [], []
    stack = [(root, 0)]
    while stack:
        node, shared = stack.pop()
        if node[0] < 0:
            for j, i in enumerate(node[1]):
                order.append(i)
                lcp.append(len(texts[i]) if j else shared)
            continue
        kids = sorted(node[2].items())
        for j in range(len(kids) - 1, -1, -1):
            stack.append((kids[j][1], node[0] if j else shared))
    return order, lcp


def deep_shallow(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order, common-prefix lengths with the predecessor) of texts, by bytes."""
    n, words = len(texts), SHALLOW // 8
    head = b"".join(t[:SHALLOW].ljust(SHALLOW, b"\0") for t in texts)
    symbols = np.frombuffer(head, ">u8").reshape(n, words).astype(np.uint64)
    order, lcp = [], []
    # three-way partition by the symbol at a depth; equal symbols go on to the next one
    stack = [(np.arange(n), 0)]
    while stack:
        ids, depth = stack.pop()
        if depth < words and len(ids) > 1:
            s = symbols[ids, depth]
            pivot = np.partition(s, len(s) // 2)[len(s) // 2]
            for part, d in ((ids[s > pivot], depth), (ids[s == pivot], depth + 1), (ids[s < pivot], depth)):
                if len(part):
                    stack.append((part, d))
            continue
        # zero padding makes "x" and "x\\0" meet here; the trie tells them apart
        own, shared = blind_trie(ids.tolist(), texts) if len(ids) > 1 else ([int(ids[0])], [0])
        shared[0] = common(texts[order[-1]], texts[own[0]]) if order else 0
        order += own
        lcp += shared
    return np.array(order, np.int64), np.array(lcp, np.int64)


def repeated_windows(contexts: list[bytes], left: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int, int]]:
    """(context, o1, o2): windows that start o1..o2 bytes before the anchor and equal one of another context.

    A context stands for the windows that start lo..hi bytes before its anchor only.
    """
    n = len(contexts)
    right_order, right_lcp = deep_shallow([c[k:] for c, k in zip(contexts, left)])
    left_order, left_lcp = deep_shallow([c[:k][::-1] for c, k in zip(contexts, left)])
    size = np.array([len(c) for c in contexts])
    low = np.maximum(lo, LENGTH - (size - left))  # least o with LENGTH - o bytes from the anchor on
    high = np.minimum(hi, left)
    marks = np.zeros((n, int(left.max()) + 1), bool)
    r, l = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(max(0, int(low.min())), int(high.max()) + 1):
        some = np.flatnonzero((low <= o) & (o <= high))
        if len(some) < 2:
            continue
        r[right_order] = np.cumsum(right_lcp < LENGTH - o)
        l[left_order] = np.cumsum(left_lcp < o)
        both = r[some] * (n + 1) + l[some]
        rank = np.argsort(both, kind="stable")
        same = both[rank][1:] == both[rank][:-1]
        marks[some[rank[1:][same]], o] = True
        marks[some[rank[:-1][same]], o] = True
    edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    starts, ends = np.argwhere(edge == 1), np.argwhere(edge == -1)
    return [(int(c), int(a), int(b) - 1) for (c, a), (_, b) in zip(starts, ends)]


RUNS = "seed long, context long, o1 long, o2 long"


def _runs(seeds, contexts, found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([seeds[c] for c, _, _ in found], pa.int64()), pa.array([contexts[c] for c, _, _ in found], pa.int64()),
         pa.array([a for _, a, _ in found], pa.int64()), pa.array([b for _, _, b in found], pa.int64())],
        names=["seed", "context", "o1", "o2"])


def _sort_batches(batches):
    """Rows come ordered by group; a chunk ends where the group changes."""
    held: list[list] = [[] for _ in range(6)]
    last = None

    def flush():
        seeds, contexts, left, lo, hi, texts = held
        return _runs(seeds, contexts, repeated_windows(texts, *(np.array(x) for x in (left, lo, hi))))
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("seed", "context", "left", "lo", "hi", "bytes", "k1", "k2"))
        for *row, k1, k2 in zip(*columns):
            group = (row[0], k1, k2)
            if len(held[0]) >= CHUNK and group != last:
                yield flush()
                held = [[] for _ in range(6)]
            last = group
            for column, value in zip(held, row):
                column.append(value)
    if len(held[0]) > 1:
        yield flush()


GROUP = ["seed", "lo", "hi", "k1", "k2"]
HALVES = "seed long, context long, left long, lo long, hi long, k1 long, k2 long, bytes binary"


def _halve_batches(batches):
    """Every (context, range of window starts) as its two halves, keyed by what each half's windows share."""
    powers, codes = Powers(), byte_codes(False)
    other = mix64(codes ^ np.uint64(0x2545F4914F6CDD1D))
    for batch in batches:
        data, offsets = column_bytes(batch.column("bytes"))
        left, lo, hi = (batch.column(c).to_numpy() for c in ("left", "lo", "hi"))
        for start, stop in row_slices(offsets):
            part, bounds = data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
            hashes = [PrefixHash(part, powers, c) for c in (codes, other)]
            size = np.diff(bounds)
            middle = (lo[start:stop] + hi[start:stop] + 1) // 2
            for a, b in ((lo[start:stop], middle - 1), (middle, hi[start:stop])):
                own = left[start:stop]
                some = np.flatnonzero((own >= a) & (size - own >= LENGTH - b))  # else no window of this half
                at = bounds[:-1][some] + own[some]
                k1, k2 = (h.ranges(at - a[some], at + LENGTH - b[some]).view(np.int64) for h in hashes)
                rows = pa.array(start + some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("seed").take(rows), batch.column("context").take(rows), batch.column("left").take(rows),
                     pa.array(a[some], pa.int64()), pa.array(b[some], pa.int64()), pa.array(k1), pa.array(k2),
                     batch.column("bytes").take(rows)], names=["seed", "context", "left", "lo", "hi", "k1", "k2", "bytes"])


# ---- the job ---------------------------------------------------------------

def _context_batches(batches):
    """Cut the wanted contexts out of whole texts."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist()):
            raw = text.as_buffer().to_pybytes()
            for w in wanted:
                out[0].append(w["seed"])
                out[1].append(w["context"])
                out[2].append(w["anchor"] - w["lo"])
                out[3].append(raw[w["lo"]:w["hi"] + LENGTH])
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.binary())],
            names=["seed", "context", "left", "bytes"])


def partial_runs(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(seed, context, o1, o2) of the repeated windows among different contexts of a seed."""
    spark = texts.sparkSession
    seeds = classes.groupBy("seed").agg(F.count("*").alias("kinds")).where("kinds > 1").select("seed")
    mixed = classes.join(seeds, "seed", "left_semi").select("seed", "context", "place.*")
    wanted = staged(mixed.groupBy("_sd_k").agg(F.collect_list(F.struct("seed", "context", "anchor", "lo", "hi"))
                                               .alias("wanted")), "suffix-wanted")  # a text's own anchors
    cut = (texts.select("_sd_k", "text").join(wanted.hint("shuffle_hash"), "_sd_k").select("text", "wanted")
           .mapInArrow(_context_batches, "seed long, context long, left long, bytes binary"))
    none = F.lit(0).cast("long")
    rows = cut.select("seed", "context", "left", none.alias("lo"), F.lit(LENGTH - SEED).cast("long").alias("hi"),
                      none.alias("k1"), none.alias("k2"), "bytes")
    small, whole = None, None
    while True:  # each level halves the range of window starts of the groups that are too large
        rows = staged(rows, "suffix-contexts")
        sizes = staged(rows.groupBy(*GROUP).count().where("count > 1"), "suffix-groups")
        large = F.col("count") > HOT
        ready = rows.join(sizes.where(~large).drop("count"), GROUP, "left_semi")
        small = ready if small is None else small.unionByName(ready)
        one = rows.join(sizes.where(large & (F.col("lo") == F.col("hi"))).drop("count"), GROUP, "left_semi") \
            .select("seed", "context", F.col("lo").alias("o1"), F.col("lo").alias("o2"))
        whole = one if whole is None else whole.unionByName(one)
        more = sizes.where(large & (F.col("lo") < F.col("hi"))).drop("count")
        if more.isEmpty():
            break
        rows = rows.join(more, GROUP, "left_semi").select("seed", "context", "left", "lo", "hi", "bytes") \
            .mapInArrow(_halve_batches, HALVES)
    small = staged(small, "suffix-small")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-small.count() // PER_TASK))
    dealt = small.repartition(parts, *GROUP).sortWithinPartitions(*GROUP, "context")
    return dealt.mapInArrow(_sort_batches, RUNS).unionByName(whole)


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with a row id ``_sd_k``, written bucketed by it: joins on the id move no text again."""
    spark = docs.sparkSession
    small_batches(spark)
    n = min(MAX_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"plume_texts_{uuid.uuid4().hex[:12]}"
    (docs.withColumn("text", docs["text"].cast("string")).withColumn("_sd_k", F.monotonically_increasing_id())
     .repartition(n, "_sd_k").write.bucketBy(n, "_sd_k").option("path", scratch_path(spark, "suffix-texts") + "/t")
     .option("compression", "zstd").saveAsTable(name))
    return spark.table(name)


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """Per row id ``_sd_k``: ``_sd_spans``, the maximal byte ranges covered by repeated windows."""
    slim = texts.where(F.octet_length("text") >= LENGTH).select("_sd_k", "text")
    all_anchors = staged(slim.mapInArrow(_anchor_batches, ANCHORS), "suffix-anchors")
    twice = all_anchors.groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")
    some = staged(all_anchors.join(twice, "seed", "left_semi"), "suffix-candidates")
    classes = staged(some.groupBy("seed", "context").agg(
        F.sum("n").alias("n"), F.min(F.struct("_sd_k", "anchor", "lo", "hi")).alias("place")), "suffix-classes")
    runs = staged(partial_runs(texts, classes), "suffix-runs")
    # a class of several anchors repeats in all its windows
    whole = classes.where("n > 1").select("seed", "context", F.lit(None).cast("long").alias("o1"),
                                          F.lit(None).cast("long").alias("o2"))
    single = runs.join(classes.where("n = 1").select("seed", "context"), ["seed", "context"], "left_semi")
    found = some.join(whole.unionByName(single), ["seed", "context"])
    start = F.when(F.col("o2").isNull(), F.col("lo")).otherwise(F.col("anchor") - F.col("o2"))
    end = F.when(F.col("o1").isNull(), F.col("run_end")).otherwise(F.col("anchor") - F.col("o1")) + LENGTH
    lists = found.groupBy("_sd_k").agg(F.collect_list(F.struct(start.alias("s"), end.alias("e"))).alias("r"))
    return staged(lists.mapInArrow(_merge_batches, f"_sd_k long, {SPANS}"), "suffix-ranges")


SPANS = "_sd_spans array<struct<s:long,e:long>>"
SPAN_TYPE = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def _merge_batches(batches):
    for batch in batches:
        spans = [[{"s": s, "e": e} for s, e in merged([(r["s"], r["e"]) for r in rs])] for rs in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, SPAN_TYPE)], names=["_sd_k", "_sd_spans"])


def merged(ranges: list[tuple[int, int]]) -> list[list[int]]:
    """Ranges as maximal runs."""
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _left_over(raw: bytes, spans: list[list[int]]) -> bytes:
    at, parts = 0, []
    for s, e in spans:
        parts.append(raw[at:s])
        at = e
    return b"".join([*parts, raw[at:]])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``_sd_kept`` (the bytes that are left) and ``_sd_spans`` (the maximal removed runs)."""
    texts = keyed_texts(docs)
    joined = texts.join(repeated_ranges(texts).hint("shuffle_hash"), "_sd_k", "left").drop("_sd_k")
    place, last = joined.columns.index("text"), len(joined.columns) - 1
    schema = StructType([*joined.drop("_sd_spans").schema.fields, *StructType.fromDDL(f"_sd_kept binary, {SPANS}").fields])

    def run(batches):
        for batch in batches:
            kept, spans = [], []
            for text, own in zip(batch.column(place), batch.column(last).to_pylist()):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                spans.append(own or [])
                kept.append(_left_over(raw, [[r["s"], r["e"]] for r in own]) if own else raw)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(kept, pa.binary()), pa.array(spans, SPAN_TYPE)],
                names=[*batch.schema.names[:-1], "_sd_kept", "_sd_spans"])

    return joined.mapInArrow(run, schema)


def repeat_report(docs: DataFrame) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and the digest of what is left."""
    out = remove_repeats(docs.select("doc_id", "text"))
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select("doc_id", n.alias("n_bytes"), (n - F.octet_length("_sd_kept")).alias("n_removed"),
                      F.size("_sd_spans").cast("long").alias("n_spans"), F.sha2("_sd_kept", 256).alias("kept_sha256"))
