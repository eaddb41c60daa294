"""Line deduplication by a deletion-neighbourhood join.

A line (split at ``\\n``, at least ``MIN_CHARS`` code points) goes if an equal
line, or one within ``1`` edit (insert, delete or replace a code point), stands
anywhere earlier: in a document before it or above it in its own, whether or
not that line itself stays.  Documents are ordered by doc_id.

1. Equal lines meet by a 128-bit hash; the earliest place of each is kept.
2. Two lines one edit apart agree outside one of ``GAPS`` stretches.  Each line
   emits a key per stretch (what is left of it, aligned at the start, and right
   of it, aligned at the end; for its own length and one less, so that lines of
   neighbouring lengths meet).  Only lines that share a key with a different
   line go on: nothing is lost, and a unique line costs a few keys.
3. Those lines emit their deletion variants within the shared stretches as
   hashed keys.  A replacement at p shows as equal variants by deletion at p, an
   insertion as a variant equal to the other, whole line.  Each line is joined
   with the earliest of its variant's group only: members of a (variant, p)
   group are one edit apart from each other, so no link is lost and no pairs
   multiply.
4. Joined lines are verified by edit distance on their texts.

Keys and hashes are spread evenly; a line that a third of all documents share
is one row per task before the shuffle.

Defined results: NULL and empty texts have no lines to remove and stay as they
are.  Shorter lines always stay.  Rows equal in doc_id and text count as one
document, with the same lines removed; NULL doc_id comes first.  Extra columns
are kept; working columns start with ``_ld_``.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import broadcast_if_small, staged
from .textbytes import Powers, PrefixHash, column_bytes, mix64, row_slices

MIN_CHARS = 20
GAPS = 4
MAX_BROADCAST_ROWS = 1_000_000


def _key():
    return F.xxhash64("doc_id", "text").alias("_ld_k")


@cache
def _codes() -> tuple[np.ndarray, np.ndarray]:
    """Per code point its two hash values."""
    one = mix64(np.arange(1, 0x110001, dtype=np.uint64))
    return one, mix64(one ^ np.uint64(0xA5A5A5A5A5A5A5A5))


class Lines:
    """The lines of some rows as ranges of one code-point sequence, with two 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, powers: Powers):
        points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"),
                               np.uint32)
        if len(points) == len(data):
            rows = np.asarray(offsets, np.int64)
        else:
            before = np.zeros(len(data) + 1, np.int64)  # code points before a byte
            np.cumsum((data & 0xC0) != 0x80, out=before[1:])
            rows = before[offsets]
        feeds = np.flatnonzero(points == 10)
        filled = np.flatnonzero(rows[1:] > rows[:-1])
        start = np.sort(np.concatenate([rows[:-1][filled], feeds + 1]))
        end = np.sort(np.concatenate([feeds, rows[1:][filled]]))
        # a text that ends with a line feed has an empty last line, which shares its start with the next row
        row = np.searchsorted(feeds, end, side="left")  # feeds before the line
        self.row = filled[np.searchsorted(rows[1:][filled], end, side="left")]
        first_feed = np.searchsorted(feeds, rows[:-1])
        self.number = row - first_feed[self.row]
        ok = end - start >= MIN_CHARS
        self.start, self.end, self.row, self.number = start[ok], end[ok], self.row[ok], self.number[ok]
        self.points = points
        first, second = _codes()
        self.hash = PrefixHash(first[points], powers)
        self.h1 = self.hash.ranges(self.start, self.end)
        self.h2 = PrefixHash(second[points], powers).ranges(self.start, self.end)

    def stretch_keys(self, which: np.ndarray) -> np.ndarray:
        """(2 * GAPS, lines): the key per stretch of the lines ``which``, for their length and one less."""
        start, end = self.start[which], self.end[which]
        out, n = [], end - start
        for length in (n, n - 1):
            for j in range(GAPS):
                left, right = j * length // GAPS, (GAPS - 1 - j) * length // GAPS
                a = self.hash.ranges(start, start + left)
                b = self.hash.ranges(end - right, end)
                out.append(mix64(a * np.uint64(3) + mix64(b + np.uint64(j)) + length.astype(np.uint64)))
        return np.array(out).reshape(2 * GAPS, len(n))


def _scan(batches, emit, schema: pa.Schema):
    """Apply ``emit(lines, row ids)`` to slices of (key, doc_id, text) batches."""
    powers = Powers()
    for batch in batches:
        data, offsets = column_bytes(batch.column("text"))
        for lo, hi in row_slices(offsets):
            lines = Lines(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], powers)
            if len(lines.start):
                yield pa.RecordBatch.from_arrays(emit(lines, batch.slice(lo, hi - lo)), schema=schema)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _places(batches):
    """A row per line: its hashes and place."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()),
                        ("_ld_k", pa.int64()), ("line", pa.int64())])
    yield from _scan(batches, lambda x, b: [
        _signed(x.h1), _signed(x.h2), b.column("doc_id").take(pa.array(x.row)),
        b.column("_ld_k").take(pa.array(x.row)), pa.array(x.number)], schema)


def _keys(batches):
    """A row per line and stretch key; equal lines of a slice once."""
    schema = pa.schema([("key", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("gap", pa.int32())])

    def emit(x, _):
        _, one = np.unique(x.h1, return_index=True)
        keys = x.stretch_keys(one)
        gap = np.repeat(np.arange(2 * GAPS) % GAPS, len(one)).astype(np.int32)
        return [_signed(keys.ravel()), _signed(np.tile(x.h1[one], 2 * GAPS)), _signed(np.tile(x.h2[one], 2 * GAPS)),
                pa.array(gap)]
    yield from _scan(batches, emit, schema)


def _variants(batches):
    """Per suspect line its whole hash (at = -1) and its deletion variants in the shared stretches."""
    schema = pa.schema([("variant", pa.int64()), ("at", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])
    for batch in batches:
        cols: list[list] = [[], [], [], []]
        for text, gaps, h1, h2 in zip(*(batch.column(c).to_pylist() for c in ("line_text", "gaps", "h1", "h2"))):
            codes = mix64(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
                          + np.uint64(1))
            n = len(codes)
            at = np.unique(np.concatenate([
                np.arange(j * (n - 1) // GAPS, n - (GAPS - 1 - j) * (n - 1) // GAPS) for j in gaps]))
            powers = Powers()
            up, _ = powers.upto(n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(codes * up[:n], out=sums[1:])
            # the line without symbol p: the prefix, and the suffix moved one place down
            down = powers.down[1]
            v = sums[at] + (sums[n] - sums[at + 1]) * down
            cols[0] += [mix64(np.append(v, sums[n]))]
            cols[1] += [np.append(at, -1)]
            cols[2] += [np.full(len(at) + 1, h1)]
            cols[3] += [np.full(len(at) + 1, h2)]
        if cols[0]:
            v, at, h1, h2 = (np.concatenate(c) for c in cols)
            yield pa.RecordBatch.from_arrays(
                [_signed(v), pa.array(at.astype(np.int32)), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())],
                schema=schema)


def line_texts(slim: DataFrame, lines: DataFrame) -> DataFrame:
    """h1, h2 and text of ``lines`` (h1, h2, place), cut out of the documents where they stand."""
    wanted = staged(lines.groupBy(F.col("place._ld_k").alias("_ld_k2"), F.col("place.doc_id").alias("_ld_id"))
                    .agg(F.collect_list(F.struct("place.line", "h1", "h2")).alias("wanted")), "line-wanted")
    here = slim.join(broadcast_if_small(wanted, MAX_BROADCAST_ROWS, "wanted"),
                     (F.col("_ld_k") == F.col("_ld_k2")) & F.col("doc_id").eqNullSafe(F.col("_ld_id")))
    return (here.select("wanted", F.explode(F.array(F.split("text", "\n", -1))).alias("cut"))  # a text is cut once
            .select("cut", F.explode("wanted").alias("w"))
            .select("w.h1", "w.h2", F.get("cut", F.col("w.line").cast("int")).alias("line_text")))


def near_lines(slim: DataFrame, first: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines with an earlier line one edit away."""
    line = ["h1", "h2"]
    keys = slim.mapInArrow(_keys, "key long, h1 long, h2 long, gap int")
    shared = staged(keys.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
                    .where("lo <> hi").select("key"), "line-keys")
    suspects = staged(keys.join(broadcast_if_small(shared, MAX_BROADCAST_ROWS), "key", "left_semi")
                      .groupBy(*line).agg(F.collect_set("gap").alias("gaps")), "line-suspects")  # GAPS values at most
    suspects = staged(suspects.join(first, line), "line-suspect-places")
    texts = line_texts(slim, suspects)
    suspects = staged(texts.groupBy(*line).agg(F.first("line_text").alias("line_text")).join(suspects, line),
                      "line-suspect-texts")
    variants = (suspects.mapInArrow(_variants, "variant long, at int, h1 long, h2 long")
                .join(suspects.select(*line, "place"), line))
    variants = staged(variants, "line-variants")
    cut, whole = variants.where("at >= 0"), variants.where("at < 0")
    best = cut.groupBy("variant", "at").agg(F.min("place").alias("p0"), F.min_by("h1", "place").alias("a1"),
                                            F.min_by("h2", "place").alias("a2"), F.count("*").alias("n")).where("n > 1")
    replaced = cut.join(best, ["variant", "at"]).where("p0 < place").select(*line, "a1", "a2")
    w = whole.select("variant", F.col("h1").alias("w1"), F.col("h2").alias("w2"), F.col("place").alias("wp"))
    both = cut.join(w, "variant")
    inserted = both.where("wp < place").select(*line, F.col("w1").alias("a1"), F.col("w2").alias("a2"))
    shortened = (both.where("place < wp").groupBy("w1", "w2")
                 .agg(F.min_by("h1", "place").alias("a1"), F.min_by("h2", "place").alias("a2"))
                 .select(F.col("w1").alias("h1"), F.col("w2").alias("h2"), "a1", "a2"))
    links = replaced.unionByName(inserted).unionByName(shortened).distinct()
    t = suspects.select(*line, "line_text")
    a = t.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("line_text").alias("a_text"))
    return (links.join(t, line).join(a, ["a1", "a2"])
            .where(F.levenshtein("line_text", "a_text", 1) >= 0).select(*line).distinct())


def removed_lines(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, ``_ld_k``): the numbers of its lines that go."""
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")) \
        .where("text is not null").select(_key(), "doc_id", "text")
    places = staged(slim.mapInArrow(_places, "h1 long, h2 long, doc_id long, _ld_k long, line long"), "line-places")
    place = F.struct("doc_id", "_ld_k", "line")
    seen = staged(places.groupBy("h1", "h2").agg(F.min(place).alias("place"), F.max(place).alias("last")), "line-first")
    near = staged(near_lines(slim, seen.select("h1", "h2", "place")), "line-near").withColumn("near", F.lit(True))
    doomed = (seen.join(near, ["h1", "h2"], "left")
              .where(F.col("near") | (F.col("place") < F.col("last"))))
    gone = (places.join(doomed.select("h1", "h2", "near", F.col("place").alias("keep")), ["h1", "h2"])
            .where(F.col("near") | (place > F.col("keep"))))
    return gone.groupBy("doc_id", "_ld_k").agg(F.collect_set("line").alias("_ld_gone"))  # a document's own lines


def strip_lines(text: str | None, gone: list[int] | None) -> str | None:
    if not gone:
        return text
    out = set(gone)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in out)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, plus ``_ld_gone`` (their number)."""
    gone = staged(removed_lines(docs), "line-gone")
    keyed = docs.withColumn("_ld_k", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    # up to MAX_BROADCAST_ROWS changed documents and lines the texts are not shuffled
    hint = broadcast_if_small(gone, MAX_BROADCAST_ROWS, "_ld_gone").select(
        F.col("doc_id").alias("_ld_id"), F.col("_ld_k").alias("_ld_k2"), "_ld_gone")
    joined = keyed.join(hint, (F.col("_ld_k") == F.col("_ld_k2")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_ld_id")),
                        "left").drop("_ld_k", "_ld_k2", "_ld_id")
    place = joined.columns.index("text")
    schema = joined.drop("_ld_gone").schema

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.num_columns - 1).to_pylist()
            texts = [strip_lines(t.as_py(), g) if g else t.as_py()
                     for t, g in zip(batch.column(place), lists)]
            cols = [batch.column(i) if i != place else pa.array(texts, pa.string())
                    for i in range(batch.num_columns - 1)]
            cols.append(pa.array([len(g or ()) for g in lists], pa.int64()))
            names = [*batch.schema.names[:-1], "_ld_gone"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return joined.mapInArrow(run, schema.add("_ld_gone", "long"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; the columns of ``docs``."""
    return dedup_lines(docs).drop("_ld_gone")


def line_report(docs: DataFrame) -> DataFrame:
    """Per document: lines, removed lines, and the size and digest of the text that is left."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.when(F.length(text) > 0, F.size(F.split(text, "\n", -1))).otherwise(0).cast("long")
    out = dedup_lines(docs.select("doc_id", "text", lines.alias("n_lines")))
    return out.select("doc_id", "n_lines", F.col("_ld_gone").alias("n_removed"),
                      F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("kept_sha256"))
