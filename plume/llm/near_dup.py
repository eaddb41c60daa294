"""MinHash near-deduplication with sequential Bayesian verification.

Documents are linked if the Jaccard similarity of their word-shingle sets is at
least ``SIMILARITY``; a component is what links connect.

1. One Arrow pass makes each document's shingle set (hashes of its word bytes,
   A-Z lower-cased), a 128-bit fingerprint of the set, and the MinHash
   signature's band keys.  Documents of equal sets fall into one class; from
   here on only class representatives (smallest doc_id) take part.
2. Classes that share a band key are candidates.  A bucket is never expanded
   into pairs.  Its members are compared with its most central one (the one
   with most co-members over all its buckets: the original of a group of
   copies), and links are merged into components.  What then lies apart in
   buckets of the same centre is compared in blocks: members outside the
   centre's component against all members of other components.  No candidate
   link is lost, and only links leave a block.
3. A pair's signatures are compared in batches of ``BATCH`` values.  After each
   batch the pair is dropped if the posterior probability (flat prior) that its
   similarity reaches the bound is below ``MISS``; survivors are verified on the
   full sets.

With ``BANDS`` bands of ``ROWS`` values a pair at the bound is missed by all
bands with probability (1 - 0.8^6)^40 = 5e-6.

Defined results: NULL, empty or blank texts have no shingles and are linked
with nothing; texts with fewer words than ``width`` have one shingle, the whole
sequence.  A NULL doc_id is linked with nothing and kept.  Rows equal in doc_id
and text have the same result; ``drop_near_dups`` keeps one of them.  Texts whose
classes share their smallest doc_id (repeated ids) count as linked.  Extra columns
are kept by ``drop_near_dups``; working columns start with ``_nd_``.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import broadcast_if_small, small_batches, staged
from .textbytes import Powers, PrefixHash, byte_codes, column_bytes, mix64, row_slices, words

WIDTH = 5                #: words of a shingle
SIMILARITY_PERCENT = 80  #: 100 * intersection >= this * union
BANDS, ROWS = 40, 6
BATCH = 48
MISS = 1e-6
BLOCK = 512              #: members of a block
MAX_BROADCAST_ROWS = 1_000_000
K1 = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int, powers: Powers):
    """Per row its sorted distinct shingle hashes."""
    start, end, row = words(data, offsets)
    w = PrefixHash(data, powers, byte_codes(True)).ranges(start, end)
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    s = w[:max(0, len(w) - width + 1)].copy()
    for j in range(1, width):
        s = mix64(s * K1 + w[j:len(s) + j])
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo >= width:
            yield np.unique(s[lo:hi - width + 1])
        elif hi > lo:
            whole = np.array([hi - lo], np.uint64)
            for x in w[lo:hi]:
                whole = mix64(whole * K1 + x)
            yield whole
        else:
            yield np.zeros(0, np.uint64)


def permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    n = BANDS * ROWS
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)) | np.uint64(1), \
        rng.integers(0, 1 << 63, n, dtype=np.uint64)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least hash under each permutation, upper 32 bits."""
    least = np.full(len(a), 0xFFFFFFFFFFFFFFFF, np.uint64)
    for lo in range(0, len(shingles), 256):
        part = shingles[None, lo:lo + 256] * a[:, None]
        part += b[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    values = sig.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix64(key * K1 + values[:, k])
    return key.view(np.int64)


def _profiler(width: int):
    def run(batches):
        powers, (a, b) = Powers(), permutations()
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            n, f1, f2, keys, ends = [], [], [], [], [0]
            for lo, hi in row_slices(offsets):
                for s in shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], width, powers):
                    n.append(len(s))
                    f1.append(int(mix64(s).sum(dtype=np.uint64).view(np.int64)))
                    f2.append(int(mix64(s ^ K1).sum(dtype=np.uint64).view(np.int64)))
                    if len(s):
                        keys.append(band_keys(signature(s, a, b)))
                    ends.append(ends[-1] + (BANDS if len(s) else 0))
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_nd_k"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                 pa.array(f2, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                names=["doc_id", "_nd_k", "n_shingles", "f1", "f2", "bands"])
    return run


def _sets(width: int):
    """Per candidate text its signature and set, as bytes."""
    def run(batches):
        powers, (a, b) = Powers(), permutations()
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for lo, hi in row_slices(offsets):
                found = list(shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo],
                                          width, powers))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo),
                     pa.array([signature(s, a, b).tobytes() for s in found], pa.binary()),
                     pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "sig", "shingles"])
    return run


def least_matches() -> list[tuple[int, int]]:
    """(values compared, matches needed): fewer matches put the posterior below MISS.

    With a flat prior the posterior after m matches of h is Beta(m + 1, h - m + 1),
    so P(similarity >= t) = P(Binomial(h + 1, t) <= m).
    """
    t, out = SIMILARITY_PERCENT / 100, []
    for h in range(BATCH, BANDS * ROWS + 1, BATCH):
        total, m = 0.0, 0
        while True:
            total += comb(h + 1, m) * t ** m * (1 - t) ** (h + 1 - m)
            if total >= MISS:
                break
            m += 1
        out.append((h, m))
    return out


def _verify(batches):
    """Keep the pairs that pass the sequential test and the exact test on full sets."""
    needs = least_matches()
    for batch in batches:
        keep = []
        a_sig, a_set, b_sig, b_set = (batch.column(c) for c in ("a_sig", "a_set", "b_sig", "b_set"))
        for i in range(batch.num_rows):
            same = np.frombuffer(a_sig[i].as_buffer(), np.uint32) == np.frombuffer(b_sig[i].as_buffer(), np.uint32)
            done, matches, ok = 0, 0, True
            for h, need in needs:
                matches += int(same[done:h].sum())
                done = h
                if matches < need:
                    ok = False
                    break
            if ok:
                x = np.frombuffer(a_set[i].as_buffer(), np.uint64)
                y = np.frombuffer(b_set[i].as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok = 100 * both >= SIMILARITY_PERCENT * (len(x) + len(y) - both)
            keep.append(ok)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
            pa.array(keep, pa.bool_()))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that are similar enough."""
    pairs = broadcast_if_small(staged(pairs, "near-pairs"), MAX_BROADCAST_ROWS)
    x = sets.select(F.col("node").alias("a"), F.col("sig").alias("a_sig"), F.col("shingles").alias("a_set"))
    y = sets.select(F.col("node").alias("b"), F.col("sig").alias("b_sig"), F.col("shingles").alias("b_set"))
    return staged(x.join(pairs, "a").join(y, "b").mapInArrow(_verify, "a long, b long"), "near-links")


def compare_block(rows: list[dict], needs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links between the rows outside the main component (``apart``) and all others of another label."""
    sigs = np.array([np.frombuffer(r["sig"], np.uint32) for r in rows])
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
    sizes = np.array([len(x) for x in sets])
    labels = np.array([r["label"] for r in rows])
    others = np.array([r["other"] for r in rows])
    out = []
    for i in np.flatnonzero([r["apart"] for r in rows]):
        # sizes alone bound the similarity
        small, large = np.minimum(sizes, sizes[i]), np.maximum(sizes, sizes[i])
        near = np.flatnonzero(others & (labels != labels[i]) & (100 * small >= SIMILARITY_PERCENT * large))
        matches, done = np.zeros(len(near), np.int64), 0
        for h, need in needs:
            matches += (sigs[near, done:h] == sigs[i, done:h]).sum(axis=1)
            done, ok = h, matches >= need
            near, matches = near[ok], matches[ok]
        met = set()  # one link to a component is enough
        for j in near[np.argsort(-matches, kind="stable")]:
            if labels[j] in met:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= SIMILARITY_PERCENT * (sizes[i] + sizes[j] - both):
                met.add(labels[j])
                out.append((max(rows[i]["node"], rows[j]["node"]), min(rows[i]["node"], rows[j]["node"])))
    return out


def _compare_blocks(batches):
    """Rows come ordered by block."""
    needs, key, rows = least_matches(), None, []

    def links(found):
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                           pa.array([y for _, y in found], pa.int64())], names=["a", "b"])
    for batch in batches:
        found = []
        for r in batch.to_pylist():
            own = (r["centre"], r["part"], r["against"])
            if own != key and rows:
                found += compare_block(rows, needs)
                rows = []
            key = own
            rows.append(r)
        yield links(found)
    yield links(compare_block(rows, needs) if rows else [])


def compared_apart(buckets: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among members of the same centre's buckets that lie in different components.

    A centre's members outside its component (*apart*) are cut into parts, all
    its members into parts to compare them against; a block is one pair of
    parts and holds ``2 * BLOCK`` rows or so, however large the group.
    """
    placed = (buckets.select("centre", "node").distinct().join(labels, "node", "left")
              .select("centre", "node", F.coalesce("label", "node").alias("label")))
    home = labels.select(F.col("node").alias("centre"), F.col("label").alias("home"))
    placed = placed.join(home, "centre", "left").withColumn(
        "apart", F.col("label") != F.coalesce("home", "centre")).drop("home")
    size = (placed.groupBy("centre").agg(F.count("*").alias("n"), F.count_if("apart").alias("k"))
            .where("k > 0").select("centre", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts_n"),
                                   F.ceil(F.col("k") / BLOCK).cast("int").alias("parts_k")))
    members = staged(placed.join(size, "centre"), "near-apart")
    draw = F.xxhash64("node", "centre")
    asks = members.where("apart").select(
        "centre", "node", "label", F.pmod(draw, "parts_k").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("parts_n") - 1)).alias("against"), F.lit(True).alias("apart"),
        F.lit(False).alias("other"))
    told = members.select(
        "centre", "node", "label", F.explode(F.sequence(F.lit(0), F.col("parts_k") - 1)).alias("part"),
        F.pmod(draw, "parts_n").alias("against"), F.lit(False).alias("apart"), F.lit(True).alias("other"))
    rows = asks.unionByName(told).join(sets, "node")
    block = ["centre", "part", "against"]
    spark = sets.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return staged(rows.repartition(parts, *block).sortWithinPartitions(*block)
                  .mapInArrow(_compare_blocks, "a long, b long"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links``: label is the component's smallest node.

    Each round takes the least label among a node's neighbours, then the label of
    the label; rounds grow with the logarithm of a component's width.
    """
    edges = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .distinct(), "near-edges")
    labels = staged(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                    .select("node", F.least("node", "b").alias("label")), "near-labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        hooked = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("label").alias("above"))
        after = staged(hooked.join(up, "next", "left")
                       .select("node", F.col("label").alias("was"),
                               F.least("next", F.coalesce("above", "next")).alias("label")), "near-labels")
        labels = after.select("node", "label")
        if after.where("label <> was").isEmpty():
            return labels


def near_classes(docs: DataFrame, width: int, among: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(profiles of all rows, classes, component label per linked class).

    With ``among`` (a column doc_id) only rows with these ids take part.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    keyed = slim.select("doc_id", F.xxhash64("doc_id", "text").alias("_nd_k"), "text")
    profiles = staged(keyed.mapInArrow(
        _profiler(width), "doc_id long, _nd_k long, n_shingles long, f1 long, f2 long, bands array<long>"),
        "near-profiles")
    if among is not None:
        profiles = profiles.join(among.select("doc_id").distinct(), "doc_id", "left_semi")
    classes = staged(profiles.where("n_shingles > 0 and doc_id is not null").groupBy("f1", "f2", "n_shingles")
                     .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")), "near-classes")
    members = classes.select("node", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    joint = staged(members.join(shared, "band"), "near-joint")
    score = joint.groupBy("node").agg(F.sum("size").alias("score"))
    scored = joint.join(score, "node")
    centre = scored.groupBy("band").agg(F.max_by("node", F.struct("score", -F.col("node"))).alias("centre"))
    buckets = staged(joint.join(centre, "band").select("band", "node", "centre"), "near-buckets")
    wanted = staged(buckets.select(F.col("node").alias("doc_id")).distinct(), "near-wanted")
    sets = staged(slim.join(broadcast_if_small(wanted, MAX_BROADCAST_ROWS), "doc_id", "left_semi")
                  .mapInArrow(_sets(width), "node long, sig binary, shingles binary"), "near-sets")
    star = buckets.where("node <> centre").select(
        F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct()
    links = linked(star, sets)
    labels = components(links)
    more = compared_apart(buckets, labels, sets)
    return profiles, classes, labels if more.isEmpty() else components(links.unionByName(more))


def near_dups(docs: DataFrame, width: int = WIDTH, among: DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (and ``_nd_k``: with doc_id, the row's key)."""
    profiles, classes, labels = near_classes(docs, width, among)
    of = classes.select("f1", "f2", "n_shingles", "node")
    out = (profiles.select("doc_id", "_nd_k", "n_shingles", "f1", "f2")
           .join(of, ["f1", "f2", "n_shingles"], "left").join(labels, "node", "left"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "node", "doc_id"))
    return out.select("doc_id", "_nd_k", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_dups(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without the documents that another one of their component stands for."""
    rows = staged(near_dups(docs, width), "near-rows")
    key = ["doc_id", "_nd_k"]
    gone = staged(rows.where("not kept").select(*key).distinct(), "near-gone")
    twice = staged(rows.where("kept and n_shingles > 0 and doc_id is not null").groupBy(*key).count()
                   .where("count > 1").select(*key), "near-twice")
    k = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = docs.withColumn("_nd_k", k).withColumn("_nd_id", F.col("doc_id").cast("long"))

    def named(df):
        return broadcast_if_small(df.withColumnRenamed("doc_id", "_nd_id"), MAX_BROADCAST_ROWS)
    gone, twice = named(gone), named(twice)
    on = ["_nd_id", "_nd_k"]
    left = keyed.join(gone, on, "left_anti")
    # equal rows are few; only they are shuffled with their texts
    once = left.join(twice, on, "left_anti").unionByName(left.join(twice, on, "left_semi").dropDuplicates(on))
    return once.select(docs.columns)


def drop_copies(docs: DataFrame, originals: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without those whose row of ``originals`` is a near-duplicate of another one in ``docs``.

    For texts that have been edited since (lines taken out): the originals are
    compared, the documents as they are now stay or go by doc_id.  A doc_id goes
    if none of its originals stands for its component.  Ids without an original,
    and NULL ids, stay; of rows equal in all columns one stays.
    """
    rows = near_dups(originals, width, docs.select(F.col("doc_id").cast("long").alias("doc_id")))
    gone = staged(rows.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept")
                  .select(F.col("doc_id").alias("_nd_id")), "near-gone")
    keyed = docs.withColumn("_nd_id", F.col("doc_id").cast("long"))
    left = keyed.join(broadcast_if_small(gone, MAX_BROADCAST_ROWS), "_nd_id", "left_anti")
    twice = staged(keyed.where("_nd_id is not null").groupBy("_nd_id").count().where("count > 1").select("_nd_id"), "near-twice")
    twice = broadcast_if_small(twice, MAX_BROADCAST_ROWS)
    once = left.join(twice, "_nd_id", "left_anti").unionByName(
        left.join(twice, "_nd_id", "left_semi").dropDuplicates(docs.columns))
    return once.select(docs.columns)
