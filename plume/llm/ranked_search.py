"""Ranked lexical search over bags of query terms, one score per class of equal bags.

For a set of items (queries) only their own vocabulary matters.  Each document
becomes a bag: how often it holds each vocabulary term, and ``m``, which stands
for its length.  Documents with equal bags and equal ``m`` have equal scores for
every item, so they form a class that is scored once:

1. one Arrow pass over whole texts finds the terms as byte runs and looks them
   up in the vocabulary: document length ``n`` and the bag (term * 2^32 + tf, in
   term order).  N, L and the document frequencies are counted over all of them;
2. classes: rows are dealt by a 64-bit hash of (bag, m) and told apart by the
   bags themselves, so equal hashes of different bags stay two classes.  Of a
   class only its ``TOP`` smallest doc_ids can be wanted; every task drops the
   rest before the shuffle, so a class with a third of all documents moves
   ``TOP`` rows per task;
3. classes are scored where they lie; a task keeps the ``TOP`` best of each item
   by (score, smallest doc_id).  That loses nothing: documents of any further
   class come after the first documents of those ``TOP`` classes;
4. the best classes of an item are expanded to their members by ascending doc_id
   and ranked.

Items are a stated query set.  They are taken in blocks of bounded rows and bytes
(``decontaminate.blocks_of``); a block's vocabulary, weights and postings are
plain arrays in a broadcast.  All documents pass each block.

Scores are 64-bit integers, the weight ``floor(1000 * ln((2N + 2) / (2df + 1)))``
in doubles: see ``weights`` and ``score_classes``.

Defined results: NULL, empty or termless texts are no documents (not in N) and
are never found; items without text or terms have no rows.  Every row of either
table is a document or an item of its own, equal rows too; a NULL doc_id comes
after all others.  Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .decontaminate import blocks_of
from .tables import small_batches, staged
from .textbytes import column_bytes, lower_bytes, row_slices, run_strings, runs

TOP = 10
CELLS = 1 << 22          #: scores held at once by a task: classes x items
TF_BITS = 32

#: bytes of a term: digits, letters, anything beyond ASCII
TERM = np.ones(256, bool)
TERM[:48] = TERM[58:65] = TERM[91:97] = TERM[123:128] = False


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(terms, their rows) of the rows in data."""
    inside = TERM[data]
    start, end, row = runs(inside, offsets)
    return run_strings(lower_bytes(data), inside, start, end), row


class Items:
    """A block of items: vocabulary in byte order, and which items hold each term."""

    def __init__(self, rows: list[tuple[int, str]]):
        data, offsets = column_bytes(pa.array([t for _, t in rows], pa.string()))
        found, row = terms(data, offsets)
        self.vocabulary = sorted(set(found.to_pylist()))
        place = pc.index_in(found, pa.array(self.vocabulary, pa.large_binary())).to_numpy(zero_copy_only=False)
        held = np.unique(place.astype(np.int64) * max(1, len(rows)) + row)
        self.item = held % max(1, len(rows))                  # by term, then item
        self.first = np.searchsorted(held // max(1, len(rows)), np.arange(len(self.vocabulary) + 1))
        self.ids = [i for i, _ in rows]


BAGS = "doc_id long, n long, bag array<long>"


def bags(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Per document with terms: doc_id, n, bag over the vocabulary."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = pa.array(sent.value, pa.large_binary())
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for lo, hi in row_slices(offsets):
                part = data[offsets[lo]:offsets[hi]]
                found, row = terms(part, offsets[lo:hi + 1] - offsets[lo])
                n = np.bincount(row, minlength=hi - lo)
                place = pc.fill_null(pc.index_in(found, known), -1).to_numpy().astype(np.int64)
                some = place >= 0
                held, tf = np.unique((row[some] << TF_BITS) + place[some], return_counts=True)
                owner, term = held >> TF_BITS, held & ((1 << TF_BITS) - 1)
                size = np.bincount(owner, minlength=hi - lo)
                bounds = np.zeros(hi - lo + 1, np.int32)
                np.cumsum(size, out=bounds[1:])
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array((term << TF_BITS) + tf))],
                    names=["doc_id", "n", "bag"])
                yield out.filter(pa.array(n > 0))

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")) \
        .mapInArrow(run, BAGS)


def weights(n_docs: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)


def score_classes(weight: np.ndarray, first: np.ndarray, item: np.ndarray, n_items: int,
                  bag: np.ndarray, bounds: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores (classes x items) of bags[bounds[c]:bounds[c + 1]]."""
    owner = np.repeat(np.arange(len(m)), np.diff(bounds))
    term, tf = bag >> TF_BITS, bag & ((1 << TF_BITS) - 1)
    share = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
    held = first[term + 1] - first[term]
    to = item[np.repeat(first[term] - np.cumsum(held) + held, held) + np.arange(held.sum())]
    out = np.zeros(len(m) * n_items, np.int64)
    np.add.at(out, np.repeat(owner, held) * n_items + to, np.repeat(share, held))
    return out.reshape(len(m), n_items)


def best(found: list[np.ndarray]) -> list[np.ndarray]:
    """The TOP rows of each item of columns (item, score, smallest doc_id, class)."""
    item, score, low, _ = found
    order = np.lexsort((low, -score, item))
    item = item[order]
    place = np.arange(len(item)) - np.searchsorted(item, item, "left")
    return [c[order[place < TOP]] for c in found]


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The TOP documents of each item: item_id, rank, doc_id, score."""
    out = None
    for block in blocks_of(items):
        found = search_block(docs, Items(block))
        out = found if out is None else out.unionByName(found)
    return out


def search_block(docs: DataFrame, block: Items) -> DataFrame:
    spark = docs.sparkSession
    held = staged(bags(docs, block.vocabulary), "search-bags")
    total = held.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    counted = held.select(F.explode("bag").alias("e")).groupBy(F.shiftrightunsigned("e", TF_BITS).alias("t")).count().collect()
    frequency = np.zeros(len(block.vocabulary), np.int64)  # a row per vocabulary term at most
    for row in counted:
        frequency[row["t"]] = row["count"]
    m = F.expr(f"10 + cast((cast(90 * n as decimal(25, 0)) * cast({total['n']} as decimal(12, 0))) "
               f"div cast({max(1, total['l'])} as decimal(20, 0)) as long)")
    key = ["h", "m", "bag"]
    placed = (held.where(F.size("bag") > 0).withColumn("m", m).withColumn("h", F.xxhash64("bag", "m"))
              .withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_last())))
              .where(F.col("place") <= TOP))
    classes = staged(placed.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("place", "doc_id"))).alias("members"))
                     .withColumn("class", F.monotonically_increasing_id()), "search-classes")
    sent = spark.sparkContext.broadcast({"weight": weights(total["n"], frequency), "first": block.first,
                                         "item": block.item, "n": len(block.ids)})

    def run(batches):
        b = sent.value
        kept = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            at = max(1, CELLS // max(1, b["n"]))
            for lo in range(0, batch.num_rows, at):
                part = batch.slice(lo, at)
                lists = part.column(0)
                bounds = lists.offsets.to_numpy()
                bag = lists.values.to_numpy()[bounds[0]:bounds[-1]]
                scores = score_classes(b["weight"], b["first"], b["item"], b["n"], bag, bounds - bounds[0],
                                       part.column(1).to_numpy())
                c, i = np.nonzero(scores > 0)
                low = pc.fill_null(part.column(2), np.iinfo(np.int64).max).to_numpy()
                new = [i, scores[c, i], low[c], part.column(3).to_numpy()[c]]
                kept = best([np.concatenate(x) for x in zip(kept, best(new))])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in kept], names=["item", "score", "low", "class"])

    scored = classes.select("bag", "m", F.col("members")[0]["doc_id"].alias("low"), "class").mapInArrow(
        run, "item long, score long, low long, class long")

    def first_of(item, doc):
        return F.row_number().over(Window.partitionBy(item).orderBy(F.col("score").desc(), F.col(doc).asc_nulls_last()))
    winners = staged(scored.withColumn("place", first_of("item", "low")).where(F.col("place") <= TOP)
                     .select("item", "score", "class"), "search-winners")  # TOP rows an item of the block at most
    ids = spark.createDataFrame([(k, i) for k, i in enumerate(block.ids)], "item long, item_id long")
    members = (classes.select("class", "members").join(F.broadcast(winners), "class")
               .select("item", "score", F.explode("members.doc_id").alias("doc_id")))
    return (members.withColumn("rank", first_of("item", "doc_id")).where(F.col("rank") <= TOP)
            .join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
