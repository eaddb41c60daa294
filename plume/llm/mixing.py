"""Mixing sources to target weights by pivotal dependent rounding.

Sources in code-point order (NULL last) weigh 5, 2, 1, 5, 2, 1, ...; a target is
the source's share of all words, at most ``MOST_COPIES`` times its own words,
with the excess reshared by weight.  A source needs ``target / size`` copies of
each document: the whole part is taken outright, the fraction is rounded.

Rounding is pivotal: documents with fractional probabilities trade mass,
measured in words, at random and without bias until one of them is taken or
left, long documents first.  The sum of expected words never changes, so a
source ends within a short document of its target: if the last residual is a
long one, it is rounded at random and settled documents make up for it.  Documents of a source are dealt to blocks; a block
settles all but its ``RESERVE`` shortest documents and a residual, and blocks
meet ``FAN_IN`` at a time in the next level until one is left, where short
documents absorb the residuals.  A block never holds more than a few thousand
short rows, however large its source.

Randomness is a hash of (SEED, doc_id, text), so reruns agree.  Defined results:
NULL or wordless text has size 0 and is taken 0 times; NULL source is a source
of its own; rows that repeat are separate documents, and swapping equal rows
changes nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .tables import WORD, staged

WEIGHTS = (5, 2, 1)      #: fixed values of the mix
MOST_COPIES = 3          #: fixed value of the mix
SEED = 17
BLOCK = 2048             #: documents of a block of the lowest level
FAN_IN = 64
RESERVE = 16
NEAR = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and a random key per row (no text)."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"),
                       F.xxhash64(F.lit(SEED), "doc_id", "text").alias("draw"))


def ranked(totals: DataFrame) -> DataFrame:
    """``totals`` plus ``rank``, the source's place in code-point order (NULL last).

    Sorted by range and numbered within partitions; only the count per
    partition is put in one place.
    """
    low = (1 << 33) - 1
    number = F.monotonically_increasing_id()
    numbered = staged(totals.sort(F.col("source").asc_nulls_last())
                      .select("*", F.shiftright(number, 33).alias("part"),
                              number.bitwiseAND(F.lit(low)).alias("place")), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy("part").agg(F.count("*").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip")))
    return (numbered.join(F.broadcast(offsets), "part")  # a row per partition of the sort
            .withColumn("rank", F.col("skip") + F.col("place")).drop("part", "place", "skip"))


def targets(sized: DataFrame) -> DataFrame:
    """Per source: rank, source_size, docs, target.

    ``level`` is words per unit of weight.  Sources whose cap lies below their
    share keep the cap, and the level rises until no more do; each round is one
    aggregate over the sources.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    table = ranked(totals).withColumn("weight", F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
    table = staged(table, "mix-targets")
    cap = MOST_COPIES * F.col("source_size")
    level, capped = 0.0, -1
    while True:
        over = cap < F.lit(level) * F.col("weight")
        row = table.agg(F.sum("source_size").alias("all"),
                        F.coalesce(F.sum(F.when(over, cap)), F.lit(0)).alias("held"),
                        F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("free"),
                        F.count(F.when(over, 1)).alias("n")).first()
        if row["n"] == capped or not row["free"]:
            break
        capped, level = row["n"], (row["all"] - row["held"]) / row["free"]
    share = F.lit(float(level)) * F.col("weight")
    return table.select("source", "rank", "source_size", "docs",
                        F.least(cap.cast("double"), share).alias("target"))


def trade(p: float, s: float, q: float, t: float, u: float) -> tuple[float, float]:
    """Two documents (probability p, q; words s, t) trade words until one is settled.

    ``u`` is uniform in [0, 1).  Each probability keeps its expected value, and
    p * s + q * t does not change.
    """
    up = min((1 - p) * s, q * t)
    down = min(p * s, (1 - q) * t)
    move = up if u * (up + down) < down else -down
    snap = lambda x: 0.0 if x < NEAR else 1.0 if x > 1 - NEAR else x
    return snap(p + move / s), snap(q - move / t)


def uniform(key: int, level: int) -> float:
    x = (int(key) + 0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def settle(rows: pd.DataFrame, level: int, last: bool) -> pd.DataFrame:
    """Settle a block: long documents first; keep the shortest open unless ``last``.

    Documents trade in pairs, the open one of a pair trading with the next.
    While the documents not yet reached share one probability q, the open one
    is settled against all of them at once (their common q moves a little) just
    before they become too few words to absorb it.
    """
    rows = rows.sort_values(["size", "draw", "doc_id", "p"], ascending=[False, True, True, True],
                            na_position="last", kind="stable").reset_index(drop=True)
    p, size, draw = rows["p"].to_numpy(float).copy(), rows["size"].to_numpy(float), rows["draw"].to_numpy()
    n = len(rows) if last else max(0, len(rows) - RESERVE)
    even = bool(len(p)) and bool((p == p[0]).all())
    rest = size[::-1].cumsum()[::-1]  # words from a row on
    held = -1
    for i in range(n):
        if held >= 0 and even:
            q, s, words = p[i], size[held], rest[i]
            after = rest[i + 1] if i + 1 < len(p) else 0.0
            fits = q - (1 - p[held]) * s / words > NEAR and q + p[held] * s / words < 1 - NEAR
            if fits and after * min(q, 1 - q) < 2 * s:
                taken = uniform(draw[held], level) < p[held]
                p[i:] = q + (p[held] - taken) * s / words
                p[held], held = float(taken), -1
        if p[i] <= 0 or p[i] >= 1:
            continue
        if held < 0:
            held = i
            continue
        p[held], p[i] = trade(p[held], size[held], p[i], size[i], uniform(draw[i], level))
        if p[held] in (0.0, 1.0):
            held = i if 0 < p[i] < 1 else -1
    if last and held >= 0:
        taken = float(uniform(draw[held], level + 1) < p[held])
        extra = (taken - p[held]) * size[held]  # words too many; below 0, too few
        p[held] = taken
        for i in range(n):  # documents settled here make up for it, long ones first
            if i != held and p[i] == (extra > 0) and size[i] <= abs(extra):
                p[i] = 1 - p[i]
                extra -= size[i] if extra > 0 else -size[i]
    rows["p"] = p
    rows["open"] = (p > 0) & (p < 1)
    return rows


def _settler(level: int):
    return lambda block: settle(block, level, bool(block["blocks"].iloc[0] == 1))


def rounded(rows: DataFrame) -> DataFrame:
    """The rows with ``p`` settled to 0 or 1: the reduction tree over each source's blocks.

    ``rows``: doc_id, rank, block, blocks, size, draw, p and constants of the source.
    """
    schema = StructType([*rows.schema.fields, StructField("open", BooleanType())])
    done, level = [], 0
    todo = rows
    while True:
        out = staged(todo.groupBy("rank", "block").applyInPandas(_settler(level), schema), f"mix-level{level}")
        done.append(out.where(~F.col("open")).drop("open"))
        left = out.where("open")
        if left.isEmpty():
            break
        todo = (left.drop("open")
                .withColumn("block", F.floor(F.col("block") / FAN_IN).cast("long"))
                .withColumn("blocks", F.ceil(F.col("blocks") / FAN_IN).cast("long")))
        level += 1
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    return whole


def mix(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken words and copies."""
    sized = staged(sizes(docs), "mix-sizes")
    aims = staged(targets(sized), "mix-aims")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    aims = aims.select(F.col("source").alias("_source"), "rank", "source_size", "docs", "target",
                       F.floor(ratio + NEAR).cast("long").alias("copies"),
                       F.greatest(ratio - F.floor(ratio + NEAR), F.lit(0.0)).alias("fraction"))
    # aims has a row per source; Spark broadcasts it by its written size, or splits hot sources
    rows = (sized.join(aims, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("blocks", F.ceil(F.col("docs") / BLOCK).cast("long"))
            .withColumn("block", F.pmod(F.col("draw"), F.col("blocks")))
            .withColumn("p", F.when(F.col("fraction") < NEAR, F.lit(0.0)).otherwise(F.col("fraction")))
            .drop("_source", "source", "docs", "fraction"))
    open_ = (F.col("size") > 0) & (F.col("p") > 0)
    settled = rows.where(~open_).withColumn("p", F.lit(0.0))
    cols = ["doc_id", "rank", "block", "blocks", "size", "draw", "source_size", "target", "copies", "p"]
    both = settled.select(cols).unionByName(rounded(rows.where(open_).select(cols)))
    copies = F.col("copies") + F.col("p").cast("long")
    return both.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
                       F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long").alias("copies"))
