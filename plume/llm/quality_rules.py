"""Quality rules whose cut-offs adapt to each language and source.

Fixed cut-offs fail a corpus of many languages and sources.  Here each rule's
cut-off is a robust fence around the middle half of its own (lang, source)
group: ``q75 + FENCE * max(q75 - q25, floor)``, and likewise below for two-sided
rules.  The quantiles come from mergeable sketches: a metric value goes to a
logarithmic bucket (relative error ``SKETCH_ERROR``), a sketch is the count per
bucket, and sketches merge by adding counts.  Adding is exact and independent
of order, so reruns and recomputed partitions give the same cut-offs.

All of it is DataFrame functions: split, sort_array, transform, aggregate and
partial aggregates; no Python runs on the executors.

A group's cut-offs are drawn towards those of its language, and a language's
towards those of all documents, as if ``PRIOR`` documents of the wider kind stood
in it: ``(n * own + PRIOR * wider) / (n + PRIOR)``, one formula at every size.

Defined results: NULL or empty text has no words and fails the base rules.
NULL lang or source is a group of its own.  Ties and repeated rows each count once per
row.  Extra columns of the input are carried through unread; working columns
start with ``_qr_``.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import WORD_BREAK, staged

SKETCH_ERROR = 0.01      #: relative error of a sketch's quantiles
SMALLEST = 1e-4          #: values below share the zero bucket
FENCE = 3.0              #: spreads beyond the middle half
PRIOR = 50               #: documents of the wider group that a cut-off starts from
MAX_BROADCAST_GROUPS = 50_000

MIN_WORDS = 50           #: fixed value of the base rules
MAX_REPEAT_PERCENT = 50  #: fixed value of the base rules

#: metric -> (numerator, denominator, least spread, two-sided?)
METRICS = {
    "word_len": ("word_chars", "n_words", 1.0, True),
    "symbols": ("n_symbols", "word_chars", 0.02, False),
    "capitals": ("n_capitals", "word_chars", 0.04, False),
    "marks": ("n_marks", "n_words", 0.06, False),
    "dup_lines": ("n_dup_lines", "n_lines", 0.10, False),
    "repeats": ("n_repeat_words", "n_words", 0.10, False),
}
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_capitals", "n_marks", "n_lines"]


def _count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, chars, ""))


def _covered(starts: Column) -> Column:
    """Words covered by the 3-word windows at these ascending starts."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        starts, zero,
        lambda a, x: F.struct((x + 3).alias("end"),
                              (a["n"] + x + 3 - F.greatest(a["end"], x)).cast("long").alias("n")),
        lambda a: a["n"])


def features(docs: DataFrame) -> DataFrame:
    """``docs`` plus the columns of ``FEATURES`` and a row number ``_qr_id``, one row per input row.

    The steps are separate projections: each array is computed once and read
    by the next step.  Repeated windows are found by sorting (hash, position)
    pairs and looking at the neighbours, n log n for a text of n words.
    """
    base = list(docs.columns)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    s1 = docs.select(*base, text.alias("_qr_t")).select(
        *base, "_qr_t",
        F.array_remove(F.split("_qr_t", WORD_BREAK, -1), "").alias("_qr_w"),
        F.filter(F.split("_qr_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_qr_l"))
    w = F.col("_qr_w")
    hashes = F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    s2 = s1.select(
        *base,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _count_chars(F.col("_qr_t"), r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        _count_chars(F.col("_qr_t"), r"\p{Lu}+").cast("long").alias("n_capitals"),
        _count_chars(F.col("_qr_t"), r"[!?]+").cast("long").alias("n_marks"),
        F.size("_qr_l").cast("long").alias("n_lines"),
        (F.size("_qr_l") - F.size(F.array_distinct("_qr_l"))).cast("long").alias("n_dup_lines"),
        hashes.alias("_qr_h"))
    keep = [*base, "n_words", "word_chars", "n_symbols", "n_capitals", "n_marks", "n_lines", "n_dup_lines"]
    some = F.size(F.array_distinct("_qr_h")) < F.size("_qr_h")
    s3 = s2.select(*keep, F.when(some, F.sort_array(F.transform(
        "_qr_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("_qr_s"))
    s = F.col("_qr_s")
    starts = F.sort_array(F.transform(
        F.filter(s, lambda x, k: x["h"].eqNullSafe(F.get(s, k + 1)["h"])
                 | x["h"].eqNullSafe(F.get(s, k - 1)["h"])),
        lambda x: x["i"]))
    # the row number keeps later filters above these steps: pushed below, they would repeat them
    return s3.select(*keep, F.coalesce(_covered(starts), F.lit(0).cast("long")).alias("n_repeat_words"),
                     F.monotonically_increasing_id().alias("_qr_id"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _value(metric: str) -> Column:
    top, below, _, _ = METRICS[metric]
    return F.when(F.col(below) > 0, F.col(top) / F.col(below)).otherwise(F.lit(0.0))


def _bucket(value: Column) -> Column:
    """Bucket b > 0 holds (SMALLEST * g^(b-1), SMALLEST * g^b]; 0 holds the rest."""
    g = (1 + SKETCH_ERROR) / (1 - SKETCH_ERROR)
    return F.when(value <= SMALLEST, F.lit(0)).otherwise(
        F.ceil(F.log(value / SMALLEST) / F.log(F.lit(g)))).cast("int")


def _bucket_value() -> Column:
    g = (1 + SKETCH_ERROR) / (1 - SKETCH_ERROR)
    return F.when(F.col("bucket") == 0, F.lit(0.0)).otherwise(
        2 * SMALLEST * F.pow(F.lit(g), F.col("bucket")) / (1 + g))


def sketches(feats: DataFrame) -> DataFrame:
    """Count per (lang, source, metric, bucket): the sketch of every group.

    Partial counts merge on the map side, so a source with a third of all rows
    sends a few hundred rows per task.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), _bucket(_value(m)).alias("bucket"))
                      for m in METRICS])
    return (feats.select("lang", "source", F.inline(F.when(F.col("n_words") > 0, pairs)))
            .groupBy("lang", "source", "metric", "bucket").agg(F.count("*").alias("n")))


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and metric: number of documents and the low and high cut-off."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    run = Window.partitionBy(*keys, "metric").orderBy("bucket")
    whole = Window.partitionBy(*keys, "metric")
    ranked = merged.select(*keys, "metric", _bucket_value().alias("v"), F.sum("n").over(run).alias("upto"),
                           F.sum("n").over(whole).alias("docs"))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("docs"), F.col("v")))
    quart = ranked.groupBy(*keys, "metric").agg(F.max("docs").alias("docs"), at(0.25).alias("q25"),
                                                at(0.75).alias("q75"))
    floor = reduce(lambda c, m: c.when(F.col("metric") == m, F.lit(METRICS[m][2])), list(METRICS)[1:],
                   F.when(F.col("metric") == list(METRICS)[0], F.lit(METRICS[list(METRICS)[0]][2])))
    spread = FENCE * F.greatest(F.col("q75") - F.col("q25"), floor)
    return quart.select(*keys, "metric", "docs", (F.col("q25") - spread).alias("low"),
                        (F.col("q75") + spread).alias("high"))


def thresholds(feats: DataFrame) -> DataFrame:
    """One row per (lang, source): ``low_<metric>`` and ``high_<metric>``."""
    sketch = staged(sketches(feats), "quality-sketch")
    own, by_lang, by_all = (_fences(sketch, k) for k in (["lang", "source"], ["lang"], []))
    by_lang = by_lang.select(F.col("lang").alias("l_lang"), F.col("metric").alias("l_metric"),
                             *[F.col(c).alias(f"l_{c}") for c in ("docs", "low", "high")])
    by_all = by_all.select(F.col("metric").alias("a_metric"),
                           *[F.col(c).alias(f"a_{c}") for c in ("low", "high")])
    joined = (own.join(by_lang, own["lang"].eqNullSafe(by_lang["l_lang"])
                       & (own["metric"] == by_lang["l_metric"]))
              .join(F.broadcast(by_all), F.col("metric") == F.col("a_metric")))  # a row per metric

    def drawn(own, docs, wider):
        return (docs * own + PRIOR * wider) / (docs + PRIOR)

    def cut(side):
        of_lang = drawn(F.col(f"l_{side}"), F.col("l_docs"), F.col(f"a_{side}"))
        return drawn(F.col(side), F.col("docs"), of_lang).alias(side)
    level = joined.select("lang", "source", "metric", cut("low"), cut("high"))
    return level.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == m, F.col(side))).alias(f"{side}_{m}")
          for m in METRICS for side in ("low", "high")])


def verdict(feats: DataFrame, cuts: DataFrame) -> DataFrame:
    """``feats`` plus ``base_failed`` and ``kept``, by a join on (lang, source).

    The cut-offs are staged and counted first: up to MAX_BROADCAST_GROUPS rows
    they are broadcast; beyond, Spark joins by shuffle and splits hot groups.
    """
    cuts = staged(cuts, "quality-cuts")
    c = cuts.select(F.col("lang").alias("_qr_lang"), F.col("source").alias("_qr_source"),
                    *[F.col(x).alias(f"_qr_{x}") for x in cuts.columns if x not in ("lang", "source")])
    c = F.broadcast(c) if c.count() <= MAX_BROADCAST_GROUPS else c
    joined = feats.join(c, feats["lang"].eqNullSafe(c["_qr_lang"])
                        & feats["source"].eqNullSafe(c["_qr_source"]), "left")
    bad = []
    for m, (_, _, _, two) in METRICS.items():
        bad.append(_value(m) > F.col(f"_qr_high_{m}"))
        if two:
            bad.append(_value(m) < F.col(f"_qr_low_{m}"))
    out = reduce(lambda a, b: a | F.coalesce(b, F.lit(False)), bad, F.lit(False))
    return joined.select(*feats.columns, base_failed().alias("base_failed"),
                         (~base_failed() & ~out).alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per document the features, ``base_failed`` and ``kept`` (no text)."""
    feats = staged(features(docs.select("doc_id", "text", "lang", "source")).drop("text", "_qr_id"),
                   "quality-features")
    return verdict(feats, thresholds(feats))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``.

    Rows are written once with their features; the sketches and the filter read
    them from there, each its own columns.
    """
    named = docs.toDF(*[f"_qr_in{i}" for i in range(len(docs.columns))])
    back = {c: f"_qr_in{i}" for i, c in enumerate(docs.columns)}
    feats = features(named.select("*", *[F.col(back[c]).alias(c) for c in ("text", "lang", "source")]))
    feats = staged(feats.drop("text", "_qr_id"), "quality-features")
    kept = verdict(feats, thresholds(feats)).where("kept")
    return kept.select(*[F.col(back[c]).alias(c) for c in docs.columns])
