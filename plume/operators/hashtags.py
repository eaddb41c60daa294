"""Hashtag extraction and trending windows (5-min tumble, 1-h hop by 5 min).

Scale: the hop view shares the 5-minute counts (panes) of its windows.  A
pane adds its count where its first window begins and takes it away where its
last one ends, so the windows are a running sum over difference rows: the
counts are shuffled once and expanded only into the rows of the answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .serving import latest_bucket

HOP_SIZE_MIN, HOP_SLIDE_MIN = 60, 5


def hashtag_events(raw: DataFrame) -> DataFrame:
    """One row per hashtag occurrence: (event_time, match).

    Created posts of any kind with text; each regex match counts, repeats in
    one post count again; posts without a match vanish.
    """
    df = raw if "event_time" in raw.columns else raw.withColumn(
        "event_time", C.event_time_micros("time_us"))
    return (df.filter(C.is_create_post_any_kind() & F.col("commit.record.text").isNotNull())
              .select("event_time",
                      F.explode(C.hashtags(F.col("commit.record.text"))).alias("match")))


def trending_hashtags_5m(raw: DataFrame) -> DataFrame:
    """COUNT(*) per (5-minute tumble, lower(tag))."""
    ev = hashtag_events(raw)
    return (ev.groupBy(F.window("event_time", "5 minutes").alias("w"),
                       F.lower("match").alias("hashtag"))
              .agg(F.count(F.lit(1)).alias("mentions"))
              .select(F.col("w.start").alias("bucket_start"), "hashtag", "mentions"))


def rollup_hop(tumble_5m: DataFrame) -> DataFrame:
    """1-hour windows sliding by 5 minutes, from the 5-minute counts.

    A pane at p is in the windows that start from p - 55 to p minutes: +m at the
    first, -m five minutes after the last.  Between two difference points of a
    tag the running sum does not change; stretches with a sum above 0 become
    one row per window start.
    """
    slide, first = HOP_SLIDE_MIN * 60, (HOP_SIZE_MIN - HOP_SLIDE_MIN) * 60
    p = F.unix_seconds("bucket_start")
    points = (tumble_5m.select("hashtag", p.alias("p"), "mentions").repartition("hashtag")
              .select("hashtag", F.explode(F.array(
                  F.struct((F.col("p") - first).alias("at"), F.col("mentions").alias("d")),
                  F.struct((F.col("p") + slide).alias("at"), (-F.col("mentions")).alias("d")))).alias("x"))
              .select("hashtag", "x.at", "x.d"))
    by_tag = Window.partitionBy("hashtag").orderBy("at")
    # rows of one point are peers of the range frame: all carry the whole sum, the last one leads to the next point
    runs = (points.withColumn("mentions", F.sum("d").over(by_tag.rangeBetween(Window.unboundedPreceding, 0)))
            .withColumn("next", F.lead("at").over(by_tag))
            .filter((F.col("mentions") > 0) & (F.col("next") > F.col("at"))))
    start = F.explode(F.sequence(F.col("at"), F.col("next") - slide, F.lit(slide).cast("long"))).alias("w")
    return (runs.select(start, "hashtag", F.col("mentions").cast("long").alias("mentions"))
                .select(F.timestamp_seconds("w").alias("window_start"),
                        F.timestamp_seconds(F.col("w") + HOP_SIZE_MIN * 60).alias("window_end"), "hashtag", "mentions"))


def trending_hashtags_1h_hop(raw: DataFrame, direct: bool | None = None) -> DataFrame:
    """COUNT(*) per (1-hour window sliding by 5 minutes, lower(tag)).

    Batch default: running sums over the 5-minute counts.
    ``direct=True`` (the streaming default) uses ``window(t, '1 hour',
    '5 minutes')`` on the occurrences; both give the same rows.
    """
    if direct is None:
        direct = raw.isStreaming
    if not direct:
        return rollup_hop(trending_hashtags_5m(raw))
    ev = hashtag_events(raw)
    return (ev.groupBy(F.window("event_time", f"{HOP_SIZE_MIN} minutes",
                                f"{HOP_SLIDE_MIN} minutes").alias("w"),
                       F.lower("match").alias("hashtag"))
              .agg(F.count(F.lit(1)).alias("mentions"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "hashtag", "mentions"))


def newest_bucket_events(raw: DataFrame) -> DataFrame:
    """The raw events of the newest 5-minute bucket that has a hashtag.

    One pass finds the newest tagged event's time (a scalar; no tag is
    extracted); the bucket's events are then a time filter that reaches the
    scan, so the counts above work on one bucket instead of all history.  The
    newest hop window begins with this bucket and holds nothing else yet.
    """
    tagged = raw.filter(C.is_create_post_any_kind() & F.col("commit.record.text").rlike(C.HASHTAG_PATTERN))
    width = HOP_SLIDE_MIN * 60 * C.MICROS_PER_SECOND
    newest = tagged.agg(F.max(F.unix_micros("event_time")).alias("t")).select(
        F.timestamp_micros(F.col("t") - F.pmod(F.col("t"), F.lit(width)))).scalar()
    return raw.filter(F.col("event_time") >= newest)


def newest_hop(raw: DataFrame) -> DataFrame:
    """The hop window that has just begun, from its only bucket so far."""
    first = trending_hashtags_5m(newest_bucket_events(raw))
    return first.select(F.col("bucket_start").alias("window_start"), "hashtag", "mentions")


def top_hashtags_latest(trending_5m: DataFrame, n: int = 20) -> DataFrame:
    """Tags of the newest 5-minute bucket, most mentioned first, n rows.

    Ties on mentions are broken by tag so the answer is deterministic.
    """
    return top_tags(latest_bucket(trending_5m, "bucket_start"), "bucket_start", n)


def top_tags(newest: DataFrame, time_col: str, n: int) -> DataFrame:
    """The n most mentioned tags of one bucket, ties by tag."""
    return (newest.orderBy(F.col("mentions").desc(), F.col("hashtag").asc())
                  .limit(n)
                  .select("hashtag", "mentions", time_col))


def top_hop_latest(hop: DataFrame, n: int = 15) -> DataFrame:
    """Tags of the newest hop window (the one that has just begun), n rows."""
    return top_tags(latest_bucket(hop, "window_start"), "window_start", n)


def latest_hashtag_card(trending_5m: DataFrame, n: int = 20) -> DataFrame:
    """One row: newest bucket, number of tags shown (<= n), top tag, peak."""
    return tag_card(top_hashtags_latest(trending_5m, n))


def tag_card(top: DataFrame) -> DataFrame:
    return top.agg(
        F.max("bucket_start").alias("bucket_start"),
        F.count(F.lit(1)).alias("unique_hashtags"),
        F.min_by("hashtag", F.struct(-F.col("mentions"), F.col("hashtag"))).alias("top_hashtag"),
        F.max("mentions").alias("peak_mentions"))


# ---- heavy hitters from mergeable sketches

TRACKED = 4096   #: tags a sketch tracks


def tag_sketches(raw: DataFrame) -> DataFrame:
    """Per 5-minute bucket a frequent-items sketch of its tags, and the number of mentions."""
    ev = hashtag_events(raw)
    return (ev.groupBy(F.window("event_time", f"{HOP_SLIDE_MIN} minutes").alias("w"))
              .agg(F.expr(f"approx_top_k_accumulate(lower(match), {TRACKED})").alias("tags"),
                   F.count(F.lit(1)).alias("mentions"))
              .select(F.col("w.start").alias("bucket_start"), "tags", "mentions"))


def top_from_sketches(panes: DataFrame, n: int = 20) -> DataFrame:
    """Per 1-hour window (sliding by 5 minutes) the n most mentioned tags by the merged sketches of its panes.

    ``error``: no estimate is off by more (a frequent-items sketch of a map of M
    slots, three quarters in use, errs by at most 3.5 / M of the mentions, and
    not at all while all tags fit).
    """
    back = F.explode(F.sequence(F.lit(0), F.lit(HOP_SIZE_MIN - HOP_SLIDE_MIN), F.lit(HOP_SLIDE_MIN))).alias("k")
    start = F.col("bucket_start") - F.make_dt_interval(F.lit(0), F.lit(0), F.col("k"), F.lit(0))
    merged = (panes.select("*", back).groupBy(start.alias("window_start"))
              .agg(F.expr(f"approx_top_k_combine(tags, {TRACKED})").alias("tags"), F.sum("mentions").alias("total")))
    error = F.ceil(F.col("total") * 3.5 / TRACKED).cast("long").alias("error")
    return merged.select("window_start", error, F.expr(f"approx_top_k_estimate(tags, {n})").alias("top"))


def sketch_agrees(top: DataFrame, exact: DataFrame, n: int = 20) -> DataFrame:
    """Per window, whether the sketch's top n holds every tag that must be in it.

    A tag must be in it if its exact count beats the best tag outside the exact
    top n by more than twice the error; every estimate must be within the error.
    """
    rank = Window.partitionBy("window_start").orderBy(F.col("mentions").desc(), "hashtag")
    ranked = exact.withColumn("place", F.row_number().over(rank)).filter(F.col("place") <= n + 1)
    cut = ranked.groupBy("window_start").agg(
        F.coalesce(F.max(F.when(F.col("place") == n + 1, F.col("mentions"))), F.lit(0)).alias("outside"))
    listed = top.select("window_start", F.explode("top").alias("t")).select(
        "window_start", F.col("t.item").alias("hashtag"), F.col("t.count").alias("estimate"))
    must = ranked.filter(F.col("place") <= n).join(cut, "window_start").join(top.select("window_start", "error"), "window_start") \
        .join(listed, ["window_start", "hashtag"], "left")
    missing = F.col("estimate").isNull() & (F.col("mentions") > F.col("outside") + 2 * F.col("error"))
    off = F.abs(F.col("estimate") - F.col("mentions")) > F.col("error")
    return must.groupBy("window_start").agg(F.count(F.lit(1)).alias("tags"),
                                            (F.count_if(missing | F.coalesce(off, F.lit(False))) == 0).alias("agrees"))
