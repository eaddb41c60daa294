"""Tumbling-window post rates (posts/minute by language, posts/second, 1-min
language rate) and the current-rate gauge.

Each function works unchanged on a batch DataFrame and on a streaming one
(given a watermark).  Buckets are epoch-aligned ``window()`` starts, which in
UTC are the same as ``date_trunc``; grouping by the window struct lets a
stream evict state once the watermark passes.  All counts use partial
(map-side) aggregation before the shuffle, so a hot language costs one row
per task, not one row per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def _ensure_event_time(raw: DataFrame) -> DataFrame:
    if "event_time" in raw.columns:
        return raw
    return raw.withColumn("event_time", C.event_time_micros("time_us"))


def posts_per_minute_by_lang(raw: DataFrame) -> DataFrame:
    """COUNT(*) per (minute, first language) over created posts (kind = commit).

    The reference truncates the micros to whole seconds before taking the
    minute; flooring to the second never moves an event across a minute
    boundary, so the bucket is taken from the source event_time (which
    carries the stream's watermark).  In batch, events without a time form a
    NULL bucket of their own, as in the reference; a stream's window cannot
    hold them (no watermark passes NULL): ``untimed_posts_by_lang`` is their view.
    """
    df = _ensure_event_time(raw).filter(C.is_create_post()).select(
        "event_time", C.primary_lang("commit.record.langs").alias("lang"))
    if not df.isStreaming:
        return (df.groupBy(F.date_trunc("minute", "event_time").alias("minute_bucket"), "lang")
                  .agg(F.count(F.lit(1)).alias("post_count")))
    return (df.groupBy(F.window("event_time", "1 minute").alias("w"), "lang")
              .agg(F.count(F.lit(1)).alias("post_count"))
              .select(F.col("w.start").alias("minute_bucket"), "lang", "post_count"))


def untimed_posts_by_lang(raw: DataFrame) -> DataFrame:
    """The NULL bucket of ``posts_per_minute_by_lang``: a counter per language, also in a stream."""
    return (raw.filter(C.is_create_post() & F.col("time_us").isNull())
               .groupBy(C.primary_lang("commit.record.langs").alias("lang"))
               .agg(F.count(F.lit(1)).alias("post_count"))
               .select(F.lit(None).cast("timestamp").alias("minute_bucket"), "lang", "post_count"))


def posts_per_second(raw: DataFrame) -> DataFrame:
    """COUNT(*) per 1-second tumble over *every* event (no predicate)."""
    df = _ensure_event_time(raw).select("event_time")
    return (df.groupBy(F.window("event_time", "1 second").alias("w"))
              .agg(F.count(F.lit(1)).alias("post_count"))
              .select(F.col("w.start").alias("second_bucket"), "post_count"))


def lang_post_rate_1m(raw: DataFrame) -> DataFrame:
    """COUNT(*) per (1-minute tumble, first language); create + post, any kind."""
    df = _ensure_event_time(raw).filter(C.is_create_post_any_kind()).select(
        "event_time", C.primary_lang("commit.record.langs").alias("lang"))
    return (df.groupBy(F.window("event_time", "1 minute").alias("w"), "lang")
              .agg(F.count(F.lit(1)).alias("posts_in_minute"))
              .select(F.col("w.start").alias("minute_bucket"), "lang", "posts_in_minute"))


def current_rate(pps: DataFrame) -> DataFrame:
    """Newest second's count: ORDER BY second_bucket DESC LIMIT 1.

    Planned as TakeOrderedAndProject (a per-task top-1 then a merge), not a
    global sort.
    """
    return pps.orderBy(F.col("second_bucket").desc()).limit(1)
