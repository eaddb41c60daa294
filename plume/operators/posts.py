"""Flattening and staging of post events (posts_flat, stg_posts, dedupe)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def posts_flat(raw: DataFrame) -> DataFrame:
    """Created posts flattened to the 6 columns of the landed table.

    event_time is whole seconds (integer division of the micros); the first
    declared language, or 'unknown'.  Stateless: in a stream, rows behind the
    watermark are kept (no silent loss in the landed table).
    """
    return (raw.filter(C.is_create_post())
               .select(F.col("did"),
                       F.col("time_us"),
                       C.event_time_seconds("time_us").alias("event_time"),
                       F.col("commit.record.text").alias("text"),
                       C.primary_lang("commit.record.langs").alias("primary_lang"),
                       F.col("commit.record.createdAt").alias("created_at")))


def stg_posts(posts: DataFrame) -> DataFrame:
    """Staging: drop NULL text and test markers, add text_length (code points).

    ``did NOT LIKE 'harness:%'`` also drops NULL dids (three-valued logic).
    The day column of a day-partitioned table is kept, so later date filters
    prune its partitions.
    """
    day = [c for c in ("event_date",) if c in posts.columns]
    return (posts.filter(F.col("text").isNotNull() & C.not_marker_did("did"))
                 .select("did", "time_us", "event_time", "text", "primary_lang", "created_at",
                         F.length("text").alias("text_length"), *day))


#: A delivery's identity: one record key may see a create, an update and a
#: delete, and likes and posts keep separate keys.
EVENT_KEY = ["did", "time_us", "kind", "rev", "operation", "collection", "rkey"]


def with_event_key(raw: DataFrame) -> DataFrame:
    """Lift the key fields to the top level (dedupe keys must be top-level)."""
    return raw.select("*", *[F.col(f"commit.{c}").alias(c)
                             for c in ("rev", "operation", "collection", "rkey")])


def dedupe_posts(raw: DataFrame, streaming: bool | None = None) -> DataFrame:
    """Drop replayed events: one row per delivery of ``EVENT_KEY``.

    The upstream reconnect replays a few seconds of events, so delivery is at
    least once.  A replay repeats every field, so which copy survives does not
    matter; a delete, an update or a like on the same record key differs in
    the key and stays.  NULL fields compare as equal (identity events have no
    commit).  One pass; in a stream the state is bounded by the watermark.
    """
    df = with_event_key(raw)
    if df.isStreaming if streaming is None else streaming:
        return df.dropDuplicatesWithinWatermark(EVENT_KEY)
    return df.dropDuplicates(EVENT_KEY)
