"""Structured Streaming builders, one per continuously maintained view.

Every view is the *same* DataFrame function used in batch, applied to a
decoded, watermarked event stream:

    value stream -> decode_events -> with_event_time -> with_watermark
                 -> view function -> writeStream

Views emit on update (no close-only emission in the reference), so they run
in ``update`` mode into an ``UpdateSink``; ``append`` mode is available for
consumers that want closed windows only.  The stacked spike view is keyed state
(``spike_state``).  State lives in the
RocksDB state store under the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import hashtags as H
from ..operators import posts as P
from ..operators import rates as R
from ..operators import spikes as K
from ..session import settings
from ..sources import readers as RD
from .sinks import PARQUET_CODEC, UpdateSink, _trigger, sink_posts
from .spike_state import spike_stream


@dataclass(frozen=True)
class View:
    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]


def dim_languages_stream(events: DataFrame) -> DataFrame:
    """dim_languages on a stream: exact COUNT(DISTINCT) is refused in
    streams, so distinct users use HyperLogLog++ (R12)."""
    from ..operators import marts as M
    return M.dim_languages(P.stg_posts(P.posts_flat(events)), approx=True)


def lang_day_sketches_stream(events: DataFrame) -> DataFrame:
    """Per (day, language) a mergeable sketch of the users, state bounded by the watermark (R12)."""
    from ..functions import columns as C
    from ..operators import marts as M
    posts = (events.filter(C.is_create_post() & F.col("commit.record.text").isNotNull() & C.not_marker_did("did"))
             .select("event_time", "did", C.event_time_seconds("time_us").alias("seen"),
                     C.primary_lang("commit.record.langs").alias("lang_code")))
    return (posts.groupBy(F.window("event_time", "1 day").alias("w"), "lang_code")
            .agg(F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"),
                 F.count(F.lit(1)).alias("total_posts"), F.hll_sketch_agg("did", M.HLL_LG_K).alias("users"))
            .select(F.to_date("w.start").alias("event_date"), "lang_code", "first_seen", "last_seen", "total_posts", "users"))


VIEWS: dict[str, View] = {
    "posts_per_minute_by_lang": View(R.posts_per_minute_by_lang, ("minute_bucket", "lang")),
    "untimed_posts_by_lang": View(R.untimed_posts_by_lang, ("minute_bucket", "lang")),
    "posts_per_second": View(R.posts_per_second, ("second_bucket",)),
    "lang_post_rate_1m": View(R.lang_post_rate_1m, ("minute_bucket", "lang")),
    "trending_hashtags_5m": View(H.trending_hashtags_5m, ("bucket_start", "hashtag")),
    "trending_hashtags_1h_hop": View(lambda r: H.trending_hashtags_1h_hop(r, direct=True),
                                     ("window_start", "window_end", "hashtag")),
    "dim_languages": View(dim_languages_stream, ("lang_code",)),
    "lang_day_sketches": View(lang_day_sketches_stream, ("event_date", "lang_code")),
    "tag_sketches": View(H.tag_sketches, ("bucket_start",)),
}


def event_stream(values: DataFrame, watermark: bool = True, dedupe: bool = False) -> DataFrame:
    """Decoded events with event_time and the 10-second watermark.

    ``dedupe=True`` drops replayed (did, rkey) pairs within the watermark
    (off by default, as in the reference)."""
    keep = tuple(c for c in ("arrival_time",) if c in values.columns)
    ev = RD.with_event_time(RD.decode_events(values, keep=keep))
    if watermark:
        ev = RD.with_watermark(ev)
    if dedupe:
        ev = P.dedupe_posts(ev, streaming=True)
    return ev


def _append(df: DataFrame, path: str, checkpoint: str, trigger: str | None) -> StreamingQuery:
    w = (df.writeStream.outputMode("append").format("parquet").option("compression", PARQUET_CODEC)
           .option("path", path).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def start_landing(values: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Raw landing: every payload unchanged, with topic, partition, offset and
    arrival time where the source has them; append-only and exactly once."""
    return _append(RD.land_raw(values), path, checkpoint, trigger)


UNTIMED_DELAY = "1 hour"


def dedupe_untimed(events: DataFrame) -> DataFrame:
    """Event keys of the events without a time, replays dropped.

    No event-time watermark ever passes them, so the time of arrival (the
    source's, or else the micro-batch's) bounds their state: a replay that
    arrives within ``UNTIMED_DELAY`` is dropped.
    """
    untimed = P.with_event_key(events.filter(F.col("time_us").isNull()))
    if "arrival_time" not in untimed.columns:
        untimed = untimed.withColumn("arrival_time", F.current_timestamp())
    return (untimed.withWatermark("arrival_time", UNTIMED_DELAY)
            .dropDuplicatesWithinWatermark(P.EVENT_KEY).select(*P.EVENT_KEY))


def start_corrupt(values: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Payloads that do not decode, kept aside."""
    return _append(RD.corrupt_events(values), path, checkpoint, trigger)


def start_bronze(values: DataFrame, path: str, checkpoint: str,
                 trigger: str | None = None) -> StreamingQuery:
    """Decode the JSON once into typed Parquet partitioned by day (bronze).

    Every view can then stream from the bronze folder (``bronze_events``):
    JSON is parsed once instead of once per view, and each view reads only
    the columns it uses.  Append-only and exactly once like the posts sink.
    """
    from ..operators.stats import observe_ingest
    # ingest statistics (events, payload bytes) per micro-batch in the query
    # progress: lastProgress["observedMetrics"]["ingest"]
    ev = (RD.with_event_time(RD.decode_events(observe_ingest(values)))
            .withColumn("event_date", F.to_date("event_time")))
    w = (ev.writeStream.outputMode("append").format("parquet")
           .option("path", path).option("checkpointLocation", checkpoint)
           .partitionBy("event_date"))
    return _trigger(w, trigger).start()


def bronze_events(spark: SparkSession, path: str, max_files: int | None = None,
                  watermark: bool = True) -> DataFrame:
    """Stream of decoded events from the bronze folder, with the watermark."""
    from pyspark.sql import types as T

    from ..schema import RAW_SCHEMA
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField("event_time", T.TimestampType()),
                                               T.StructField("event_date", T.DateType())])
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    ev = reader.parquet(path)
    return RD.with_watermark(ev) if watermark else ev


def start_view(name: str, events: DataFrame, out_path: str, checkpoint: str,
               trigger: str | None = None, mode: str = "update") -> tuple[StreamingQuery, UpdateSink | None]:
    """Start one view.  ``update``: UpdateSink at out_path; ``append``: closed
    windows appended to Parquet at out_path."""
    view = VIEWS[name]
    df = view.build(events)
    if mode == "update":
        sink = UpdateSink(out_path, list(view.keys))
        return sink.start(df, checkpoint, trigger), sink
    if mode == "append":
        w = (df.writeStream.outputMode("append").format("parquet")
               .option("path", out_path).option("checkpointLocation", checkpoint))
        return _trigger(w, trigger).start(), None
    raise ValueError(f"unknown output mode {mode!r}")


def start_posts_flat(events: DataFrame, out_path: str, checkpoint: str,
                     trigger: str | None = "60 seconds", table: str | None = None) -> StreamingQuery:
    """posts_flat -> append-only landed-table sink (about one commit a minute)."""
    return sink_posts(P.posts_flat(events), out_path, checkpoint, trigger, table=table)


SPIKE_KEYS = ["minute_bucket", "lang"]
SPIKE_PARTITIONS = 16   #: languages are few, and each state partition costs a Python worker per micro-batch


def start_spikes(events: DataFrame, out_path: str, checkpoint: str,
                 trigger: str | None = None) -> tuple[StreamingQuery, UpdateSink]:
    """The spike view from keyed state, on update."""
    sink, spark, key = UpdateSink(out_path, SPIKE_KEYS), events.sparkSession, "spark.sql.shuffle.partitions"
    with settings(spark, {key: str(min(SPIKE_PARTITIONS, int(spark.conf.get(key))))}):
        return sink.start(spike_stream(events), checkpoint, trigger), sink


# --- the self-join form of the spike view (append mode) ---------------------

RATE_SCHEMA = "minute_bucket timestamp, lang string, posts_in_minute long"
JOIN_DELAY = "2 minutes"


def spikes_interval_join(a: DataFrame, b: DataFrame, delay: str = JOIN_DELAY) -> DataFrame:
    """Stream-stream inner self-join of closed per-minute rates, then the
    trailing-hour aggregate, in append mode.

    ``a`` and ``b`` must come from two separate ``readStream`` calls (reusing
    one streaming DataFrame on both sides is not a self-join in Spark).  The
    time-range condition lets Spark drop join state older than an hour plus
    the watermark delay; a minute's row is emitted once the watermark passes
    it, so the newest hour is held back (append semantics).
    """
    a = a.withWatermark("minute_bucket", delay)
    b = (b.withWatermark("minute_bucket", delay)
          .select(F.col("lang").alias("b_lang"), F.col("minute_bucket").alias("b_minute"),
                  F.col("posts_in_minute").alias("b_posts")))
    hour = F.expr(f"INTERVAL {K.LOOKBACK_MIN} MINUTES")
    minute = F.expr("INTERVAL 1 MINUTE")
    joined = a.join(b, (a["lang"] == b["b_lang"])
                    & (b["b_minute"] >= a["minute_bucket"] - hour)
                    & (b["b_minute"] <= a["minute_bucket"] - minute), "inner")
    stats = (joined.groupBy("minute_bucket", "lang", "posts_in_minute")
                   .agg(F.sum("b_posts").alias("hr_sum"), F.count(F.lit(1)).alias("hr_cnt")))
    return K._finish(stats)


def start_spike_join_pipeline(events: DataFrame, rate_path: str, spike_path: str,
                              rate_checkpoint: str, spike_checkpoint: str,
                              trigger: str | None = None) -> tuple[StreamingQuery, callable]:
    """Query 1: lang_post_rate_1m in append mode (closed minutes) -> Parquet.
    Returns it and a starter for query 2, which reads that folder twice and
    appends the joined spike rows to ``spike_path``."""
    q1 = start_view("lang_post_rate_1m", events, rate_path, rate_checkpoint, trigger, mode="append")[0]

    def start_second() -> StreamingQuery:
        spark = events.sparkSession
        a = spark.readStream.schema(RATE_SCHEMA).parquet(rate_path)
        b = spark.readStream.schema(RATE_SCHEMA).parquet(rate_path)
        w = (spikes_interval_join(a, b).writeStream.outputMode("append").format("parquet")
               .option("path", spike_path).option("checkpointLocation", spike_checkpoint))
        return _trigger(w, trigger).start()

    return q1, start_second
