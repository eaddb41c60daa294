"""Streaming twins of the views for ``queries()``.

Each twin writes the fixture's raw events as compressed JSON-lines files under
the session's checkpoint folder, runs the *streaming* query over them
(``availableNow``) into a fresh sink there, and returns the sink read back
as a batch DataFrame.  The fixture is read in one micro-batch, or in slices of
time one after another, so no row is behind the watermark: each twin must equal
its batch oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import hashtags as H
from ..operators import marts as M
from ..operators import posts as P
from ..operators import rates as R
from ..operators import reconcile as X
from ..operators import stats as ST
from ..session import prepare, scratch_path, settings
from ..sources import fixtures as FX
from ..sources import readers as RD
from ..streaming.restart import land_with_kill, land_with_restart
from ..streaming.sinks import UpdateSink
from ..streaming.views import (_append, dedupe_untimed, event_stream, start_landing, start_posts_flat,
                               start_spike_join_pipeline, start_spikes, start_view)

_SOURCES: dict[tuple, str] = {}
TIMEOUT_S = 600
SLICES = 8   #: micro-batches of the twins that carry state across batches


def _files(spark: SparkSession) -> int:
    """Files of a source folder: as many as shuffle partitions, eight at least."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_json(values: DataFrame, path: str) -> None:
    """Append events to a folder of JSON-lines files, compressed; the text reader unpacks them."""
    values.select("value").write.mode("append").option("compression", "gzip").text(path)


def json_source(spark: SparkSession, sf_dir: str, clock: str, files: int | None = None) -> str:
    """Folder of JSON-lines files holding the fixture's raw events, written
    once per (application, tables, clock, number of files).  Whole events are
    not shuffled: the files are in no order of time."""
    files = files or _files(spark)
    key = (spark.sparkContext.applicationId, sf_dir, clock, files)
    if key not in _SOURCES:
        path = scratch_path(spark, f"raw-json-{clock}")
        write_json(FX.raw_json(spark, sf_dir, clock, parts=files), path)
        _SOURCES[key] = path
    return _SOURCES[key]


def time_slices(spark: SparkSession, sf_dir: str, clock: str, n: int = SLICES) -> list[Column]:
    """Conditions on ``time_us`` that part the events into at most n slices of about equal size,
    earliest first; events without a time are in the first."""
    t = F.col("time_us")
    cuts = FX.raw_events(spark, sf_dir, clock, with_documents=False).agg(
        F.percentile_approx(t, [k / n for k in range(1, n)]).alias("cuts")).first().cuts   # n - 1 numbers
    bounds = sorted(set(cuts or []))
    if not bounds:
        return [F.lit(True)]
    return [t.isNull() | (t < bounds[0]), *[(t >= lo) & (t < hi) for lo, hi in zip(bounds, bounds[1:])], t >= bounds[-1]]


def ordered_json_source(spark: SparkSession, sf_dir: str, clock: str, files: int = SLICES) -> str:
    """The same events, a file per time slice, each written by its own job, one after
    another: the file source replays files by modification time, so arrival order
    equals time order across micro-batches of one file.  For small tables (a file is
    one task); ``replay`` reads slices of any size."""
    key = ("ordered", spark.sparkContext.applicationId, sf_dir, clock, files)
    if key not in _SOURCES:
        path = scratch_path(spark, f"raw-json-ordered-{clock}")
        for part in time_slices(spark, sf_dir, clock, files):
            write_json(FX.raw_json(spark, sf_dir, clock).filter(part).coalesce(1), path)
        _SOURCES[key] = path
    return _SOURCES[key]


def _events(spark: SparkSession, sf_dir: str, clock: str) -> DataFrame:
    return event_stream(RD.read_raw_stream(spark, fmt="files",
                                           path=json_source(spark, sf_dir, clock)))


def _await(q) -> None:
    q.awaitTermination(TIMEOUT_S)
    if q.isActive:
        q.stop()
        raise TimeoutError("streaming twin did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_view(name: str, clock: str = "fast"):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        ev = _events(spark, sf_dir, clock)
        q, sink = start_view(name, ev, scratch_path(spark, f"view-{name}"),
                             scratch_path(spark, f"ckpt-{name}"), trigger="availableNow")
        _await(q)
        return sink.read(spark)
    return build


def stream_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts per minute and language, and the posts without a time from the view of their own."""
    return stream_view("posts_per_minute_by_lang")(spark, sf_dir).unionByName(
        stream_view("untimed_posts_by_lang")(spark, sf_dir))


def replay(spark: SparkSession, sf_dir: str, clock: str, parts: list[Column],
           start: Callable[[DataFrame], tuple[StreamingQuery, UpdateSink]]) -> UpdateSink:
    """Run a view over parts of the events, each of them one micro-batch however many files it has.

    A part is written as a folder's new files, then the query goes on from its
    checkpoint and reads them all; the next part is written after that.  As in a
    run without stops, the batch without data that closes windows comes last only.
    The documents are shuffled once, whatever the number of parts.
    """
    path, files = scratch_path(spark, f"raw-json-parts-{clock}"), min(_files(spark), FX.MAX_BUCKETS)
    docs = FX.dealt_documents(spark, sf_dir, files)
    sink = None
    for k, part in enumerate(parts, 1):
        write_json(FX.raw_json(spark, sf_dir, clock, parts=files, docs=docs).filter(part), path)
        with settings(spark, {"spark.sql.streaming.noDataMicroBatches.enabled": str(k == len(parts)).lower()}):
            q, sink = start(event_stream(RD.read_raw_stream(spark, fmt="files", path=path)))
            _await(q)
    return sink


def stream_view_batches(name: str):
    """The view over 8 micro-batches (a time slice each): state carried across
    batches, upserts of the same keys in later batches."""
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        out, checkpoint = scratch_path(spark, f"viewb-{name}"), scratch_path(spark, f"ckptb-{name}")
        return replay(spark, sf_dir, "fast", time_slices(spark, sf_dir, "fast"),
                      lambda ev: start_view(name, ev, out, checkpoint, trigger="availableNow")).read(spark)
    return build


SPIKE_COLUMNS = ["minute_bucket", "lang", "posts_in_minute", "rolling_hr_avg", "is_spiking"]


def stream_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spike view from keyed state."""
    prepare(spark)
    q, sink = start_spikes(_events(spark, sf_dir, "fast"), scratch_path(spark, "spikes"),
                           scratch_path(spark, "ckpt-spikes"), trigger="availableNow")
    _await(q)
    return sink.read(spark).select(*SPIKE_COLUMNS)


def stream_spikes_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over 8 micro-batches: counts carried in the state, rows of earlier minutes emitted again."""
    prepare(spark)
    out, checkpoint = scratch_path(spark, "spikes"), scratch_path(spark, "ckpt-spikes")
    sink = replay(spark, sf_dir, "fast", time_slices(spark, sf_dir, "fast"),
                  lambda ev: start_spikes(ev, out, checkpoint, trigger="availableNow"))
    return sink.read(spark).select(*SPIKE_COLUMNS)


def stream_posts_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    ev = _events(spark, sf_dir, "slow")
    out = scratch_path(spark, "posts")
    q = start_posts_flat(ev, out, scratch_path(spark, "ckpt-posts"), trigger="availableNow")
    _await(q)
    return RD.scan_posts(spark, out)


def stream_land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads landed unchanged by the raw landing stream."""
    prepare(spark)
    values = RD.read_raw_stream(spark, fmt="files", path=json_source(spark, sf_dir, "slow"))
    out = scratch_path(spark, "raw")
    _await(start_landing(values, out, scratch_path(spark, "ckpt-raw"), trigger="availableNow"))
    return spark.read.parquet(out).select("value")


def stream_dedupe_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replays dropped in the stream, one row per delivery: timed events within
    the watermark, those without a time by their own query."""
    prepare(spark)

    def events():
        return event_stream(RD.read_raw_stream(spark, fmt="files", path=json_source(spark, sf_dir, "slow")))
    timed, untimed = scratch_path(spark, "deduped"), scratch_path(spark, "deduped-untimed")
    once = P.dedupe_posts(events().filter(F.col("event_time").isNotNull())).select(*P.EVENT_KEY)
    _await(_append(once, timed, scratch_path(spark, "ckpt-deduped"), "availableNow"))
    _await(_append(dedupe_untimed(event_stream(RD.read_raw_stream(
        spark, fmt="files", path=json_source(spark, sf_dir, "slow")), watermark=False)), untimed,
        scratch_path(spark, "ckpt-untimed"), "availableNow"))
    return spark.read.parquet(timed).unionByName(spark.read.parquet(untimed))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts per second when the oldest quarter of the events arrives once more, late.

    The events come in two micro-batches by time, the late copies in a third:
    Spark drops rows behind the watermark that the batch before the last one
    left, so the copies add nothing.
    """
    prepare(spark)
    events = FX.raw_events(spark, sf_dir, "fast", with_documents=False)
    lo, hi = events.agg(F.min("time_us"), F.max("time_us")).first()   # two numbers
    if lo is None:
        lo = hi = 0
    middle, quarter = (lo + hi) // 2, (3 * lo + hi) // 4
    t = F.col("time_us")
    out, checkpoint = scratch_path(spark, "view-late"), scratch_path(spark, "ckpt-late")
    return replay(spark, sf_dir, "fast", [t < middle, t.isNull() | (t >= middle), t < quarter],
                  lambda ev: start_view("posts_per_second", ev, out, checkpoint, trigger="availableNow")).read(spark)


JOIN_HOLDBACK = "INTERVAL 70 MINUTES"   #: the join's hour, its watermark delay and the rates' own, rounded up


def stream_spikes_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The literal self-join of two streams of closed minutes, in append mode.

    Append mode holds back what is not final, so the answer is the minutes that
    are ``JOIN_HOLDBACK`` older than the newest one.
    """
    prepare(spark)
    rates, spikes = scratch_path(spark, "join-rates"), scratch_path(spark, "join-spikes")
    q, second = start_spike_join_pipeline(_events(spark, sf_dir, "fast"), rates, spikes, scratch_path(spark, "ckpt-join-1"),
                                          scratch_path(spark, "ckpt-join-2"), trigger="availableNow")
    _await(q)
    _await(second())
    newest = R.lang_post_rate_1m(RD.with_event_time(FX.raw_events(spark, sf_dir, "fast", with_documents=False))) \
        .select(F.max("minute_bucket")).scalar()
    return spark.read.parquet(spikes).filter(F.col("minute_bucket") <= newest - F.expr(JOIN_HOLDBACK))


def stream_top_hashtags_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top tags per hop window from sketches that the stream keeps up, against the exact counts."""
    panes = stream_view("tag_sketches")(spark, sf_dir)
    exact = H.trending_hashtags_1h_hop(RD.with_event_time(FX.raw_events(spark, sf_dir, "fast")))
    return H.sketch_agrees(H.top_from_sketches(panes), exact)


def stream_dim_languages_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users per language from day sketches that the stream keeps up, against the exact number of timed posts."""
    days = stream_view("lang_day_sketches", "slow")(spark, sf_dir)
    posts = P.posts_flat(FX.raw_events(spark, sf_dir, "slow")).filter(F.col("time_us").isNotNull())
    return M.users_within_bound(M.dim_from_sketches(days), M.dim_languages(P.stg_posts(posts)), M.HLL_BOUND)


def stream_ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and payload bytes as the landing query itself observed them, summed over its micro-batches."""
    prepare(spark)
    values = RD.read_raw_stream(spark, fmt="files", path=json_source(spark, sf_dir, "slow"))
    q = _append(ST.observe_ingest(values), scratch_path(spark, "observed"), scratch_path(spark, "ckpt-observed"),
                "availableNow")
    _await(q)
    seen = [p["observedMetrics"]["ingest"] for p in q.recentProgress if p.get("observedMetrics")]
    return spark.createDataFrame([(sum(m["events"] or 0 for m in seen), sum(m["bytes"] or 0 for m in seen))],
                                 "events long, bytes long")


def stream_exactly_once_killed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the posts with the driver process killed in mid-batch, restart on its checkpoint, reconcile.

    ``left_files``: did the dead attempt leave files that the restart had to pass over?
    """
    prepare(spark)
    src = json_source(spark, sf_dir, "slow", files=max(32, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    landed, left = land_with_kill(spark, src, scratch_path(spark, "posts-killed"), scratch_path(spark, "ckpt-killed"),
                                  timeout_s=TIMEOUT_S)
    rec = X.reconcile(FX.expected_markers(spark, sf_dir), X.marker_counts(landed))
    return X.reconcile_report(rec).withColumn("left_files", F.lit(left > 0))


def stream_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the posts with three mid-stream stops and restarts, then reconcile."""
    prepare(spark)
    src = json_source(spark, sf_dir, "slow", files=max(32, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    landed = land_with_restart(spark, src, scratch_path(spark, "posts-restart"),
                               scratch_path(spark, "ckpt-restart"), files_per_batch=1,
                               stop_after_batches=1, timeout_s=TIMEOUT_S, stops=3)
    rec = X.reconcile(FX.expected_markers(spark, sf_dir), X.marker_counts(landed))
    return X.reconcile_report(rec)


STREAM = {
    "stream_land_raw": stream_land_raw,
    "stream_dedupe_posts": stream_dedupe_posts,
    "stream_late_rows": stream_late_rows,
    "stream_posts_flat": stream_posts_flat,
    "stream_posts_per_minute_by_lang": stream_per_minute,
    "stream_posts_per_second": stream_view("posts_per_second"),
    "stream_lang_post_rate_1m": stream_view("lang_post_rate_1m"),
    "stream_trending_hashtags_5m": stream_view("trending_hashtags_5m"),
    "stream_trending_hashtags_1h_hop": stream_view("trending_hashtags_1h_hop"),
    "stream_lang_spike_detector": stream_spikes,
    "stream_exactly_once": stream_exactly_once,
    "stream_exactly_once_killed": stream_exactly_once_killed,
    "stream_spikes_join": stream_spikes_join,
    "stream_top_hashtags_sketch": stream_top_hashtags_sketch,
    "stream_dim_languages_sketch": stream_dim_languages_sketch,
    "stream_ingest_stats": stream_ingest_stats,
    "stream_trending_hashtags_5m_batches": stream_view_batches("trending_hashtags_5m"),
    "stream_lang_spike_detector_batches": stream_spikes_batches,
}

# Stream twin -> batch oracle with the same answer (others have their own).
STREAM_ORACLE = {
    "stream_land_raw": "land_raw",
    "stream_dedupe_posts": "dedupe_posts",
    "stream_top_hashtags_sketch": "top_hashtags_sketch",
    "stream_late_rows": "posts_per_second",
    "stream_posts_flat": "posts_flat",
    "stream_posts_per_minute_by_lang": "posts_per_minute_by_lang",
    "stream_posts_per_second": "posts_per_second",
    "stream_lang_post_rate_1m": "lang_post_rate_1m",
    "stream_trending_hashtags_5m": "trending_hashtags_5m",
    "stream_trending_hashtags_1h_hop": "trending_hashtags_1h_hop",
    "stream_lang_spike_detector": "lang_spike_detector",
    "stream_exactly_once": "reconcile_report",
    "stream_trending_hashtags_5m_batches": "trending_hashtags_5m",
    "stream_lang_spike_detector_batches": "lang_spike_detector",
}
