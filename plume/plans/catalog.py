"""Query catalogue: name -> builder(spark, sf_dir) -> DataFrame.

Every builder reads the driver tables through the fixture adapter, so its
work grows with them.  Clock choice: the landed table and the marts use the
table's own timestamps (``slow``); the streaming views use the squeezed
``fast`` clock so that minute and hour windows see real traffic.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import hashtags as H
from ..operators import lateness as L
from ..operators import marts as M
from ..operators import posts as P
from ..operators import quality as Q
from ..operators import rates as R
from ..operators import reconcile as X
from ..operators import serving as V
from ..operators import spikes as K
from ..operators import stats as ST
from ..session import prepare, scratch_path
from ..sources import fixtures as FX
from ..sources import readers as RD
from ..streaming import sinks as SK

Builder = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf_dir: str, clock: str = "slow", with_documents: bool = True) -> DataFrame:
    prepare(spark)
    return FX.raw_events(spark, sf_dir, clock, with_documents)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.posts_flat(raw(spark, sf_dir, "slow"))


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.stg_posts(posts(spark, sf_dir))


def fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RD.with_event_time(raw(spark, sf_dir, "fast"))


def fast_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events for queries that use neither text nor language."""
    return RD.with_event_time(raw(spark, sf_dir, "fast", with_documents=False))


def as_of_newest(raw_df: DataFrame):
    """now() for the fixture: the newest event time (scalar subquery)."""
    return raw_df.select(F.max(C.event_time_micros("time_us"))).scalar()


def _counts(spark, sf_dir):
    return X.marker_counts(posts(spark, sf_dir))


def _rec(spark, sf_dir):
    return X.reconcile(FX.expected_markers(spark, sf_dir), _counts(spark, sf_dir))


def _dq_checks(spark, sf_dir):
    """Every model once: staging in one pass, the marts from their own aggregates."""
    s = stg(spark, sf_dir)
    dim = M.dim_languages(s)
    return (Q.checks(s, "stg_posts", ["did", "text", "event_time"], [("text_length", "<= 200")])
            .unionByName(Q.checks(M.fct_posts_hourly(s), "fct_posts_hourly", ["hour_bucket"], [("post_count", ">= 0")]))
            .unionByName(Q.not_null(dim, "dim_languages", ["lang_code"]))
            .unionByName(Q.unique(dim, "dim_languages", "lang_code"))
            .unionByName(Q.unique(s, "stg_posts", "did")))


def _dq_unique(spark, sf_dir):
    s = stg(spark, sf_dir)
    return Q.unique(M.dim_languages(s), "dim_languages", "lang_code").unionByName(Q.unique(s, "stg_posts", "did"))


def _dq_expression(spark, sf_dir):
    s = stg(spark, sf_dir)
    return (Q.expression_is_true(M.fct_posts_hourly(s), "fct_posts_hourly", "post_count", ">= 0")
            .unionByName(Q.expression_is_true(s, "stg_posts", "text_length", "<= 200")))


def _dq_not_null(spark, sf_dir):
    s = stg(spark, sf_dir)
    return (Q.not_null(s, "stg_posts", ["did", "text", "event_time"])
            .unionByName(Q.not_null(M.fct_posts_hourly(s), "fct_posts_hourly", ["hour_bucket"]))
            .unionByName(Q.not_null(M.dim_languages(s), "dim_languages", ["lang_code"])))


def _fct_incremental(spark, sf_dir):
    """Full mart = (mart built before the middle day) + (incremental from it)."""
    s = stg(spark, sf_dir)
    bounds = s.agg(F.min("event_time"), F.max("event_time")).first()   # two scalars
    since = (bounds[0] + (bounds[1] - bounds[0]) / 2).date()
    # posts without a time form the oldest row of their language
    old = F.col("event_time").isNull() | (F.col("event_time") < F.lit(str(since)).cast("timestamp"))
    before = M.fct_posts_hourly(s.filter(old))
    return before.unionByName(M.fct_posts_hourly_incremental(s, before, since))


def _dim_incremental(spark, sf_dir):
    """dim_languages from per-day user state built in two separate halves."""
    s = stg(spark, sf_dir)
    bounds = s.agg(F.min("event_time"), F.max("event_time")).first()   # two scalars
    since = F.lit(str((bounds[0] + (bounds[1] - bounds[0]) / 2).date())).cast("timestamp")
    days = (M.lang_user_days(s.filter(F.col("event_time").isNull() | (F.col("event_time") < since)))
             .unionByName(M.lang_user_days(s.filter(F.col("event_time") >= since))))
    return M.dim_from_user_days(days)


def _roundtrip(spark, sf_dir):
    r = raw(spark, sf_dir, "slow")
    sent = r.select(C.once(F.to_json(F.struct(*r.columns), {"ignoreNullFields": "false"})).alias("value"))
    received = RD.decode_events(sent)
    kept = received.filter(~F.col("commit.operation").eqNullSafe("delete"))
    prints = X.held_fingerprint(r)     # both comparisons are with the same rows
    return (X.same_multiset(r, received, prints_a=prints).select(F.lit("intact").alias("side"), "*")
            .unionByName(X.same_multiset(r, kept, prints_a=prints).select(F.lit("without deletes").alias("side"), "*")))


def _dedupe(spark, sf_dir):
    return P.dedupe_posts(raw(spark, sf_dir, "slow", with_documents=False)).select(*P.EVENT_KEY)


def _report_deduped(spark, sf_dir):
    once = P.posts_flat(P.dedupe_posts(raw(spark, sf_dir, "slow", with_documents=False)))
    return X.reconcile_report(X.reconcile(FX.expected_markers(spark, sf_dir, lost=False), X.marker_counts(once)))


def _volume(spark, sf_dir):
    r = fast(spark, sf_dir)
    as_of = as_of_newest(fast_times(spark, sf_dir))
    return V.pivot_rows(V.volume_last_30m(R.posts_per_minute_by_lang(r), as_of), "minute", "post_count")


def _age(spark, sf_dir):
    r = fast_times(spark, sf_dir)
    return L.event_age_hist(r, as_of_newest(r))


def _newest_tags(spark, sf_dir):
    return H.trending_hashtags_5m(H.newest_bucket_events(fast(spark, sf_dir)))


def _row_counts(spark, sf_dir):
    r = fast(spark, sf_dir)
    rate = R.lang_post_rate_1m(r)
    return Q.row_counts({
        "posts_flat": P.posts_flat(r),
        "posts_per_minute_by_lang": R.posts_per_minute_by_lang(r),
        "posts_per_second": R.posts_per_second(fast_times(spark, sf_dir)),
        "lang_post_rate_1m": rate,
        "lang_spike_detector": K.lang_spike_detector(rate),
        "trending_hashtags_5m": H.trending_hashtags_5m(r),
    })


def _recent(spark, sf_dir):
    """Freshness as seen 0, 30 and 31 seconds after the newest event."""
    r = fast_times(spark, sf_dir)
    out = None
    for after in (0, 30, 31):
        as_of = as_of_newest(r) + F.make_dt_interval(secs=F.lit(after))
        row = Q.recent_events(r, as_of).select(F.lit(after).alias("seconds_after"), "newest_event", "passed")
        out = row if out is None else out.unionByName(row)
    return out


def _topic_offsets(spark, sf_dir):
    """The topic as its events would be dealt to four partitions."""
    prepare(spark)
    id_ = F.col("event_id")
    ev = FX.table(spark, sf_dir, "events").select("event_id")
    ev = ev.unionByName(ev.filter(id_ % FX.REPLAY_MOD == FX.REPLAY_REM))
    return Q.topic_offsets(ev.select((id_ % 4).alias("partition"), C.floor_div(id_, 4).alias("offset")))


def _fault_log(spark, sf_dir):
    """A fault log made of the events, errors as scenario starts."""
    ev = FX.table(spark, sf_dir, "events")
    event = F.when(F.col("event_type") == "error", F.lit("scenario_start")).otherwise(F.col("event_type"))
    return ev.select(
        F.date_format(F.col("ts").cast("timestamp"), FX.ISO_FORMAT).alias("ts"), event.alias("event"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"))


def _fault_summary(spark, sf_dir):
    """Scenario starts of a fault log made of the error events."""
    prepare(spark)
    return X.fault_summary(_fault_log(spark, sf_dir))


def _dim_sketch(spark, sf_dir):
    """Users per language from day sketches that are written and read back, against the exact number."""
    s = stg(spark, sf_dir)
    out = scratch_path(spark, "lang-day-sketches") + "/t"
    M.lang_day_sketches(s).write.partitionBy("event_date").parquet(out)
    return M.users_within_bound(M.dim_from_sketches(spark.read.parquet(out)), M.dim_languages(s), M.HLL_BOUND)


def _dim_approx(spark, sf_dir):
    """HyperLogLog++ users per language against the exact number."""
    s = stg(spark, sf_dir)
    return M.users_within_bound(M.dim_languages(s, approx=True), M.dim_languages(s), 3 * M.APPROX_RSD)


def _tag_sketches(spark, sf_dir):
    """Top tags per hop window from merged pane sketches, against the exact counts."""
    r = fast(spark, sf_dir)
    return H.sketch_agrees(H.top_from_sketches(H.tag_sketches(r)), H.trending_hashtags_1h_hop(r))


def _sink_files(spark, sf_dir):
    """Files and rows of a sink written with a fixed number of files.

    The eight parts are dealt before the documents are attached: a task reads
    its events and documents, not an eighth of all whole posts.
    """
    prepare(spark)
    out = scratch_path(spark, "sink-files") + "/t"
    P.posts_flat(FX.raw_events(spark, sf_dir, "slow", parts=8)).write.parquet(out)
    return Q.sink_file_count(RD.scan_posts(spark, out)).select("parquet_file_count", "rows")


def _posts_table(spark, sf_dir):
    """The landed table by its catalogue name: created, filled, scanned."""
    prepare(spark)
    name = f"default.plume_posts_{uuid.uuid4().hex[:12]}"
    SK.ensure_posts_table(spark, name, scratch_path(spark, "posts-table"))
    posts(spark, sf_dir).write.insertInto(name)
    return RD.scan_posts(spark, name)


def _materialized(spark, sf_dir):
    """The language mart as a table over the staging view."""
    name = f"plume_{uuid.uuid4().hex[:12]}"
    staging = SK.materialize(stg(spark, sf_dir), f"{name}_stg", "view")
    return SK.materialize(M.dim_languages(staging), f"{name}_dim", "table", scratch_path(spark, "mart-table") + "/t")


def _expected_file(spark, sf_dir):
    """The ground-truth file: ids of landed markers written one a line, read back as a set."""
    out = scratch_path(spark, "expected-file") + "/t"
    SK.write_expected(X.expected_from_landed(posts(spark, sf_dir)), out)
    return RD.read_expected(spark, out)


def _fault_log_file(spark, sf_dir):
    """Scenario starts read from a fault log file of JSON lines with blank ones between."""
    prepare(spark)
    out = scratch_path(spark, "fault-log") + "/t"
    line = F.to_json(F.struct(*_fault_log(spark, sf_dir).columns))
    _fault_log(spark, sf_dir).select(F.concat(line, F.lit("\n")).alias("value")).write.text(out)
    return X.fault_summary(RD.read_fault_log(spark, out))


def _made_markers(spark, sf_dir):
    """As many marker events as there are signups, through the decoder and the flattening."""
    prepare(spark)
    n = FX.table(spark, sf_dir, "events").filter(F.col("event_type") == "signup").count()
    made = X.make_markers(spark, n)
    sent = made.select(F.to_json(F.struct(*made.columns)).alias("value"))
    return P.posts_flat(RD.decode_events(sent))


def _lateness_csv(spark, sf_dir):
    """The event-age histogram written as CSV and read back."""
    out = scratch_path(spark, "event-age-csv") + "/csv"
    L.write_lateness_csv(_age(spark, sf_dir), out)
    return spark.read.schema("lateness_seconds int, event_count long").csv(out, header=True)


BATCH: dict[str, Builder] = {
    "expected_from_landed": lambda s, d: X.expected_from_landed(posts(s, d)),
    "topic_offsets": _topic_offsets,
    "fault_summary": _fault_summary,
    "lateness_csv": _lateness_csv,
    "event_age_series": lambda s, d: V.ordered_series(_age(s, d), "lateness_seconds"),
    "dim_languages_approx": _dim_approx,
    "dim_languages_sketch": _dim_sketch,
    "sink_file_count": _sink_files,
    "posts_table_scan": _posts_table,
    "materialized_mart": _materialized,
    "expected_file": _expected_file,
    "fault_log_file": _fault_log_file,
    "made_markers": _made_markers,
    "top_hashtags_sketch": _tag_sketches,
    # landed table and marts
    "posts_flat": posts,
    "stg_posts": stg,
    "fct_posts_hourly": lambda s, d: M.fct_posts_hourly(stg(s, d)),
    "fct_posts_hourly_sliced": lambda s, d: M.fct_posts_hourly(stg(s, d), "day"),
    "dim_languages": lambda s, d: M.dim_languages(stg(s, d)),
    "fct_posts_hourly_incremental": _fct_incremental,
    "dim_languages_incremental": _dim_incremental,
    "history_hourly": lambda s, d: M.history_hourly(posts(s, d)),
    "history_kpis": lambda s, d: M.history_kpis(M.history_hourly(posts(s, d))),
    "history_pivot": lambda s, d: V.pivot_rows(
        M.history_pivot(M.history_hourly(posts(s, d))), "hour", "posts"),
    "top_languages": lambda s, d: V.top_languages(M.history_hourly(posts(s, d)), "posts"),
    "total_posts": lambda s, d: V.total_posts(P.posts_flat(raw(s, d, "slow", with_documents=False))),
    "marker_counts": _counts,
    "duplicate_markers": lambda s, d: X.duplicate_markers(_counts(s, d)),
    "missing_markers": lambda s, d: X.missing_markers(FX.expected_markers(s, d), _counts(s, d)),
    "unexpected_markers": lambda s, d: X.unexpected_markers(FX.expected_markers(s, d),
                                                            _counts(s, d)),
    "marker_reconcile": _rec,
    "reconcile_report": lambda s, d: X.reconcile_report(_rec(s, d)),
    "reconcile_report_deduped": _report_deduped,
    "first_unexpected": lambda s, d: X.first_anomalies(_rec(s, d), "unexpected"),
    "dq_checks": _dq_checks,
    "dq_not_null": _dq_not_null,
    "dq_unique": _dq_unique,
    "dq_expression": _dq_expression,
    "dedupe_posts": _dedupe,
    "sample_events": lambda s, d: RD.sample_events(raw(s, d, "slow")),
    "roundtrip_multiset": _roundtrip,
    # streaming views and serving queries
    "posts_per_minute_by_lang": lambda s, d: R.posts_per_minute_by_lang(fast(s, d)),
    "posts_per_second": lambda s, d: R.posts_per_second(fast_times(s, d)),
    "lang_post_rate_1m": lambda s, d: R.lang_post_rate_1m(fast(s, d)),
    "lang_spike_detector": lambda s, d: K.lang_spike_detector(R.lang_post_rate_1m(fast(s, d))),
    "top_spikes": lambda s, d: K.top_spikes(R.lang_post_rate_1m(fast(s, d))),
    "active_spikes": lambda s, d: K.active_spikes(
        K.lang_spike_detector(R.lang_post_rate_1m(fast(s, d)))),
    "hashtag_events": lambda s, d: H.hashtag_events(fast(s, d)),
    "trending_hashtags_5m": lambda s, d: H.trending_hashtags_5m(fast(s, d)),
    "trending_hashtags_1h_hop": lambda s, d: H.trending_hashtags_1h_hop(fast(s, d)),
    "top_hashtags_latest": lambda s, d: H.top_tags(_newest_tags(s, d), "bucket_start", 20),
    "top_hop_latest": lambda s, d: H.top_tags(H.newest_hop(fast(s, d)), "window_start", 15),
    "latest_hashtag_card": lambda s, d: H.tag_card(H.top_tags(_newest_tags(s, d), "bucket_start", 20)),
    "current_rate": lambda s, d: R.current_rate(R.posts_per_second(fast_times(s, d))),
    "active_languages": lambda s, d: V.active_languages(R.posts_per_minute_by_lang(fast(s, d))),
    "volume_last_30m": _volume,
    "event_age_hist": _age,
    "lateness_percentiles": lambda s, d: L.lateness_percentiles(_age(s, d)),
    "recent_events": _recent,
    "row_counts": _row_counts,
    "ingest_stats": lambda s, d: ST.ingest_stats(FX.raw_json(s, d, "slow")),
    "land_raw": lambda s, d: RD.land_raw(FX.raw_json(s, d, "slow")).select("value"),
    "top_language_rows": lambda s, d: V.restrict_to_top(M.history_hourly(posts(s, d)), "posts"),
    "history_display": lambda s, d: V.for_display(M.history_hourly(posts(s, d)), "history"),
    "top_hashtags_display": lambda s, d: V.for_display(
        H.top_tags(_newest_tags(s, d), "bucket_start", 20), "hashtags"),
    "spiking_minutes": lambda s, d: K.spiking_only(
        K.lang_spike_detector(R.lang_post_rate_1m(fast(s, d)))),
}
