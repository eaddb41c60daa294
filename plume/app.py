"""Command line: run the pipeline's jobs on a cluster or locally.

    python -m plume.app stream   --source files:/in --out /lake --checkpoint /ckpt
    python -m plume.app marts    --posts /lake/posts --out /lake/marts
    python -m plume.app verify   --expected ids.txt --posts /lake/posts [--fault-log log.jsonl]
    python -m plume.app dashboard --out /lake [--as-of ISO]
    python -m plume.app lateness --source files:/in --out /lake/event_age_csv [--as-of ISO]

``stream`` starts the posts sink, every view and the stacked spike view on one
raw stream and blocks; ``marts`` builds staging, fact and dimension, runs the
data tests after them and exits non-zero when one fails; ``verify`` prints
the reconciliation report and exits 1 on FAIL.  Only bounded results (one
report row, at most 10 sample ids per class, the percentile rows) reach the
driver.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import lateness as L
from .operators import marts as M
from .operators import posts as P
from .operators import quality as Q
from .operators import reconcile as X
from .schema import RAW_SCHEMA
from .session import build_session, prepare
from .sources import readers as RD
from .streaming import sinks as SK
from .streaming import views as V


def _raw_stream(spark: SparkSession, source: str, max_files: int | None = None,
                max_offsets: int | None = None, start: str | None = None,
                min_partitions: int | None = None) -> DataFrame:
    kind, _, where = source.partition(":")
    if kind == "kafka":
        servers, _, topic = where.partition("/")
        return RD.read_raw_stream(spark, fmt="kafka", max_offsets_per_trigger=max_offsets,
                                  starting_offsets=start or "latest", min_partitions=min_partitions,
                                  options={"kafka.bootstrap.servers": servers,
                                           "subscribe": topic or RD.KAFKA_TOPIC})
    return RD.read_raw_stream(spark, fmt="files", path=where, max_files_per_trigger=max_files)


def cmd_stream(spark: SparkSession, a) -> int:
    queries = []
    if a.land_raw:
        # the payload as received, before any decoding; undecodable events aside
        values = _raw_stream(spark, a.source, a.max_files, a.max_offsets, a.start, a.min_partitions)
        queries.append(V.start_landing(values, f"{a.out}/raw", f"{a.checkpoint}/raw", trigger=a.view_interval))
        queries.append(V.start_corrupt(values, f"{a.out}/corrupt", f"{a.checkpoint}/corrupt",
                                       trigger=a.view_interval))
    if a.bronze:
        from .operators.stats import IngestListener
        # running "events | events/s | MB" line every 1,000 events (fixed value)
        spark.streams.addListener(IngestListener(log_every=1000).listener)
        # parse JSON once; the views stream the typed, pruned bronze files
        queries.append(V.start_bronze(_raw_stream(spark, a.source, a.max_files, a.max_offsets, a.start, a.min_partitions),
                                      f"{a.out}/bronze", f"{a.checkpoint}/bronze",
                                      trigger=a.view_interval))
        if a.trigger_available_now:
            queries[0].awaitTermination()
        events = V.bronze_events(spark, f"{a.out}/bronze")
        if a.dedupe:
            events = P.dedupe_posts(events, streaming=True)
    else:
        events = V.event_stream(_raw_stream(spark, a.source, a.max_files, a.max_offsets, a.start, a.min_partitions),
                                dedupe=a.dedupe)
    queries.append(SK.sink_posts(P.posts_flat(events), f"{a.out}/posts", f"{a.checkpoint}/posts",
                                 trigger=a.commit_interval, partition_by_day=a.partition_by_day))
    for name in V.VIEWS:
        q, _ = V.start_view(name, events, f"{a.out}/{name}", f"{a.checkpoint}/{name}",
                            trigger=a.view_interval)
        queries.append(q)
    queries.append(V.start_spikes(events, f"{a.out}/lang_spike_detector", f"{a.checkpoint}/lang_spike_detector",
                                  trigger=a.view_interval)[0])
    if a.trigger_available_now:
        for q in queries:
            q.awaitTermination()
        return 0
    spark.streams.awaitAnyTermination()
    return 0


def cmd_marts(spark: SparkSession, a) -> int:
    posts = RD.scan_posts(spark, a.posts)
    stg = SK.materialize(P.stg_posts(posts), "stg_posts", "view")
    fct_path = f"{a.out}/fct_posts_hourly"
    if a.since:
        # Incremental: only days >= since are recomputed and overwritten.  The
        # previous mart's tail (<= 23 rows per language) alone is staged first,
        # so the job never reads the partitions it overwrites.
        from .session import scratch_path
        tail_path = scratch_path(spark, "fct-tail")
        prev = spark.read.parquet(fct_path).drop("event_date")
        M.previous_tail(prev, a.since).write.mode("overwrite").parquet(tail_path)
        fct = M.fct_posts_hourly_incremental(stg, spark.read.parquet(tail_path), a.since)
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    else:
        fct = M.fct_posts_hourly(stg)
    (fct.withColumn("event_date", F.to_date("hour_bucket"))
        .write.mode("overwrite").partitionBy("event_date").parquet(fct_path))
    # dim_languages from per-day user state: only the refreshed days are
    # rewritten; the distinct count stays exact
    days = M.on_or_after(stg, a.since) if a.since else stg
    (M.lang_user_days(days).write.mode("overwrite").partitionBy("event_date")
      .parquet(f"{a.out}/lang_user_days"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    dim = M.dim_from_user_days(spark.read.parquet(f"{a.out}/lang_user_days"))
    dim.write.mode("overwrite").parquet(f"{a.out}/dim_languages")
    fct_t = spark.read.parquet(fct_path)
    dim_t = spark.read.parquet(f"{a.out}/dim_languages")
    checks = (Q.not_null(stg, "stg_posts", ["did", "text", "event_time"])
              .unionByName(Q.not_null(fct_t, "fct_posts_hourly", ["hour_bucket"]))
              .unionByName(Q.expression_is_true(fct_t, "fct_posts_hourly", "post_count", ">= 0"))
              .unionByName(Q.not_null(dim_t, "dim_languages", ["lang_code"]))
              .unionByName(Q.unique(dim_t, "dim_languages", "lang_code")))
    rows = checks.collect()          # 7 rows
    for r in rows:
        print(json.dumps(r.asDict()))
    return 0 if all(r.passed for r in rows) else 1


def cmd_verify(spark: SparkSession, a) -> int:
    expected = RD.read_expected(spark, a.expected)
    rec = X.reconcile(expected, X.marker_counts(RD.scan_posts(spark, a.posts)))
    report = X.reconcile_report(rec).first().asDict()
    if a.fault_log:
        report["scenarios"] = [r.asDict() for r in
                               X.fault_summary(RD.read_fault_log(spark, a.fault_log)).collect()]
    for status in ("duplicate", "missing", "unexpected"):
        report[f"first_{status}"] = [r.marker_id for r in
                                     X.first_anomalies(rec, status).collect()]
    print(json.dumps(report, default=str))
    return 0 if report["verdict"] == "PASS" else 1


def dashboard_panels(spark: SparkSession, out: str, as_of=None) -> dict[str, DataFrame]:
    """Every dashboard figure, read from the sinks the ``stream`` job keeps
    (event -> streaming view -> serving query).  All are small frames."""
    from .operators import hashtags as H
    from .operators import rates as R
    from .operators import serving as S
    from .operators import spikes as K

    nothing = RD.with_event_time(spark.createDataFrame([], RAW_SCHEMA))

    def view(name: str) -> DataFrame:
        v = V.VIEWS[name]
        return SK.UpdateSink(f"{out}/{name}", list(v.keys)).read(spark, v.build(nothing).schema)

    posts = RD.scan_posts(spark, f"{out}/posts")
    ppm = view("posts_per_minute_by_lang").unionByName(view("untimed_posts_by_lang"))
    rates = view("lang_post_rate_1m")
    spikes = SK.UpdateSink(f"{out}/lang_spike_detector", V.SPIKE_KEYS).read(spark)
    t5 = view("trending_hashtags_5m")
    hist = M.history_hourly(posts)
    pps = view("posts_per_second")
    # now(): a given time, else the newest second seen by the stream
    now = (F.lit(as_of).cast("timestamp") if as_of
           else pps.select(F.max("second_bucket")).scalar())
    return {
        "current_rate": R.current_rate(pps),
        "total_posts": S.total_posts(posts),
        "active_languages": S.active_languages(ppm),
        "active_spikes": K.active_spikes(spikes),
        "volume_last_30m": S.volume_last_30m(ppm, now),
        "top_spikes": K.top_spikes(rates),
        "top_hashtags": H.top_hashtags_latest(t5),
        "hashtag_card": H.latest_hashtag_card(t5),
        "top_hop": H.top_hop_latest(view("trending_hashtags_1h_hop")),
        "history_kpis": M.history_kpis(hist),
        "history_pivot": M.history_pivot(hist),
    }


def cmd_dashboard(spark: SparkSession, a) -> int:
    from .operators import serving as S
    for name, df in dashboard_panels(spark, a.out, a.as_of).items():
        time_col = next((c for c in ("minute", "hour") if c in df.columns), None)
        if time_col:
            df = S.ordered_series(df, time_col)
        # a panel is printed whole or not at all
        rows = [r.asDict() for r in df.limit(a.max_rows + 1).collect()]
        if len(rows) > a.max_rows:
            raise SystemExit(f"panel {name} has more than {a.max_rows} rows; raise --max-rows")
        print(json.dumps({"panel": name, "rows": rows}, default=str))
    return 0


def cmd_lateness(spark: SparkSession, a) -> int:
    kind, _, where = a.source.partition(":")
    raw = RD.with_event_time(RD.decode_events(spark.read.text(where)))
    as_of = F.lit(a.as_of).cast("timestamp") if a.as_of else F.current_timestamp()
    hist = L.event_age_hist(raw, as_of)
    if a.out:
        L.write_lateness_csv(hist, a.out)
    for r in L.lateness_percentiles(hist).orderBy("percentile").collect():
        print(json.dumps(r.asDict()))
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="plume")
    ap.add_argument("--master", default=None)
    ap.add_argument("--input-bytes", type=int, default=None,
                    help="size the shuffle and scan partitions for this much input")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--source", required=True, help="files:/dir or kafka:host:port/topic")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--commit-interval", default=SK.COMMIT_INTERVAL)
    s.add_argument("--view-interval", default="5 seconds")
    s.add_argument("--start", default=None, help="kafka: earliest, latest or a JSON of offsets")
    s.add_argument("--min-partitions", type=int, default=None, help="kafka: least read partitions")
    s.add_argument("--max-files", type=int, default=None)
    s.add_argument("--max-offsets", type=int, default=None)
    s.add_argument("--land-raw", action="store_true", help="also land payloads unchanged, corrupt ones aside")
    s.add_argument("--bronze", action="store_true", help="decode JSON once into typed Parquet")
    s.add_argument("--partition-by-day", action="store_true")
    s.add_argument("--dedupe", action="store_true")
    s.add_argument("--trigger-available-now", action="store_true")
    m = sub.add_parser("marts")
    m.add_argument("--posts", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--since", default=None, help="YYYY-MM-DD: refresh only days >= since")
    v = sub.add_parser("verify")
    v.add_argument("--expected", required=True)
    v.add_argument("--posts", required=True)
    v.add_argument("--fault-log", default=None)
    d = sub.add_parser("dashboard")
    d.add_argument("--out", required=True, help="the --out folder of the stream job")
    d.add_argument("--as-of", default=None)
    d.add_argument("--max-rows", type=int, default=100_000, help="fail above this many rows of a panel")
    lt = sub.add_parser("lateness")
    lt.add_argument("--source", required=True, help="files:/dir of raw JSON events")
    lt.add_argument("--out", default=None)
    lt.add_argument("--as-of", default=None)
    a = ap.parse_args(argv)
    if a.cmd == "stream" and a.trigger_available_now:
        a.commit_interval = a.view_interval = "availableNow"
    spark = prepare(build_session(a.master, app=f"plume-{a.cmd}"))
    if a.input_bytes and a.cmd != "stream":  # a stream's partition count is fixed by its checkpoint
        from .session import scale_conf
        for k, v in scale_conf(a.input_bytes).items():
            spark.conf.set(k, v)
    return {"stream": cmd_stream, "marts": cmd_marts, "verify": cmd_verify,
            "dashboard": cmd_dashboard, "lateness": cmd_lateness}[a.cmd](spark, a)


if __name__ == "__main__":
    sys.exit(main())
