"""The command line end to end: stream -> marts -> verify -> lateness."""
import json

import __spark_entry__ as E
from conftest import SF_SMALL
from plume import app
from plume.operators.serving import pivot_rows
from plume.plans.streams import json_source
from plume.session import scratch_path
from plume.sources import fixtures as FX
from plume.streaming.sinks import write_expected


def test_cli_pipeline(spark, capsys):
    src = json_source(spark, SF_SMALL, "slow")
    out, ck = scratch_path(spark, "app-out"), scratch_path(spark, "app-ck")
    assert app.main(["stream", "--source", f"files:{src}", "--out", out,
                     "--checkpoint", ck, "--trigger-available-now"]) == 0
    qs = E.queries()
    assert spark.read.parquet(f"{out}/posts").count() == qs["posts_flat"](spark, SF_SMALL).count()
    # the planted events without a time fail their not_null tests, and nothing else does
    capsys.readouterr()
    assert app.main(["marts", "--posts", f"{out}/posts", "--out", f"{out}/marts"]) == 1
    tests = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert {(t["model"], t["column"]) for t in tests if not t["passed"]} == {
        ("stg_posts", "event_time"), ("fct_posts_hourly", "hour_bucket")}
    full = spark.read.parquet(f"{out}/marts/fct_posts_hourly").drop("event_date")
    rows = qs["fct_posts_hourly"](spark, SF_SMALL).count()
    assert full.count() == rows
    copy = scratch_path(spark, "app-fct-full")
    full.write.mode("overwrite").parquet(copy)        # keep the full build before overwriting
    full = spark.read.parquet(copy)
    dim_copy = scratch_path(spark, "app-dim-full")
    spark.read.parquet(f"{out}/marts/dim_languages").write.mode("overwrite").parquet(dim_copy)
    dim_full = spark.read.parquet(dim_copy)
    assert dim_full.exceptAll(E.queries()["dim_languages"](spark, SF_SMALL)).count() == 0
    assert app.main(["marts", "--posts", f"{out}/posts", "--out", f"{out}/marts",
                     "--since", "2024-01-15"]) == 1
    inc = spark.read.parquet(f"{out}/marts/fct_posts_hourly").drop("event_date")
    assert inc.count() == rows and inc.exceptAll(full).count() == 0
    dim_inc = spark.read.parquet(f"{out}/marts/dim_languages")
    assert dim_inc.count() == dim_full.count() and dim_inc.exceptAll(dim_full).count() == 0
    exp = scratch_path(spark, "app-exp")
    write_expected(FX.expected_markers(spark, SF_SMALL), exp)
    capsys.readouterr()
    assert app.main(["verify", "--expected", exp, "--posts", f"{out}/posts"]) == 1  # replays, lost markers
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    want = qs["reconcile_report"](spark, SF_SMALL).first().asDict()
    assert {k: rep[k] for k in want} == want and rep["missing"] > 0
    from pyspark.sql import functions as F
    newest = FX.raw_events(spark, SF_SMALL, "slow").agg(
        F.date_format(F.timestamp_micros(F.max("time_us")), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    assert app.main(["lateness", "--source", f"files:{src}", "--as-of", newest]) == 0
    pct = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()[-3:]]
    assert [p["percentile"] for p in pct] == [50, 95, 99]


def test_cli_stream_through_bronze(spark):
    src = json_source(spark, SF_SMALL, "fast")
    out, ck = scratch_path(spark, "app-bronze"), scratch_path(spark, "app-bronze-ck")
    assert app.main(["stream", "--source", f"files:{src}", "--out", out, "--checkpoint", ck,
                     "--bronze", "--partition-by-day", "--trigger-available-now"]) == 0
    import __spark_entry__ as E
    from plume.streaming.sinks import UpdateSink
    tags = UpdateSink(f"{out}/trending_hashtags_5m", ["bucket_start", "hashtag"]).read(spark)
    batch = E.queries()["trending_hashtags_5m"](spark, SF_SMALL)
    assert tags.count() == batch.count() > 0
    assert tags.exceptAll(batch).count() == 0
    assert spark.read.parquet(f"{out}/posts").count() == E.queries()["posts_flat"](spark, SF_SMALL).count()
    # dashboard panels from the running views' sinks equal the batch queries
    from pyspark.sql import functions as F
    newest = FX.raw_events(spark, SF_SMALL, "fast").agg(
        F.date_format(F.timestamp_micros(F.max("time_us")), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    panels = app.dashboard_panels(spark, out, as_of=newest)
    qs = E.queries()
    for panel, key in [("current_rate", "current_rate"), ("active_languages", "active_languages"),
                       ("active_spikes", "active_spikes"), ("volume_last_30m", "volume_last_30m"),
                       ("top_spikes", "top_spikes"), ("top_hashtags", "top_hashtags_latest"),
                       ("hashtag_card", "latest_hashtag_card"), ("top_hop", "top_hop_latest")]:
        got, exp = panels[panel], qs[key](spark, SF_SMALL)
        if panel == "volume_last_30m":  # a pivot; the query gives its cells as rows
            got = pivot_rows(got, "minute", "post_count")
        assert got.count() == exp.count() and got.exceptAll(exp).count() == 0, panel
    from plume.schema import RAW_SCHEMA
    assert RAW_SCHEMA.names == ["did", "time_us", "kind", "commit"]   # shared schema untouched


def test_cli_verify_fails_on_missing_and_lists_scenarios(spark, tmp_path, capsys):
    from plume.operators import reconcile as X
    from plume.operators.posts import posts_flat
    posts = scratch_path(spark, "verify-posts")
    posts_flat(X.make_markers(spark, 20)).write.mode("overwrite").parquet(posts)
    ids = X.expected_from_landed(spark.read.parquet(posts)).collect()
    exp = tmp_path / "ids.txt"
    exp.write_text("\n".join([r.value for r in ids] + ["never-landed"]) + "\n")
    log = tmp_path / "faults.jsonl"
    log.write_text('{"ts": "t1", "event": "scenario_start", "name": "stop-1"}\n\n'
                   '{"ts": "t2", "event": "scenario_start", "name": "stop-2"}\n')
    capsys.readouterr()
    rc = app.main(["verify", "--expected", str(exp), "--posts", posts, "--fault-log", str(log)])
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rc == 1 and rep["verdict"] == "FAIL" and rep["missing"] == 1
    assert rep["first_missing"] == ["never-landed"]
    assert [s["name"] for s in rep["scenarios"]] == ["stop-1", "stop-2"]


def test_cli_stream_runs_continuously_until_stopped(spark):
    import threading
    import time
    src = json_source(spark, SF_SMALL, "fast")
    out, ck = scratch_path(spark, "app-cont"), scratch_path(spark, "app-cont-ck")
    result = {}
    before = {q.id for q in spark.streams.active}
    t = threading.Thread(target=lambda: result.setdefault("rc", app.main(
        ["stream", "--source", f"files:{src}", "--out", out, "--checkpoint", ck,
         "--commit-interval", "1 second", "--view-interval", "1 second"])))
    t.start()
    deadline = time.time() + 180
    mine = []
    while time.time() < deadline:
        mine = [q for q in spark.streams.active if q.id not in before]
        # stateful views also run no-data batches (watermark), so look at all
        # recent progress, not only the last one
        if len(mine) == 11 and all(any(p.get("numInputRows", 0) > 0 for p in q.recentProgress)
                                  for q in mine):
            break
        time.sleep(0.5)
    assert len(mine) == 11         # posts sink + 9 views + spike view
    for q in mine:
        q.stop()
    t.join(60)
    assert result.get("rc") == 0
    assert spark.read.parquet(f"{out}/posts").count() > 0
