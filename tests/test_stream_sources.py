"""Sources of the streaming twins, the killed landing process, and the costs of what reads whole events."""
import subprocess
import sys
from types import SimpleNamespace

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from plume.operators import reconcile as X
from plume.plans import catalog, streams
from plume.session import scratch_path, settings
from plume.sources import fixtures as FX
from plume.sources import readers as RD
from plume.streaming import restart


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _shuffles(df):
    """Columns that each shuffle of the physical plan carries."""
    plan, out = df._jdf.queryExecution().sparkPlan(), []

    def walk(node):
        if "ShuffleExchange" in node.getClass().getSimpleName():
            out.append(node.output().mkString(","))
        for k in range(node.children().size()):
            walk(node.children().apply(k))
    walk(plan)
    return out


def test_source_is_compressed_and_holds_all_events(spark):
    path = streams.json_source(spark, SF_SMALL, "slow", files=5)
    files = spark.read.text(path).select(F.input_file_name()).distinct()
    names = [r[0] for r in files.collect()]
    assert 1 <= len(names) <= 5 and all(n.endswith(".gz") for n in names)
    events = FX.raw_json(spark, SF_SMALL, "slow").select("value")
    got = spark.read.text(path)
    assert got.count() == events.count() > 0
    assert got.exceptAll(events).count() == 0


def test_no_whole_event_is_shuffled_for_a_source(spark):
    shuffled = _shuffles(FX.raw_json(spark, SF_SMALL, "slow", parts=5))
    assert len(shuffled) == 2                              # events, documents
    assert not any("ts" in s and "d_text" in s for s in shuffled)
    assert not any("value" in s for s in shuffled)


def test_time_slices_part_the_events(spark):
    parts = streams.time_slices(spark, SF_SMALL, "fast", 4)
    events = FX.raw_json(spark, SF_SMALL, "fast").cache()
    held = [events.filter(p).agg(F.count("*").alias("n"), F.min("time_us").alias("lo"), F.max("time_us").alias("hi"))
            .first() for p in parts]
    assert len(parts) == 4 and sum(r.n for r in held) == events.count()
    assert all(a.hi < b.lo for a, b in zip(held, held[1:]))
    assert events.filter(parts[0]).filter("time_us is null").count() == events.filter("time_us is null").count() > 0
    assert max(r.n for r in held) < 2 * min(r.n for r in held)
    events.unpersist()


def test_replay_reads_each_slice_as_one_micro_batch(spark):
    """Many files a slice, one batch a slice: no file of a slice is behind a watermark that its neighbours moved."""
    out, ck, seen = scratch_path(spark, "replay-view"), scratch_path(spark, "replay-ckpt"), []

    def start(events):
        q, sink = streams.start_view("posts_per_second", events, out, ck, trigger="availableNow")
        seen.append(q)
        return q, sink
    parts = streams.time_slices(spark, SF_SMALL, "fast", 3)
    sink = streams.replay(spark, SF_SMALL, "fast", parts, start)
    batches = [[p for p in q.recentProgress if p["numInputRows"] > 0] for q in seen]
    assert [len(b) for b in batches] == [1, 1, 1]
    assert sum(b[0]["numInputRows"] for b in batches) == FX.raw_json(spark, SF_SMALL, "fast").count()
    want = catalog.BATCH["posts_per_second"](spark, SF_SMALL)
    got = sink.read(spark)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_replay_shuffles_the_documents_once(spark, monkeypatch):
    plans, write = [], streams.write_json

    def note(values, path):
        plans.append(values._jdf.queryExecution().executedPlan().toString())
        write(values, path)
    monkeypatch.setattr(streams, "write_json", note)
    got = streams.stream_late_rows(spark, SF_SMALL)
    assert len(plans) == 3
    for plan in plans:
        assert plan.count("Exchange hashpartitioning(doc_key") == 1 and "hashpartitioning(doc_id" not in plan
    want = catalog.BATCH["posts_per_second"](spark, SF_SMALL)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_events_over_dealt_documents_are_the_same(spark):
    docs = FX.dealt_documents(spark, SF_SMALL, 5)
    got, want = FX.raw_json(spark, SF_SMALL, "fast", parts=5, docs=docs), FX.raw_json(spark, SF_SMALL, "fast")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_settings_are_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), settings(spark, {key: "77", "plume.none": "1"}):
        assert spark.conf.get(key) == "77"
        raise ValueError
    assert spark.conf.get(key) == before and spark.conf.get("plume.none", None) is None


def _dying(monkeypatch, deaths):
    """The first processes end by themselves."""
    started = []

    def popen(args, **kw):
        started.append(args)
        if len(started) <= deaths:
            args = [sys.executable, "-c", "import sys; sys.exit('no such luck')"]
        child = subprocess.Popen(args, **kw)
        if len(started) <= deaths:
            child.wait()
        return child
    monkeypatch.setattr(restart, "subprocess", SimpleNamespace(
        Popen=popen, DEVNULL=subprocess.DEVNULL, STDOUT=subprocess.STDOUT))
    return started


def test_landing_process_that_ends_by_itself_is_started_again(spark, monkeypatch):
    started = _dying(monkeypatch, 1)
    src = streams.json_source(spark, SF_SMALL, "slow", files=32)
    landed, left = restart.land_with_kill(spark, src, scratch_path(spark, "dying"), scratch_path(spark, "dying-ckpt"))
    assert len(started) >= 2 and left > 0
    assert landed.count() == catalog.BATCH["posts_flat"](spark, SF_SMALL).count()


def test_landing_process_that_always_ends_says_why(spark, monkeypatch):
    _dying(monkeypatch, 99)
    src = streams.json_source(spark, SF_SMALL, "slow", files=32)
    with pytest.raises(RuntimeError, match="no such luck"):
        restart.land_with_kill(spark, src, scratch_path(spark, "dead"), scratch_path(spark, "dead-ckpt"), kills=2)


def test_sink_of_eight_files_shuffles_no_whole_posts(spark, monkeypatch):
    made = []
    monkeypatch.setattr(catalog.P, "posts_flat", lambda raw, f=catalog.P.posts_flat: made.append(f(raw)) or made[-1])
    row = catalog.BATCH["sink_file_count"](spark, SF_SMALL).first()
    assert row.parquet_file_count == 8 and row.rows == made[0].count()
    assert not any("created_at" in s for s in _shuffles(made[0])) and len(_shuffles(made[0])) == 2


def test_land_raw_makes_each_payload_once(spark):
    plan = _plan(RD.land_raw(FX.raw_json(spark, SF_SMALL, "slow")).select("value"))
    assert plan.count("HARNESS_MARKER_") == 1 and plan.count("get_json_object") == 1   # the text stands in the payload


def test_land_raw_keeps_wanted_and_unknown_collections(spark):
    df = spark.createDataFrame([('{"commit":{"collection":"a"}}',), ('{"commit":{"collection":"b"}}',), ('{"kind":"x"}',),
                                (None,)], "value string")
    assert RD.land_raw(df, ("a",)).count() == 3
    assert RD.land_raw(df, ("a", "b")).count() == 4
    assert RD.land_raw(df, ()).count() == 2


def test_sides_that_differ_are_told_apart_without_their_rows(spark, monkeypatch):
    """Rows of plain types: the fingerprint settles it; only floats, whose zeros have two texts, are compared as rows."""
    looks, hashes = [], X._row_hashes
    monkeypatch.setattr(X, "_row_hashes", lambda *a: looks.append(1) or hashes(*a))
    a = spark.createDataFrame([(1, "x"), (2, None)], "a long, b string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "a long, b string")
    assert X.same_multiset(a, b).first().asDict() == {"sent": 2, "received": 2, "match": False}
    assert len(looks) == 2
    zero = spark.createDataFrame([(0.0,), (1.0,)], "a double")
    minus = spark.createDataFrame([(-0.0,), (1.0,)], "a double")
    assert X.same_multiset(zero, minus).first().match is True
    held = X.held_fingerprint(a)
    assert X.same_multiset(a, a.repartition(2), prints_a=held).first().match is True
    assert X.same_multiset(a, b, prints_a=held).first().match is False
