"""Plan guards: scale properties checked on the physical plans of every
registered batch query (no all-pairs joins, no Python in the hot path,
partial aggregation before shuffles, pruned scans)."""
import contextlib
import io
import re

from conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_all_pairs_joins_and_no_python(spark):
    from plume.plans.catalog import BATCH
    for name, build in BATCH.items():
        plan = _plan(build(spark, SF_SMALL))
        bad = [op for op in FORBIDDEN if op in plan]
        assert not bad, (name, bad)


def test_scans_are_pruned(spark):
    from plume.plans.catalog import BATCH
    plan = _plan(BATCH["posts_per_second"](spark, SF_SMALL))
    events_schema = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    # posts per second needs the time only: no user, type, value or props column
    assert any(s == "struct<event_id:bigint,ts:timestamp_ntz>" or s == "struct<ts:timestamp_ntz>"
               for s in events_schema), events_schema
    for s in events_schema:
        assert "props" not in s and "value" not in s
    plan = _plan(BATCH["fct_posts_hourly"](spark, SF_SMALL))
    docs = [s for s in re.findall(r"ReadSchema: (struct<[^\n]*>)", plan) if "doc_id" in s]
    assert docs and all("n_chars" not in s for s in docs)
    # documents keep their whole text
    assert "substring(text" not in plan


def test_time_only_queries_read_no_documents(spark):
    from plume.plans.catalog import BATCH
    for name in ["posts_per_second", "current_rate", "event_age_hist", "lateness_percentiles", "total_posts",
                 "dedupe_posts", "reconcile_report_deduped"]:
        plan = _plan(BATCH[name](spark, SF_SMALL))
        assert "documents.parquet" not in plan, name


def test_longest_post_is_as_long_as_its_document(spark):
    from pyspark.sql import functions as F

    from plume.plans import catalog as CAT
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    posts = CAT.stg(spark, SF_SMALL).withColumn("source", F.substring_index("text", " ", 1))
    longest = posts.agg(F.max_by("text", "text_length")).first()[0]
    texts = [r.text for r in docs.select("text").collect()]
    body = max((t for t in texts if longest.endswith(" " + t)), key=len)
    tags = longest[:-len(body)].split()
    assert len(tags) == 3 and tags[1].startswith("#") and tags[2].startswith("#")
    assert len(body) > 379


def test_incremental_marts_prune_days_through_staging(spark):
    from pyspark.sql import functions as F

    from plume.operators import marts as M
    from plume.operators import posts as P
    from plume.plans import catalog as CAT
    from plume.session import scratch_path
    from plume.sources import readers as RD
    out = scratch_path(spark, "posts-days")
    (CAT.posts(spark, SF_SMALL).withColumn("event_date", F.to_date("event_time"))
        .write.mode("overwrite").partitionBy("event_date").parquet(out))
    stg = P.stg_posts(RD.scan_posts(spark, out))
    for df in (M.hourly(M.on_or_after(stg, "2024-01-15")), M.lang_user_days(M.on_or_after(stg, "2024-01-15"))):
        assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*>=", _plan(df)), _plan(df)
    tail = M.previous_tail(M.fct_posts_hourly(stg), "2024-01-15")
    assert tail.groupBy("primary_lang").count().agg(F.max("count")).first()[0] <= 23


def test_aggregates_are_partial_before_the_shuffle(spark):
    from plume.plans.catalog import BATCH
    for name in ["posts_per_minute_by_lang", "trending_hashtags_5m", "fct_posts_hourly",
                 "history_hourly", "marker_counts", "dim_languages"]:
        plan = _plan(BATCH[name](spark, SF_SMALL))
        assert "partial_count" in plan, name
    dim = _plan(BATCH["dim_languages"](spark, SF_SMALL))
    # distinct users shuffle on (language, did), not on language alone
    assert re.search(r"hashpartitioning\(primary_lang#\d+L?, did#\d+", dim), dim


def test_event_age_prunes_day_partitions(spark):
    from pyspark.sql import functions as F

    from plume.operators import lateness as L
    from plume.plans import catalog as CAT
    from plume.session import scratch_path
    out = scratch_path(spark, "age-days")
    (CAT.fast(spark, SF_SMALL).withColumn("event_date", F.to_date("event_time"))
        .write.mode("overwrite").partitionBy("event_date").parquet(out))
    landed = spark.read.parquet(out)
    as_of = F.lit("2024-01-01 02:00:00").cast("timestamp")
    plan = _plan(L.event_age_hist(landed, as_of))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan), plan
    assert L.event_age_hist(landed, as_of).count() > 0
