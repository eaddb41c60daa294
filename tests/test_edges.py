"""One test per semantic trap."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import B, MIN, raw_rows
from plume.operators import hashtags as H
from plume.operators import lateness as L
from plume.operators import marts as M
from plume.operators import posts as P
from plume.operators import rates as R
from plume.operators import spikes as K
from plume.functions import columns as C


def test_x1_flat_time_whole_seconds_source_time_micros(spark):
    t = 1_704_067_207_785_529
    df = raw_rows(spark, [{"time_us": t, "text": "a"}])
    flat = P.posts_flat(df).first()
    assert flat.event_time == dt.datetime(2024, 1, 1, 0, 0, 7)
    src = df.select(C.event_time_micros("time_us").alias("t")).first().t
    assert src.microsecond == 785_529


def test_x2_language_edges(spark):
    df = raw_rows(spark, [
        {"time_us": B, "langs": [], "rkey": "a"},
        {"time_us": B, "langs": None, "rkey": "b"},
        {"time_us": B, "langs": [""], "rkey": "c"},
        {"time_us": B, "langs": ["fr", "xx"], "rkey": "d"},
    ])
    langs = sorted((r.primary_lang for r in P.posts_flat(df).collect()), key=str)
    assert langs == sorted(["unknown", "unknown", "", "fr"])


def test_x3_unicode_hashtags(spark):
    df = raw_rows(spark, [{"time_us": B, "text": "#日本 #Été #a_b #A #a"}])
    tags = sorted(r.hashtag for r in H.trending_hashtags_5m(df).collect())
    assert tags == sorted(["日本", "été", "a_b", "a"])
    counts = {r.hashtag: r.mentions for r in H.trending_hashtags_5m(df).collect()}
    assert counts["a"] == 2


def test_x4_one_event_in_twelve_hop_windows(spark):
    df = raw_rows(spark, [{"time_us": B + 7 * MIN, "text": "#x"}])
    direct = H.trending_hashtags_1h_hop(df, direct=True)
    rolled = H.trending_hashtags_1h_hop(df, direct=False)
    assert direct.count() == 12
    assert direct.exceptAll(rolled).count() == 0 and rolled.exceptAll(direct).count() == 0


def test_x7_identity_counted_by_posts_per_second_only(spark):
    df = raw_rows(spark, [{"time_us": B, "kind": "identity"},
                          {"time_us": B + 1, "text": "x", "rkey": "p"}])
    assert R.posts_per_second(df).first().post_count == 2
    assert R.posts_per_minute_by_lang(df).first().post_count == 1
    assert P.posts_flat(df).count() == 1


def test_x8_spike_rows_need_a_prior_minute_within_the_hour(spark):
    rate = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0), "en", 1),
         (dt.datetime(2024, 1, 1, 0, 1), "en", 5),      # 5 > 2 * 1 -> spike
         (dt.datetime(2024, 1, 1, 2, 30), "en", 9),     # gap over an hour -> no row
         (dt.datetime(2024, 1, 1, 0, 0), "fr", 3)],     # first minute -> no row
        "minute_bucket timestamp, lang string, posts_in_minute long")
    rows = K.lang_spike_detector(rate).collect()
    assert len(rows) == 1
    assert rows[0].lang == "en" and rows[0].is_spiking and rows[0].rolling_hr_avg == 1.0
    j = K.spike_detector_join(rate)
    assert j.exceptAll(K.lang_spike_detector(rate)).count() == 0
    # inclusive bounds: exactly 60 minutes back still counts
    rate2 = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0), "en", 4), (dt.datetime(2024, 1, 1, 1, 0), "en", 9)],
        "minute_bucket timestamp, lang string, posts_in_minute long")
    r2 = K.lang_spike_detector(rate2).collect()
    assert len(r2) == 1 and r2[0].is_spiking


def test_x9_rolling_is_24_present_rows(spark):
    hours = [h for h in range(40) if h % 4 != 3]   # 30 rows with gaps
    stg = spark.createDataFrame(
        [("d", 0, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), "t", "en", "", 1)
         for h in hours],
        "did string, time_us long, event_time timestamp, text string, primary_lang string, "
        "created_at string, text_length int")
    rows = sorted(M.fct_posts_hourly(stg).collect(), key=lambda r: r.hour_bucket)
    assert [r.rolling_24h_count for r in rows] == [min(i + 1, 24) for i in range(len(rows))]


def test_x10_stg_drops_null_did_keeps_empty_text(spark):
    posts = spark.createDataFrame(
        [(None, 1, None, "x", "en", None), ("did:1", 1, None, "", "en", None),
         ("harness:u", 1, None, "x", "en", None), ("did:2", 1, None, None, "en", None)],
        "did string, time_us long, event_time timestamp, text string, primary_lang string, "
        "created_at string")
    rows = P.stg_posts(posts).collect()
    assert len(rows) == 1 and rows[0].did == "did:1" and rows[0].text_length == 0


def test_x11_length_counts_code_points(spark):
    posts = spark.createDataFrame([("d", 1, None, "a😀é", "en", None)],
                                  "did string, time_us long, event_time timestamp, text string, "
                                  "primary_lang string, created_at string")
    assert P.stg_posts(posts).first().text_length == 3


def test_x13_future_event_floors_down(spark):
    df = raw_rows(spark, [{"time_us": B + 1_500_000}])
    as_of = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    assert L.event_age_hist(df, as_of).first().lateness_seconds == -2


def test_f9_ratio_null_when_average_zero(spark):
    df = spark.range(1).select(C.round_half_up_ratio(F.lit(5), F.lit(0)).alias("r"),
                               C.round_half_up_ratio(F.lit(17), F.lit(8)).alias("half"),
                               C.round_half_up_ratio(F.lit(1), F.lit(3)).alias("third"))
    r = df.first()
    assert r.r is None and r.half == 2.13 and r.third == 0.33


def test_x12_nearest_rank_percentiles(spark):
    hist = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1)],
                                 "lateness_seconds int, event_count long")
    got = {r.percentile: r.lateness_seconds
           for r in L.lateness_percentiles(hist, (50, 95, 99)).collect()}
    assert got == {50: 2, 95: 4, 99: 4}       # nearest rank, no interpolation
    hist2 = spark.createDataFrame([(-2, 10), (0, 40), (5, 45), (9, 4), (30, 1)],
                                  "lateness_seconds int, event_count long")
    got2 = {r.percentile: r.lateness_seconds
            for r in L.lateness_percentiles(hist2, (50, 95, 99)).collect()}
    # cumulative 10, 50, 95, 99, 100 of 100: p50 is reached exactly at 0
    assert got2 == {50: 0, 95: 5, 99: 9}


def test_json_decode_is_tolerant(spark):
    from plume.sources.readers import decode_events
    vals = spark.createDataFrame([("{not json",), ('{"did": "a", "time_us": "text"}',),
                                  ('{"did": "b", "time_us": 5, "extra": 1}',)], "value string")
    rows = {r.did: r for r in decode_events(vals).collect()}
    assert rows[None].time_us is None            # broken line: all-NULL row
    assert rows["a"].time_us is None             # wrongly typed field: NULL
    assert rows["b"].time_us == 5                # unknown key ignored


def test_spike_join_form_equals_window_form_on_fixture(spark):
    from conftest import SF_SMALL
    from plume.plans import catalog as CAT
    rate = R.lang_post_rate_1m(CAT.fast(spark, SF_SMALL))
    w = K.lang_spike_detector(rate)
    j = K.spike_detector_join(rate)
    assert w.count() == j.count() > 0
    assert w.exceptAll(j).count() == 0


def test_dedupe_drops_replays_only(spark):
    """A delete or a like on the same record key is no replay; identity events count too."""
    from plume.operators import posts as P
    rows = [{"did": "d", "time_us": 5, "rkey": "k"}, {"did": "d", "time_us": 5, "rkey": "k"},
            {"did": "d", "time_us": 9, "rkey": "k", "op": "delete"},
            {"did": "d", "time_us": 9, "rkey": "k", "coll": "app.bsky.feed.like"},
            {"did": "e", "time_us": 7, "kind": "identity"}, {"did": "e", "time_us": 7, "kind": "identity"},
            {"did": "d", "time_us": None, "rkey": "k"}, {"did": "d", "time_us": None, "rkey": "k"}]
    assert P.dedupe_posts(raw_rows(spark, rows)).count() == 5


def test_events_without_time_keep_a_bucket(spark):
    from plume.operators import rates as R
    rows = [{"did": "d", "time_us": B}, {"did": "d", "time_us": None}]
    got = {r.minute_bucket is None: r.post_count for r in R.posts_per_minute_by_lang(raw_rows(spark, rows)).collect()}
    assert got == {False: 1, True: 1}


def test_integer_division_is_exact_beyond_doubles(spark):
    from pyspark.sql import functions as F

    from plume.functions import columns as C
    n = 2 ** 60 + 7
    for v in (n, -n, -1, 0, 999_999):
        row = spark.range(1).select(C.trunc_div(F.lit(v), 1_000_000).alias("t"),
                                    C.floor_div(F.lit(v), 1_000_000).alias("f")).first()
        assert row.f == v // 1_000_000
        assert row.t == (abs(v) // 1_000_000) * (1 if v >= 0 else -1)


def test_sink_read_errors_are_not_empty_views(spark, tmp_path):
    import pytest

    from plume.streaming.sinks import UpdateSink
    sink = UpdateSink(str(tmp_path / "view"), ["k"])
    schema = spark.createDataFrame([(1, 2)], "k int, v int").schema
    assert sink.read(spark, schema).count() == 0
    sink.write_batch(spark.createDataFrame([(1, 2)], schema), 0)
    assert sink.read(spark, schema).count() == 1
    for f in (tmp_path / "view" / "batch_id=0").glob("part-*.parquet"):
        f.write_bytes(b"broken")
    with pytest.raises(Exception):
        sink.read(spark, schema).collect()


def test_corrupt_payloads_are_kept_aside(spark):
    from plume.sources import readers as RD
    good = '{"did":"d","time_us":1,"kind":"identity"}'
    df = spark.createDataFrame([(good,), ("{broken",), (None,), ('{"did":"d","time_us":"x"}',)], "value string")
    assert sorted(r.value for r in RD.corrupt_events(df).collect()) == ['{"did":"d","time_us":"x"}', "{broken"]
    assert RD.land_raw(df).count() == 4


def test_pivot_rows_fill_every_cell(spark):
    from plume.operators import serving as V
    df = spark.createDataFrame([(1, "en", 5), (2, "de", 7)], "hour int, lang string, posts long")
    got = {(r.hour, r.lang): r.posts for r in V.pivot_rows(V.pivot_by_lang(df, "hour", "posts"), "hour", "posts").collect()}
    assert got == {(1, "en"): 5, (1, "de"): 0, (2, "en"): 0, (2, "de"): 7}
