"""Batch marts over the landed posts: hourly fact, language dimension and the
history queries of the dashboard.

Scale: every aggregate is partial-then-final on (hour, language) keys; the
24-row rolling sum runs over the *hourly* rows of each language (at most 8,760
a year), or over slices of them, each with the rows before it that its frames
reach.  The distinct-user
count shuffles on (language, did) pairs after a map-side distinct, never on
language alone; where a bounded error is enough, sketches per (day, language)
are kept and merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .serving import TOP_LANGS, pivot_by_lang

ROLLING_ROWS = 24
APPROX_RSD = 0.05    #: relative standard deviation of the approximate distinct count


def hourly(stg: DataFrame) -> DataFrame:
    """Inner part of fct_posts_hourly: per (hour, language)."""
    return (stg.groupBy(F.date_trunc("hour", "event_time").alias("hour_bucket"), "primary_lang")
               .agg(F.count(F.lit(1)).alias("post_count"),
                    F.avg("text_length").alias("avg_text_length"),
                    F.sum(F.when(F.col("text_length") > C.LONG_POST_CHARS, 1).otherwise(0))
                     .cast("long").alias("long_posts")))


def rolling_sum(rows: DataFrame, keys: list[str], order: str, value: str, name: str, slice_of: Column,
                frame: int = ROLLING_ROWS) -> DataFrame:
    """SUM(value) over the last ``frame`` present rows per key, in slices with a halo.

    ``slice_of`` gives the slice of a row, rising with ``order``.  Frames count present rows, which may lie any time back, so a slice's
    halo is the last ``frame - 1`` rows of *all* before it: each slice keeps its
    last rows only, and those are handed on over slices that are too short.
    """
    sliced = rows.withColumn("_slice", slice_of)
    newest = Window.partitionBy(*keys, "_slice").orderBy(F.col(order).desc())
    tails = sliced.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") < frame)
    # per key and slice: its number of tail rows, and the next slices until frame - 1 rows lie between
    held = tails.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(1, frame)
    next_slices = held.withColumn("_next", F.collect_list(F.struct("_slice", "_n")).over(ahead))
    reach = next_slices.select(*keys, F.col("_slice").alias("_from"), F.posexplode("_next").alias("_k", "_to"),
                               F.col("_next").alias("_all")) \
        .select(*keys, "_from", F.col("_to._slice").alias("_slice"),
                F.aggregate(F.slice("_all", F.lit(1), F.col("_k")), F.lit(0).cast("long"),
                            lambda acc, x: acc + x["_n"]).alias("_between")) \
        .filter(F.col("_between") < frame - 1)
    lent = (tails.withColumnRenamed("_slice", "_from")
            .join(reach.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("_from").alias("_r_from"), "_slice", "_between"),
                  [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys] + [F.col("_from") == F.col("_r_from")])
            .filter(F.col("_back") < frame - F.col("_between"))
            .select(*rows.columns, "_slice", F.lit(False).alias("_own")))
    both = sliced.withColumn("_own", F.lit(True)).select(*rows.columns, "_slice", "_own").unionByName(lent)
    w = Window.partitionBy(*keys, "_slice").orderBy(order).rowsBetween(-(frame - 1), Window.currentRow)
    return both.withColumn(name, F.sum(value).over(w).cast("long")).filter("_own").drop("_slice", "_own")


def fct_posts_hourly(stg: DataFrame, slice_by: str | None = None) -> DataFrame:
    """Hourly facts + SUM(post_count) over the 24 most recent *present* rows.

    A language has at most 8,760 hourly rows a year, so its whole history is one
    small window partition.  ``slice_by`` ('year', 'month', 'day') cuts it into
    slices with a halo instead, for finer groups or centuries of them.
    """
    rows = hourly(stg)
    if slice_by is None:
        w = (Window.partitionBy("primary_lang").orderBy("hour_bucket")
                   .rowsBetween(-(ROLLING_ROWS - 1), Window.currentRow))
        return rows.withColumn("rolling_24h_count", F.sum("post_count").over(w).cast("long"))
    part = F.coalesce(F.unix_date(F.to_date(F.date_trunc(slice_by, "hour_bucket"))), F.lit(-1 << 30))
    return rolling_sum(rows, ["primary_lang"], "hour_bucket", "post_count", "rolling_24h_count", part)


def on_or_after(df: DataFrame, since) -> DataFrame:
    """Rows from the day ``since`` on; a day-partitioned table prunes to those days."""
    out = df.filter(F.col("event_time") >= F.lit(str(since)).cast("timestamp"))
    if "event_date" in df.columns:
        out = out.filter(F.col("event_date") >= F.lit(str(since)).cast("date"))
    return out


def previous_tail(fct_prev: DataFrame, since) -> DataFrame:
    """Each language's last 23 present rows before ``since`` (a row without an hour is the oldest)."""
    since_ts = F.lit(str(since)).cast("timestamp")
    rank = Window.partitionBy("primary_lang").orderBy(F.col("hour_bucket").desc())
    return (fct_prev.filter(F.col("hour_bucket").isNull() | (F.col("hour_bucket") < since_ts))
                    .withColumn("_r", F.row_number().over(rank))
                    .filter(F.col("_r") < ROLLING_ROWS)
                    .select("hour_bucket", "primary_lang", "post_count", "avg_text_length", "long_posts"))


def fct_posts_hourly_incremental(stg: DataFrame, fct_prev: DataFrame, since) -> DataFrame:
    """Rows of fct_posts_hourly for hours >= ``since`` (a date), exactly as a
    full refresh would give them, without re-reading older history.

    * hourly aggregates are recomputed only for staged rows on or after
      ``since`` (a day-partitioned landed table prunes to those days);
    * the rolling sum needs the 23 previous *present* rows of each language:
      they are the last 23 rows before ``since`` of the previous mart
      (at most 23 rows per language, taken with a per-language rank over the
      previous mart's hourly rows);
    * the 24-row window runs over that tail plus the new rows, and only the
      new rows are returned, ready for a dynamic partition overwrite.
    """
    new = hourly(on_or_after(stg, since)).withColumn("_new", F.lit(True))
    tail = previous_tail(fct_prev, since).withColumn("_new", F.lit(False))
    w = (Window.partitionBy("primary_lang").orderBy("hour_bucket")
               .rowsBetween(-(ROLLING_ROWS - 1), Window.currentRow))
    both = new.unionByName(tail)
    return (both.withColumn("rolling_24h_count", F.sum("post_count").over(w).cast("long"))
                .filter(F.col("_new")).drop("_new"))


def dim_languages(stg: DataFrame, approx: bool = False) -> DataFrame:
    """First/last seen, total posts and distinct users per language.

    ``approx=True`` swaps the exact distinct for HyperLogLog++, which is
    what a stream can maintain.
    """
    users = (F.approx_count_distinct("did", APPROX_RSD) if approx else F.countDistinct("did"))
    return (stg.filter(F.col("primary_lang").isNotNull())
               .groupBy(F.col("primary_lang").alias("lang_code"))
               .agg(F.min("event_time").alias("first_seen"),
                    F.max("event_time").alias("last_seen"),
                    F.count(F.lit(1)).alias("total_posts"),
                    users.alias("distinct_users")))


def lang_user_days(stg: DataFrame) -> DataFrame:
    """Per (day, language, did): first and last post time and post count.

    The incremental state of dim_languages: it can be rebuilt day by day
    (dynamic partition overwrite on event_date), and it keeps the distinct
    count exact because dids are kept per day.  Its size is the number of
    user-days, not the number of posts.
    """
    return (stg.filter(F.col("primary_lang").isNotNull())
               .groupBy(F.to_date("event_time").alias("event_date"),
                        F.col("primary_lang").alias("lang_code"), "did")
               .agg(F.min("event_time").alias("first_seen"),
                    F.max("event_time").alias("last_seen"),
                    F.count(F.lit(1)).alias("posts")))


def dim_from_user_days(user_days: DataFrame) -> DataFrame:
    """dim_languages from the per-day user state: two partial-then-final
    aggregates, (language, did) then language."""
    per_user = (user_days.groupBy("lang_code", "did")
                         .agg(F.min("first_seen").alias("first_seen"),
                              F.max("last_seen").alias("last_seen"),
                              F.sum("posts").alias("posts")))
    return (per_user.groupBy("lang_code")
                    .agg(F.min("first_seen").alias("first_seen"),
                         F.max("last_seen").alias("last_seen"),
                         F.sum("posts").cast("long").alias("total_posts"),
                         F.count(F.lit(1)).alias("distinct_users")))


HLL_LG_K = 12
#: three standard errors of a HyperLogLog sketch of 2^12 registers (1.04 / sqrt(2^12) each)
HLL_BOUND = 3 * 1.04 / 2 ** (HLL_LG_K / 2)


def lang_day_sketches(stg: DataFrame) -> DataFrame:
    """Per (day, language): first and last post, posts, and a mergeable sketch of the users.

    The bounded form of ``lang_user_days``: a few KB per day and language instead
    of a row per user, so a day can be rewritten alone and any range of days
    merged.
    """
    return (stg.filter(F.col("primary_lang").isNotNull())
               .groupBy(F.to_date("event_time").alias("event_date"), F.col("primary_lang").alias("lang_code"))
               .agg(F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"),
                    F.count(F.lit(1)).alias("total_posts"),
                    F.hll_sketch_agg("did", HLL_LG_K).alias("users")))


def dim_from_sketches(days: DataFrame) -> DataFrame:
    """dim_languages from per-day sketches: distinct users within ``HLL_BOUND`` of the exact number."""
    return days.groupBy("lang_code").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.sum("total_posts").cast("long").alias("total_posts"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("distinct_users"))


def users_within_bound(approx: DataFrame, exact: DataFrame, bound: float) -> DataFrame:
    """Per language the exact number of users, and whether the estimate is within ``bound`` of it."""
    e = exact.select("lang_code", "first_seen", "last_seen", "total_posts", "distinct_users")
    a = approx.select("lang_code", F.col("distinct_users").alias("estimate"), F.col("total_posts").alias("posts"))
    off = F.abs(F.col("estimate") - F.col("distinct_users"))
    ok = (off <= F.greatest(F.lit(1.0), bound * F.col("distinct_users"))) & (F.col("posts") == F.col("total_posts"))
    return (e.join(a, "lang_code", "full_outer")
            .select("lang_code", "total_posts", "distinct_users", F.coalesce(ok, F.lit(False)).alias("within_bound")))


def history_hourly(posts: DataFrame) -> DataFrame:
    """COUNT per (hour, language) of the landed table; non-empty language,
    no test markers; NULL text is kept."""
    return (posts.filter(C.non_empty_lang("primary_lang") & C.not_marker_did("did"))
                 .groupBy(F.date_trunc("hour", "event_time").alias("hour"),
                          F.col("primary_lang").alias("lang"))
                 .agg(F.count(F.lit(1)).alias("posts")))


def history_kpis(hist: DataFrame) -> DataFrame:
    """One row: total posts, languages, hours of data, dominant language.

    The dominant language is the largest total, ties to the smaller code.
    One pass over the hourly rows: GROUPING SETS ((lang), (hour)) yields one
    row per language (with its total) and one row per hour, and a final
    one-row aggregate reads both (languages and hours are small sets).
    """
    sets = (hist.groupingSets([["lang"], ["hour"]], "lang", "hour")
                .agg(F.sum("posts").alias("p"), F.grouping_id().alias("g")))
    by_lang = F.col("g") == 1          # hour rolled up
    by_hour = F.col("g") == 2          # lang rolled up
    return sets.agg(
        F.sum(F.when(by_lang, F.col("p"))).cast("long").alias("total_posts"),
        F.count_if(by_lang).alias("languages"),
        F.count_if(by_hour & F.col("hour").isNotNull()).alias("hours"),
        F.min_by(F.when(by_lang, F.col("lang")),
                 F.when(by_lang, F.struct(-F.col("p"), F.col("lang")))).alias("dominant_language"))


def history_pivot(hist: DataFrame, k: int = TOP_LANGS) -> DataFrame:
    """Rows = hour, columns = top-k languages, posts (0 when absent)."""
    return pivot_by_lang(hist, "hour", "posts", k)
