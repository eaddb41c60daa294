"""Trailing-hour spike detector per language.

Semantics (the reference's inner self-join): for minute a, average the
counts of the *present* minutes b of the same language with
a - 60 min <= b <= a - 1 min; no such b means no row; spiking when
a > 2 x that average (strict).

Batch plan: a RANGE window frame [-60, -1] minutes over the per-minute
counts, partitioned by (language, day): one shuffle, no join and no pair
expansion.  A day's partition also gets the last hour of the day before (its
halo), which is all that a frame can reach, so the history of a language is as
many tasks as it has days, of at most 1,500 rows each.  The join form is kept as an exact cross-check
(``spike_detector_join``): each b row is fanned out to the 60 minutes it
serves and joined on equality, so the work is bounded by 60 x the number of
per-minute rows, never by the square of a language's row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C

LOOKBACK_MIN = 60
SLICE_MIN = 24 * 60     #: minutes of a language in one window partition


def _minute_index(col: str = "minute_bucket"):
    return C.floor_div(F.unix_seconds(F.col(col)), 60)


def spike_stats(rate: DataFrame) -> DataFrame:
    """rate (minute_bucket, lang, posts_in_minute) + trailing-hour sum/count;
    rows without a prior minute in the hour are dropped (inner-join rule)."""
    w = (Window.partitionBy("lang", "slice").orderBy("m")
               .rangeBetween(-LOOKBACK_MIN, -1))
    own = C.floor_div(F.col("m"), SLICE_MIN)
    halo = F.when(F.pmod("m", F.lit(SLICE_MIN)) >= SLICE_MIN - LOOKBACK_MIN, F.array(own, own + 1)).otherwise(F.array(own))
    return (rate.withColumn("m", _minute_index())
                .withColumn("slice", F.explode(halo))
                .withColumn("hr_sum", F.sum("posts_in_minute").over(w))
                .withColumn("hr_cnt", F.count("posts_in_minute").over(w))
                .filter((F.col("hr_cnt") > 0) & (F.col("slice") == own))
                .drop("m", "slice"))


def _finish(stats: DataFrame) -> DataFrame:
    avg = F.col("hr_sum") / F.col("hr_cnt")
    return stats.select(
        "minute_bucket", "lang", "posts_in_minute",
        avg.alias("rolling_hr_avg"),
        (F.col("posts_in_minute") > F.lit(C.SPIKE_FACTOR) * avg).alias("is_spiking"))


def lang_spike_detector(rate: DataFrame) -> DataFrame:
    """minute_bucket, lang, posts_in_minute, rolling_hr_avg, is_spiking."""
    return _finish(spike_stats(rate))


def spike_stats_join(rate: DataFrame) -> DataFrame:
    """Same rows as ``spike_stats`` through an equi-join on (lang, minute)."""
    a = rate.withColumn("m", _minute_index())
    b = (rate.select("lang", _minute_index().alias("bm"), "posts_in_minute")
             .select("lang", "posts_in_minute",
                     F.explode(F.sequence(F.col("bm") + 1, F.col("bm") + LOOKBACK_MIN)).alias("m"))
             .groupBy("lang", "m")
             .agg(F.sum("posts_in_minute").alias("hr_sum"),
                  F.count(F.lit(1)).alias("hr_cnt")))
    return a.join(b, ["lang", "m"], "inner").drop("m")


def spike_detector_join(rate: DataFrame) -> DataFrame:
    return _finish(spike_stats_join(rate))


def top_spikes(rate: DataFrame, n: int = 20) -> DataFrame:
    """Newest spiking minutes first, then the largest ratio, n rows.

    Spike Ratio = ROUND(posts / NULLIF(avg, 0), 2) computed exactly as
    posts * count / sum, half up.
    """
    stats = spike_stats(rate)
    avg = F.col("hr_sum") / F.col("hr_cnt")
    ratio = C.round_half_up_ratio(F.col("posts_in_minute") * F.col("hr_cnt"), F.col("hr_sum"))
    spiking = stats.filter(F.col("posts_in_minute") > F.lit(C.SPIKE_FACTOR) * avg)
    return (spiking.select(F.col("lang").alias("Language"),
                           F.col("minute_bucket").alias("Minute"),
                           F.col("posts_in_minute").alias("Posts"),
                           avg.alias("Hourly Avg"),
                           ratio.alias("Spike Ratio"))
                   .orderBy(F.col("Minute").desc(), F.col("Spike Ratio").desc_nulls_last(),
                            F.col("Language").asc())
                   .limit(n))


def spiking_only(spikes: DataFrame) -> DataFrame:
    """Rows flagged as spiking (is_spiking = true)."""
    return spikes.filter(F.col("is_spiking"))


def active_spikes(spikes: DataFrame) -> DataFrame:
    """COUNT(*) WHERE is_spiking, as a one-row frame."""
    return spikes.agg(F.count_if(F.col("is_spiking")).alias("n"))
