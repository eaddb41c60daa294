"""Event-age histogram and nearest-rank percentiles.

The reference's "lateness" view subtracts event time from ``now()`` at
*read* time, so it measures event **age**; ``event_age_hist`` keeps that
meaning with ``as_of`` as a parameter.  ``arrival_lateness_hist`` measures
true lateness (arrival time - event time) when the source records an
arrival time (Kafka's message timestamp, or the landing time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C

DEFAULT_PERCENTILES = (50, 95, 99)
RECENT_MINUTES = 10


def event_age_hist(raw: DataFrame, as_of: Column, minutes: int = RECENT_MINUTES) -> DataFrame:
    """COUNT per whole second of (as_of - event_time) over the last 10 minutes
    (event_time > as_of - 10 min, strict); FLOOR goes down for negatives."""
    as_of_us = F.unix_micros(as_of)
    lo = as_of_us - F.lit(minutes * 60 * C.MICROS_PER_SECOND)
    if "event_date" in raw.columns:
        # day-partitioned input (bronze / landed table): prune to the days in range
        raw = raw.filter(F.col("event_date") >= F.to_date(F.timestamp_micros(lo)))
    return (raw.filter(F.col("time_us") > lo)
               .groupBy(C.age_seconds(as_of_us, "time_us").alias("lateness_seconds"))
               .agg(F.count(F.lit(1)).alias("event_count")))


def arrival_lateness_hist(df: DataFrame, arrival_col: str = "arrival_time") -> DataFrame:
    """COUNT per whole second of (arrival_time - event_time)."""
    arr_us = F.unix_micros(F.col(arrival_col))
    return (df.groupBy(C.age_seconds(arr_us, "time_us").alias("lateness_seconds"))
              .agg(F.count(F.lit(1)).alias("event_count")))


def lateness_percentiles(hist: DataFrame, percentiles=DEFAULT_PERCENTILES) -> DataFrame:
    """Nearest rank: for each p, the first bucket whose cumulative share >= p.

    The running sum is over the *aggregated* histogram, one row per second
    of age (a bounded number: the view keeps 10 minutes), so its single
    ordered partition is small.  The comparison is done in integers
    (cum * 100 >= p * total), which equals the float test on these ratios.
    """
    w = Window.orderBy("lateness_seconds").rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.select("lateness_seconds",
                      F.sum("event_count").over(w).alias("cum"),
                      F.sum("event_count").over(Window.partitionBy()).alias("total"))
    ps = F.explode(F.array(*[F.lit(int(p)) for p in percentiles])).alias("percentile")
    return (cum.select("*", ps)
               .filter(F.col("cum") * 100 >= F.col("percentile") * F.col("total"))
               .groupBy("percentile")
               .agg(F.min("lateness_seconds").alias("lateness_seconds")))


def share_within(hist: DataFrame, seconds: int) -> DataFrame:
    """Share of events whose age is at most ``seconds`` (e.g. the watermark)."""
    return hist.agg((F.sum(F.when(F.col("lateness_seconds") <= seconds, F.col("event_count"))
                           .otherwise(0)) / F.sum("event_count")).alias("share"))


def write_lateness_csv(hist: DataFrame, path: str) -> None:
    """Sorted histogram with a header line, as one CSV file (the histogram is
    bounded by the 10-minute view, so one output task is enough)."""
    (hist.orderBy("lateness_seconds").coalesce(1)
         .write.mode("overwrite").option("header", True).csv(path))
