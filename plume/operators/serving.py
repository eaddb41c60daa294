"""Serving queries over the views: key figures, top-k, pivots, recent windows.

Scalars (the newest bucket, the as-of time) are scalar subqueries: Spark runs
one small distributed aggregate and feeds its value into the filter; nothing
passes through Python and there is no join.  The only driver round trip is
``pivot_by_lang``, which needs its k (<= 8) column names at plan time.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

TOP_LANGS = 8


def latest_bucket(df: DataFrame, col: str) -> DataFrame:
    """Rows of the newest bucket: col = (SELECT max(col) FROM df)."""
    newest = df.select(F.max(col)).scalar()
    return df.filter(F.col(col) == newest)


def as_of_column(as_of: datetime | str | Column | None, default: DataFrame | None = None,
                 time_col: str = "event_time") -> Column:
    """``now()`` as a parameter: a literal, a Column, or the newest time_col."""
    if isinstance(as_of, Column):
        return as_of
    if as_of is None:
        if default is None:
            return F.current_timestamp()
        return default.select(F.max(time_col)).scalar()
    return F.lit(as_of).cast("timestamp")


def last(df: DataFrame, col: str, minutes: int, as_of: Column, strict: bool = False) -> DataFrame:
    """Recent rows: col >= as_of - interval (or > when strict)."""
    bound = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))
    return df.filter(F.col(col) > bound if strict else F.col(col) >= bound)


def total_posts(flat: DataFrame) -> DataFrame:
    return flat.agg(F.count(F.lit(1)).alias("n"))


def active_languages(ppm: DataFrame) -> DataFrame:
    """COUNT(DISTINCT lang) over all history, ignoring NULL and ''."""
    return ppm.filter(C.non_empty_lang("lang")).agg(F.countDistinct("lang").alias("n"))


def top_languages(df: DataFrame, value_col: str, k: int = TOP_LANGS,
                  lang_col: str = "lang") -> DataFrame:
    """k languages with the largest summed volume; ties go to the smaller code."""
    return (df.groupBy(lang_col).agg(F.sum(value_col).cast("long").alias("total"))
              .orderBy(F.col("total").desc(), F.col(lang_col).asc())
              .limit(k))


def restrict_to_top(df: DataFrame, value_col: str, k: int = TOP_LANGS,
                    lang_col: str = "lang") -> DataFrame:
    """Rows whose language is among the top k: a left-semi join to a k-row
    frame (broadcast: its size is bounded by k)."""
    top = top_languages(df, value_col, k, lang_col).select(lang_col)
    return df.join(F.broadcast(top), lang_col, "left_semi")


def pivot_by_lang(df: DataFrame, time_col: str, value_col: str, k: int = TOP_LANGS,
                  lang_col: str = "lang") -> DataFrame:
    """Rows = time, one column per top-k language (in code order), SUM, NULL -> 0."""
    langs = sorted(r[0] for r in top_languages(df, value_col, k, lang_col).collect())
    if not langs:
        return df.select(time_col).limit(0)
    kept = df.filter(F.col(lang_col).isin(langs))
    piv = kept.groupBy(time_col).pivot(lang_col, langs).agg(F.sum(value_col).cast("long"))
    return piv.na.fill(0, subset=langs)


def pivot_rows(df: DataFrame, time_col: str, value_col: str, lang_col: str = "lang") -> DataFrame:
    """A pivot (one column per language) as rows again, zeros included: a
    schema that does not depend on the data."""
    langs = [c for c in df.columns if c != time_col]
    if not langs:
        return df.select(time_col, F.lit(None).cast("string").alias(lang_col),
                         F.lit(None).cast("long").alias(value_col))
    return df.unpivot([time_col], langs, lang_col, value_col)


def volume_last_30m(ppm: DataFrame, as_of: Column, minutes: int = 30,
                    k: int = TOP_LANGS) -> DataFrame:
    """Per-minute volume of the top-k languages over the last 30 minutes."""
    recent = last(ppm.filter(C.non_empty_lang("lang")), "minute_bucket", minutes, as_of)
    recent = recent.select(F.col("minute_bucket").alias("minute"), "lang", "post_count")
    return pivot_by_lang(recent, "minute", "post_count", k)


def ordered_series(df: DataFrame, *cols: str) -> DataFrame:
    """A series in time order for presentation (minute, hour or lateness
    rows).  A global sort is a range-partitioned shuffle; use it on
    aggregated series, whose size is bounded by the number of buckets."""
    return df.orderBy(*cols)


# Column titles of the dashboard tables (fixed values).
DISPLAY_NAMES = {
    "history": {"hour": "Hour", "lang": "Language", "posts": "Posts"},
    "hashtags": {"hashtag": "Hashtag", "mentions": "Mentions"},
}


def for_display(df: DataFrame, kind: str) -> DataFrame:
    """Rename columns for presentation (select only the renamed ones)."""
    names = DISPLAY_NAMES[kind]
    return df.select(*[F.col(k).alias(v) for k, v in names.items()])
