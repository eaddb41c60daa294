"""Column expressions (``Column -> Column``) shared by batch and streaming.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------
POST_COLLECTION = "app.bsky.feed.post"
CREATE_OPERATION = "create"
COMMIT_KIND = "commit"
UNKNOWN_LANG = "unknown"
MARKER_DID_PREFIX = "harness:"
MARKER_TEXT_PREFIX = "HARNESS_MARKER_"
LONG_POST_CHARS = 200          # text_length > 200 counts as a long post
SPIKE_FACTOR = 2               # a minute spikes above 2x its trailing-hour mean
WATERMARK_DELAY = "10 seconds"
# A hashtag is '#' followed by one or more word characters, Unicode-aware:
# letters, letter numbers, marks, decimal digits, connector punctuation and
# the two join controls.  Written as an explicit class so that Java and RE2
# (the SQL oracle) read it the same way.
HASHTAG_PATTERN = r"#([\p{L}\p{Nl}\p{M}\p{Nd}\p{Pc}\x{200C}\x{200D}]+)"

MICROS_PER_SECOND = 1_000_000


def c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


# --- time -------------------------------------------------------------------

def event_time_micros(time_us: str | Column = "time_us") -> Column:
    """Source-side event time: microsecond precision (to_timestamp(us / 1e6))."""
    return F.timestamp_micros(c(time_us))


def event_time_seconds(time_us: str | Column = "time_us") -> Column:
    """Flat/minute event time: whole seconds, integer division of the micros."""
    return F.timestamp_seconds(trunc_div(c(time_us).cast("long"), MICROS_PER_SECOND))


def trunc_div(num: Column, den: int) -> Column:
    """Exact integer division rounding toward zero (SQL BIGINT / BIGINT)."""
    return F.call_function("div", num, F.lit(den))


def floor_div(num: Column, den: int | Column) -> Column:
    """Exact floor division of longs (rounds toward minus infinity)."""
    d = den if isinstance(den, Column) else F.lit(den)
    return F.call_function("div", num - F.pmod(num, d), d)


def age_seconds(as_of_us: Column, time_us: str | Column = "time_us") -> Column:
    """FLOOR(EPOCH(as_of - event_time))::INT, computed on microseconds."""
    return floor_div(as_of_us - c(time_us), MICROS_PER_SECOND).cast("int")


# --- record fields ------------------------------------------------------------

def first_lang(langs: str | Column = "commit.record.langs") -> Column:
    """langs[1] in 1-based SQL; out of range or NULL array gives NULL."""
    return F.get(c(langs), 0)


def primary_lang(langs: str | Column = "commit.record.langs") -> Column:
    return F.coalesce(first_lang(langs), F.lit(UNKNOWN_LANG))


def is_create_post() -> Column:
    """kind = 'commit' AND operation = 'create' AND collection = post."""
    return ((F.col("kind") == COMMIT_KIND) & is_create_post_any_kind())


def is_create_post_any_kind() -> Column:
    return ((F.col("commit.operation") == CREATE_OPERATION)
            & (F.col("commit.collection") == POST_COLLECTION))


def is_marker_did(did: str | Column = "did") -> Column:
    """did starts with the marker prefix; NULL counts as false."""
    return F.coalesce(c(did).startswith(MARKER_DID_PREFIX), F.lit(False))


def not_marker_did(did: str | Column = "did") -> Column:
    """did NOT LIKE 'harness:%' with SQL three-valued logic (NULL did fails)."""
    return ~c(did).startswith(MARKER_DID_PREFIX)


def non_empty_lang(lang: str | Column) -> Column:
    return c(lang).isNotNull() & (c(lang) != F.lit(""))


def hashtags(text: str | Column) -> Column:
    """All first capture groups of the hashtag pattern, in order."""
    return F.regexp_extract_all(c(text), F.lit(HASHTAG_PATTERN), 1)


def marker_uuid_from_text(text: str | Column = "text") -> Column:
    """text.removeprefix('HARNESS_MARKER_')."""
    return F.regexp_replace(c(text), F.lit("^" + MARKER_TEXT_PREFIX), F.lit(""))


def uuid_from_did(did: str | Column = "did") -> Column:
    """did.split(':', 1)[1]: everything after the first colon."""
    return F.substr(c(did), F.instr(c(did), ":") + F.lit(1))


def round_half_up_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """ROUND(num / den, scale) on exact rationals, half up, as DOUBLE.

    num and den are non-negative integers; den = 0 gives NULL (NULLIF).
    Integer arithmetic avoids the double-rounding of a float division.
    """
    k = 10 ** scale
    n = num.cast("long") * F.lit(2 * k)
    d = den.cast("long")
    safe_d = F.when(d == 0, F.lit(1)).otherwise(d)
    scaled = floor_div(n + safe_d, F.lit(2) * safe_d)   # floor((2kn + d) / 2d)
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(scaled / F.lit(float(k)))


def preview(text: str | Column, n: int) -> Column:
    """text[:n].replace('\\n', ' '): truncation first, then newline swap."""
    return F.translate(F.substring(c(text), 1, n), "\n", " ")


def once(value: Column) -> Column:
    """``value`` as a column of its own: filters above read it instead of computing it again.

    A filter is pushed through a projection together with the expression it
    tests; it is not pushed through a generator.
    """
    return F.explode(F.array(value))
