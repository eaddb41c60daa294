"""Declared schemas of the raw post event and of the derived tables."""

from pyspark.sql import types as T

S = T.StringType()

RECORD_SCHEMA = T.StructType([
    T.StructField("$type", S),
    T.StructField("createdAt", S),
    T.StructField("text", S),
    T.StructField("langs", T.ArrayType(S)),
])

COMMIT_SCHEMA = T.StructType([
    T.StructField("rev", S),
    T.StructField("operation", S),
    T.StructField("collection", S),
    T.StructField("rkey", S),
    T.StructField("record", RECORD_SCHEMA),
    T.StructField("cid", S),
])

# One JSON object per message; unknown keys are ignored, bad values become NULL.
RAW_SCHEMA = T.StructType([
    T.StructField("did", S),
    T.StructField("time_us", T.LongType()),
    T.StructField("kind", S),
    T.StructField("commit", COMMIT_SCHEMA),
])

# The append-only landed posts table (all columns nullable).
POSTS_SCHEMA = T.StructType([
    T.StructField("did", S),
    T.StructField("time_us", T.LongType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("text", S),
    T.StructField("primary_lang", S),
    T.StructField("created_at", S),
])

POSTS_DDL = ("did STRING, time_us BIGINT, event_time TIMESTAMP, text STRING, "
             "primary_lang STRING, created_at STRING")

# Fault log lines of the restart harness.
FAULT_LOG_SCHEMA = T.StructType([
    T.StructField("ts", S),
    T.StructField("event", S),
    T.StructField("name", S),
    T.StructField("container", S),
    T.StructField("detail", S),
    T.StructField("file", S),
    T.StructField("rc", T.IntegerType()),
])

LATENESS_SCHEMA = T.StructType([
    T.StructField("lateness_seconds", T.IntegerType()),
    T.StructField("event_count", T.LongType()),
])
