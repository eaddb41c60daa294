"""Sources and scans: raw stream, JSON decode, landed table, side files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..schema import FAULT_LOG_SCHEMA, POSTS_SCHEMA, RAW_SCHEMA

KAFKA_TOPIC = "posts"


def read_raw_stream(spark: SparkSession, *, fmt: str = "files", path: str | None = None,
                    starting_offsets: str = "latest", options: dict | None = None,
                    max_files_per_trigger: int | None = None,
                    max_offsets_per_trigger: int | None = None,
                    min_partitions: int | None = None) -> DataFrame:
    """Subscribe to the raw JSON post stream; returns column ``value`` (string).

    ``fmt='kafka'`` reads a Kafka-API topic (needs the Kafka connector on the
    classpath; ``startingOffsets`` is ignored once a checkpoint exists).
    ``max_offsets_per_trigger`` bounds a micro-batch after downtime, and
    ``min_partitions`` splits large topic partitions over more tasks.
    ``fmt='files'`` tails a folder of JSON-lines files, one event per line.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("subscribe", opts.pop("subscribe", KAFKA_TOPIC))
                  .option("startingOffsets", starting_offsets))
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        if min_partitions:
            reader = reader.option("minPartitions", min_partitions)
        for k, v in opts.items():
            reader = reader.option(k, v)
        return reader.load().select(
            F.col("value").cast("string").alias("value"),
            "topic", "partition", "offset", F.col("timestamp").alias("arrival_time"))
    if fmt == "files":
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        for k, v in opts.items():
            reader = reader.option(k, v)
        return reader.load(path)
    raise ValueError(f"unknown stream format {fmt!r}")


def decode_events(df: DataFrame, value_col: str = "value",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text -> typed nested event (PERMISSIVE: bad JSON or a wrongly
    typed field becomes NULL, unknown keys are ignored)."""
    parsed = F.from_json(F.col(value_col), RAW_SCHEMA, {"mode": "PERMISSIVE"})
    return df.select(parsed.alias("e"), *keep).select("e.*", *keep)


def corrupt_events(df: DataFrame, value_col: str = "value") -> DataFrame:
    """The rows whose payload is no JSON object of the event schema, unchanged."""
    marked = T.StructType([*RAW_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(value_col), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return df.filter(parsed["_corrupt"].isNotNull() | (F.col(value_col).isNotNull() & parsed.isNull()))


def with_event_time(df: DataFrame) -> DataFrame:
    """Computed column event_time = to_timestamp(time_us / 1e6) (micros kept)."""
    return df.withColumn("event_time", C.event_time_micros("time_us"))


def with_watermark(df: DataFrame, delay: str = C.WATERMARK_DELAY) -> DataFrame:
    """WATERMARK FOR event_time AS event_time - INTERVAL '10 seconds'."""
    return df.withWatermark("event_time", delay)


def scan_posts(spark: SparkSession, path_or_table: str, fmt: str = "parquet") -> DataFrame:
    """Read the landed posts table by path, or by catalog name when it has a dot
    and no slash (``ns.posts``)."""
    if "/" not in path_or_table and "." in path_or_table:
        return spark.table(path_or_table)
    if fmt == "parquet":
        return spark.read.schema(POSTS_SCHEMA).parquet(path_or_table)
    return spark.read.format(fmt).load(path_or_table)


def read_expected(spark: SparkSession, path: str) -> DataFrame:
    """One id per line -> a *set* of ids (column ``value``)."""
    return spark.read.text(path).filter(F.col("value") != "").distinct()


def read_fault_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, blank lines skipped."""
    return (spark.read.schema(FAULT_LOG_SCHEMA).option("mode", "PERMISSIVE").json(path)
            .filter(F.col("event").isNotNull()))


def land_raw(stream: DataFrame, collections: tuple[str, ...] = (C.POST_COLLECTION,)) -> DataFrame:
    """Bronze landing: keep the payload unchanged, drop unwanted collections.

    Events without a collection (identity, account) are kept: the collection
    filter is a subscription to collections, not a filter of event kinds.
    The collection is read from the payload with ``get_json_object`` so the
    landed bytes are the bytes received.
    """
    coll = F.get_json_object(F.col("value"), "$.commit.collection")
    # one look at the payload: NULL IN (...) is NULL
    return stream.filter(F.coalesce(coll.isin(*collections), F.lit(True)) if collections else coll.isNull())


def sample_events(raw: DataFrame, n: int = 10) -> DataFrame:
    """Peek n events: time, did[:20], text[:80] with newlines -> spaces.

    An event without a record (identity, account) previews as ''.  Ordered
    by (time_us, did) so the sample is deterministic.
    """
    return (raw.orderBy(F.col("time_us").asc_nulls_last(), F.col("did").asc_nulls_last())
               .limit(n)
               .select(C.event_time_micros("time_us").alias("event_time"),
                       F.substring(F.col("did"), 1, 20).alias("did"),
                       C.preview(F.coalesce(F.col("commit.record.text"), F.lit("")), 80)
                        .alias("text")))
