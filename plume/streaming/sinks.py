"""Streaming sinks.

* ``sink_posts``: append-only sink of posts_flat into the landed posts table.
  Exactly once: the file sink commits each micro-batch in its own log,
  keyed by the batch id, and the checkpoint binds that id to the source
  offsets, so a restart neither loses nor repeats a batch.
* ``UpdateSink``: the writer for update-mode views.  Parquet takes no updates, so
  a micro-batch's rows are one partition of one table, and readers take the
  newest row of each key.  On a table format, ``merge_batch`` updates in place.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..schema import POSTS_DDL

COMMIT_INTERVAL = "60 seconds"
PARQUET_CODEC = "zstd"   #: of the landed tables, which hold whole texts


def _trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def ensure_posts_table(spark: SparkSession, name: str, location: str | None = None,
                       fmt: str = "parquet", partition_by_day: bool = False) -> None:
    """CREATE TABLE IF NOT EXISTS with the 6 nullable post columns."""
    part = ""
    ddl = POSTS_DDL
    if partition_by_day:
        ddl += ", event_date DATE"
        part = " PARTITIONED BY (event_date)"
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {fmt}{part}{loc}")


def sink_posts(flat: DataFrame, path: str, checkpoint: str, trigger: str | None = COMMIT_INTERVAL,
               fmt: str = "parquet", table: str | None = None,
               query_name: str | None = None, partition_by_day: bool = False) -> StreamingQuery:
    """Append posts_flat rows to a Parquet path (or an existing table).

    ``partition_by_day`` adds ``event_date`` and partitions the files by it,
    so date-bounded marts read only the days they need.
    """
    if partition_by_day:
        flat = flat.withColumn("event_date", F.to_date("event_time"))
    w = (flat.writeStream.outputMode("append").format(fmt)
             .option("checkpointLocation", checkpoint))
    if fmt == "parquet":
        w = w.option("compression", PARQUET_CODEC)
    if partition_by_day:
        w = w.partitionBy("event_date")
    if query_name:
        w = w.queryName(query_name)
    w = _trigger(w, trigger)
    if table:
        return w.toTable(table)
    return w.option("path", path).start()


class UpdateSink:
    """Update-mode rows of a keyed view: one Parquet table, a partition per micro-batch.

    A batch is written by a dynamic overwrite of its own ``batch_id`` partition, so
    a replayed batch replaces itself and a write that fails changes nothing.  A
    reader takes the row of the largest ``batch_id`` per key.
    """

    def __init__(self, path: str, keys: list[str]):
        self.path, self.keys, self.schema = path.rstrip("/"), keys, None

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.path))

    def start(self, view: DataFrame, checkpoint: str, trigger: str | None = None,
              query_name: str | None = None) -> StreamingQuery:
        self.schema = view.schema
        w = (view.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                 .foreachBatch(self.write_batch))
        if query_name:
            w = w.queryName(query_name)
        return _trigger(w, trigger).start()

    def read(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        """The newest row of every key; with a schema (given, or of the view that was started), a view
        that has written nothing yet is empty."""
        schema = schema or self.schema
        if schema is None:
            versions = spark.read.parquet(self.path)
        else:
            try:
                versions = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])) \
                    .parquet(self.path)
            except AnalysisException as ex:
                if ex.getCondition() != "PATH_NOT_FOUND":
                    raise
                return spark.createDataFrame([], schema)
        values = [c for c in versions.columns if c not in self.keys and c != "batch_id"]
        newest = versions.groupBy(*self.keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("v"))
        return newest.select(*self.keys, *[F.col(f"v.{c}").alias(c) for c in values])


def merge_statement(table: str, keys: list[str], source: str) -> str:
    """Upsert of the rows of the view ``source`` into ``table`` by key (NULL keys match)."""
    on = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    return (f"MERGE INTO {table} t USING {source} s ON {on} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def merge_batch(table: str, keys: list[str]):
    """``foreachBatch`` writer for a table whose format takes MERGE (none is bundled here)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.createOrReplaceTempView("plume_updates")
        df.sparkSession.sql(merge_statement(table, keys, "plume_updates"))
    return write


def write_expected(ids: DataFrame, path: str) -> None:
    """Ground-truth file, one id per line, from the *committed* marker ids
    (e.g. ``reconcile.expected_from_landed``), written by the executors."""
    ids.select(F.col(ids.columns[0]).cast("string").alias("value")) \
       .write.mode("overwrite").text(path)


def materialize(df: DataFrame, name: str, kind: str = "table",
                path: str | None = None) -> DataFrame:
    """Staging models become views, marts become tables (full refresh)."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "table":
        w = df.write.mode("overwrite").format("parquet")
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
        return spark.table(name)
    raise ValueError(f"unknown materialization {kind!r}")
