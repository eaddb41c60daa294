"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.session import scratch_path

#: A word: a run of anything but ASCII white space.  Fixed by the contracts.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BREAK = r"[\x20\x09-\x0D]+"

BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows: a batch of whole texts stays a few MB in each worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation above this point)
    and gives later joins a real size for their broadcast decision.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, name) + "/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int, lists: str | None = None) -> DataFrame:
    """Hint a broadcast only for a staged table that is counted to be small.

    ``lists`` names an array column whose entries count as rows.
    """
    rows = df.count() if lists is None else df.agg(
        F.count("*") + F.coalesce(F.sum(F.size(lists)), F.lit(0))).first()[0]
    return F.broadcast(df) if rows <= max_rows else df
