"""Data-quality and health checks as Spark jobs.

Each check returns rows (model, column, test, failures, passed); several
checks over one frame are folded into a single ``agg`` pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ["model", "column", "test", "failures", "passed"]


def _rows(model: str, results: list[tuple[str, str, Column]], df: DataFrame) -> DataFrame:
    """Evaluate all failure counts in one pass, then unpivot to one row each."""
    aggs = [expr.cast("long").alias(f"f{i}") for i, (_, _, expr) in enumerate(results)]
    one = df.agg(*aggs)
    stacked = F.inline(F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(col).alias("column"),
                 F.lit(test).alias("test"), F.col(f"f{i}").alias("failures"))
        for i, (col, test, _) in enumerate(results)]))
    return one.select(stacked).withColumn("passed", F.col("failures") == 0)


def not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """failures = rows where the column IS NULL."""
    return _rows(model, [(c, "not_null", F.count_if(F.col(c).isNull())) for c in columns], df)


def expression_is_true(df: DataFrame, model: str, column: str, expression: str) -> DataFrame:
    """failures = rows where NOT (column <expression>); NULL counts as a pass."""
    cond = F.expr(f"`{column}` {expression}")
    return _rows(model, [(column, f"expression_is_true {expression}",
                          F.count_if(~cond))], df)


def checks(df: DataFrame, model: str, not_null_columns: list[str] = (),
           expressions: list[tuple[str, str]] = ()) -> DataFrame:
    """The not_null and expression_is_true tests of one model in one pass over it."""
    tests = [(c, "not_null", F.count_if(F.col(c).isNull())) for c in not_null_columns]
    tests += [(c, f"expression_is_true {e}", F.count_if(~F.expr(f"`{c}` {e}"))) for c, e in expressions]
    return _rows(model, tests, df)


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """failures = number of values that occur more than once (NULLs ignored)."""
    dup = (df.filter(F.col(column).isNotNull()).groupBy(column).count()
             .filter(F.col("count") > 1))
    return _rows(model, [(column, "unique", F.count(F.lit(1)))], dup)


def recent_events(raw: DataFrame, as_of: Column, seconds: int = 30) -> DataFrame:
    """Freshness: did anything arrive in the last ``seconds`` before as_of?"""
    newest = F.max("event_time")
    bound = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))
    return raw.agg(newest.alias("newest_event"),
                   F.coalesce(newest >= bound, F.lit(False)).alias("passed"))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per named view: (view, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
                 F.lit(name).alias("view"), "row_count") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sink_files(df: DataFrame) -> DataFrame:
    """Per file behind a file-backed table: path, size and rows, from the scan's hidden metadata."""
    return (df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
              .groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("rows")))


def sink_file_count(df: DataFrame) -> DataFrame:
    """One row: Parquet files behind a file-backed table, their rows, and rows of the smallest and largest."""
    return sink_files(df).agg(F.count(F.lit(1)).alias("parquet_file_count"),
                              F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
                              F.min("rows").alias("least_rows"), F.max("rows").alias("most_rows"))


def topic_offsets(landed: DataFrame) -> DataFrame:
    """Per partition of the landed raw topic: latest offset and depth."""
    return (landed.groupBy("partition")
                  .agg(F.max("offset").alias("latest_offset"),
                       F.count(F.lit(1)).alias("messages")))
