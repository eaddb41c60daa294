"""Exactly-once reconciliation of marker events (all distributed).

``expected`` is a one-column frame of ids (``value``); ``posts`` is the landed
table.  Nothing is collected: counts are conditional sums over a full outer
join of (expected ids) and (found id, count); the first-10 samples are
ordered top-k queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..schema import RAW_SCHEMA

SAMPLE = 10


def make_markers(spark: SparkSession, n: int, seed: str = "plume") -> DataFrame:
    """n marker events, deterministic ids from md5(seed:id) shaped as UUIDs.

    did 'harness:<uuid>', text 'HARNESS_MARKER_<uuid>', langs ['en'],
    rkey the first 8 characters of the uuid; time_us = the id in seconds
    after 2024-01-01 so the markers form an ordered stream.
    """
    h = F.md5(F.concat(F.lit(seed + ":"), F.col("id").cast("string")))
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
    t_us = F.lit(1_704_067_200_000_000) + F.col("id") * F.lit(5_000)
    created = F.date_format(F.timestamp_micros(t_us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    record = F.struct(F.lit(C.POST_COLLECTION).alias("$type"), created.alias("createdAt"),
                      F.concat(F.lit(C.MARKER_TEXT_PREFIX), F.col("u")).alias("text"),
                      F.array(F.lit("en")).alias("langs"))
    commit = F.struct(F.lit("harness").alias("rev"), F.lit("create").alias("operation"),
                      F.lit(C.POST_COLLECTION).alias("collection"),
                      F.substring(F.col("u"), 1, 8).alias("rkey"), record.alias("record"),
                      F.lit("harness").alias("cid"))
    return (spark.range(n).withColumn("u", uuid)
                 .select(F.concat(F.lit(C.MARKER_DID_PREFIX), F.col("u")).alias("did"),
                         t_us.alias("time_us"), F.lit("commit").alias("kind"),
                         commit.cast(RAW_SCHEMA["commit"].dataType).alias("commit")))


def expected_from_landed(posts: DataFrame) -> DataFrame:
    """Ground truth from what was *committed*: uuid after 'harness:' of the
    landed marker dids (not from the plan)."""
    return (posts.filter(C.is_marker_did("did"))
                 .select(C.uuid_from_did("did").alias("value")).distinct())


def marker_counts(posts: DataFrame) -> DataFrame:
    """Per marker id (text without the prefix): how many rows landed."""
    return (posts.filter(C.is_marker_did("did"))
                 .groupBy(C.marker_uuid_from_text("text").alias("marker_id"))
                 .agg(F.count(F.lit(1)).alias("found")))


def duplicate_markers(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("found") > 1)


def missing_markers(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """expected - found (left anti)."""
    return (expected.select(F.col("value").alias("marker_id")).distinct()
                    .join(counts.select("marker_id"), "marker_id", "left_anti"))


def unexpected_markers(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """found - expected (left anti)."""
    exp = expected.select(F.col("value").alias("marker_id"))
    return counts.select("marker_id").join(exp, "marker_id", "left_anti")


def reconcile(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per id: expected flag, found count and a status in
    ok / missing / duplicate / unexpected."""
    exp = expected.select(F.col("value").alias("marker_id")).distinct() \
                  .withColumn("expected", F.lit(True))
    j = exp.join(counts, "marker_id", "full_outer")
    expected_flag = F.coalesce(F.col("expected"), F.lit(False))
    found = F.coalesce(F.col("found"), F.lit(0)).cast("long")
    status = (F.when(~expected_flag, F.lit("unexpected"))
               .when(found == 0, F.lit("missing"))
               .when(found > 1, F.lit("duplicate"))
               .otherwise(F.lit("ok")))
    return j.select("marker_id", expected_flag.alias("expected"), found.alias("found"),
                    status.alias("status"))


def reconcile_report(rec: DataFrame) -> DataFrame:
    """One row: expected, distinct found, duplicates, missing, unexpected and
    the verdict (PASS iff no duplicate and no missing; unexpected ignored)."""
    s = F.col("status")
    rep = rec.agg(
        F.count_if(F.col("expected")).alias("expected"),
        F.count_if(F.col("found") > 0).alias("distinct_found"),
        F.count_if(s == "duplicate").alias("duplicates"),
        F.count_if(s == "missing").alias("missing"),
        F.count_if(s == "unexpected").alias("unexpected"))
    verdict = F.when((F.col("duplicates") == 0) & (F.col("missing") == 0), F.lit("PASS")) \
               .otherwise(F.lit("FAIL"))
    return rep.withColumn("verdict", verdict)


def first_anomalies(rec: DataFrame, status: str, n: int = SAMPLE) -> DataFrame:
    """The first n ids of one anomaly class, by id (deterministic)."""
    return rec.filter(F.col("status") == status).orderBy("marker_id").limit(n)


def fault_summary(log: DataFrame) -> DataFrame:
    """Scenarios started: (ts, name), one row each."""
    return log.filter(F.col("event") == "scenario_start").select("ts", "name")


FINGERPRINT_BUCKETS = 256


def _row_hashes(df: DataFrame, buckets: int) -> DataFrame:
    """Two 64-bit hashes of every whole row, and its bucket.

    Rows are hashed as JSON with explicit NULLs: a hash over columns skips
    NULLs, so it could not tell (NULL, x) from (x, NULL).
    """
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return (df.withColumn("_row", row)
              .withColumn("_h1", F.xxhash64("_row")).withColumn("_h2", F.xxhash64(F.lit("second"), F.col("_row")))
              .withColumn("_bucket", F.pmod("_h1", F.lit(buckets)).cast("int")).drop("_row"))


def fingerprint(df: DataFrame, buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """Order-free fingerprint of the rows: per bucket their number and the sums of both hashes.

    Sums do not depend on order and add up over tasks, so a task shuffles at
    most one row per bucket, however wide or many its rows are.
    """
    wide = "decimal(38,0)"
    return (_row_hashes(df, buckets).groupBy("_bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_h1").cast(wide)).alias("s1"),
                 F.sum(F.col("_h2").cast(wide)).alias("s2")))


def held_fingerprint(df: DataFrame, buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """The fingerprint worked out now, for more than one comparison: a row per bucket."""
    prints = fingerprint(df, buckets)
    return df.sparkSession.createDataFrame(prints.collect(), prints.schema)


def _json_tells_rows(kind: T.DataType) -> bool:
    """Do equal values of this type always have the same JSON text?  Not where 0.0 = -0.0, nor for
    maps, whose order may differ, or collated strings."""
    if isinstance(kind, T.StructType):
        return all(_json_tells_rows(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _json_tells_rows(kind.elementType)
    return kind == T.StringType() or isinstance(kind, (T.BooleanType, T.IntegralType, T.DateType, T.TimestampType,
                                                       T.BinaryType, T.DecimalType))


def same_multiset(a: DataFrame, b: DataFrame, buckets: int = FINGERPRINT_BUCKETS,
                  prints_a: DataFrame | None = None) -> DataFrame:
    """One row: sizes of both sides and whether they are equal as multisets.

    Where the fingerprints of all buckets agree the sides are equal (up to the
    collision of two independent 64-bit sums).  Where one differs, the sides
    differ, for equal rows have equal JSON and so equal hashes; that is no
    estimate and needs no row compared.  For types whose equal values may have
    different JSON (0.0 and -0.0) the rows of buckets that differ are compared
    exactly, grouped on all columns with a count per side.  ``prints_a``: the
    fingerprint of ``a``, if it is there already.
    """
    spark = a.sparkSession
    fa, fb = prints_a if prints_a is not None else fingerprint(a, buckets), fingerprint(b.select(*a.columns), buckets)
    both = fa.select("_bucket", F.struct("n", "s1", "s2").alias("x")).join(
        fb.select("_bucket", F.struct("n", "s1", "s2").alias("y")), "_bucket", "full_outer")
    rows = both.select("_bucket", F.coalesce("x.n", F.lit(0)).alias("na"), F.coalesce("y.n", F.lit(0)).alias("nb"),
                       F.col("x").eqNullSafe(F.col("y")).alias("same")).collect()  # a row per bucket
    sent, received = sum(r.na for r in rows), sum(r.nb for r in rows)
    differ = [r._bucket for r in rows if not r.same]
    counts = f"{sent}L AS sent", f"{received}L AS received"
    if not differ:
        return spark.range(1).selectExpr(*counts, "true AS match")
    cols = a.columns
    if sent != received or (all(x.dataType == y.dataType for x, y in zip(a.schema, b.select(*cols).schema))
                            and _json_tells_rows(a.schema)):
        return spark.range(1).selectExpr(*counts, "false AS match")
    sides = [_row_hashes(df.select(*cols), buckets).filter(F.col("_bucket").isin(differ)).select(
        *cols, F.lit(ia).alias("_in_a"), F.lit(1 - ia).alias("_in_b")) for df, ia in ((a, 1), (b, 0))]
    per_row = sides[0].unionByName(sides[1]).groupBy(*cols).agg(F.sum("_in_a").alias("na"), F.sum("_in_b").alias("nb"))
    return per_row.agg((F.count_if(F.col("na") != F.col("nb")) == 0).alias("match")).selectExpr(*counts, "match")
