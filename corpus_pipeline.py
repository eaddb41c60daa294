"""Corpus pipeline: documents -> quality rules -> line dedup -> near-dedup -> decontamination -> mix.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  All but the last return the columns of ``documents``; the last returns
how many words of each document the mix takes.  ``run`` writes every stage's
result to the shared checkpoint folder, so a lost executor costs one stage at
most and nothing is computed twice.

Defined results: NULL or empty texts fail the base quality rules and go first.
A NULL doc_id is linked with nothing; NULL lang or source is a group of its own.
Of rows that repeat whole, one goes on from the near-duplicate stage.  Documents
that the line stage leaves empty without being copies go on and are taken 0
times.  Empty tables give empty results, with the columns of each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.llm import decontaminate, line_dedup, mixing, near_dup, quality_rules
from plume.llm.tables import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand earlier in the corpus; n_chars follows the text."""
    out = line_dedup.without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, compared twice: as they stand in ``documents``, and as they are now.

    The line stage has taken the lines that copies share out of all but the
    first of them; their whole texts tell which are copies, so no remnant of one
    goes on as a document.  What the line stage left of the others may be
    near-duplicates that their whole texts were not: texts that differ by lines
    which stand elsewhere too.
    """
    return near_dup.drop_near_dups(near_dup.drop_copies(docs, table(spark, sf_dir, "documents")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", mix),
]

#: Near-duplicates, edit distances and dependent rounding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
