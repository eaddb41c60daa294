"""What one stage of the pipeline leaves decides what the next one does; suspect lines are cut out where they stand."""
import corpus_pipeline
from pyspark.sql import functions as F

from plume.llm import line_dedup


def _words(k, n):
    return " ".join(f"w{k}x{i}" for i in range(n))


def test_near_duplicate_stage_compares_what_the_line_stage_left(spark, tmp_path):
    """Two documents that differ by long lines which stand in an earlier one are copies once those are gone."""
    common = [_words(f"c{j}", 60) for j in range(4)]
    body = _words("body", 50)
    texts = {1: "\n".join(common), 2: "\n".join([common[0], common[1], body]), 3: "\n".join([common[2], common[3], body + " end"]),
             4: _words("other", 80)}
    docs = spark.createDataFrame([(k, t, "en", "web", len(t)) for k, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    before = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in before.collect()) == [1, 2, 3, 4]
    left = corpus_pipeline.lines(spark, docs, str(tmp_path))
    after = corpus_pipeline.near_duplicates(spark, left, str(tmp_path))
    assert sorted(r.doc_id for r in after.collect()) == [1, 2, 4]


def test_line_texts_are_those_of_their_hashes(spark):
    texts = [(None, "naïve line that is long enough ☂\n\nsecond line of the first text here"),
             (7, "short\nthird line, which is also long enough\n"), (7, "short\nthird line, which is also long enough\n"),
             (8, "fourth line: 𝔘𝔫𝔦𝔠𝔬𝔡𝔢 outside the basic plane")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    slim = docs.select(line_dedup._key(), "doc_id", "text")
    places = slim.mapInArrow(line_dedup._places, "h1 long, h2 long, doc_id long, _ld_k long, line long")
    first = places.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "_ld_k", "line")).alias("place"))
    got = {(r.h1, r.h2): r.line_text for r in line_dedup.line_texts(slim, first).collect()}
    long_lines = {x for _, t in texts for x in t.split("\n") if len(x) >= line_dedup.MIN_CHARS}
    assert set(got.values()) == long_lines and len(got) == first.count() == 4
