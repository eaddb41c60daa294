"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
text.  A text is compressed with each, in pieces of ``PIECE`` bytes so that the
dictionary matters as much at the end of a long text as at its start.  The
difference ``bad - good`` of the compressed sizes, normalised by the text's own
size, is turned into a probability by a logistic curve fitted on labelled rows that
built no dictionary.

The fit reads at most ``MAX_FIT_ROWS`` labelled documents per class (a fixed
pseudo-random choice among those that stand in the table with text), of texts
above ``MAX_FIT_BYTES`` whole pieces from all over the text, and only documents
whose crc32(doc_id) mod 5 is not 0.  Scoring reads every whole text in one
Arrow pass, without shuffle; the two dictionaries (``DICT_BYTES`` each) are all
that is broadcast.

Defined results: NULL and empty texts have difference 0 and get the curve's value
there.  Labels that are NULL or not 0/1 are not used; a document labelled
both ways counts as bad; repeated doc_ids are used once.  Without labels of
both classes every score is 0.5.  Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_batches

MAX_FIT_ROWS = 1500
MAX_FIT_BYTES = 40_000
DICT_BYTES = 64 * 1024
PIECE = 4096
LEVEL = 3
FOLDS = 5
LEAST_SCORE = 0.3    #: fixed value: predicted 1 from here on


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0


def fit_rows(docs: DataFrame, labels: DataFrame) -> list[tuple[bytes, int]]:
    """The bounded labelled sample: (text, quality), in a fixed order."""
    one = (labels.where("doc_id is not null and quality in (0, 1)").where(~held_out())
           .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    texts = (docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
             .where(F.octet_length("text") > 0))
    one = one.join(texts.select("doc_id"), "doc_id", "left_semi")
    picks = [one.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_FIT_ROWS)
             for q in (0, 1)]
    ids = F.broadcast(picks[0].unionByName(picks[1]))  # 2 * MAX_FIT_ROWS rows at most
    size, n = F.octet_length("text"), MAX_FIT_BYTES // PIECE
    last = F.ceil(size / PIECE) - 1
    spread = F.concat(*[F.substr("text", (F.floor(last * k / (n - 1)) * PIECE + 1).cast("int"), F.lit(PIECE))
                        for k in range(n)])
    rows = (texts.join(ids, "doc_id")
            .select("doc_id", "quality", F.when(size > MAX_FIT_BYTES, spread).otherwise(F.col("text")).alias("text"))
            .groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
            .select(F.xxhash64("doc_id").alias("k"), "doc_id", "text", "quality").collect())
    return [(bytes(r["text"]), r["quality"]) for r in sorted(rows, key=lambda r: (r["k"], r["doc_id"]))]


def pieces(text: bytes) -> list[bytes]:
    return [text[i:i + PIECE] for i in range(0, len(text), PIECE)]


def dictionary(texts: list[bytes]) -> bytes:
    """A dictionary from these texts; raw content where there are too few to train on."""
    parts = [p for t in texts for p in pieces(t)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, parts, k=200, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICT_BYTES:]


def compressors(dicts: tuple[bytes, bytes]) -> list:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    made = [zstandard.ZstdCompressionDict(d) for d in dicts]
    for d in made:
        d.precompute_compress(compression_params=params)
    return [zstandard.ZstdCompressor(dict_data=d, compression_params=params) for d in made]


def difference(text: bytes, made: list) -> float:
    """Difference of the compressed sizes per byte of text; above 0 the good dictionary fits better."""
    parts = pieces(text)
    return sum(len(made[0].compress(p)) - len(made[1].compress(p)) for p in parts) / len(text) if text else 0.0


def logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Slopes and, last, offset of the calibration curve: Newton steps with a slight ridge."""
    scale = np.append(np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0), 1.0)
    z = np.column_stack([x, np.ones(len(x))]) / scale
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + 1e-2 * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return (w / scale).tolist()


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Dictionaries and curve: {"dicts": (bad, good), "curve"}."""
    rows = fit_rows(docs, labels)
    sides = [[t for t, q in rows if q == k] for k in (0, 1)]
    if not all(len(s) > 1 for s in sides):
        return {"dicts": None, "curve": [0.0, 0.0]}
    # two thirds build the dictionaries, every third row fits the curve
    dicts = tuple(dictionary([t for i, t in enumerate(s) if i % 3]) for s in sides)
    made = compressors(dicts)
    spare = [[t for i, t in enumerate(s) if i % 3 == 0] for s in sides]
    x = np.array([[difference(t, made)] for s in spare for t in s])
    y = np.array([k for k, s in enumerate(spare) for _ in s], float)
    return {"dicts": dicts, "curve": logistic(x, y)}


def sigmoid(v: float) -> float:
    return 1 / (1 + math.exp(-v)) if v >= 0 else math.exp(v) / (1 + math.exp(v))


def scores(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score and the size difference for every row of ``docs``."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        made = compressors(m["dicts"]) if m["dicts"] else None
        for batch in batches:
            d = [difference((t.as_py() or "").encode(), made) if made else 0.0 for t in batch.column(1)]
            slope, offset = m["curve"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([sigmoid(slope * v + offset) for v in d], pa.float64()),
                 pa.array(d, pa.float64())], names=["doc_id", "score", "difference"])

    return docs.select("doc_id", docs["text"].cast("string")).mapInArrow(
        run, "doc_id long, score double, difference double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = scores(docs, fit(docs, labels))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"), "difference")
