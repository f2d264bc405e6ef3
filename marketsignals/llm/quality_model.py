"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL-proximal updates.

Features are hashed unigrams and bigrams of words, of word shapes (runs of
letters and digits collapsed: ``THE,!!`` is ``A,!!``) and of equal neighbours.
All are n-grams of the text alone.  A score is the sigmoid of a sparse dot
product: counts, divided by the root of the words, times weights.

Training streams at most ``SAMPLE`` labelled documents, chosen by hash (a bound,
not a share), ``EPOCHS`` times in hash order through one task, whose memory is
the model and an Arrow batch.  The model has a fixed size (``BITS``) and is
broadcast.  Scoring covers every row and shuffles nothing.

Defined results: a null or empty text has the bias as its score; a document with
several labels has the smallest; rows with a null doc_id are scored, not trained
on, and not held out; without any label every score is 0.5; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import NON_SPACE, U64, chunks, mix, word_hashes, words

BITS = 18
SAMPLE = 20_000
EPOCHS = 2
THRESHOLD = 0.3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.2, 0.5

# Byte classes of shapes: letters and digits collapse, the rest stands for itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a"):ord("z") + 1] = _SHAPE[128:] = ord("a")
_SHAPE[ord("A"):ord("Z") + 1] = ord("A")
_SHAPE[ord("0"):ord("9") + 1] = ord("0")


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text index of every n-gram occurrence, and the words of each text."""
    starts, _, bounds = words(data, offs, NON_SPACE)
    count = np.diff(bounds)
    doc = np.repeat(np.arange(len(count)), count)
    if not len(starts):
        return np.zeros(0, np.int64), doc, count
    unit = word_hashes(data, starts, NON_SPACE)
    shape = _SHAPE[data]
    first = np.zeros(len(data), bool)
    first[starts] = True
    keep = first.copy()
    keep[1:] |= shape[1:] != shape[:-1]
    keep[1:] |= ~np.isin(shape[1:], np.frombuffer(b"aA0", np.uint8))
    keep &= NON_SPACE[data]
    small = shape[keep]
    forms = word_hashes(small, np.flatnonzero(first[keep]), np.ones(256, bool))
    pair = doc[1:] == doc[:-1]
    same = (unit[1:] == unit[:-1]).astype(U64)
    grams = [mix(unit + U64(1)), mix(forms + U64(2)), mix(unit[:-1] * U64(3) + unit[1:])[pair],
             mix(forms[:-1] * U64(5) + forms[1:])[pair], mix(same + U64(11))[pair]]
    docs = [doc, doc, doc[1:][pair], doc[1:][pair], doc[1:][pair]]
    return (np.concatenate(grams) >> U64(64 - BITS)).astype(np.int64), np.concatenate(docs), count


class Ftrl:
    """FTRL-proximal for logistic loss; the last weight is the bias."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model, size = Ftrl(1 << BITS), 1 << BITS
    for batch in batches:
        labels = batch.column(1).to_numpy()
        for part in chunks(batch.column(0)):
            bucket, doc, count = features(part.data, part.offs)
            order = np.argsort(doc, kind="stable")
            bucket, edge = bucket[order], np.searchsorted(doc[order], np.arange(len(count) + 1))
            for i in range(len(count)):
                at, n = np.unique(bucket[edge[i]:edge[i + 1]], return_counts=True)
                x = n / np.sqrt(max(1, count[i]))
                model.update(np.append(at, size), np.append(x, 1.0), int(labels[part.first + i]))
    yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype(np.float32).tobytes()], pa.binary())], ["weights"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (float32; the last is the bias) learned from rows that are not held out."""
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
             .groupBy(F.col(doc_id).alias("id")).agg(F.min(label).cast("int").alias("label")))
    # The sample is at most ``sample`` rows of two numbers.
    chosen = known.orderBy(F.xxhash64(F.lit(1), "id"), "id").limit(sample)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.select("text", "label", F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"), "id")
    # One task in a fixed order: FTRL is a sequential rule, the rows are bounded, the sort may spill.
    ordered = rows.repartition(1).sortWithinPartitions("epoch", F.xxhash64("epoch", "id"), "id", "text")
    row = ordered.select("text", "label").mapInArrow(_train, "weights binary").first()
    return np.frombuffer(row[0], np.float32) if row else np.zeros((1 << BITS) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row doc_id and score."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def scored(col: pa.Array) -> pa.Array:
        w, out = model.value, np.zeros(len(col))
        for part in chunks(col):
            bucket, doc, count = features(part.data, part.offs)
            dot = np.bincount(doc, w[bucket], len(count)) / np.sqrt(np.maximum(1, count)) + w[-1]
            out[part.first:part.first + len(count)] = 1 / (1 + np.exp(-np.clip(dot, -35, 35)))
        return pa.array(out)

    return docs.select(F.col(doc_id).alias("doc_id"), scored(F.col(text)).alias("score"))


def op7(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    weights = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, weights).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
