"""Toxicity by a linear classifier on character n-grams scaled by log-count ratios (operator 8).

Texts, A-Z lower-cased, are read as overlapping n-grams of code points, hashed into buckets. Over the labelled
sample each bucket gets its naive Bayes log-count ratio (document counts, smoothed); the buckets that
tell the classes apart best are kept, and a logistic model is fitted on which of them a text has, each
scaled by its ratio. Every whole text is scored, in pieces that overlap by an n-gram.

The model learns from at most SAMPLE labelled documents (those of smallest hash of the id); where rows
share a labelled id, the text of smallest hash counts, so no more rows than that are gathered.

Defined cases: null text counts as empty; bytes that aren't UTF-8 read as the replacement character; an empty text gets the model's intercept; a null doc_id is
scored but never labelled, and counts as held out like the ids of the remainder; repeated rows are
rows; without labels of both classes the score is the share of toxic labels (0 without any); empty
tables give no rows; other columns don't matter and never enter a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.llm.common import by_batch, column, id_and_text, raw
from molspark.session import materialised, shuffle_partitions

ORDERS = (4, 5, 6, 7, 8)
BUCKET_BITS = 21
BUCKETS = 1 << BUCKET_BITS
KEPT = 4_096
SAMPLE = 12_000
SMOOTH = 1.0
PIECE = 1 << 20
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
NONE = np.zeros(0, np.uint32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(True))


def buckets_of(text: bytes | None):
    """Bucket numbers of all n-grams of the whole text, piece by piece."""
    characters = (b" " + (text or b"").lower() + b" ").decode("utf-8", "replace")
    longest = max(ORDERS)
    for at in range(0, len(characters), PIECE):
        a = np.frombuffer(characters[at : at + PIECE + longest - 1].encode("utf-32-le"), np.uint32)
        h = a.copy()
        for n in range(2, longest + 1):
            if len(a) < n:
                break
            h = h[: len(a) - n + 1] * np.uint32(0x01000193) + a[n - 1 :]
            if n in ORDERS:
                yield ((h ^ np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


def present(text: bytes | None, place: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Which kept buckets the text has; `place` gives a bucket's place or the last place for none."""
    mark[:] = False
    for h in buckets_of(text):
        mark[place[h]] = True
    return np.flatnonzero(mark[:-1])


def _sampled(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    picked = (
        labels.select(column(labels, "doc_id", "bigint").alias("doc_id"), column(labels, label, "int").alias("y"))
        .where("doc_id IS NOT NULL AND y IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    known = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit(""))).join(F.broadcast(picked), "doc_id")
    one = known.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    # Dealt anew: adaptive execution would leave so small a table in one task.
    return materialised(one.repartition(shuffle_partitions(docs.sparkSession), "doc_id").select("text", "y"))


class Model:
    """Weights by bucket place; picklable and small."""

    def __init__(self, place: np.ndarray, weights: np.ndarray, intercept: float):
        self.place, self.weights, self.intercept = place, weights, intercept
        self.mark = np.zeros(len(weights) + 1, bool)

    def __call__(self, text: bytes | None) -> float:
        z = self.intercept + self.weights[present(text, self.place, self.mark)].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _logistic(rows: np.ndarray, places: np.ndarray, values: np.ndarray, y: np.ndarray, ridge: float, rounds: int, rate: float = 0.02):
    """Weights and intercept by adaptive gradient steps; rows and places are a sparse matrix of ones."""
    width = len(values)
    w, b = np.zeros(width), float(np.log(y.mean() / (1 - y.mean())))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for k in range(1, rounds + 1):
        z = np.bincount(rows, (w * values)[places], len(y)) + b
        off = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        slope = values * np.bincount(places, off[rows], width) + ridge * w
        gradient = np.append(slope, off.sum()) / len(y)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient * gradient
        step = rate * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
        w, b = w - step[:-1], b - float(step[-1])
    return w, b


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, ridge: float = 1.0, rounds: int = 200) -> Model:
    """Two passes over the labelled sample: counts by bucket, then which kept buckets each text has."""
    rows = _sampled(docs, labels, label, sample)

    def counting():
        def work(batch: pa.RecordBatch) -> dict | None:
            counts = np.zeros((2, BUCKETS), np.int32)
            y = batch.column(1).to_pylist()
            for text, toxic in zip(raw(batch, "text"), y):
                counts[toxic, np.unique(np.concatenate([*buckets_of(text), NONE]))] += 1
            seen = np.flatnonzero(counts.any(0))
            # One more row, of bucket -1, counts the texts themselves.
            return {
                "bucket": np.r_[-1, seen],
                "toxic": np.r_[sum(y), counts[1, seen]],
                "other": np.r_[len(y) - sum(y), counts[0, seen]],
            }

        return work

    counted = materialised(
        by_batch(rows, "bucket bigint, toxic bigint, other bigint", counting)
        .groupBy("bucket")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    )
    texts = counted.where("bucket < 0").first()
    pos, neg = (texts["toxic"], texts["other"]) if texts else (0, 0)
    if not pos or not neg:
        share = 1 - 1e-6 if pos else 1e-6
        return Model(np.zeros(BUCKETS, np.int16), np.zeros(0), float(np.log(share / (1 - share))))
    p, q = (F.col("toxic") + SMOOTH) / (pos + 2 * SMOOTH), (F.col("other") + SMOOTH) / (neg + 2 * SMOOTH)
    both = (F.col("toxic") + F.col("other") + SMOOTH) / (pos + neg + 2 * SMOOTH)
    # How far the share of toxic texts with the bucket is from that of the others, in deviations.
    apart = F.abs(p - q) / F.sqrt(both * (1 - both) * (1 / pos + 1 / neg))
    best = (
        counted.where("bucket >= 0")
        .select("bucket", F.log(p / q).alias("ratio"), apart.alias("apart"))
        .orderBy(F.col("apart").desc(), "bucket")
        .limit(KEPT)
        .collect()
    )
    best.sort(key=lambda r: r["bucket"])
    values = np.array([r["ratio"] for r in best])
    place = np.full(BUCKETS, len(best), np.int16)
    place[[r["bucket"] for r in best]] = np.arange(len(best))
    placed = docs.sparkSession.sparkContext.broadcast(place)

    width = len(values)

    def showing():
        mark, table = np.zeros(KEPT + 1, bool), placed.value

        def work(batch: pa.RecordBatch) -> dict:
            mark[:] = False
            return {"y": batch.column(1), "places": [present(x, table, mark[: width + 1]).tolist() for x in raw(batch, "text")]}

        return work

    seen = by_batch(rows, "y int, places array<int>", showing).collect()
    seen.sort(key=lambda r: (r[0], r[1]))
    y = np.array([r[0] for r in seen], float)
    at = np.repeat(np.arange(len(seen)), [len(r[1]) for r in seen])
    places = np.concatenate([np.array(r[1], np.int32) for r in seen])
    w, b = _logistic(at, places, values, y, ridge, rounds)
    return Model(place, w * values, b)


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **how))

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0), "score": [model.value(t) for t in raw(batch, "text")]}

        return work

    return by_batch(id_and_text(docs), "doc_id bigint, score double", make).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
