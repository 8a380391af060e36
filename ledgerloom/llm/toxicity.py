"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

N-grams of lower-cased UTF-8 bytes are hashed. Over the labelled texts, Spark counts in how many
texts of each class every hashed n-gram occurs; the smoothed log-count ratio of an n-gram is its
scale. The `features` n-grams with the strongest evidence keep a weight, fitted by logistic
regression on the scaled presence of each in a text. Whole texts are scored.

Defined cases: a null or empty text has no n-gram and gets the intercept's score; with no labelled
row, or only one class, every score is the smoothed base rate (0.5 without a label, so every text is then predicted toxic);
a label without a document, or null, counts for nothing; of repeated labels the larger holds; of documents that repeat an
id one is learned from and each is scored; equal texts have equal scores; texts of any length are read whole; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import is_held_out, materialize, text_bytes

SIZES = (3, 4, 5, 6)
BITS = 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass(frozen=True)
class FitBound:
    """Bounds of the labelled sample and of the model. Score 0.3 and above counts as toxic."""

    labelled_rows: int = 20_000
    features: int = 2_000
    least_texts: int = 5
    threshold: float = 0.3


def gram_codes(data: np.ndarray, offsets: np.ndarray, pick: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the hashed n-grams within texts and their texts' numbers. `pick` maps codes to features (-1: drop)."""
    low = LOWER[data].astype(np.uint64)
    ends = offsets[1:]
    grams = low[: max(0, len(low) - SIZES[0] + 1)].copy()
    for k in range(1, SIZES[0]):
        grams = (grams << np.uint64(8)) | low[k : k + len(grams)]
    for n in SIZES:
        if len(low) < n:
            continue
        if n > SIZES[0]:
            grams = (grams[:-1] << np.uint64(8)) | low[n - 1 :]
        h = (grams + np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        code = (h >> np.uint64(64 - BITS)).astype(np.int64)
        if pick is not None:
            code = pick[code]
            at = np.flatnonzero(code >= 0)
            code = code[at]
        else:
            at = np.arange(len(code))
        owner = np.searchsorted(ends, at, side="right")
        inside = at + n <= ends[owner]
        yield code[inside], owner[inside]


def presence(column: pa.Array, pick: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, code) pairs of a column."""
    data, offsets = text_bytes(column)
    keys = [owner.astype(np.int64) << BITS | code for code, owner in gram_codes(data, offsets, pick)]
    pairs = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def labelled_texts(docs: DataFrame, labels: DataFrame, bound: FitBound) -> DataFrame:
    """text and toxic of at most `labelled_rows` labelled ids that are not held out, chosen by their hash; of an id's texts one."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = bound.labelled_rows * (1 << 20) / max(1, known.count())
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * 0.97).limit(bound.labelled_rows)
    one = F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")
    return materialize(docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(one).select("doc_id", "text", "toxic"), "toxic-sample")


def class_counts(sample: DataFrame) -> DataFrame:
    """In how many texts of each class each hashed n-gram occurs: code, clean, toxic; at most 2^BITS rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for start in range(0, batch.num_rows, 32):
                owner, code = presence(batch.column("text").slice(start, 32))
                for k in (0, 1):
                    np.add.at(seen[k], code[toxic[start:][owner] == k], 1)
        at = np.flatnonzero(seen.any(axis=0))
        for start in range(0, len(at), 100_000):
            part = at[start : start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[0, part]), pa.array(seen[1, part])], names=["code", "clean", "toxic"])

    return (
        sample.select("text", "toxic")
        .mapInArrow(count, "code long, clean long, toxic long")
        .groupBy("code")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )


@dataclass(frozen=True)
class Model:
    pick: np.ndarray  # feature of each code, or -1
    weight: np.ndarray  # log-count ratio times fitted weight, by feature
    intercept: float

    def scores(self, column: pa.Array) -> np.ndarray:
        owner, feature = presence(column, self.pick)
        z = np.bincount(owner, weights=self.weight[feature], minlength=len(column)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _logistic(owner, feature, rows, features, y, ridge: float, steps: int = 300, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Full-batch Adam on a sparse 0/1 matrix whose columns are scaled beforehand."""
    w, b = np.zeros(features + 1), np.zeros(1)
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    scale, cols = feature
    for t in range(1, steps + 1):
        z = np.bincount(owner, weights=scale * w[cols], minlength=rows) + w[-1]
        d = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / rows
        g = np.append(np.bincount(cols, weights=scale * d[owner], minlength=features), d.sum())
        g[:-1] += ridge * w[:-1]
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, bound: FitBound = FitBound()) -> Model:
    spark = docs.sparkSession
    sample = labelled_texts(docs, labels, bound)
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    base = float(np.log((n1 + 1) / (n0 + 1)))
    if not n0 or not n1:
        return Model(np.full(1 << BITS, -1, np.int32), np.zeros(1), base)
    ratio = F.log(((F.col("toxic") + 1) / (n1 + 2)) / ((F.col("clean") + 1) / (n0 + 2)))
    seen = F.col("toxic") + F.col("clean")
    pooled = seen / (n0 + n1)
    gap = F.abs(F.col("toxic") / n1 - F.col("clean") / n0)
    strength = gap / F.sqrt(pooled * (1 - pooled) * (1 / n0 + 1 / n1) + 1e-12)  # a two-proportion z score
    best = (
        class_counts(sample)
        .filter(seen >= bound.least_texts)
        .select("code", ratio.alias("ratio"), strength.alias("strength"))
        .orderBy(F.desc("strength"), "code")
        .limit(bound.features)
        .toPandas()
    )
    if best.empty:
        return Model(np.full(1 << BITS, -1, np.int32), np.zeros(1), base)
    pick = np.full(1 << BITS, -1, np.int32)
    pick[best["code"].to_numpy()] = np.arange(len(best))
    shared = spark.sparkContext.broadcast(pick)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, feature = presence(batch.column("text"), shared.value)
            cut = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), lists], names=["doc_id", "toxic", "features"])

    rows = sample.mapInArrow(features, "doc_id long, toxic int, features array<int>").toArrow().sort_by("doc_id")
    lists = rows["features"].combine_chunks()
    cols = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    scale = best["ratio"].to_numpy()
    w, b = _logistic(owner, (scale[cols], cols), len(lists), len(best), rows["toxic"].to_numpy(), ridge=2e-5)
    return Model(pick, scale * w, b)


def score_texts(docs: DataFrame, model: Model, threshold: float = FitBound.threshold) -> DataFrame:
    """doc_id, held_out, score and predicted for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shared.value.scores(batch.column("text").slice(i, 64)) for i in range(0, batch.num_rows, 64)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(np.concatenate(parts or [np.zeros(0)]))], names=["doc_id", "held_out", "score"]
            )

    return (
        docs.select("doc_id", is_held_out("doc_id").alias("held_out"), "text")
        .mapInArrow(score, "doc_id long, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def toxicity(docs: DataFrame, labels: DataFrame, bound: FitBound = FitBound()) -> DataFrame:
    return score_texts(docs, fit(docs, labels, bound), bound.threshold)


__all__ = ["FitBound", "Model", "class_counts", "fit", "score_texts", "toxicity"]
