"""Language identification by a byte convolutional network.

Bytes are embedded, convolved with filters of several widths, max-pooled over a fixed-length window
and classified by a softmax layer. The network is small and trained in numpy with Adam on windows of
labelled text; a text is scored over all its windows, whose log-probabilities are averaged.

For scoring, embedding and convolution are folded into tables: a filter's response to a byte pair is
a row of a 65,536-row table, so a width-4 filter is two look-ups. The result is the network's own.

Defined cases: a null text or one without any letter is `und` with score 0; with no labelled row at
all every text is `und`; ties go to the smaller language name; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_crc, is_held_out, materialize, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
UNDETERMINED = "und"


@dataclass(frozen=True)
class TrainingBound:
    """Bounds of the labelled sample that the network is fitted on: rows of each language, and rows of all together.

    Every labelled language is learned; where there are more than rows / per_language of them, each gets an equal share."""

    per_language: int = 500
    rows: int = 50_000
    windows_per_text: int = 3


def labelled_sample(docs: DataFrame, bound: TrainingBound = TrainingBound()) -> pd.DataFrame:
    """At most `per_language` rows of each language, those whose ids hash lowest; columns lang, w0, w1, ..."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out("doc_id"))
    counts = materialize(known.groupBy(F.col("lang").alias("lang")).agg(F.count(F.lit(1)).alias("n")), "langid-counts")
    each = min(bound.per_language, max(1, bound.rows // max(1, counts.count())))
    # Twice the share by hash, so that hardly more than the sample is sorted; the order decides the rest.
    shares = F.broadcast(counts.select("lang", (F.lit(2.0 * each * (1 << 20)) / F.col("n") + 64).alias("share")))  # a row for each language
    chosen = known.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))).join(shares, "lang").filter(F.col("place") < F.col("share"))
    length = F.char_length("text")
    pieces = [
        F.substring("text", (F.lit(1) + F.floor(F.greatest(length - WINDOW, F.lit(0)) * (i / max(1, bound.windows_per_text - 1)))).cast("int"), F.lit(WINDOW)).alias(f"w{i}")
        for i in range(bound.windows_per_text)
    ]
    windows = [f"w{i}" for i in range(bound.windows_per_text)]
    first = Window.partitionBy("lang").orderBy("place", "doc_id", *windows)
    one = chosen.select("lang", "doc_id", "place", *pieces).groupBy("lang", "doc_id", "place").agg(F.min(F.struct(*windows)).alias("one"))  # one row an id
    rows = one.select("lang", "doc_id", "place", "one.*").withColumn("n", F.row_number().over(first)).filter(F.col("n") <= each)
    return rows.toPandas().sort_values(["lang", "n"], kind="stable")[["lang", *windows]]


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts as rows of WINDOW bytes, zero-padded at each text's end; and each row's text.

    A window begins with the last bytes of the one before it, so that no filter misses bytes across an edge."""
    shared = max(WIDTHS) - 1
    step = WINDOW - shared
    per = np.maximum(1, -(-(np.diff(offsets) - shared) // step))
    owner = np.repeat(np.arange(len(per)), per)
    begin = offsets[:-1][owner] + step * (np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per))
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[begin].copy()
    rows[np.arange(WINDOW) >= (offsets[1:][owner] - begin)[:, None]] = 0
    return rows, owner


class ByteCNN:
    def __init__(self, languages: list[str], seed: int = 6):
        rng = np.random.default_rng(seed)
        self.languages = languages
        n = FILTERS * len(WIDTHS)
        self.p = {
            "emb": rng.normal(0, 0.3, (256, EMBEDDING)).astype(np.float32),
            "conv": rng.normal(0, 0.25, (max(WIDTHS), EMBEDDING, n)).astype(np.float32),
            "bias": np.zeros(n, np.float32),
            "out": rng.normal(0, 0.3, (n, len(languages))).astype(np.float32),
            "out_bias": np.zeros(len(languages), np.float32),
        }
        # Filters of a smaller width have no weights at the later places.
        self.mask = np.zeros((max(WIDTHS), 1, n), np.float32)
        for k, width in enumerate(WIDTHS):
            self.mask[:width, :, k * FILTERS : (k + 1) * FILTERS] = 1
        self.p["conv"] *= self.mask

    def _pooled(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        p = self.p
        x = p["emb"][rows]
        places = rows.shape[1] - max(WIDTHS) + 1
        z = sum(x[:, o : o + places] @ p["conv"][o] for o in range(max(WIDTHS))) + p["bias"]
        at = z.argmax(axis=1)
        top = np.take_along_axis(z, at[:, None, :], axis=1)[:, 0]
        return x, at, top, np.maximum(top, 0)

    def fit(self, rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, epochs: int = 5, batch: int = 64, rate: float = 0.006, seed: int = 6) -> "ByteCNN":
        rng, p = np.random.default_rng(seed), self.p
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for start in range(0, len(order), batch):
                pick = order[start : start + batch]
                r, y, w = rows[pick], labels[pick], weights[pick]
                x, at, top, hidden = self._pooled(r)
                logits = hidden @ p["out"] + p["out_bias"]
                prob = np.exp(logits - logits.max(axis=1, keepdims=True))
                prob /= prob.sum(axis=1, keepdims=True)
                prob[np.arange(len(y)), y] -= 1
                d = prob * (w / w.sum())[:, None]
                g = {"out": hidden.T @ d, "out_bias": d.sum(axis=0)}
                dh = (d @ p["out"].T) * (top > 0)
                g["bias"] = dh.sum(axis=0)
                g["conv"], g["emb"] = np.zeros_like(p["conv"]), np.zeros_like(p["emb"])
                for o in range(max(WIDTHS)):  # only the place of the maximum gets a gradient
                    xo = np.take_along_axis(x, (at + o)[:, :, None], axis=1)
                    g["conv"][o] = np.einsum("bne,bn->en", xo, dh)
                    np.add.at(g["emb"], np.take_along_axis(r, at + o, axis=1), dh[:, :, None] * p["conv"][o].T[None])
                g["conv"] *= self.mask
                step += 1
                for k in p:
                    m, v = moments[k]
                    m += 0.1 * (g[k] - m)
                    v += 0.001 * (g[k] ** 2 - v)
                    p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
        return self

    def folded(self) -> "FoldedCNN":
        p = self.p
        place = [p["emb"] @ p["conv"][o] for o in range(4)]  # a byte's part at each place of a filter
        pairs = [(place[o][:, None, :] + place[o + 1][None, :, :]).reshape(65536, -1) for o in (0, 2)]
        return FoldedCNN(self.languages, pairs[0] + p["bias"], pairs[1], p["out"], p["out_bias"])


@dataclass(frozen=True)
class FoldedCNN:
    languages: list[str]
    first: np.ndarray
    second: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Of each language, for each window."""
        hidden = np.empty((len(rows), self.first.shape[1]), np.float32)
        for start in range(0, len(rows), 32):  # a slice that stays in the processor's cache
            part = rows[start : start + 32].astype(np.intp)
            pair = part[:, :-1] * 256 + part[:, 1:]
            z = self.first.take(pair[:, :-2], axis=0)
            z += self.second.take(pair[:, 2:], axis=0)
            z.max(axis=1, out=hidden[start : start + 32])
        logits = np.maximum(hidden, 0) @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def train(sample: pd.DataFrame, seed: int = 6) -> ByteCNN | None:
    languages = sorted(sample["lang"].unique())
    if not languages:
        return None
    code = {x: i for i, x in enumerate(languages)}
    rows, labels = [], []
    for i in range(sample.shape[1] - 1):
        data, offsets = text_bytes(pa.array(sample[f"w{i}"], pa.string()))
        window, owner = windows_of(data, offsets)
        keep = np.diff(owner, prepend=-1) > 0  # the first WINDOW bytes of each sampled piece
        rows.append(window[keep])
        labels.append(sample["lang"].map(code).to_numpy()[owner[keep]])
    rows, labels = np.concatenate(rows), np.concatenate(labels)
    if rows.shape[0] > 1:  # short ends of texts are scored as well, so some rows are learned cut short
        cut = rows[::4].copy()
        cut[:, WINDOW // 4 :] = 0
        rows, labels = np.concatenate([rows, cut]), np.concatenate([labels, labels[::4]])
    counts = np.bincount(labels, minlength=len(languages))
    return ByteCNN(languages, seed).fit(rows, labels, (1.0 / np.maximum(counts, 1))[labels].astype(np.float32), seed=seed)


def _classify(net: FoldedCNN, text: pa.Array, lettered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The language and score of each text; windows are built for few texts at a time."""
    names = np.array(net.languages, dtype=object)
    total = np.zeros((len(text), len(names)))
    for begin in range(0, len(text), 256):
        data, offsets = text_bytes(text.slice(begin, 256))
        window, owner = windows_of(data, offsets)
        for start in range(0, len(window), 4096):
            part = slice(start, start + 4096)
            np.add.at(total, begin + owner[part], net.log_probabilities(window[part]))
        total[begin : begin + 256] /= np.bincount(owner, minlength=len(offsets) - 1)[:, None]
    prob = np.exp(total - total.max(axis=1, keepdims=True))
    prob /= prob.sum(axis=1, keepdims=True)
    return np.where(lettered, names[prob.argmax(axis=1)], UNDETERMINED), np.where(lettered, prob.max(axis=1), 0.0)


def _lettered(text_col: str):
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def predict_languages(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score of each row."""
    if model is None:
        return docs.select(id_col, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    folded = docs.sparkSession.sparkContext.broadcast(model.folded())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, prob = _classify(folded.value, batch.column(1), batch.column(2).to_numpy(zero_copy_only=False).astype(bool))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(prob)], names=[id_col, "lang_pred", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col, _lettered(text_col).alias("__lettered")).mapInArrow(score, f"`{id_col}` {id_type}, lang_pred string, score double")


def keep_languages(docs: DataFrame, model: ByteCNN | None, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose language is determined with at least this score, all columns as they were.

    Without a model (no labelled row) nothing can be refused, so all rows stay. Only texts go through Python."""
    if model is None:
        return docs
    folded = docs.sparkSession.sparkContext.broadcast(model.folded())

    @F.arrow_udf("boolean")
    def confident(text: pa.Array, lettered: pa.Array) -> pa.Array:
        best, prob = _classify(folded.value, text, lettered.to_numpy(zero_copy_only=False).astype(bool))
        return pa.array((best != UNDETERMINED) & (prob >= least_score))

    return docs.filter(confident(F.col(text_col), _lettered(text_col)))


def identify(docs: DataFrame, bound: TrainingBound = TrainingBound()) -> DataFrame:
    """Train on the labelled rows of `docs` that are not held out, then predict every row."""
    return predict_languages(docs, train(labelled_sample(docs, bound))).withColumn("held_out", is_held_out("doc_id"))


__all__ = ["ByteCNN", "TrainingBound", "id_crc", "identify", "keep_languages", "labelled_sample", "predict_languages", "train"]
