"""Importance resampling of documents towards a target corpus, by hashed word runs.

Features of a text are its runs of one and two words, hashed into buckets. They are written once, as packed little-endian
uint16 streams of whole documents with the places at which documents begin. Counting reads the streams block by block,
sorts each and run-length encodes it; a task sums the runs over its blocks, so that it sends one row a bucket at most. The
gains of all buckets, a table of a fixed size, then go to the tasks, which gather them along the streams and add them up by
document (`np.add.reduceat`). Documents are drawn by the largest sums of weight and Gumbel noise.

A bigram's crc32 follows from its words': crc(a + ' ' + b) = crc(a + ' ') moved on by len(b) bytes, xor crc(b).

Defined cases: a null text, or one without words, has no features and weight 0; a null id counts as one without digits and
loses ties; rows that repeat an id and a text have equal scores and are drawn as rows of their own; without a target row all
gains follow from zero counts; an empty table gives no rows; texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize, text_bytes
from ledgerloom.operators.merge import placed

BUCKETS = 10_000
#: Bytes of text whose features make one block; a longer text is a block of its own.
BLOCK = 4 << 20
#: Words up to so many bytes are hashed together, longer ones one by one.
SHORT = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = True
_WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _step(crc: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _CRC[(crc ^ byte) & 0xFF] ^ (crc >> 8)


@functools.cache
def _moved() -> np.ndarray:
    """[length, byte of the crc, its value]: what it becomes after `length` zero bytes; the crc's bytes add up by xor."""
    tables = np.zeros((SHORT + 1, 4, 256), np.uint32)
    for k in range(4):
        tables[0, k] = np.arange(256, dtype=np.uint32) << (8 * k)
    for n in range(1, SHORT + 1):
        tables[n] = _CRC[tables[n - 1] & 0xFF] ^ (tables[n - 1] >> 8)
    return tables


def word_crcs(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The features of all texts in order, as buckets, and where each text's begin; words of a text, then its pairs."""
    low = _LOWER[data]
    inside = _WORD[low]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edge] = inside[edge]  # a word never goes on into the next text
    ends[edge - 1] = inside[edge - 1]
    first = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - first
    cut = np.searchsorted(first, offsets)
    crc = np.full(len(first), 0xFFFFFFFF, np.uint32)
    clipped = np.minimum(length, SHORT + 1)
    order = np.argsort(-clipped, kind="stable")  # the longest first, so those still read are a prefix
    by_length = np.searchsorted(-clipped[order], -np.arange(SHORT + 1), side="left")  # how many are longer than k
    register, at = crc[order], first[order]
    for k in range(min(SHORT, int(length.max(initial=0)))):
        n = by_length[k]
        register[:n] = _step(register[:n], low[at[:n] + k])
    crc[order] = ~register
    long = np.flatnonzero(length > SHORT)
    for i in long.tolist():
        crc[i] = zlib.crc32(low[first[i] : first[i] + length[i]])
    # Pairs: the first word with a space, moved on by the second one's length.
    second = np.arange(1, len(first))
    paired = np.ones(len(second), bool)
    paired[cut[1:-1][(cut[1:-1] > 0) & (cut[1:-1] < len(first))] - 1] = False  # the last word of a text has no next one
    second = second[paired]
    spaced = ~_step(~crc[second - 1], np.uint32(32))
    n, moved = np.minimum(length[second], SHORT), _moved()
    pairs = crc[second].copy()
    for k in range(4):
        pairs ^= moved[n, k, (spaced >> np.uint32(8 * k)) & 0xFF]
    for i in np.flatnonzero(length[second] > SHORT).tolist():
        j = second[i]
        pairs[i] = zlib.crc32(low[first[j] : first[j] + length[j]], int(spaced[i]))
    words = np.diff(cut)
    of_pairs = np.maximum(words - 1, 0)
    starts = np.concatenate([[0], np.cumsum(words + of_pairs)])
    out = np.empty(int(starts[-1]), np.uint16)
    out[np.arange(len(first)) + np.repeat(starts[:-1] - cut[:-1], words)] = crc % buckets
    pair_cut = np.cumsum(of_pairs) - of_pairs
    out[np.arange(len(second)) + np.repeat(starts[:-1] + words - pair_cut, of_pairs)] = pairs % buckets
    return out, starts


STREAMS = "ids array<long>, words array<long>, starts array<long>, stream binary"


def feature_streams(docs: DataFrame, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """Written table of blocks: the ids and numbers of words of its documents, where each begins in the stream, the stream."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("a bucket has to fit in 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(text_bytes(batch.column(1))[1])
            part = (np.cumsum(sizes) - 1) // BLOCK
            edges = np.append(np.searchsorted(part, np.unique(part)), batch.num_rows).tolist()
            for a, b in zip(edges[:-1], edges[1:]):
                data, offsets = text_bytes(batch.column(1).slice(a, b - a))
                out, starts = word_crcs(data, offsets, buckets)
                words = (np.diff(starts) + 1) // 2
                one = lambda x: pa.array([x], pa.list_(pa.int64()))
                columns = [one(batch.column(0).slice(a, b - a).to_pylist()), one(words), one(starts[:-1]), pa.array([out.astype("<u2").tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["ids", "words", "starts", "stream"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialize(given.mapInArrow(run, STREAMS), "importance-streams", "zstd")


def bucket_counts(streams: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all streams; one number a bucket reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for stream in batch.column(0):
                block = np.sort(np.frombuffer(stream.as_buffer(), "<u2"), kind="stable")  # a radix sort for 16 bits
                heads = np.flatnonzero(np.concatenate([np.ones(min(len(block), 1), bool), block[1:] != block[:-1]]))
                total[block[heads]] += np.diff(heads, append=len(block))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    counted = streams.select("stream").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():  # `buckets` rows at any size
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each bucket, in doubles."""
    buckets = len(source)
    t_all, s_all = float(target.sum() + buckets), float(source.sum() + buckets)
    gains = [math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all))) for t, s in zip(target.tolist(), source.tolist())]
    return np.array(gains, np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(streams: DataFrame, gains: np.ndarray, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    told = streams.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, words, starts, stream in zip(*(batch.column(c) for c in range(4))):
                ids, at = ids.values, starts.values.to_numpy()
                gained = told.value[np.frombuffer(stream.as_buffer(), "<u2")]
                sizes = np.diff(at, append=len(gained))
                sums, some = np.zeros(len(at), np.int64), sizes > 0
                if some.any():
                    sums[some] = np.add.reduceat(gained, at[some])
                weight = np.where(some, sums // np.maximum(sizes, 1), 0)
                score = weight + np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
                columns = [ids, words.values, pa.array(sizes), pa.array(weight), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight", "score"])

    return streams.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = BUCKETS, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of `docs`; rank is null where it is not drawn.

    Of the N rows with at least `least_words` words the floor(percent N / 100) of the highest scores are drawn."""
    streams = feature_streams(docs, buckets, id_col, text_col)
    wanted = feature_streams(target.withColumn("__id", F.lit(None).cast("long")), buckets, "__id", target_text)
    gains = bucket_gains(bucket_counts(wanted, buckets), bucket_counts(streams, buckets))
    scored = materialize(weights(streams, gains, seed).withColumn("__row", F.monotonically_increasing_id()), "importance-scores")
    fit = F.col("n_words") >= least_words
    n = scored.filter(fit).count() * percent // 100
    # Ranks follow from a range sort over all tasks; a key of one value keeps what takes part apart from the rest.
    ranked = placed(scored.withColumn("__fit", fit), ["__fit"], [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("__row")], "rank")
    drawn = F.when(F.col("__fit") & (F.col("rank") < n), F.col("rank") + 1)
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", drawn.cast("long").alias("rank"))
