"""Binary token output: packed id matrices with segment lengths and position resets.

Each task tokenises its texts, cuts overlong ones losslessly, and packs a bounded buffer of pieces
with best-fit decreasing. The fitting sequence is found by a segment tree over the gap sizes, which
knows for every range of gaps whether an open sequence has one. A packed row holds `capacity` ids as
little-endian uint16 (uint32 if the vocabulary needs it) padded with `pad_id`, the cumulative
lengths of its segments, and the places where positions start again from 0.

Defined cases: a null text is an empty one, whose only id is the end id; repeated rows are packed
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import shared_path
from ledgerloom.llm.tokens import loaded, tokenizer_json

CAPACITY = 2048
END_ID = 49407
#: Pieces that a task packs at once; at 2048 ids of 4 bytes each they take 64 MB at most.
BUFFER = 8192

ROWS = "sequence_id long, ids binary, n_ids int, cu_lengths array<int>, position_resets array<int>, doc_ids array<long>, pieces array<int>, starts array<long>"


class GapTree:
    """A segment tree over gap sizes 0..capacity; a node counts the open sequences with a gap in its range."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def change(self, gap: int, by: int) -> None:
        at = gap + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def successor(self, size: int) -> int | None:
        """The smallest gap >= size that an open sequence has."""
        at = size + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Indices of the pieces of each sequence, in the order in which they were placed."""
    tree, open_by_gap, sequences = GapTree(capacity), [[] for _ in range(capacity + 1)], []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        gap = tree.successor(size)
        if gap is None:
            sequences.append([])
            at, gap = len(sequences) - 1, capacity
        else:
            at = open_by_gap[gap].pop()
            tree.change(gap, -1)
        sequences[at].append(i)
        if gap > size:
            open_by_gap[gap - size].append(at)
            tree.change(gap - size, 1)
    return sequences


def packed_rows(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = END_ID, pad_id: int = 0, wide: bool = False
) -> DataFrame:
    """One row per packed sequence; every id of every text is in exactly one."""
    json = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer_path))
    kind = "<u4" if wide else "<u2"

    def flush(pieces: list[tuple], first: int) -> pa.RecordBatch:
        lengths = np.array([len(p[3]) for p in pieces], np.int64)
        out: list[list] = [[] for _ in range(8)]
        for n, members in enumerate(best_fit_decreasing(lengths, capacity)):
            row = np.full(capacity, pad_id, kind)
            ends = np.cumsum(lengths[members])
            row[: ends[-1]] = np.concatenate([pieces[i][3] for i in members])
            cu = [0, *ends.tolist()]
            values = (first + n, row.tobytes(), cu[-1], cu, cu[:-1], [pieces[i][0] for i in members], [pieces[i][1] for i in members], [pieces[i][2] for i in members])
            for column, value in zip(out, values):
                column.append(value)
        types = [pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        names = [c.split()[0] for c in ROWS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(json.value)
        if tokenizer.tokenizer.get_vocab_size() > 65536 and not wide:
            raise ValueError("ids of this vocabulary need wide=True")
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        end = np.array([end_id], "<u4").tobytes()
        held: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(tokenizer.encode(text.as_py() or "") + end, "<u4")
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    held.append((doc_id, piece, at, ids[at : at + capacity].astype(kind)))
                    if len(held) == BUFFER:
                        done = flush(held, first)
                        first += done.num_rows
                        held = []
                        yield done
        if held:
            yield flush(held, first)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, ROWS)


def write_packed(docs: DataFrame, path: str | None = None, **options) -> str:
    """Write the packed rows as Parquet files; returns the path."""
    path = path or shared_path(docs.sparkSession, "packed-ids")
    packed_rows(docs, **options).write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1").parquet(path)
    return path


def segments(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """One row per segment of written rows: where it stands, where it comes from, and its own id bytes."""
    rows = spark.read.parquet(path)
    each = rows.select("sequence_id", "ids", "cu_lengths", "doc_ids", "pieces", "starts", F.posexplode("position_resets").alias("n", "offset"))
    length = F.element_at("cu_lengths", F.col("n") + 2) - F.col("offset")
    return each.select(
        F.element_at("doc_ids", F.col("n") + 1).alias("doc_id"),
        F.element_at("pieces", F.col("n") + 1).alias("piece"),
        F.element_at("starts", F.col("n") + 1).alias("start"),
        length.cast("long").alias("length"),
        "sequence_id",
        F.col("offset").cast("long").alias("offset"),
        F.substring("ids", F.col("offset") * width + 1, length * width).alias("ids"),
    )
