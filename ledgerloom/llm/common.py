"""Helpers shared by the operators: input tables, held-out rows, and byte views of Arrow text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import discard, materialize, shared_dir, shared_path
from ledgerloom.shipping import ship_package


def prepare(spark: SparkSession) -> None:
    """Ship the package, and let tasks exchange whole texts in batches of 1,000 rows unless the session has its own size."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default, which holds a hundred megabytes of long texts
        spark.conf.set(key, "1000")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_uneven(left: DataFrame, right: DataFrame, keys: list[str], weight: str, most: int = 2048) -> DataFrame:
    """Inner join in which a key may hold a large part of `left`; `right` (read more than once) tells by `weight` how many rows.

    Keys of more than 1 / `most` of all these rows, fewer than `most` at any size, are broadcast; only the others are shuffled.
    Where `right` has at most `most` rows it is broadcast whole, and where no key is heavy nothing is: then each side is read
    once, since every scan and every stage of a plan costs the driver some megabytes until it collects its garbage."""
    one = right.groupBy(*keys).agg(F.max(weight).alias("n"), F.count(F.lit(1)).alias("rows"))
    found = one.agg(F.sum("n").alias("total"), F.max("n").alias("heaviest"), F.sum("rows").alias("rows")).first()
    if (found["rows"] or 0) <= most:
        return left.join(F.broadcast(right.drop(weight)), keys)
    total = found["total"] or 0
    if (found["heaviest"] or 0) * most <= total:
        return left.join(right.drop(weight), keys)
    heavy = F.col(weight) * most > total
    hot = right.filter(heavy).drop(weight)
    rest = left.join(F.broadcast(hot.select(*keys).distinct()), keys, "left_anti").join(right.filter(~heavy).drop(weight), keys)
    return left.join(F.broadcast(hot), keys).unionByName(rest)


def id_crc(column: str | Column) -> Column:
    """crc32 of an id written as text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary"))


def is_held_out(column: str) -> Column:
    """Rows that no classifier learns from; a null id is not held out, but is never learned from either."""
    return F.coalesce(id_crc(column) % 4 == 2, F.lit(False))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column, and len + 1 offsets into them; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def bit_map(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """A map of `bits` bits, a multiple of 32,768, in which those that the column names are set; built by the executors."""
    place = F.col(column) + 1
    maps = rows.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for row in maps:
        out[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over an unsigned array: a bijection that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


__all__ = ["bit_map", "discard", "id_crc", "is_held_out", "join_uneven", "materialize", "mix64", "prepare", "read_table", "shared_dir", "shared_path", "text_bytes"]
