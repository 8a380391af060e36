"""Order-sensitive merges and picks. Rows have no order of their own: callers carry a sequence column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialize


def last_non_empty(value: str, sequence: str) -> Column:
    """Aggregate: the value of the last row in which it is not empty, else ''."""
    filled = F.when(F.col(value) != "", F.col(value))
    return F.coalesce(F.max_by(filled, F.when(filled.isNotNull(), F.col(sequence))), F.lit(""))


def concatenated(array: str, sequence: str) -> Column:
    """Aggregate: all arrays joined in order of the sequence."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(sequence).alias("s"), F.col(array).alias("a"))))
    return F.flatten(F.transform(ordered, lambda x: x["a"]))


def merge_fragments(rows: DataFrame, key: str, sequence: str, scalars: Sequence[str], arrays: Sequence[str] = ()) -> DataFrame:
    """One row per key: last non-empty scalars, concatenated arrays; rows without a key are dropped."""
    aggregates = [last_non_empty(c, sequence).alias(c) for c in scalars] + [concatenated(c, sequence).alias(c) for c in arrays]
    return rows.filter(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(*aggregates)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in `order`; end the order with a unique column."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(window)).filter("__n = 1").drop("__n")


def top_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(window)).filter(F.col("__n") <= n).drop("__n")


def placed(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """The place of each row within its key, from 0, as `name`; end the order with a unique column.

    Rows are range-sorted over all tasks by key and order, so one frequent key is dealt over many; a place is the rows of
    the key in earlier parts, one small count a key and part, and the row's distance from the key's first in its own."""
    ordered = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # Written once: both uses below must see the same parts.
    ordered = materialize(ordered.withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()}), "placed-rows")
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    begins = ordered.groupBy(*keys, "__part").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    begins = begins.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    begins = begins.select(*[F.col(k).alias(f"__key{n}") for n, k in enumerate(keys)], F.col("__part").alias("__of"), "__first", "__before")
    same = F.col("__part") == F.col("__of")
    for n, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__key{n}"))
    return ordered.join(begins, same).withColumn(name, F.col("__before") + F.col("__row") - F.col("__first")).select(*rows.columns, name)


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], prefix: str, name: str) -> DataFrame:
    """Labels prefix0, prefix1, ... within each key."""
    return placed(rows, keys, order, name).withColumn(name, F.concat(F.lit(prefix), F.col(name).cast("string")))


def chunked(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], size: int, name: str = "chunk") -> DataFrame:
    """Number of the chunk of `size` rows that each row falls in, counted within each key."""
    return placed(rows, keys, order, name).withColumn(name, F.floor(F.col(name) / size))


def unique_terms(terms: DataFrame) -> DataFrame:
    return terms.filter(F.col("text") != "").select("category", "text").distinct()


def source_summary(files: DataFrame) -> DataFrame:
    """One row: all `source:dataset` pairs, sorted, joined by ', '."""
    filled = lambda c, d: F.coalesce(F.when(F.trim(c) != "", F.col(c)), F.lit(d))
    label = F.concat_ws(":", filled("source", "unknown-source"), filled("dataset", "unknown-dataset"))
    return files.select(label.alias("label")).distinct().agg(F.array_join(F.array_sort(F.collect_list("label")), ", ").alias("datasets"))
