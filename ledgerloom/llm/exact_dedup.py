"""Exact deduplication with a split for heavy hitters.

Texts are equal when their SHA-256 is equal after all ASCII white space is deleted. A slim table
(row, id, digest, length) is written once. Each task summarises its digests with Misra-Gries
counters; summed over tasks, every digest with more than rows / (counters + 1) copies is sure to
be among the candidates. Their exact counts and winners are then verified by an aggregation that
combines on the map side, and the at most `counters` verified winners are broadcast, so no copy of
a frequent text is shuffled. All other digests have groups of a bounded share and take an ordinary
shuffle.

Defined cases: a null text is the empty text; a null id loses every tie against an id; rows that
repeat an id and a text count as separate rows, of which one is kept; an empty table gives an
empty result; other columns are ignored by `dedup_decisions` and carried by `drop_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize

#: Counters of each Misra-Gries summary, and the bound on broadcast winners.
COUNTERS = 4096


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", "")


def text_digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def misra_gries(counters: int):
    """A function for mapInArrow: digests in, at most `counters` (digest, lower bound) rows out per task."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for entry in batch.column(0).value_counts().to_pylist():
                held[entry["values"]] = held.get(entry["values"], 0) + entry["counts"]
            if len(held) > counters:  # lower all by the first count that finds no place
                cut = int(np.partition(np.fromiter(held.values(), np.int64), -counters - 1)[-counters - 1])
                held = {k: v - cut for k, v in held.items() if v > cut}
        # A digest seen once in a task can only matter with others like it; below two nothing is heavy.
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["digest", "seen"]
            )

    return summarise


def frequent_digests(slim: DataFrame, counters: int) -> DataFrame:
    """At most `counters` candidate digests; holds every digest with over rows / (counters + 1) rows."""
    return (
        slim.select("digest")
        .mapInArrow(misra_gries(counters), "digest binary, seen long")
        .groupBy("digest")
        .agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "digest")
        .limit(counters)
        .select("digest")
    )


def _winner() -> Column:
    return F.min(F.struct((-F.col("len")).alias("neg_len"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))


def _groups(docs: DataFrame, id_col: str, text_col: str, counters: int) -> tuple[DataFrame, DataFrame]:
    """Written table of frequent digests (digest, winner, group_size), and all rows (row_id, doc_id, digest, len) with it, null for other digests."""
    slim = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col(id_col).alias("doc_id"),
            text_digest(text_col).alias("digest"),
            F.coalesce(F.char_length(text_col), F.lit(0)).cast("long").alias("len"),
        ),
        "dedup-digests",
    )
    limit = slim.count() // (counters + 1)
    candidates = F.broadcast(frequent_digests(slim, counters))
    heavy = materialize(
        slim.join(candidates, "digest", "left_semi")
        .groupBy("digest")
        .agg(_winner().alias("winner"), F.count(F.lit(1)).alias("group_size"))
        .filter((F.col("group_size") > limit) & (F.col("group_size") > 1)),
        "dedup-heavy",
    )
    # Fewer than `counters` + 1 digests can exceed the limit, so this side stays small at any size.
    return heavy, slim.join(F.broadcast(heavy), "digest", "left")


def dedup_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256 and the digest's bytes."""
    _, marked = _groups(docs, id_col, text_col, counters)
    return marked.filter(F.col("winner").isNotNull()).unionByName(_infrequent(marked)).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("winner.row_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "digest",
    )


def _infrequent(marked: DataFrame) -> DataFrame:
    """The rows of digests that are not frequent, with their winner and group_size."""
    group = Window.partitionBy("digest")
    rest = marked.filter(F.col("winner").isNull()).drop("winner", "group_size")
    return rest.withColumn("winner", _winner().over(group)).withColumn("group_size", F.count(F.lit(1)).over(group))


def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task for each value of the last column, which holds at most as many as there are frequent digests."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for i, key in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            if key not in seen:
                seen.add(key)
                keep.append(i)
        if keep:
            yield batch.take(pa.array(keep))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """`docs` with one row of each group of equal texts, all columns as they were.

    The winners of frequent digests are broadcast: tasks drop all other rows of these, and of rows that equal a winner in id, text and
    length each task passes on the first, so no copy of a frequent text is shuffled. The winners of the others meet their rows on (id,
    digest); rows that repeat both are numbered under the same partitioning, so texts are shuffled once."""
    key_of = lambda c: {"__id": F.coalesce(F.col(c).cast("string"), F.lit("")), "__none": F.col(c).isNull()}
    heavy, marked = _groups(docs, id_col, text_col, counters)
    length = F.coalesce(F.char_length(text_col), F.lit(0)).cast("long")
    found = docs.withColumns({**key_of(id_col), "__digest": text_digest(text_col), "__len": length})

    told = heavy.select(F.col("digest").alias("__digest"), F.col("winner.doc_id").alias("__won"), (-F.col("winner.neg_len")).alias("__most"))
    told = told.withColumns({"__won_id": key_of("__won")["__id"], "__won_none": key_of("__won")["__none"]}).drop("__won")
    met = found.join(F.broadcast(told), "__digest")  # at most `counters` winners
    met = met.filter((F.col("__id") == F.col("__won_id")) & (F.col("__none") == F.col("__won_none")) & (F.col("__len") == F.col("__most"))).select(*docs.columns, "__digest")
    once = met.mapInArrow(first_of_each, met.schema)
    frequent = once.withColumn("__place", F.row_number().over(Window.partitionBy("__digest").orderBy(F.lit(0)))).filter("__place = 1").select(*docs.columns)

    keys = ["__id", "__none", "__digest"]
    winners = _infrequent(marked).filter(F.col("row_id") == F.col("winner.row_id")).withColumns(key_of("doc_id")).withColumnRenamed("digest", "__digest").select(*keys)
    rest = found.join(F.broadcast(told.select("__digest")), "__digest", "left_anti").join(winners, keys)
    longest = Window.partitionBy(*keys).orderBy(F.desc("__len"))
    return rest.withColumn("__place", F.row_number().over(longest)).filter("__place = 1").select(*docs.columns).unionByName(frequent)
