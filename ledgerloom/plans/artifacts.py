"""Search and crawl artifacts in tables bucketed and sorted by their keys, so that an upsert or a join moves the new rows only."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.upsert import last_by_key, merged_map, new, old, upsert
from ledgerloom.session import shared_path

#: What identifies an artifact.
SEARCH_KEYS, CRAWL_KEYS = ("raw_id", "provider", "query", "rank", "url"), ("raw_id", "url")


@dataclass(frozen=True)
class Bucketed:
    """A snapshot of a table of artifacts, in so many buckets of its keys; a next snapshot is a table of its own."""

    name: str
    keys: tuple[str, ...]
    buckets: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def write_bucketed(rows: DataFrame, tag: str, keys: Sequence[str], buckets: int | None = None) -> Bucketed:
    """Write `rows` in the shared folder as a bucketed, sorted table. There are no fewer buckets than shuffle partitions, else
    Spark would move both sides of a join."""
    spark = rows.sparkSession
    buckets = max(buckets or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"{tag}_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", shared_path(spark, tag)).format("parquet").saveAsTable(name)
    return Bucketed(name, tuple(keys), buckets)


def changes(columns: Sequence[str], keys: Sequence[str]) -> Mapping[str, Column]:
    """What an artifact that is seen again changes: all but its keys, with both metadata merged."""
    return {c: merged_map(old(c), new(c)) if c == "metadata" else new(c) for c in columns if c not in keys}


def upserted(table: Bucketed, rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """`table` after `rows`, of which the first in `order` counts for each key. Only `rows` are shuffled."""
    before = table.read(rows.sparkSession)
    return upsert(before, last_by_key(rows, table.keys, order), list(table.keys), changes(before.columns, table.keys))


def upsert_artifacts(table: Bucketed, rows: DataFrame, order: Sequence[Column], tag: str) -> Bucketed:
    """The written next snapshot. A task of the join holds one bucket, so each is written as one file without another shuffle."""
    return write_bucketed(upserted(table, rows, order), tag, table.keys, table.buckets)


def crawled_results(search: DataFrame, crawl: DataFrame, keys: Sequence[str] = ("domain", "url")) -> DataFrame:
    """Search artifacts with their crawl artifact's columns; one that was never crawled is an error."""
    others = [c for c in crawl.columns if c not in keys]
    joined = search.join(crawl.withColumn("__there", F.lit(True)), list(keys), "left")
    lost = F.raise_error(F.concat(F.lit("no crawl artifact for "), F.col(keys[-1])))
    # In every column that comes from the crawl, so that no projection leaves it out.
    return joined.select(*search.columns, *[F.when(F.col("__there").isNull(), lost.cast(crawl.schema[c].dataType)).otherwise(F.col(c)).alias(c) for c in others])
