"""Versioned snapshots of a keyed table, of which a batch rewrites only the buckets that it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class SnapshotSink:
    """foreachBatch sink: batch n writes the buckets of its keys to folder v=n and where all buckets stand to folder m=n.

    A batch that runs again overwrites its own folders from the same predecessor, so the effect is
    exactly once. `merge(table, rows)` gives the next rows of the touched buckets; it must leave keys as they are."""

    def __init__(self, path: str, empty: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], key: str, buckets: int = 64):
        self.path, self.empty, self.merge, self.key, self.buckets = path.rstrip("/"), empty, merge, key, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _versions(self, spark: SparkSession, version: int) -> dict[int, int]:
        """The version of each bucket that has rows; at most `buckets` entries."""
        if version < 0:
            return {}
        return {r["bucket"]: r["version"] for r in spark.read.schema("bucket int, version int").parquet(f"{self.path}/m={version}").collect()}

    def _read(self, spark: SparkSession, versions: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/v={v}/bucket={b}" for b, v in sorted(versions.items())]
        return spark.read.schema(self.empty.schema).parquet(*paths) if paths else self.empty

    def snapshot(self, spark: SparkSession, version: int) -> DataFrame:
        return self._read(spark, self._versions(spark, version))

    def __call__(self, rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        versions = self._versions(spark, batch - 1)
        touched = [r["bucket"] for r in rows.select(self._bucket().alias("bucket")).distinct().collect()]  # at most `buckets`
        table = self._read(spark, {b: v for b, v in versions.items() if b in touched})
        merged = self.merge(table, rows).withColumn("bucket", self._bucket())
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v={batch}")
        here = spark.createDataFrame([(b, v) for b, v in {**versions, **{b: batch for b in touched}}.items()], "bucket int, version int")
        here.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/m={batch}")
