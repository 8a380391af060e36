"""Sharding by a two-pass external shuffle.

Pass one scatters every record by a seeded hash of its id and text into buckets that fit in memory. Pass two
permutes each bucket with Fisher-Yates and gives every record its place in one global random order;
shards are equal ranges of that order, so their row counts differ by at most one, and each bucket
is written to one or two shards. Both passes are seeded: a task that runs again on another executor
gives the same rows the same places.

A count of rows and bytes in each of SLOTS hash slots (more where the table needs more buckets) decides the buckets.
A slot over two buckets' size holds rows that repeat an id and a text; these are dealt over several buckets by the
part of the input that they stand in, and written once, so that they stay where they are.

Defined cases: a null text has size 1 and the checksum of the empty text; null ids scatter by their
text; repeated rows each get a place; an empty table gives no rows; other columns are carried, those
named like the operator's own are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import materialize, shared_path

#: Bytes of text that one bucket holds on average; a bucket is one group of one task.
BUCKET_BYTES = 16 << 20
#: Buckets at least, so that small tables still spread over all tasks.
LEAST_BUCKETS = 64
#: Hash slots that are counted to decide the buckets.
SLOTS = 1 << 16
#: Buckets of a task, about.
BUCKETS_A_TASK = 4

OWN = ("size", "text_crc32", "bucket", "position", "shard", "slot")


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    order = list(range(n))
    draws = rng.integers(0, np.arange(n, 0, -1)).tolist() if n else []
    for last, j in zip(range(n - 1, 0, -1), draws):
        order[last], order[j] = order[j], order[last]
    return np.array(order, np.int64)


def shard_records(
    docs: DataFrame, shards: int = 8, seed: int = 20, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """`docs` with size, text_crc32, bucket, position, shard and slot; position is a random order of all rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = [c for c in docs.columns if c not in OWN]
    sized = docs.select(
        *kept,
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), "text_crc32", "size")

    def counted(slots: int) -> DataFrame:
        slot = F.pmod(key, F.lit(slots)).alias("slot")
        return materialize(sized.groupBy(slot).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-slots")

    slots, counts = SLOTS, counted(SLOTS)
    total = counts.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    buckets = max(LEAST_BUCKETS, -(-total["bytes"] // bucket_bytes))
    if 4 * buckets > slots:
        slots = 1 << (4 * buckets).bit_length()
        counts = counted(slots)
    # Buckets 0 to buckets - 1 are runs of slots; a full slot has its own ones after them.
    bucket = F.floor(F.col("slot") * F.lit(buckets / slots)).cast("long")
    full = F.col("bytes") > 2 * bucket_bytes
    slotted = sized.withColumn("slot", F.pmod(key, F.lit(slots)))
    scattered = slotted.withColumn("bucket", bucket).drop("slot")
    sizes = counts.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"))
    hot = counts.filter(full).select("slot", F.ceil(F.col("bytes") / bucket_bytes).cast("long").alias("parts"))
    if not hot.isEmpty():
        part = F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), F.col("parts"))
        dealt = slotted.join(hot, "slot").withColumn("bucket", buckets + F.col("slot") * (1 << 20) + part).drop("slot", "parts")
        dealt = materialize(dealt.select(*scattered.columns), "shard-repeated")
        scattered = slotted.join(hot, "slot", "left_anti").withColumn("bucket", bucket).select(*scattered.columns).union(dealt)
        sizes = counts.filter(~full).groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n")).union(dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    begins = _begins(materialize(sizes, "shard-buckets"))
    base, more = divmod(total["rows"], shards)
    edge = more * (base + 1)  # the first `more` shards hold one row more
    schema = T.StructType(
        [f for f in scattered.schema.fields]
        + [T.StructField("position", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]
    )

    def permute(group: pa.Table, begin: pa.Table) -> pa.Table:
        if group.num_rows:
            keys = [(c, "ascending") for c in (id_col, "text_crc32", "size")]
            group = group.take(pa.compute.sort_indices(group, sort_keys=keys))  # arrival order depends on the cluster
            rng = np.random.default_rng([seed, group["bucket"][0].as_py()])
            group = group.take(fisher_yates(group.num_rows, rng))
        at = (begin["begin"][0].as_py() if begin.num_rows else 0) + np.arange(group.num_rows)
        late = at >= edge
        shard = np.where(late, more + (at - edge) // max(base, 1), at // (base + 1))
        slot = np.where(late, (at - edge) % max(base, 1), at % (base + 1))
        for name, values in (("position", at), ("shard", shard.astype(np.int32)), ("slot", slot)):
            group = group.append_column(name, pa.array(values))
        return group

    scattered = scattered.repartition(max(16, buckets // BUCKETS_A_TASK), "bucket")
    return scattered.groupBy("bucket").cogroup(begins.groupBy("bucket")).applyInArrow(permute, schema)


def _begins(sizes: DataFrame) -> DataFrame:
    """bucket and the rows of all buckets before it, of (bucket, n) rows. Runs of buckets are summed before and in themselves, so
    that no window holds more than about the square root of their number."""
    runs = max(1, int(sizes.count() ** 0.5))
    run = F.pmod(F.xxhash64("bucket"), F.lit(runs)).alias("run")  # any order of buckets will do
    ranked = sizes.select("bucket", "n", run)
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranked.groupBy("run").agg(F.sum("n").alias("n")).select("run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.sum("n").over(Window.partitionBy("run").orderBy("bucket")) - F.col("n")
    return ranked.join(starts, "run").select("bucket", (F.col("start") + inside).alias("begin"))


def write_shards(docs: DataFrame, path: str | None = None, shards: int = 8, seed: int = 20, **columns) -> str:
    """Write the shards as folders shard=0, shard=1, ... of Parquet files, rows in slot order; returns the path."""
    path = path or shared_path(docs.sparkSession, "shards")
    placed = shard_records(docs, shards, seed, **columns)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path


def read_shards(spark, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)
