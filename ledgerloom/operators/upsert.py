"""Idempotent upserts of keyed tables. Parquet has no MERGE, so a table's next snapshot is computed
from the last one by a full outer join on the key; a caller writes it to a new folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialize

NEW, OLD = "__new", "__old"


def last_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the one that comes first in `order`. A snapshot may only get one row per key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__place", F.row_number().over(window)).filter("__place = 1").drop("__place")


def new(name: str) -> Column:
    return F.col(f"{NEW}.{name}")


def old(name: str) -> Column:
    return F.col(f"{OLD}.{name}")


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str], on_conflict: Mapping[str, Column] | Sequence[str], when: Column | None = None) -> DataFrame:
    """`table` after inserting `rows`; where a key is there already, the named columns change.

    `on_conflict` is a list of columns to take from the new row, or a mapping of columns to
    expressions over `new(...)` and `old(...)`; `when` restricts which existing rows change."""
    changes = dict(on_conflict) if isinstance(on_conflict, Mapping) else {c: new(c) for c in on_conflict}
    a = table.withColumn("__there", F.lit(True)).alias(OLD)
    b = rows.withColumn("__here", F.lit(True)).alias(NEW)
    condition = [F.col(f"{OLD}.{k}") == F.col(f"{NEW}.{k}") for k in keys]
    joined = a.join(b, condition, "full_outer")
    there, here = F.col(f"{OLD}.__there").isNotNull(), F.col(f"{NEW}.__here").isNotNull()
    changed = there & here & (when if when is not None else F.lit(True))
    out = []
    for c in table.columns:
        inserted = new(c) if c in rows.columns else F.lit(None)
        out.append(F.when(~there, inserted).when(changed & F.lit(c in changes), changes.get(c, old(c))).otherwise(old(c)).alias(c))
    return joined.select(*out)


def upsert_by_hash(table: DataFrame, rows: DataFrame, native_key: str, seen_at: str = "last_seen_at", run: str = "run_id") -> DataFrame:
    """Content-hash upsert: an unchanged payload only moves `last_seen_at` and `run_id`, a changed one is a new row."""
    rows = last_by_key(rows, [native_key, "payload_hash"], [F.col(seen_at).desc()])
    return upsert(table, rows, [native_key, "payload_hash"], [seen_at, run])


def insert_unless_known(table: DataFrame, rows: DataFrame, native_key: str, force: bool = False) -> DataFrame:
    """Registry writer: a native id that is known is left alone unless `force`."""
    rows = rows.filter(F.col(native_key) != "")
    if not force:
        rows = rows.join(table.select(native_key), native_key, "left_anti")
    return upsert_by_hash(table, rows, native_key)


def write_inputs(table: DataFrame, rows: DataFrame, native_key: str, force: bool = False, seen_at: str = "last_seen_at", run: str = "run_id") -> tuple[DataFrame, dict[str, int]]:
    """Registry writer: the written next snapshot of `table`, and how many of `rows` were written, skipped and new payloads.

    Rows without a native id are neither. Unless `force`, rows of ids that are known are skipped. The counts are observed while the
    snapshot is written; table and rows are read once and shuffled once, by the native id."""
    both = table.withColumn("__old", F.lit(1)).unionByName(rows.filter(F.col(native_key) != "").select(*table.columns).withColumn("__old", F.lit(0)))
    known = F.max("__old").over(Window.partitionBy(native_key))
    payload = Window.partitionBy(native_key, "payload_hash")
    marked = both.withColumns({"__skip": (F.col("__old") == 0) & (known == 1) & F.lit(not force), "__there": F.max("__old").over(payload) == 1})
    given, skip = F.col("__old") == 0, F.col("__skip")
    first_of = F.row_number().over(payload.orderBy("__old", F.desc(seen_at))) == 1
    counted = Observation("written")
    marked = marked.withColumn("__first", first_of).observe(
        counted, F.count_if(given & ~skip).alias("written"), F.count_if(given & skip).alias("skipped"), F.count_if(given & ~skip & ~F.col("__there") & F.col("__first")).alias("new_payloads")
    )
    # An existing row stays but for its last sight, which is that of the latest written row.
    kept = F.max_by(F.struct(*table.columns), F.struct("__old", seen_at)).alias("kept")
    sight = F.max_by(F.struct(seen_at, run), F.struct(1 - F.col("__old"), seen_at)).alias("sight")
    merged = marked.filter(~skip).groupBy(native_key, "payload_hash").agg(kept, sight)
    out = [F.col(f"sight.{c}" if c in (seen_at, run) else f"kept.{c}").alias(c) for c in table.columns]
    snapshot = materialize(merged.select(*out), "raw-inputs")
    return snapshot, {k: v or 0 for k, v in counted.get.items()}


def seen_range(observations: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """First and last time that each key was observed: what any sequence of hash upserts leads to."""
    return observations.groupBy(*keys).agg(F.min(at).alias("first_seen_at"), F.max(at).alias("last_seen_at"))


def merged_map(before: Column, after: Column) -> Column:
    """Entries of both maps; those of `after` win."""
    kept = F.map_filter(before, lambda k, _: ~F.array_contains(F.map_keys(after), k))
    return F.when(before.isNull(), after).when(after.isNull(), before).otherwise(F.map_concat(kept, after))


def upsert_domains(bridge: DataFrame, discovered: DataFrame, force: bool = False) -> DataFrame:
    """Bridge of records and discovered domains, keyed (raw_id, domain, signal): metadata is merged; a row that is
    not active stays as it is unless `force`, which makes it active again."""
    rows = discovered.withColumn("status", F.lit("active"))
    changes = {"confidence": new("confidence"), "metadata": merged_map(old("metadata"), new("metadata")), "status": F.lit("active")}
    return upsert(bridge, rows, ["raw_id", "domain", "signal"], changes, None if force else old("status") == "active")


def append_events(events: DataFrame, action_ids: DataFrame, status: str, message: str) -> DataFrame:
    """The log with one event more for each non-empty action id."""
    more = action_ids.filter(F.coalesce(F.col("action_id"), F.lit("")) != "").select("action_id", F.lit(status).alias("status"), F.lit(message).alias("message"))
    return events.select("action_id", "status", "message").unionByName(more)


def save_checkpoint(checkpoints: DataFrame, source: str, cursor: str) -> DataFrame:
    """Checkpoints with this source's cursor; an existing row keeps its time of completion."""
    row = checkpoints.sparkSession.createDataFrame([(source, cursor)], "source_name string, cursor string")
    return upsert(checkpoints, row, ["source_name"], ["cursor"])
