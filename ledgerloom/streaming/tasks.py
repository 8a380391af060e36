"""Tasks as keyed state with timers: leases that run out and retries that come due need no further event.

Events of a task are created, claimed (until a time), succeeded, skipped, failed_retryable (until the next try) and failed_terminal.
Each moves the task's state; claims and retryable failures set one timer at their time, which the watermark fires, whether or not
the task has another event. A claimed task whose time passes is pending again, as is a retryable one; a later event replaces the timer.

A batch moves all its tasks by one shuffle, a window and a grouping. The state is kept in versioned buckets: a batch rewrites those that
have events or a timer that is due, and each bucket's next timer stands beside its version."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.streaming.snapshots import SnapshotSink

#: The state that an event leads to.
STATES = {
    "created": "pending",
    "claimed": "running",
    "succeeded": "succeeded",
    "skipped": "skipped",
    "failed_retryable": "failed_retryable",
    "failed_terminal": "failed_terminal",
}
#: States that a timer ends, and the ones that no event leaves.
TIMED, FINAL = ("running", "failed_retryable"), ("succeeded", "skipped", "failed_terminal")
EVENTS = "task string, kind string, at timestamp, until timestamp"


STATE = "task string, status string, attempts int, changed_us long, until_us long"
CHANGES = "task string, status string, attempts int, changed_at timestamp, until timestamp"
#: State columns, and the same as a batch's events leave them before its timers fire.
HELD, MOVED = ("status", "attempts", "changed_us", "until_us"), ("moved_status", "moved_attempts", "moved_changed_us", "moved_until_us")
WRITTEN = f"{STATE}, moved_status string, moved_attempts int, moved_changed_us long, moved_until_us long, moved boolean, bucket int"


def moved_tasks(state: DataFrame, events: DataFrame) -> DataFrame:
    """STATE after events (task, kind, at_us, until_us), with what was held before as `held` (null: a new task).

    Nothing leaves a final state, and an event older than the state's last change is known to be overtaken."""
    led_to = F.coalesce(F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair])[F.col("kind")], F.raise_error(F.concat(F.lit("unknown event: "), F.coalesce("kind", F.lit("null")))))
    nothing = lambda schema: F.lit(None).cast(schema)
    held = state.select("task", nothing("long").alias("at_us"), nothing("string").alias("kind"), nothing("long").alias("until_us"), F.struct(*HELD).alias("held"), F.col("status").alias("to"))
    given = events.select("task", "at_us", "kind", "until_us", F.lit(None).cast(held.schema["held"].dataType).alias("held"), led_to.alias("to"))
    # A task's state comes first, then its events in order.
    order = Window.partitionBy("task").orderBy(F.asc_nulls_first("at_us"), "kind")
    rows = held.unionByName(given).withColumn("since", F.max(F.col("held.changed_us")).over(order))
    rows = rows.withColumn("counts", F.col("held").isNull() & (F.coalesce("since", "at_us") <= F.col("at_us")))
    ends = F.col("to").isin(*FINAL) & (F.col("held").isNotNull() | F.col("counts"))
    over = F.coalesce(F.max(ends).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    rows = rows.withColumn("counts", F.col("counts") & ~over)
    claims = F.count(F.when(F.col("counts") & (F.col("kind") == "claimed"), 1)).cast("int")
    last = F.max(F.when(F.col("counts"), F.struct("at_us", "kind", "to", "until_us")))
    done = rows.groupBy("task").agg(F.max("held").alias("held"), claims.alias("claims"), last.alias("last"))
    until = F.when(F.col("last").isNull(), F.col("held.until_us")).when(F.col("last.to").isin(*TIMED), F.col("last.until_us"))
    return done.select(
        "task", "held", F.coalesce("last.to", "held.status").alias("status"), (F.coalesce("held.attempts", F.lit(0)) + F.col("claims")).alias("attempts"),
        F.coalesce("last.at_us", "held.changed_us").alias("changed_us"), until.alias("until_us"),
    )


def timers_fired(tasks: DataFrame, now: int) -> DataFrame:
    """Tasks whose time has come by `now` (microseconds) are pending since that time."""
    due = F.coalesce(F.col("until_us") <= now, F.lit(False))
    fired = {"status": F.when(due, "pending").otherwise(F.col("status")), "changed_us": F.when(due, F.col("until_us")).otherwise(F.col("changed_us"))}
    return tasks.withColumns({**fired, "until_us": F.when(~due, F.col("until_us"))})


class TaskSink(SnapshotSink):
    """foreachBatch sink of EVENTS: state in versioned buckets, with each batch's changes in `changes/batch=n`.

    Events at or before the watermark of earlier batches come too late and are left out; a batch's own watermark fires timers at its end."""

    def __init__(self, folder: str, empty: DataFrame, delay: str, buckets: int = 64):
        super().__init__(f"{folder}/state", empty, moved_tasks, "task", buckets)
        self.changes, self.delay = f"{folder}/changes", delay

    def __call__(self, rows: DataFrame, batch: int) -> None:
        spark, bucket = rows.sparkSession, self._bucket().alias("bucket")
        micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
        places: dict[int, tuple[int, int | None]] = {}
        before = None
        if batch > 0:  # one row a bucket, at most `buckets`
            for r in spark.read.schema("bucket int, version int, due_us long, watermark_us long").parquet(f"{self.path}/m={batch - 1}").collect():
                before = r["watermark_us"]
                if r["bucket"] is not None:
                    places[r["bucket"]] = (r["version"], r["due_us"])
        events = rows.select("task", "kind", F.coalesce(micros("at"), F.raise_error(F.lit("an event without a time"))).alias("at_us"), micros("until").alias("until_us"))
        if before is not None:
            events = events.filter(F.col("at_us") > before // 1000 * 1000)  # as Spark's watermarks, in milliseconds
        latest = F.max(F.unix_micros(F.timestamp_micros("at_us") - F.expr(f"INTERVAL {self.delay}")))
        met = {r["bucket"]: r["latest"] for r in events.groupBy(bucket).agg(latest.alias("latest")).collect()}
        now = max([x for x in (before, *met.values()) if x is not None], default=None)
        touched = set(met) | {b for b, (_, due) in places.items() if due is not None and now is not None and due <= now}
        table = self._read(spark, {b: v for b, (v, _) in places.items() if b in touched}).select("task", *HELD)
        after = self.merge(table, events)
        if before is not None:
            after = timers_fired(after, before)
        after = after.withColumns({m: F.col(c) for c, m in zip(HELD, MOVED)})
        if now is not None:
            after = timers_fired(after, now)
        after = after.withColumn("moved", ~F.col("held").eqNullSafe(F.struct(*[F.col(m).alias(c) for c, m in zip(HELD, MOVED)]))).drop("held")
        written = f"{self.path}/v={batch}"
        after.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(written)
        # Without rows nothing but the marker of a finished write is there, so the schema is given.
        here = spark.read.schema(WRITTEN).parquet(written)
        self._write_changes(here, batch)
        due = here.groupBy("bucket").agg(F.min("until_us").alias("due")).collect()
        places.update({r["bucket"]: (batch, r["due"]) for r in due})
        meta = [(b, v, due, now) for b, (v, due) in places.items()] or [(None, None, None, now)]
        spark.createDataFrame(meta, "bucket int, version int, due_us long, watermark_us long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/m={batch}")

    def _write_changes(self, here: DataFrame, batch: int) -> None:
        """A row for each task that the batch's events moved, and one for each timer that fired."""
        row = lambda *c: F.struct(F.col(c[0]).alias("status"), F.col(c[1]).alias("attempts"), F.timestamp_micros(c[2]).alias("changed_at"), F.timestamp_micros(c[3]).alias("until"))
        fired = F.col("moved_until_us").isNotNull() & F.col("until_us").isNull()
        both = F.filter(F.array(F.when(F.col("moved"), row(*MOVED)), F.when(fired, row(*HELD))), lambda x: x.isNotNull())
        here.select("task", F.inline(both)).write.mode("overwrite").parquet(f"{self.changes}/batch={batch}")


def run_tasks(events: DataFrame, folder: str, delay: str = "0 seconds") -> DataFrame:
    """All changes so far of a stream of EVENTS, after what is there now has been read; `folder` holds them and the state for the next run."""
    spark = events.sparkSession
    sink = TaskSink(folder, spark.createDataFrame([], STATE), delay)
    query = events.writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(CHANGES).parquet(f"{folder}/changes").select("task", "status", "attempts", "changed_at", "until")


def current_tasks(changes: DataFrame) -> DataFrame:
    """The latest row of each task among its changes, which follow one another in time."""
    latest = F.max_by(F.struct("status", "attempts", "changed_at", "until"), F.struct("changed_at", "attempts", F.col("status").isin(*FINAL), F.col("until").isNull()))
    return changes.groupBy("task").agg(latest.alias("s")).select("task", "s.*")
