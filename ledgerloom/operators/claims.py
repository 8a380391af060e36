"""Claims of work under a lease. One writer computes the next snapshot, so no row locks are needed;
time is an argument, so a claim is reproducible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEASE_MINUTES = 10
#: States of a translation action.
ACTION_STATUSES = ["notdone", "queued", "running", "succeeded", "failed", "skipped", "cancelled"]
#: Lifecycle of a raw input.
LIFECYCLE_STATES = ["input", "suggestion_submitted", "completed", "superseded"]


def checked(value: str, allowed: Sequence[str], what: str) -> str:
    if value not in allowed:
        raise ValueError(f"invalid {what}: {value}")
    return value


def claimable(now: Column, worker: str, include_failed: bool) -> Column:
    """Rows that may be claimed: pending (or failed), or leased by the worker itself or not any more."""
    fresh = F.col("status").isin("pending", *(["failed"] if include_failed else []))
    stale = (F.col("status") == "translating") & ((F.col("lease_until") < now) | (F.col("lease_by") == worker))
    return fresh | stale


def candidates(table: DataFrame, now: Column, worker: str, limit: int | None, include_failed: bool = False, ids: Sequence | None = None, order: Sequence[str] = ("created_at", "id")) -> DataFrame:
    """The ids of the oldest claimable rows, `limit` at most (all, without one); of `ids` only, if given, which may be failed ones too."""
    free = table.filter(claimable(now, worker, include_failed or ids is not None))
    if ids is not None:
        free = free.join(table.sparkSession.createDataFrame([(i,) for i in ids], f"id {table.schema['id'].dataType.simpleString()}"), "id", "left_semi")
    return free.select("id") if limit is None else free.orderBy(*order).limit(limit).select("id")


def claim(table: DataFrame, now: Column, worker: str, limit: int | None, include_failed: bool = False, ids: Sequence | None = None, minutes: int = LEASE_MINUTES) -> DataFrame:
    """The table after a claim; `claimed` marks the rows that were taken."""
    taken = candidates(table, now, worker, limit, include_failed, ids).withColumn("claimed", F.lit(True))
    got = F.col("claimed")
    return (
        table.join(taken, "id", "left")
        .withColumn("claimed", F.coalesce("claimed", F.lit(False)))
        .withColumns(
            {
                "status": F.when(got, F.lit("translating")).otherwise(F.col("status")),
                "attempts": F.col("attempts") + F.when(got, 1).otherwise(0),
                "error": F.when(~got, F.col("error")),
                "lease_by": F.when(got, F.lit(worker)).otherwise(F.col("lease_by")),
                "lease_until": F.when(got, now + F.make_dt_interval(mins=F.lit(minutes))).otherwise(F.col("lease_until")),
            }
        )
    )


def next_attempts(claimed: DataFrame, actions: DataFrame, key: str = "id") -> DataFrame:
    """Number of the next attempt for each claimed row."""
    done = actions.filter("action_type = 'translate'").groupBy(F.col("raw_input_id").alias(key)).agg(F.max("attempt").alias("last"))
    return claimed.join(done, key, "left").select(key, (F.coalesce("last", F.lit(0)) + 1).alias("attempt"))


def written(table: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """The table after a batch: results (id, payload_en or error) end the lease of their rows."""
    r = results.select("id", F.col("payload_en").alias("__en"), F.col("error").alias("__error"), F.lit(True).alias("__done"))
    done, failed = F.col("__done").isNotNull(), F.col("__error").isNotNull()
    return (
        table.join(r, "id", "left")
        .withColumns(
            {
                "payload_en": F.when(done & ~failed, F.col("__en")).when(~done, F.col("payload_en")),
                "status": F.when(done & failed, F.lit("failed")).when(done, F.lit("translated")).otherwise(F.col("status")),
                "error": F.when(done, F.col("__error")).otherwise(F.col("error")),
                "translated_at": F.when(done & ~failed, now).otherwise(F.col("translated_at")),
                "lease_by": F.when(~done, F.col("lease_by")),
                "lease_until": F.when(~done, F.col("lease_until")),
            }
        )
        .drop("__en", "__error", "__done")
    )


def retryable(tasks: DataFrame, task_type: str, category: str | None, limit: int, now: Column) -> DataFrame:
    """Tasks reset for another run: failed ones of a category, and running ones whose lease is over; oldest first."""
    stale = (F.col("status") == "running") & (F.col("lease_until") < now)
    failed = (F.col("status") == "failed_retryable") & (F.lit(True) if category is None else F.col("error_category") == category)
    picked = tasks.filter((F.col("task_type") == task_type) & (failed | stale)).orderBy("updated_at", "id").limit(limit)
    return picked.withColumns({"status": F.lit("pending"), "next_retry_at": now, "lease_until": F.lit(None).cast("timestamp")})
