"""State of records, tasks and assets: counts under conditions, verdicts and readiness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.merge import first_per_key

#: States of a task.
TASK_STATUSES = ["pending", "running", "succeeded", "skipped", "failed_retryable", "failed_terminal"]


def asset_state(rows: DataFrame, by: Sequence[str] = (), status: str = "status") -> DataFrame:
    """Counts of each status, completeness and blocking of the tasks of each group.

    An asset is complete when every task succeeded or was skipped, and blocked when one failed for good."""
    s = F.col(status)
    counts = [F.count_if(s == x).alias(f"{x}_count") for x in TASK_STATUSES]
    done = s.isin("succeeded", "skipped")
    out = rows.groupBy(*by) if by else rows.groupBy()
    return out.agg(
        F.count(F.lit(1)).alias("total_count"),
        *counts,
        F.coalesce(F.bool_and(done), F.lit(False)).alias("complete"),
        F.coalesce(F.bool_or(s == "failed_terminal"), F.lit(False)).alias("blocked"),
    )


def check_passed() -> Column:
    """Verdict over an asset state."""
    return (F.col("total_count") > 0) & F.col("complete") & ~F.col("blocked")


def latest_artifacts(artifacts: DataFrame, keys: Sequence[str], at: str = "created_at", tie: str = "id") -> DataFrame:
    return first_per_key(artifacts, keys, [F.col(at).desc(), F.col(tie).desc()])


def asset_rows(raw: DataFrame, tasks: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Current raw records with their task state ('pending' if none) and their latest artifact."""
    latest = latest_artifacts(artifacts, ["raw_id"]).select("raw_id", F.col("id").alias("artifact_id"))
    return (
        raw.filter("is_current")
        .join(tasks.select("raw_id", F.col("status").alias("task_status")), "raw_id", "left")
        .join(latest, "raw_id", "left")
        .withColumn("task_status", F.coalesce("task_status", F.lit("pending")))
    )


def batch_status(items: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rollup of item states: succeeded, failed or partial."""
    completed, failed, skipped = (F.count_if(F.col("status") == x) for x in ("succeeded", "failed", "skipped"))
    return items.groupBy(*by).agg(
        completed.alias("completed"),
        failed.alias("failed"),
        skipped.alias("skipped"),
        F.when(failed == 0, F.lit("succeeded")).when(completed + skipped == 0, F.lit("failed")).otherwise(F.lit("partial")).alias("status"),
    )


def run_summary(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts of a run's results: by status, with domains, related sites and a primary presence."""
    return rows.groupBy(*by, "status").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("best_domain").isNotNull()).alias("domains_found"),
        F.sum("related_count").alias("related_sites"),
        F.count_if(F.col("has_primary")).alias("primary_count"),
    )


def ready_records(raw: DataFrame, translation: DataFrame, domain: DataFrame, financial: DataFrame) -> DataFrame:
    """Records whose translation succeeded and whose other parts are finished in either way."""
    part = lambda df, name: df.select("raw_id", F.col("status").alias(name))
    joined = (
        raw.filter("is_current").join(part(translation, "t"), "raw_id", "left").join(part(domain, "d"), "raw_id", "left").join(part(financial, "f"), "raw_id", "left")
    )
    ready = (F.coalesce("t", F.lit("pending")) == "succeeded") & F.coalesce("d", F.lit("pending")).isin("succeeded", "skipped") & F.coalesce(
        "f", F.lit("pending")
    ).isin("succeeded", "skipped")
    return joined.select("raw_id", ready.alias("ready"))


def claimable_after(tasks: DataFrame, needs: str, unless: str, task_type: str) -> DataFrame:
    """Pending tasks of a type whose record has a finished `needs` task and no succeeded `unless` task."""
    finished = tasks.filter((F.col("task_type") == needs) & F.col("status").isin("succeeded", "skipped", "failed_terminal")).select("raw_id")
    found = tasks.filter((F.col("task_type") == unless) & (F.col("status") == "succeeded")).select("raw_id")
    return tasks.filter((F.col("task_type") == task_type) & (F.col("status") == "pending")).join(finished, "raw_id", "left_semi").join(found, "raw_id", "left_anti")


def superseded(built: DataFrame, key: str = "native_id", at: str = "created_at", tie: str = "id") -> DataFrame:
    """Built records with their state: the latest of each key is current, those before it are superseded."""
    newest = Window.partitionBy(key).orderBy(F.col(at).desc(), F.col(tie).desc())
    return built.withColumn("state", F.when(F.row_number().over(newest) == 1, "current").otherwise("superseded"))
