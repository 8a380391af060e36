"""The task machine: its timers, its order of events, and that it goes on where it stopped."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.streaming import tasks


def at(minute):
    return f"2026-01-01 00:{minute:02d}:00"


def write(spark, folder, *events):
    rows = [(t, k, at(a), u and at(u)) for t, k, a, u in events]
    given = spark.createDataFrame(rows, "task string, kind string, at string, until string")
    given.select("task", "kind", *[F.to_timestamp(c).alias(c) for c in ("at", "until")]).coalesce(1).write.mode("append").parquet(folder)


def state(changes):
    rows = tasks.current_tasks(changes).collect()
    return {r["task"]: (r["status"], r["attempts"], r["changed_at"].minute, r["until"] and r["until"].minute) for r in rows}


def test_timers_fire_without_input_and_over_runs(spark, tmp_path):
    folder, run = str(tmp_path / "events"), str(tmp_path / "run")
    stream = lambda: spark.readStream.schema(tasks.EVENTS).parquet(folder)
    write(
        spark, folder,
        ("lease", "claimed", 2, 5), ("lease", "created", 1, None), ("long", "created", 1, None), ("long", "claimed", 2, 50),
        ("retried", "claimed", 1, 4), ("retried", "failed_retryable", 3, 8), ("retried", "claimed", 9, 12), ("retried", "succeeded", 11, None),
        ("retry", "failed_retryable", 6, 15), ("final", "skipped", 9, None), ("final", "claimed", 10, 11), ("new", "created", 20, None),
    )
    first = state(tasks.run_tasks(stream(), run))
    assert first == {
        "lease": ("pending", 1, 5, None), "long": ("running", 1, 2, 50), "retried": ("succeeded", 2, 11, None),
        "retry": ("pending", 0, 15, None), "final": ("skipped", 0, 9, None), "new": ("pending", 0, 20, None),
    }
    # Another run has the state of the first: a new event replaces a timer, and the lease of `long` ends although it has no event.
    write(spark, folder, ("lease", "claimed", 30, 58), ("retried", "created", 31, None), ("new", "failed_terminal", 55, None))
    second = state(tasks.run_tasks(stream(), run))
    assert second == {**first, "lease": ("running", 2, 30, 58), "long": ("pending", 1, 50, None), "new": ("failed_terminal", 0, 55, None)}
    assert state(tasks.run_tasks(stream(), run)) == second  # nothing to do


def test_a_batch_is_planned_without_python_and_leaves_other_buckets(spark, tmp_path):
    """Tasks used to go one by one through Python workers, some milliseconds each."""
    folder, run = str(tmp_path / "events"), str(tmp_path / "run")
    stream = lambda: spark.readStream.schema(tasks.EVENTS).parquet(folder)
    plan = tasks.moved_tasks(spark.createDataFrame([], tasks.STATE), spark.createDataFrame([], "task string, kind string, at_us long, until_us long"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning") <= 1
    write(spark, folder, ("a", "created", 20, None), ("b", "claimed", 10, 40), ("b", "skipped", 4, None), ("c", "failed_retryable", 5, 20), (None, "claimed", 6, 59))
    expected = {"a": ("pending", 0, 20, None), "b": ("skipped", 0, 4, None), "c": ("pending", 0, 20, None), None: ("running", 1, 6, 59)}
    assert state(tasks.run_tasks(stream(), run)) == expected
    # Late events are left out; a time that is over at once leaves no lease; the null task has one state.
    write(spark, folder, ("late", "created", 5, None), ("c", "succeeded", 20, None), ("z", "claimed", 21, 19), (None, "failed_terminal", 22, None))
    changes = tasks.run_tasks(stream(), run)
    assert state(changes) == {**expected, "z": ("pending", 1, 19, None), None: ("failed_terminal", 1, 22, None)}
    assert sorted(r["status"] for r in changes.filter("task = 'c'").collect()) == ["failed_retryable", "pending"]
    old = {p.parent.name: p for p in (tmp_path / "run/state/v=1").glob("bucket=*/*.parquet")}
    assert 1 <= len(old) <= 2


def test_unknown_events_raise(spark, tmp_path):
    folder = str(tmp_path / "events")
    write(spark, folder, ("a", "lost", 1, None))
    with pytest.raises(Exception, match="unknown event: lost"):
        tasks.run_tasks(spark.readStream.schema(tasks.EVENTS).parquet(folder), str(tmp_path / "run"))
