"""Streams into keyed snapshots: paged pulls that resume, idempotent sinks, and retries with state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerloom.session import materialize
from ledgerloom.streaming.snapshots import SnapshotSink


def run_available(stream: DataFrame, sink: SnapshotSink, checkpoint: str) -> StreamingQuery:
    """Process everything that is there now, then stop; the next run goes on from the checkpoint."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def fail_once(calls: DataFrame) -> DataFrame:
    """Stream of calls (key) to (key, attempt, outcome): the first call of each key fails, later ones succeed."""

    def outcome(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        attempt = state.get[0] if state.exists else 0
        rows = []
        for batch in batches:
            for _ in range(len(batch)):
                attempt += 1
                rows.append((key[0], attempt, "failed" if attempt == 1 else "succeeded"))
        state.update((attempt,))
        yield pd.DataFrame(rows, columns=["key", "attempt", "outcome"])

    return calls.groupBy("key").applyInPandasWithState(outcome, "key string, attempt int, outcome string", "attempt int", "append", GroupStateTimeout.NoTimeout)


def retry_missing(items: DataFrame, call: Callable[[DataFrame, int], DataFrame], key: str, most_attempts: int) -> DataFrame:
    """Answers of `call(items, attempt)`; items without one are sent again, `most_attempts` rounds in all.

    Each round's answers are written before the next begins, so an item is sent once a round, whatever the service answers."""
    answers, left = None, items
    for attempt in range(most_attempts):
        got = materialize(call(left, attempt), "retry-answers")
        answers = got if answers is None else answers.unionByName(got)
        if attempt < most_attempts - 1:
            left = materialize(left.join(got.select(key), key, "left_anti"), "retry-left")
            if left.isEmpty():
                break
    return answers
