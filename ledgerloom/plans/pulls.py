"""One call per registry: the files' companies into the raw-input table, then the run's audit rows and checkpoint."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import upsert
from ledgerloom.operators.merge import first_per_key
from ledgerloom.plans import registries
from ledgerloom.sources import files as file_source
from ledgerloom.sources import paged


@dataclass(frozen=True)
class Registry:
    """How a registry's records become companies, and the column that identifies one."""

    companies: Callable[[DataFrame], DataFrame]
    native_key: str
    wrappers: tuple[str, ...] = file_source.WRAPPERS
    modes: tuple[str, ...] = ("bulk",)


REGISTRIES = {
    "brreg": Registry(registries.brreg_companies, "organization_number", modes=("bulk", "incremental")),
    "gleif": Registry(registries.gleif_companies, "lei", registries.GLEIF_WRAPPERS, ("full", "delta")),
    "cvr": Registry(registries.cvr_companies, "cvr_number", modes=("bulk", "incremental")),
    "ariregister": Registry(registries.ariregister_companies, "registry_code"),
}

#: Registries that are read by pages of a list API.
PAGED = {"brreg": paged.BRREG, "companies_house": paged.COMPANIES_HOUSE}

RAW = "native_id string, payload_hash string, raw_payload string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, run_id string"
EXECUTIONS = "id string, status string, records_written long, pages_fetched long, completed_at timestamp_ntz"
CHECKPOINTS = "source_name string, cursor string, last_completed_at timestamp_ntz"


@dataclass(frozen=True)
class Pulled:
    raw: DataFrame
    executions: DataFrame
    checkpoints: DataFrame


def snapshot_id(given: str, now: dt.datetime, hourly: bool = False) -> str:
    """The caller's snapshot id, else the day (and hour, for feeds that change within a day) in UTC."""
    return given.strip() or now.strftime("%Y%m%d-%H" if hourly else "%Y%m%d")


def raw_inputs(companies: DataFrame, native_key: str, seen_at: Column, run_id: str) -> DataFrame:
    """Companies as rows of the raw-input table."""
    at = seen_at.cast("timestamp_ntz")
    return companies.select(F.col(native_key).alias("native_id"), "payload_hash", "raw_payload", at.alias("first_seen_at"), at.alias("last_seen_at"), F.lit(run_id).alias("run_id"))


def mark_complete(executions: DataFrame, checkpoints: DataFrame, execution_id: str, source: str, cursor: str, result: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Both tables after a run. `result` is one row of records_written and pages_fetched. Without an execution id no
    execution changes; without a cursor no checkpoint does."""
    at = now.cast("timestamp_ntz")
    if execution_id:
        done = result.select(F.lit(execution_id).alias("id"), F.lit("completed").alias("status"), F.col("records_written").cast("long"), F.col("pages_fetched").cast("long"), at.alias("completed_at"))
        changed = upsert.upsert(executions, done, ["id"], ["status", "records_written", "pages_fetched", "completed_at"])
        executions = changed.join(executions.select("id"), "id", "left_semi")  # an update: an unknown run gets no row
    if cursor:
        row = result.select(F.lit(source).alias("source_name"), F.lit(cursor).alias("cursor"), at.alias("last_completed_at"))
        checkpoints = upsert.upsert(checkpoints, row, ["source_name"], ["cursor", "last_completed_at"])
    return executions, checkpoints


def import_companies(source: str, records: DataFrame, before: Pulled, run_id: str, execution_id: str, cursor: str, pages: int, now: Column, force: bool = True) -> Pulled:
    """All three tables after a registry's records; the raw inputs are written. An unchanged payload moves only its last sight; with `force`
    off, companies that are known are left alone and not counted as written."""
    registry = REGISTRIES[source]
    rows = raw_inputs(registry.companies(records), registry.native_key, now, run_id)
    return _written(source, rows, before, execution_id, cursor, pages, now, force)


def _written(source: str, rows: DataFrame, before: Pulled, execution_id: str, cursor: str, pages: int, now: Column, force: bool) -> Pulled:
    raw, counts = upsert.write_inputs(before.raw, rows, "native_id", force)
    result = rows.sparkSession.createDataFrame([(counts["written"], pages)], "records_written long, pages_fetched long")
    executions, checkpoints = mark_complete(before.executions, before.checkpoints, execution_id, source, cursor, result, now)
    return Pulled(raw, executions, checkpoints)


def pull_files(spark: SparkSession, source: str, listed: DataFrame, before: Pulled, run_id: str, execution_id: str, now: Column, mode: str = "", snapshot: str = "", force: bool = True, split_from: int | None = None) -> Pulled:
    """As `import_companies` for downloaded files (rows of `FILES`); CSV and JSON files may stand together, in the order in which they are
    listed. Without a file the run is complete with no record."""
    registry = REGISTRIES[source]
    mode = mode or registry.modes[0]
    if mode not in registry.modes:
        raise ValueError(f"unknown mode for {source}: {mode}")
    rows = [(*r, n) for n, r in enumerate(listed.collect())]  # a snapshot's few files
    records = spark.createDataFrame([], file_source.RECORDS)
    for csv in (False, True):
        some = [r for r in rows if file_source.is_csv(r[5] or "", r[2]) == csv]
        if some:
            part = spark.createDataFrame(some, file_source.FILES + ", file_ord int")
            records = records.unionByName(file_source.csv_records(spark, part, ";", registries.ariregister_header, split_from) if csv else file_source.json_records(spark, part, registry.wrappers, split_from))
    return import_companies(source, records, before, run_id, execution_id, f"{mode}:{snapshot}" if snapshot else "", len(rows), now, force)


def pull_pages(spark: SparkSession, source: str, read_page: paged.PageReader, folder: str, before: Pulled, run_id: str, execution_id: str, start: str, now: Column, force: bool = True, most_pages: int = 50, paging: paged.Paging | None = None) -> Pulled:
    """As `import_companies` for a list API from the date `start` on, read page by page in batches of at most `most_pages`.

    Each batch appends its records to `folder` and commits its cursor there, so a run that fails goes on from its last batch, within a
    day, when it is called again with the same folder. All records are merged once, at the end."""
    name = f"pages_{uuid.uuid4().hex}"
    spark.dataSource.register(paged.paged_source(name, read_page, paging or PAGED[source], start, most_pages))
    at, before_batch = None, None
    while at is None or not (at["done"] or at == before_batch):
        stream = spark.readStream.format(name).load()
        query = stream.writeStream.format("parquet").option("path", f"{folder}/pages").option("checkpointLocation", f"{folder}/cursor").trigger(availableNow=True).start()
        query.awaitTermination()
        at, before_batch = _committed(spark, f"{folder}/cursor"), at
    pages = spark.read.schema(paged.SCHEMA).parquet(f"{folder}/pages").withColumn("payload_hash", paged.payload_hash(F.col("raw_json")))
    rows = raw_inputs(pages.withColumnRenamed("raw_json", "raw_payload"), "native_id", now, run_id)
    return _written(source, rows, before, execution_id, f"{at['date']},{at['page']}", at["pages"], now, force)


def _committed(spark: SparkSession, checkpoint: str) -> dict:
    """The cursor of the last batch that a stream's checkpoint holds."""
    lines = spark.read.text(f"{checkpoint}/offsets").select(F.input_file_name().alias("file"), "value").filter(F.col("value").contains('"done"'))
    last = lines.withColumn("batch", F.regexp_extract("file", r"(\d+)$", 1).cast("long")).orderBy(F.desc("batch")).first()
    return json.loads(last["value"])


def append_to_latest(events: DataFrame, actions: DataFrame, done: DataFrame, status: str, message: str) -> DataFrame:
    """The log with one event for the latest translate action of each done record (raw_input_id, payload_hash).

    An action belongs to a record only with the payload that it was made for; a record without one is an error."""
    latest = first_per_key(actions.filter("action_type = 'translate'"), ["raw_input_id", "payload_hash"], [F.desc("attempt"), F.desc("action_id")])
    found = done.select("raw_input_id", "payload_hash").join(latest.select("raw_input_id", "payload_hash", "action_id"), ["raw_input_id", "payload_hash"], "left")
    lost = F.raise_error(F.concat(F.lit("no translate action for raw input "), F.col("raw_input_id").cast("string")))
    ids = found.select(F.when(F.col("action_id").isNull(), lost.cast("string")).otherwise(F.col("action_id")).alias("action_id"))
    return upsert.append_events(events, ids, status, message)


def run_totals(batches: DataFrame, by: list[str]) -> DataFrame:
    """What a workflow's batches add up to."""
    return batches.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("claimed", "translated", "failed", "records_written", "pages_fetched")])
