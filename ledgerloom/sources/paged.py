"""Cursor-paged list APIs as a streaming source: the offset is the cursor, so Spark's checkpoint resumes it.

Pages of a date bucket are read until one is short; a bucket that reaches the API's last page goes on
from the last record's date, whose records are then read again (the sinks drop known ones). A single day
that fills all pages cannot be read whole this way, so it raises. The page reader is injected, nothing here opens a connection."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ledgerloom.functions.text import payload_hash

SCHEMA = "native_id string, name string, status string, company_type string, record_date string, raw_json string"
#: (from_date, page number) -> records as dicts, in order of their dates.
PageReader = Callable[[str, int], list[dict]]


@dataclass(frozen=True)
class Paging:
    page_size: int
    last_page: int


#: Page sizes and last pages that the registries' list APIs serve.
BRREG, COMPANIES_HOUSE = Paging(200, 49), Paging(100, 99)


def next_cursor(cursor: dict, records: list[dict], paging: Paging) -> dict:
    """Where to go on after a page. The cursor holds date, page and done. No record is passed over."""
    if len(records) < paging.page_size:
        return {**cursor, "done": True}
    if cursor["page"] < paging.last_page:
        return {**cursor, "page": cursor["page"] + 1}
    day = dt.date.fromisoformat(records[-1]["date"][:10]).isoformat()
    if day == cursor["date"]:
        raise ValueError(f"{day} has more records than the {paging.last_page + 1} pages that the API serves; narrow the request")
    return {"date": day, "page": 0, "done": False}


def row_of(record: dict) -> tuple:
    text = json.dumps(record, sort_keys=True)
    return tuple(None if record.get(k) is None else str(record[k]) for k in ("id", "name", "status", "type", "date")) + (text,)


def paged_source(name: str, read_page: PageReader, paging: Paging, start: str, most_pages: int = 1) -> type[DataSource]:
    """A data source class to register under `name`. A batch takes at most `most_pages` pages; its offset is the cursor, with the pages and
    records read so far."""

    class Reader(SimpleDataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"date": start, "page": 0, "done": False, "pages": 0, "records": 0}

        def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
            rows: list[tuple] = []
            for _ in range(most_pages):
                if start["done"]:
                    break
                records, start = self.page(start)
                rows += map(row_of, records)
            return iter(rows), start

        def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
            while start != end and not start["done"]:
                records, start = self.page(start)
                yield from map(row_of, records)

        @staticmethod
        def page(at: dict) -> tuple[list[dict], dict]:
            records = read_page(at["date"], at["page"])
            totals = {"pages": at["pages"] + bool(records), "records": at["records"] + len(records)}
            return records, {**next_cursor(at, records, paging), **totals}

        def commit(self, end: dict) -> None:
            pass

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
            return Reader()

    return Source


__all__ = ["BRREG", "COMPANIES_HOUSE", "Paging", "next_cursor", "paged_source", "payload_hash"]
