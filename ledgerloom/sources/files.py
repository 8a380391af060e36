"""Downloaded snapshot files: verified, decompressed, and cut into records with their exact text.

Hashes are taken of a record's own text, which Spark's JSON functions would re-serialise; so files that
wrap their records in one document are cut by small helpers: compressed and small ones one file to a task, large ones by many
tasks (`split_files`)."""

from __future__ import annotations

import gzip
import hashlib
import io
import itertools
import json
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources import split_files

FILES = "source string, dataset string, file_path string, snapshot_id string, sha256 string, format string, source_url string"
#: Keys under which registries' documents hold their records.
WRAPPERS = ("data", "records", "_embedded.enheter")
RECORDS = "source string, dataset string, snapshot_id string, file_ord int, record_no long, record string"


def compression(content: Column, fmt: Column, path: Column) -> Column:
    """'gzip', 'zip' or 'none': first bytes decide, then the format, then the file's name."""
    magic = F.hex(F.substring(content, 1, 4))
    name, kind = F.lower(path), F.lower(fmt)
    return (
        F.when(magic.startswith("1F8B"), "gzip")
        .when(magic.isin("504B0304", "504B0506", "504B0708"), "zip")
        .when(kind.rlike(r"(^|\.)(gz|gzip)$"), "gzip")
        .when(kind.rlike(r"(^|\.)zip$"), "zip")
        .when(name.endswith(".gz"), "gzip")
        .when(name.endswith(".zip"), "zip")
        .otherwise("none")
    )


def is_csv(fmt: str, path: str) -> bool:
    fmt, path = fmt.lower(), path.lower()
    return fmt == "csv" or fmt.endswith(".csv") or "csv." in fmt or path.endswith(".csv") or ".csv." in path


def is_json_lines(fmt: str, path: str) -> bool:
    return any(x in s.lower() for s in (fmt, path) for x in ("jsonl", "ndjson"))


def safe_name(*parts: str) -> str:
    """A file name of checked parts; raises for anything that could leave its folder."""
    for part in parts:
        if not re.fullmatch(r"[A-Za-z0-9._-]+", part) or part in (".", ".."):
            raise ValueError(f"unsafe file name part: {part!r}")
    return "_".join(parts)


def opened(content: bytes, sha256: str | None, kind: str) -> bytes:
    """A file's data after its checksum held; of a zip archive the first file."""
    if sha256 and hashlib.sha256(content).hexdigest() != sha256.lower():
        raise ValueError("checksum mismatch")
    if kind == "gzip":
        return gzip.decompress(content)
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            names = [i for i in archive.infolist() if not i.is_dir()]
            if not names:
                raise ValueError("zip archive without a file")
            return archive.read(names[0])
    return content


def json_elements(text: str, wrappers: Sequence[str]) -> Iterator[str]:
    """Exact texts of a document's records: an array's elements, those of the wrapper keys, or the document itself.

    A wrapper may be a path of keys, such as `outer.inner`."""
    decoder, space = json.JSONDecoder(), re.compile(r"\s*")
    skip = lambda at: space.match(text, at).end()

    def members(at: int, named: bool) -> Iterator[tuple[str | None, int, int]]:
        """(key, start, end) of what stands in the array or object that begins at `at`."""
        at = skip(at + 1)
        while text[at] not in "]}":
            key = None
            if named:
                key, at = decoder.raw_decode(text, at)
                at = skip(skip(at) + 1)
            _, end = decoder.raw_decode(text, at)
            yield key, at, end
            at = skip(end)
            if text[at] == ",":
                at = skip(at + 1)

    def wrapped(at: int, path: str) -> Iterator[tuple[int, int]]:
        """Places of the arrays under the wrappers."""
        for key, start, end in members(at, True):
            full = f"{path}{key}"
            if full in wrappers and text[start] == "[":
                yield start, end
            elif text[start] == "{" and any(w.startswith(f"{full}.") for w in wrappers):
                yield from wrapped(start, f"{full}.")

    start = skip(0)
    if start == len(text):
        return
    if text[start] not in "[{":
        raise ValueError("neither a JSON array nor an object")
    arrays = [(start, len(text))] if text[start] == "[" else list(wrapped(start, ""))
    for at, _ in arrays:
        yield from (text[a:b] for _, a, b in members(at, False))
    if not arrays:
        yield text[start : decoder.raw_decode(text, start)[1]]


def _contents(spark: SparkSession, files: DataFrame) -> DataFrame:
    """`files` with their bytes; the list of files is small, their contents are read by the tasks."""
    listed = files.collect()
    if not listed:
        return spark.createDataFrame([], f"{FILES}, file_ord int, __path string, content binary, kind string")
    order = spark.createDataFrame(listed, FILES + ", file_ord int")
    contents = spark.read.format("binaryFile").load([r["file_path"] for r in listed])
    path = F.regexp_replace("path", "^file:/+", "/")
    joined = order.join(contents.select(path.alias("__path"), "content"), F.regexp_replace("file_path", "^file:/+", "/") == F.col("__path"))
    return joined.withColumn("kind", compression(F.col("content"), F.col("format"), F.col("file_path")))


def _frames(f, records: Iterator[str], size: int = 10_000) -> Iterator[pd.DataFrame]:
    """A file's records with their places, some thousand at a time."""
    for n in itertools.count(0, size):
        some = list(itertools.islice(records, size))
        if not some:
            return
        yield pd.DataFrame({"source": f.source, "dataset": f.dataset, "snapshot_id": f.snapshot_id, "file_ord": f.file_ord, "record_no": range(n, n + len(some)), "record": some})


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def split_records(spark: SparkSession, files: DataFrame, least: int | None, read: Callable[[list[str], bool], tuple[DataFrame, list[str]]]) -> tuple[DataFrame, list[DataFrame]]:
    """`files` (with file_ord) to be read whole, and the records of those of more than `least` bytes (by default a partition of Spark's files),
    which are cut by many tasks. `read` gives the records of some paths, JSON lines or not, and which of them cannot be cut."""
    listed = [r for r in files.collect() if not re.search(r"(^|\.)(gz|gzip|zip)$", (r["format"] or "").lower()) and not r["file_path"].lower().endswith((".gz", ".zip"))]
    least = least or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    if not listed:
        return files, []
    sizes = spark.read.format("binaryFile").load([r["file_path"] for r in listed]).select(_plain(F.col("path")).alias("path"), "length").collect()
    large = {r["path"]: r["length"] for r in sizes if r["length"] > least}
    cut = [r for r in listed if re.sub("^file:/+", "/", r["file_path"]) in large]
    done, parts = [], []
    for lines in (False, True):
        some = [r for r in cut if is_json_lines(r["format"] or "", r["file_path"]) == lines]
        if not some:
            continue
        records, whole = read([r["file_path"] for r in some], lines)
        whole = {re.sub("^file:/+", "/", p) for p in whole}
        some = [r for r in some if re.sub("^file:/+", "/", r["file_path"]) not in whole]
        done += some
        named = spark.createDataFrame([(re.sub("^file:/+", "/", r["file_path"]), r["source"], r["dataset"], r["snapshot_id"], r["file_ord"]) for r in some], "__path string, source string, dataset string, snapshot_id string, file_ord int")
        met = records.join(F.broadcast(named), _plain(F.col("path")) == F.col("__path"))  # one row a file
        parts.append(met.select(*[c.split()[0] for c in RECORDS.split(", ")]))
    checked(spark, done, large)
    kept = [r["file_ord"] for r in done]
    return files.filter(~F.col("file_ord").isin(kept)) if kept else files, parts


def checked(spark: SparkSession, files: list, sizes: dict[str, int]) -> None:
    """Raise unless the checksums of files hold, each computed by one task. Spark hands over at most 2 GB of a file."""
    wanted = {re.sub("^file:/+", "/", r["file_path"]): r["sha256"].lower() for r in files if r["sha256"]}
    for path in wanted:
        if sizes[path] >= 1 << 31:
            raise ValueError(f"{path} is too large to be checked here; check it when it is downloaded and leave its checksum out")
    if wanted:
        sums = spark.read.format("binaryFile").load(list(wanted)).select(_plain(F.col("path")).alias("path"), F.sha2("content", 256).alias("sha256"))
        if any(wanted[r["path"]] != r["sha256"] for r in sums.collect()):
            raise ValueError("checksum mismatch")


def _ordered(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The list of files with their order, unless it has one."""
    if "file_ord" in files.columns:
        return files
    return spark.createDataFrame([(*r, i) for i, r in enumerate(files.collect())], FILES + ", file_ord int")


def json_records(spark: SparkSession, files: DataFrame, wrappers: Sequence[str] = WRAPPERS, split_from: int | None = None) -> DataFrame:
    """All records of JSON and JSON-lines files with their place (file_ord, record_no). Files of more than `split_from` bytes that are not
    compressed are cut by many tasks (`split_files`), others by one each."""
    wrappers = tuple(wrappers)
    files = _ordered(spark, files)
    files, parts = split_records(spark, files, split_from, lambda paths, lines: split_files.split_lines(spark, paths) if lines else split_files.split_json(spark, paths, wrappers))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for f in batch.itertuples():
                text = opened(f.content, f.sha256, f.kind).decode("utf-8-sig")
                lines = (x for x in text.split("\n") if x.strip()) if is_json_lines(f.format or "", f.file_path) else json_elements(text, wrappers)
                yield from _frames(f, lines)

    return reduce(DataFrame.unionByName, parts, _contents(spark, files).mapInPandas(cut, RECORDS))


def csv_records(spark: SparkSession, files: DataFrame, separator: str, header_name, split_from: int | None = None) -> DataFrame:
    """Rows of CSV files as JSON objects of their non-blank fields; ragged rows and byte-order marks are allowed.

    `header_name` maps a header to the field's name ('' drops it). Large files are cut as those of `json_records`."""
    import csv

    files = _ordered(spark, files)
    files, parts = split_records(spark, files, split_from, lambda paths, _: split_files.split_csv(spark, paths, separator, header_name))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for f in batch.itertuples():
                text = opened(f.content, f.sha256, f.kind).decode("utf-8-sig")
                reader = csv.reader(io.StringIO(text, newline=""), delimiter=separator, skipinitialspace=True)
                names = [header_name(h) for h in next(reader, [])]
                records = ({k: v.strip() for k, v in zip(names, values) if k and v.strip()} for values in reader if values)
                yield from _frames(f, (json.dumps(r, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in records))

    return reduce(DataFrame.unionByName, parts, _contents(spark, files).mapInPandas(cut, RECORDS))


def record_file(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Objects of a JSON array file, in order, one text each."""
    files = spark.createDataFrame([("file", "records", path, "", "", "json", "")], FILES)
    rows = json_records(spark, files, ()).filter(F.col("record").startswith("{")).orderBy("record_no")
    return rows.select("record") if limit is None else rows.limit(limit).select("record")


def page_count(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("pages"))
