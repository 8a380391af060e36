"""Large uncompressed snapshot files, cut into records by many tasks, with each record's exact text.

Spark's text source reads byte ranges of a file. It is given the byte at which it may cut, a closing brace for JSON documents and a
line's end for JSON lines and CSV, so a range always begins right after such a byte. A first pass gives each range's state as a
function of the state before it: JSON's quotes flip `inside a string`, and brackets add to the depth, counted for both cases;
CSV's lines end inside quotes or not, for both cases. These compose in order of the ranges (one small row each on the driver), which gives
the state at which each range begins. A second pass cuts every range from there. Records that cross ranges are put together from
their fragments, and places follow from counts of the ranges before.

A file's checksum needs all of it in order, so it is checked by one task for each file of at most 2 GB (`files.checked`).
Defined cases: an empty file has no records; a document that is neither an array nor holds one under a wrapper is one record and is
left to the reader of whole files; a header that does not end within a file's first range raises."""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialize

_BOM = b"\xef\xbb\xbf"
_OPEN, _CLOSE = np.zeros(256, np.int64), np.zeros(256, np.int64)
_OPEN[[ord("{"), ord("[")]] = 1
_CLOSE[[ord("}"), ord("]")]] = 1
#: Members of a document's outermost objects beside its records that are listed on the driver.
MOST_MEMBERS = 100_000


def pieces(spark: SparkSession, paths: Sequence[str], end: str) -> DataFrame:
    """path, start (of the byte range), size (of the file) and value: the bytes between two ends, in order within a range."""
    meta = F.col("_metadata")
    rows = spark.read.option("lineSep", end).text(list(paths))
    return rows.select(meta["file_path"].alias("path"), meta["file_block_start"].alias("start"), meta["file_size"].alias("size"), F.col("value").cast("binary").alias("value"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list[bytes]]]:
    """(path, start, size, values) of consecutive rows of one byte range; a range may come in several parts."""
    for batch in batches:
        path, start, size = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        values = batch.column(3).to_pylist()
        cuts = [i for i in range(1, len(path)) if start[i] != start[i - 1] or path[i] != path[i - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(path)]):
            if b > a:
                yield path[a], int(start[a]), int(size[a]), values[a:b]


def scan(data: np.ndarray, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """After each byte of JSON text: whether it is inside a string, and the depth."""
    quotes = np.flatnonzero(data == 34)
    slashes = data == 92
    if slashes.any() and len(quotes):
        plain = np.maximum.accumulate(np.where(slashes, -1, np.arange(len(data))))
        before = np.where(quotes > 0, plain[quotes - 1], -1)
        quotes = quotes[(quotes - 1 - before) % 2 == 0]  # an even run of backslashes escapes itself
    flips = np.zeros(len(data), np.int64)
    flips[quotes] = 1
    within = (inside + np.cumsum(flips)) & 1
    return within, depth + np.cumsum((_OPEN[data] - _CLOSE[data]) * (1 - within))


@dataclass
class Range:
    """A byte range of a file: its first pass, then the state before it."""

    path: str
    start: int
    size: int
    pieces: int
    bytes: int
    flips: int
    delta: tuple[int, int]
    head: bytes
    inside: int = 0
    depth: int = 0
    array: int = 0  # depth of the array of records that the range begins in, 0 for none
    opens: tuple[tuple[int, int], ...] = ()  # (place after the bracket, depth) of the arrays that open in it
    complete: bool = True  # the last piece ends with the cutting byte


SUMMARY = "path string, start long, size long, pieces long, bytes long, flips long, delta0 long, delta1 long, head binary"


State = tuple[int, int, int]


def _summaries(rows: DataFrame, of_part: Callable[[list[bytes]], State], composed: Callable[[State, State], State], head: int) -> dict[str, list[Range]]:
    """Ranges of each file in order. `of_part` gives the state function of some pieces, `composed` that of two parts in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SUMMARY.split(", ")]
        for path, start, size, values in _runs(batches):
            flips, *delta = of_part(values)
            first = b"\n".join(values[:head]) if start == 0 else b""
            row = [path, start, size, len(values), sum(map(len, values)) + len(values), flips, *delta, first]
            yield pa.RecordBatch.from_pydict({n: pa.array([v], pa.binary() if n == "head" else None) for n, v in zip(names, row)})

    out: dict[str, list[Range]] = {}
    # Parts of a range come in order from its task; one small row for each.
    for row in rows.mapInArrow(run, SUMMARY).withColumn("part", F.monotonically_increasing_id()).orderBy("path", "start", "part").toArrow().to_pylist():
        ranges, state = out.setdefault(row["path"], []), (row["flips"], row["delta0"], row["delta1"])
        if not ranges or ranges[-1].start != row["start"]:
            ranges.append(Range(row["path"], row["start"], row["size"], row["pieces"], row["bytes"], state[0], state[1:], row["head"]))
            continue
        last = ranges[-1]
        last.flips, *delta = composed((last.flips, *last.delta), state)
        last.delta, last.pieces, last.bytes = tuple(delta), last.pieces + row["pieces"], last.bytes + row["bytes"]
    for ranges in out.values():
        total = sum(r.bytes for r in ranges)
        # The source leaves a byte-order mark out; a last piece without the cutting byte was counted with it.
        ranges[-1].complete = total in (ranges[-1].size, ranges[-1].size - len(_BOM))
    return out


#: First bytes of gzip and zip files, which are read whole.
_PACKED = (b"\x1f\x8b", b"PK\x03\x04", b"PK\x05\x06", b"PK\x07\x08")


def _packed(files: dict[str, list[Range]]) -> list[str]:
    return [p for p, ranges in files.items() if ranges[0].head.startswith(_PACKED)]


def _json_part(values: list[bytes]) -> tuple[int, int, int]:
    data = np.frombuffer(b"}".join(values) + b"}", np.uint8)
    within, depth = scan(data, 0, 0)
    both = int((_OPEN[data] - _CLOSE[data]).sum())
    return int(within[-1]), int(depth[-1]), both - int(depth[-1])


def _json_composed(a: State, b: State) -> State:
    """Quotes of both; the depth that both add, by the state before the first."""
    return a[0] ^ b[0], a[1] + b[1 + a[0]], a[2] + b[2 - a[0]]


def _members(rows: DataFrame, files: dict[str, list[Range]], most: int) -> dict[str, list[tuple[int, int, int, str, str]]]:
    """(start, place after the bracket, depth, key, bracket) of the containers under a key whose parents stand at most `most` deep."""
    states = {(p, r.start): (r.inside, r.depth) for p, ranges in files.items() for r in ranges}
    key_of = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$')

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, at = None, 0
        for path, start, _, values in _runs(batches):
            if (path, start) not in states:
                continue
            if state is None or state[0] != (path, start):
                state, at = ((path, start), *states[path, start]), 0
            text = b"}".join(values) + b"}"
            data = np.frombuffer(text, np.uint8)
            within, depth = scan(data, state[1], state[2])
            state = (state[0], int(within[-1]), int(depth[-1]))
            found = []
            for i in np.flatnonzero((_OPEN[data] == 1) & (within == 0) & (depth <= most + 1)).tolist():
                key = key_of.search(text, max(0, i - 1000), i)
                if key:
                    found.append((path, start, at + i + 1, int(depth[i]), json.loads(b'"' + key[1] + b'"'), chr(text[i])))
            at += len(text)
            if found:
                yield pa.RecordBatch.from_pydict(dict(zip(("path", "start", "place", "depth", "key", "bracket"), map(list, zip(*found)))))

    listed = rows.mapInArrow(run, "path string, start long, place long, depth long, key string, bracket string").limit(MOST_MEMBERS + 1).toArrow().to_pylist()
    if len(listed) > MOST_MEMBERS:
        raise ValueError("a document holds too much beside its records")
    out: dict[str, list] = {}
    for r in sorted(listed, key=lambda r: (r["path"], r["start"], r["place"])):
        out.setdefault(r["path"], []).append((r["start"], r["place"], r["depth"], r["key"], r["bracket"]))
    return out


def _placed_json(rows: DataFrame, files: dict[str, list[Range]], wrappers: Sequence[str]) -> list[str]:
    """Give each range the state that it begins in. Returns the files that hold no array of records."""
    objects = {}
    for path, ranges in files.items():
        inside, depth = 0, 0
        for r in ranges:
            r.inside, r.depth = inside, depth
            inside, depth = inside ^ r.flips, depth + r.delta[inside]
        head = ranges[0].head.removeprefix(_BOM)
        root = head.lstrip()[:1]
        if root == b"[":
            ranges[0].opens = ((head.index(b"[") + 1, 1),)
            for r in ranges[1:]:
                r.array = 1 if r.depth >= 1 else 0
        elif root == b"{":
            objects[path] = ranges
        elif root:
            raise ValueError("neither a JSON array nor an object")
    if not objects:
        return []
    whole = []
    members = _members(rows, objects, max((w.count(".") + 1 for w in wrappers), default=0)) if wrappers else {}
    for path, ranges in objects.items():
        arrays, names = [], {}
        for start, place, depth, key, bracket in members.get(path, []):
            names[depth] = key
            full = ".".join(names.get(d, "") for d in range(2, depth + 1))
            arrays.append((start, place, depth, full in wrappers and bracket == "["))
        if not any(a[-1] for a in arrays):
            whole.append(path)
        for r in ranges:
            r.opens = tuple((place, depth) for start, place, depth, wanted in arrays if start == r.start and wanted)
            # Nothing reaches an array's depth again, once it has closed, but by another member.
            last = [a for a in arrays if a[0] < r.start][-1:]
            r.array = last[0][2] if last and last[0][3] and r.depth >= last[0][2] else 0
    return whole


FRAGMENTS = "path string, start long, number long, record binary, goes_on boolean, ends boolean"


def _cut_json(r: Range, parts: Iterator[list[bytes]]) -> Iterator[tuple[bytes, bool, bool]]:
    """(text, whether it goes on with a record of the range before, whether the record ends here) of a range's records."""
    inside, depth, array, opens = r.inside, r.depth, r.array, list(r.opens)
    goes_on = bool(array) and (inside == 1 or depth > array)
    held, done, at, seen = b"", False, 0, 0
    for values in parts:
        seen += len(values)
        text = b"}".join(values) + (b"" if seen == r.pieces and not r.complete else b"}")
        data = np.frombuffer(text, np.uint8)
        if not len(data):
            continue
        within, level = scan(data, inside, depth)
        from_ = 0
        while True:
            if not array:
                if not opens or opens[0][0] > at + len(text):
                    break
                from_, array = opens[0][0] - at, opens.pop(0)[1]
            ends = np.flatnonzero((within[from_:] == 0) & (((data[from_:] == 44) & (level[from_:] == array)) | ((_CLOSE[data[from_:]] == 1) & (level[from_:] == array - 1)))) + from_
            closed = ends[level[ends] < array][:1]
            for e in ends[ends <= closed[0]].tolist() if len(closed) else ends.tolist():
                record = held + text[from_:e]
                if record.strip() or goes_on:
                    yield record, goes_on, True
                held, goes_on, from_ = b"", False, e + 1
            if not len(closed):
                held += text[from_:]
                break
            array = 0
        inside, depth, at = int(within[-1]), int(level[-1]), at + len(text)
    if array and (held.strip() or goes_on):
        yield held, goes_on, False


def line_ends_open(line: bytes, inside: bool, separator: bytes) -> bool:
    """Whether a line of CSV that begins inside quotes, or not, ends inside quotes."""
    if b'"' not in line:
        return inside
    at, n = 0, len(line)
    while True:
        if inside:
            while True:
                at = line.find(b'"', at)
                if at < 0:
                    return True
                if line[at + 1 : at + 2] != b'"':
                    break
                at += 2
            at += 1
        else:
            while line[at : at + 1] == b" ":
                at += 1
            if line[at : at + 1] == b'"':
                inside, at = True, at + 1
                continue
        at = line.find(separator, at)
        if at < 0:
            return False
        inside, at = False, at + 1


def _cut_lines(r: Range, parts: Iterator[list[bytes]], quoted: bytes | None) -> Iterator[tuple[bytes, bool, bool]]:
    """As `_cut_json` for lines; with a separator `quoted`, of CSV, in which a record goes on as long as quotes are open."""
    inside = bool(r.inside)
    goes_on, held = inside, []
    for values in parts:
        for line in values:
            held.append(line)
            inside = quoted is not None and line_ends_open(line, inside, quoted)
            if not inside:
                record = b"\n".join(held)
                if record.strip(b"\r" if quoted else None) or goes_on:
                    yield record, goes_on, True
                held, goes_on = [], False
    if held:
        yield b"\n".join(held) + b"\n", goes_on, False


def _cut(rows: DataFrame, files: dict[str, list[Range]], cutter) -> DataFrame:
    """Written table path, start, place (within the range) and record of all records, those that cross ranges put together."""
    states = rows.sparkSession.sparkContext.broadcast({(p, r.start): r for p, ranges in files.items() for r in ranges})  # one small entry a range

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, ahead = _runs(batches), []

        def of_range(key: tuple[str, int]) -> Iterator[list[bytes]]:
            while True:
                if not ahead:
                    following = next(runs, None)
                    if following is None:
                        return
                    ahead.append(following)
                if ahead[0][:2] != key:
                    return
                yield ahead.pop()[3]

        def rows_of(found: list) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=[c.split()[0] for c in FRAGMENTS.split(", ")])

        while True:
            if not ahead:
                following = next(runs, None)
                if following is None:
                    return
                ahead.append(following)
            key = ahead[0][:2]
            found, held, number = [], 0, 0
            parts = of_range(key)
            for record, goes_on, ends in cutter(states.value[key], parts) if key in states.value else ():
                found.append((*key, number, record, goes_on, ends))
                number += not goes_on
                held += len(record)
                if held > 8 << 20 or len(found) >= 10_000:
                    yield rows_of(found)
                    found, held = [], 0
            if found:
                yield rows_of(found)
            for _ in parts:  # a range that nothing is wanted of
                pass

    cut = materialize(rows.mapInArrow(run, FRAGMENTS), "split-records")
    whole = cut.filter("not goes_on and ends").select("path", "start", "number", "record")
    # Of each range at most the first fragment goes on and the last does not end.
    order = Window.partitionBy("path").orderBy("start", F.desc("goes_on"), "number")
    chained = cut.filter("goes_on or not ends").withColumn("chain", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(order))
    first = F.min(F.struct("start", "number")).alias("first")
    joined = F.array_sort(F.collect_list(F.struct("start", "number", "record")))
    bytes_of = F.unhex(F.array_join(F.transform(joined, lambda x: F.hex(x["record"])), ""))
    crossing = chained.groupBy("path", "chain").agg(first, bytes_of.alias("record")).select("path", "first.start", "first.number", "record")
    return whole.unionByName(crossing)


def _numbered(records: DataFrame) -> DataFrame:
    """`records` with `at`: their places in the file, counted over its ranges."""
    counts = records.groupBy("path", "start").agg((F.max("number") + 1).alias("n"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")  # one row a range
    return records.join(offsets, ["path", "start"]).withColumn("at", F.col("before") + F.col("number"))


def split_json(spark: SparkSession, paths: Sequence[str], wrappers: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(path, record_no, record) of the records of JSON documents, and the paths of files to be read whole: packed ones, and documents that are
    one record themselves."""
    rows = pieces(spark, paths, "}")
    files = _summaries(rows, _json_part, _json_composed, 1)
    whole = _packed(files)
    whole += _placed_json(rows, {p: r for p, r in files.items() if p not in whole}, tuple(wrappers))
    records = _numbered(_cut(rows, {p: r for p, r in files.items() if p not in whole}, _cut_json))
    text = F.regexp_replace(F.col("record").cast("string"), r"^\s+|\s+$", "")
    return records.select("path", F.col("at").alias("record_no"), text.alias("record")), whole


def split_lines(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """As `split_json` for the lines of JSON-lines files that are not blank."""
    rows = pieces(spark, paths, "\n")
    files = _summaries(rows, lambda values: (0, 0, 0), lambda a, b: a, 1)
    whole = _packed(files)
    records = _numbered(_cut(rows, {p: r for p, r in files.items() if p not in whole}, lambda r, parts: _cut_lines(r, parts, None)))
    return records.select("path", F.col("at").alias("record_no"), F.col("record").cast("string").alias("record")), whole


def split_csv(spark: SparkSession, paths: Sequence[str], separator: str, header_name: Callable[[str], str]) -> tuple[DataFrame, list[str]]:
    """As `split_json` for the rows of CSV files as JSON objects of their fields that are not blank."""
    by, form = separator.encode(), {"delimiter": separator, "skipinitialspace": True}
    rows = pieces(spark, paths, "\n")

    def part(values: list[bytes]) -> State:
        ends = [False, True]  # whether a range ends inside quotes, for both cases before it
        for line in values:
            ends = [line_ends_open(line, e, by) for e in ends]
        return 0, int(ends[0]), int(ends[1])

    files = _summaries(rows, part, lambda a, b: (0, b[1 + a[1]], b[1 + a[2]]), 100)
    whole, names = _packed(files), {}
    files = {p: r for p, r in files.items() if p not in whole}
    for path, ranges in files.items():
        header = next(csv.reader(io.StringIO(ranges[0].head.removeprefix(_BOM).decode(), newline=""), **form), [])
        names[path] = [header_name(h) for h in header]
        inside = 0
        for r in ranges:
            r.inside, inside = inside, r.delta[inside]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, at, record in zip(*(c.to_pylist() for c in batch.columns)):
                for values in csv.reader(io.StringIO(record.decode("utf-8-sig"), newline=""), **form):
                    if values and at:  # the first record is the header
                        fields = {name: v.strip() for name, v in zip(names[path], values) if name and v.strip()}
                        out.append((path, at - 1, json.dumps(fields, sort_keys=True, separators=(",", ":"), ensure_ascii=False)))
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(("path", "record_no", "record"), map(list, zip(*out)))))

    records = _numbered(_cut(rows, files, lambda r, parts: _cut_lines(r, parts, by))).select("path", "at", "record")
    return records.mapInArrow(parse, "path string, record_no long, record string"), whole
