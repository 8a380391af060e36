"""Bulk-synchronous best-fit packing of documents into sequences of a fixed capacity.

A document's ids are cut into pieces of at most `capacity` ids. Documents go in bands of size, the
largest first. In each superstep the documents of a band and the open gaps are sorted together by
size and cut into ranges, each swept by a task: from the largest size down, every document takes its
successor, the smallest open gap that holds it; where a band's documents are small against its gaps, what is left of a gap stays
open in the sweep. What a range leaves over meets the next ranges: all untouched gaps of an earlier
range hold all documents of a later one, so ranks decide which document gets which gap. Gaps are then
updated, and the band is swept again until no gap holds any of its documents. These open new sequences:
they are dealt by hash into parts of a range's size, each of which has the sizes of the whole, and are
packed there by best fit.

The driver sees one count for each size up to the capacity, and three for each range of RANGE_ROWS rows.
No group holds more than a range: one length, or one id, however frequent, is dealt over many.

Defined cases: a null text is an empty one, whose only id is the end id; a text without any word is
the same; repeated rows are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize
from ledgerloom.llm.tokens import loaded, tokenizer_json

CAPACITY = 2048
END_ID = 0
#: Rows of a range.
RANGE_ROWS = 1 << 15
#: Documents of at most the capacity's share 1 / LAST_BAND are one band.
LAST_BAND = 16

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of each text; with `with_ids` also its ids as little-endian uint32 bytes."""
    json = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer_path))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(json.value)
        step = 4 * capacity
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            out = []
            for doc_id, text in zip(ids, texts):
                tokens = memoryview(tokenizer.encode(text.as_py() or "") + end)
                for piece, at in enumerate(range(0, len(tokens), step)):
                    part = tokens[at : at + step]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), *([bytes(part)] if with_ids else [])))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]
            columns = list(zip(*out)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


SWEPT = "kind string, doc long, sequence long, size long, range long, rank long"


def sweep_range(rows: pa.Table, least: int | None = None) -> pa.Table:
    """One range's documents and gaps from the largest size down: each document takes the smallest open gap that holds it.

    What is left of a taken gap stays open in this sweep if it is at least `least`; without that each gap is taken once.
    What is left over, documents that met no gap and gaps that met no document, is ranked in order, for the ranges beside
    this one."""
    size, gap, ident = (rows[c].to_numpy() for c in ("size", "gap", "id"))
    gap = gap.astype(bool)
    order = np.lexsort((rows["slot"].to_numpy(), ident, ~gap, -size))
    fit = BestFit(least)
    gaps, docs = order[gap[order]], order[~gap[order]]
    for i, n in zip(gaps[::-1].tolist(), size[gaps[::-1]].tolist()):
        fit.open(i, n)
    taken = [fit.take(n) for n in size[docs].tolist()]
    met = np.array([t >= 0 for t in taken], bool)
    untouched = np.setdiff1d(gaps, np.array(taken, np.int64), assume_unique=False)
    open_gaps = gaps[np.isin(gaps, untouched)]
    at = np.concatenate([docs[met], docs[~met], open_gaps])
    a, b, c = int(met.sum()), int((~met).sum()), len(open_gaps)
    is_gap = np.arange(len(at)) >= a + b
    sequence = np.where(is_gap, ident[at], 0)
    sequence[:a] = ident[np.array(taken, np.int64)[met]]
    alone = (np.arange(len(at)) >= a) & ~is_gap
    kind = ["matched"] * a + ["document"] * b + ["gap"] * c
    rank = np.concatenate([np.zeros(a), np.arange(b), np.arange(c)]).astype(np.int64)
    columns = [
        pa.array(kind, pa.string()), pa.array(ident[at], mask=is_gap), pa.array(sequence, mask=alone),
        pa.array(size[at]), pa.array(np.full(len(at), rows["range"][0].as_py() if rows.num_rows else 0)), pa.array(rank),
    ]
    return pa.table(columns, names=[c.split()[0] for c in SWEPT.split(", ")])


class BestFit:
    """Open gaps by size, of which each document takes the smallest that holds it. Sizes are bits of one integer, so a successor
    is its lowest set bit."""

    def __init__(self, least: int | None):
        self.least, self.gaps, self.sizes = least, {}, 0

    def open(self, name: int, size: int) -> None:
        self.gaps.setdefault(size, []).append(name)
        self.sizes |= 1 << size

    def take(self, size: int) -> int:
        """The gap that a document of this size gets, or -1."""
        fits = self.sizes >> size
        if not fits:
            return -1
        found = size + (fits & -fits).bit_length() - 1
        names = self.gaps[found]
        name = names.pop()
        if not names:
            self.sizes ^= 1 << found
        if self.least is not None and found - size >= self.least:
            self.open(name, found - size)
        return name


def neighbours(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Which ranks of documents left in a range meet which ranks of gaps left in ranges before it.

    `counts` holds (range, documents left, gaps left), largest sizes first. Every gap of an earlier range holds every
    document of a later one, so ranks alone decide. Gives (range, first rank, count, range of the gaps, their first rank)."""
    open_gaps: list[list[int]] = []
    runs = []
    for at, docs, gaps in counts:
        met = 0
        while met < docs and open_gaps:
            n = min(docs - met, open_gaps[-1][1])
            open_gaps[-1][1] -= n
            runs.append((at, met, n, open_gaps[-1][0], open_gaps[-1][1]))
            met += n
            if not open_gaps[-1][1]:
                open_gaps.pop()
        if gaps:
            open_gaps.append([at, gaps])
    return runs


def new_sequences(rows: pa.Table, capacity: int, keep_last: bool = True) -> pa.Table:
    """Documents that no gap holds, packed into new sequences by best fit, the largest first; a sequence is named by its first document.

    Without `keep_last` the documents of the sequence that was opened last, which has most room, get none."""
    size, ident = rows["size"].to_numpy(), rows["id"].to_numpy()
    order = np.lexsort((ident, -size))
    fit, out, last = BestFit(1), np.zeros(len(size), np.int64), -1
    for i, n in zip(order.tolist(), size[order].tolist()):
        name = fit.take(n)
        if name < 0:
            name = last = i
            if n < capacity:
                fit.open(i, capacity - n)
        out[i] = name
    return pa.table({"doc": ident, "size": size, "sequence": pa.array(ident[out], mask=(out == last) & (not keep_last))})


def _ranges(entries: DataFrame, counts: list) -> DataFrame:
    """`entries` (size, gap, id, slot) with `range`: intervals of the descending order of about RANGE_ROWS rows.

    One size, however frequent, is dealt over as many ranges as it needs."""
    cuts, at, held = [], 0, 0
    for r in sorted(counts, key=lambda r: (-r["size"], not r["gap"])):
        if held and held + r["n"] > RANGE_ROWS:
            at, held = at + 1, 0
        parts = -(-r["n"] // RANGE_ROWS)
        cuts.append((r["size"], r["gap"], at, parts))
        at, held = (at, held + r["n"]) if parts == 1 else (at + parts, 0)
    spark = entries.sparkSession
    cuts = spark.createDataFrame(cuts, "c_size long, c_gap boolean, first long, parts long")  # two rows at most for each size up to the capacity
    placed = entries.join(F.broadcast(cuts), (F.col("size") == F.col("c_size")) & (F.col("gap") == F.col("c_gap")))
    return placed.select("size", "gap", "id", "slot", (F.col("first") + F.pmod(F.xxhash64("id", "slot"), F.col("parts"))).alias("range"))


def superstep(docs: DataFrame, gaps: DataFrame, largest: int, least: int | None) -> tuple[DataFrame | None, DataFrame, int]:
    """Match documents (doc, size) and gaps (sequence, size): (doc, size, sequence) of those that found a place, None if no gap
    holds any document; (doc, size) of those that found none; and their number. Both are written.

    `largest` is a bound on the documents' sizes. A gap in which several such fit is offered as several slots."""
    slots = F.greatest(F.floor(F.col("size") / largest), F.lit(1)).cast("int")
    offered = gaps.select("sequence", "size", F.explode(F.sequence(F.lit(1), slots)).alias("slot"), slots.alias("slots")).select(
        F.when(F.col("slot") < F.col("slots"), F.lit(largest)).otherwise(F.col("size") - (F.col("slots") - 1) * largest).cast("long").alias("size"), F.lit(True).alias("gap"), F.col("sequence").alias("id"), "slot"
    )
    entries = docs.select("size", F.lit(False).alias("gap"), F.col("doc").alias("id"), F.lit(0).alias("slot")).union(offered)
    counts = entries.groupBy("size", "gap").agg(F.count(F.lit(1)).alias("n")).collect()  # two rows at most for each size up to the capacity
    sizes = {side: [r["size"] for r in counts if r["gap"] == side] for side in (False, True)}
    if not sizes[False] or not sizes[True] or min(sizes[False]) > max(sizes[True]):
        return None, docs, sum(r["n"] for r in counts if not r["gap"])
    swept = materialize(_ranges(entries, counts).groupBy("range").applyInArrow(lambda rows: sweep_range(rows, least), SWEPT), "pack-sweep")
    of = lambda kind: F.count_if(F.col("kind") == kind)
    left = swept.filter("kind <> 'matched'").groupBy("range").agg(of("document").alias("docs"), of("gap").alias("gaps")).orderBy("range").collect()
    runs = neighbours([tuple(r) for r in left])
    plan = docs.sparkSession.createDataFrame([(n, *r) for n, r in enumerate(runs)], "run long, d_range long, d_first long, n long, g_range long, g_first long")
    plan = F.broadcast(plan)  # no more rows than ranges twice
    inside = lambda side: (F.col("range") == F.col(f"{side}_range")) & (F.col("rank") >= F.col(f"{side}_first")) & (F.col("rank") < F.col(f"{side}_first") + F.col("n"))
    ranked = swept.filter("kind = 'document'").select("doc", "size", "range", "rank").join(plan, inside("d"), "left").select("doc", "size", "run", (F.col("rank") - F.col("d_first")).alias("place"))
    free = swept.filter("kind = 'gap'").select("sequence", "range", "rank").join(plan, inside("g")).select("sequence", "run", (F.col("rank") - F.col("g_first")).alias("place"))
    step = swept.filter("kind = 'matched'").select("doc", "size", "sequence").union(ranked.join(free, ["run", "place"], "left").select("doc", "size", "sequence"))
    step = materialize(step, "pack-step")
    return step.filter("sequence is not null"), step.filter("sequence is null").select("doc", "size"), sum(r["docs"] for r in left) - sum(r[2] for r in runs)


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (length and other columns) with sequence_id and offset."""
    columns = pieces.columns
    pieces = materialize(pieces.withColumn("__doc", F.monotonically_increasing_id()), "pack-numbered")
    sized = pieces.select(F.col("__doc").alias("doc"), F.col("length").alias("size"))

    def open_new(band: DataFrame, parts: int, keep_last: bool) -> DataFrame:
        dealt = band.select("size", F.col("doc").alias("id"), F.pmod(F.xxhash64("doc"), F.lit(parts)).alias("part"))
        return materialize(dealt.groupBy("part").applyInArrow(lambda rows: new_sequences(rows, capacity, keep_last), "doc long, size long, sequence long"), "pack-new")

    # Documents over half the capacity open one sequence each: no two fit together.
    opened = sized.filter(F.col("size") > capacity // 2).select("doc", "size", F.col("doc").alias("sequence"))
    placed = [opened]
    gaps = materialize(opened.filter(F.col("size") < capacity).select("sequence", (capacity - F.col("size")).alias("size")), "pack-gaps")
    largest = capacity // 2
    while largest:
        least = largest // 2 if largest > capacity // LAST_BAND else 0
        band = sized.filter((F.col("size") > least) & (F.col("size") <= largest))
        # Gaps hold no more than half the capacity, so what is left of one can only serve documents of at most a quarter.
        again = least + 1 if 2 * (least + 1) <= capacity // 2 else None
        while True:
            matched, band, n = superstep(band, gaps.filter(F.col("size") > least), largest, again)
            if matched is not None:
                placed.append(matched)
                gaps = _updated(gaps, matched, None, capacity)
            elif n:
                # In the last band nothing follows to fill the parts' last sequences, so their documents are swept again together.
                parts = -(-n // RANGE_ROWS)
                keep_last = parts == 1 or least > 0
                opened = open_new(band, parts, keep_last)
                band, opened = opened.filter("sequence is null").select("doc", "size"), opened.filter("sequence is not null")
                placed.append(opened)
                gaps = _updated(gaps, None, opened, capacity)
                n = 0 if keep_last else n
            if not n:
                break
        largest = least
    sequence = reduce(DataFrame.union, placed).select(F.col("doc").alias("__doc"), F.col("sequence").alias("sequence_id"))
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "__doc")
    return pieces.join(sequence, "__doc").withColumn("offset", F.sum("length").over(order) - F.col("length")).select(*columns, "sequence_id", "offset")


def _updated(gaps: DataFrame, matched: DataFrame | None, new: DataFrame | None, capacity: int) -> DataFrame:
    """Written table of the gaps (sequence, size) after documents have been placed."""
    changes = gaps
    if matched is not None:
        changes = changes.union(matched.select("sequence", -F.col("size")))
    if new is not None:
        changes = changes.union(new.select("sequence", -F.col("size"))).union(new.filter("doc = sequence").select("sequence", F.lit(capacity).cast("long")))
    return materialize(changes.groupBy("sequence").agg(F.sum("size").alias("size")).filter("size > 0"), "pack-gaps")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return assign_sequences(token_pieces(docs, capacity, tokenizer_path), capacity)
