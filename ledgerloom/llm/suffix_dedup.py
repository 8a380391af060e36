"""Exact removal of repeated byte strings: every byte goes that a string of `window` bytes covers which also starts elsewhere.

*Where repeats can be.* A window's anchor is its leftmost gram of the least hash, so equal windows have equal anchors at equal
places. Anchors are counted by hash; only around those that occur again can a window repeat. An anchor's surroundings are
the bytes of all windows whose anchor it is. Surroundings that are equal as a whole repeat as a whole, which a
count of their digests shows. What is left are surroundings that differ somewhere, one of each: they are divided into parts
by where a window begins, and a part counts only if its core, the bytes common to all windows that can begin there, is that
of another part.

*Suffix arrays.* Parts with equal cores go to one shard, or to several if they are more than a shard holds. The core's bytes
stand as its digest. A shard sorts the suffixes of its parts by Larsson-Sadakane refinement: doubling depths, in each only what is
still unsorted. Common prefixes of neighbours follow by Kasai's argument: places whose preceding bytes differ are compared, all
others follow from the place before. Runs of common prefixes of at least a window are equal windows.

*Merging.* Windows of cores that are dealt over several shards are merged: each shard sends one of each of its distinct
windows, which its core and the few bytes beside it determine, in sorted runs, cut into slices by content; a task merges the runs
of a slice by binary search. So no task holds more than a shard or a slice, however often a passage occurs.

Digests of whole surroundings, parts and cores have 128 bits. Broadcast are two bit maps of a fixed size, which tell the tasks
what anchors occur again and what surroundings to send; what they let pass by chance drops out by exact counts and a join.

Defined cases: a null text is the empty one; texts shorter than a window keep all; repeated rows are places of their own, so both
go; overlapping occurrences within a text count; a text of any length is read whole, in pieces of CHUNK windows; what is
kept may end within a UTF-8 character, so it is binary; an empty table gives no rows; other columns are carried by `remove_repeats`, whatever
their names, and ids may be null or repeat.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bit_map, join_uneven, materialize, mix64, text_bytes

WINDOW = 400
#: Bytes of a gram, and how many parts the starts of an anchor's windows are divided into.
GRAM, PARTS = 160, 8
#: Windows whose anchors are found together; places of their grams have to fit in _PLACE bits.
CHUNK, _PLACE = 1 << 19, 20
#: Parts that one shard sorts, and windows of a slice that a task merges.
SHARD, SLICE = 8192, 1 << 15
#: Bits of the map of the surroundings that are wanted (4 MB).
MAP_BITS = 1 << 25

_BASE = 0x9E3779B97F4A7C15
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64))
_BELOW = np.uint64((1 << _PLACE) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Anchors:
    """Finds anchors: of every window the leftmost gram of the least hash."""

    def __init__(self, window: int, gram: int):
        if not 0 < gram < window:
            raise ValueError("a gram has to be shorter than a window")
        self.window, self.gram, self.grams = window, gram, window - gram + 1
        if CHUNK + window > 1 << _PLACE:
            raise ValueError("windows too long")
        size = CHUNK + window
        self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """A hash of the gram at each place; it does not depend on the place."""
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * self.up[: len(data)], out=sums[1:])
        return mix64((sums[self.gram :] - sums[: -self.gram]) * self.down[: len(data) - self.gram + 1])

    def find(self, data: np.ndarray, valid: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Places of the anchors of all (valid) windows of at most CHUNK + window - 1 bytes, in order, the starts of the first and
        last window of each, and their hashes."""
        none = np.zeros(0, np.int64)
        if len(data) < self.window:
            return none, none, none, np.zeros(0, np.uint64)
        hashes = self.hashes(data)
        least = (hashes & ~_BELOW) | np.arange(len(hashes), dtype=np.uint64)
        span = 1
        while 2 * span <= self.grams:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < self.grams:
            least = np.minimum(least[: -(self.grams - span)], least[self.grams - span :])
        places = (least & _BELOW).astype(np.int64)
        start = np.arange(len(places)) if valid is None else np.flatnonzero(valid[: len(places)])
        places = places[start]
        if not len(places):
            return none, none, none, np.zeros(0, np.uint64)
        heads = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        places = places[heads]
        return places, start[heads], start[np.append(heads[1:] - 1, len(start) - 1)], hashes[places]

    def of_texts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, place in it, starts of the first and last window, hash) of the anchors of some texts, a few hundred thousand windows at
        a time. Where a long text is cut, an anchor may come twice, with windows on both sides."""
        sizes = np.diff(offsets)
        part = (np.cumsum(sizes) - 1) // (CHUNK // 2)
        edges = np.append(np.searchsorted(part, np.unique(part)), len(sizes)).tolist()
        for a, b in zip(edges[:-1], edges[1:]):
            if sizes[a:b].sum() <= CHUNK:
                start, stop = int(offsets[a]), int(offsets[b])
                own = np.arange(stop - start) + self.window <= np.repeat(offsets[a + 1 : b + 1] - start, sizes[a:b])
                places, first, last, hashes = self.find(data[start:stop], own)
                text = np.searchsorted(offsets[a : b + 1] - start, places, side="right") - 1 + a
                before = offsets[text] - start
                yield text, places - before, first - before, last - before, hashes
                continue
            for i in range(a, b):  # the last text of a part may reach far beyond it
                for at in range(0, max(int(sizes[i]) - self.window + 1, 0), CHUNK):
                    places, first, last, hashes = self.find(data[offsets[i] + at : offsets[i] + min(at + CHUNK + self.window - 1, int(sizes[i]))])
                    yield np.full(len(places), i), places + at, first + at, last + at, hashes


def digest(content: bytes, before: int) -> bytes:
    return hashlib.blake2b(content, digest_size=16, salt=before.to_bytes(8)).digest()


def hash_bits(hashes: np.ndarray) -> np.ndarray:
    """The bit of a hash in the map."""
    return (hashes & np.uint64(MAP_BITS - 1)).astype(np.int64)


def place_bits(row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The bit of surroundings in the map; they are known by where they begin."""
    return (mix64(mix64(row.astype(np.uint64)) + place.astype(np.uint64)) & np.uint64(MAP_BITS - 1)).astype(np.int64)


def anchors_of(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """The hash of every anchor of `docs` (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(window, gram)
        for batch in batches:
            for *_, hashes in finder.of_texts(*text_bytes(batch.column(0))):
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["hash"])

    return docs.select("text").mapInArrow(run, "hash long")


def surroundings_of(docs: DataFrame, window: int, gram: int, wanted, by_hash: bool) -> DataFrame:
    """Anchors of `docs` (row, text) that a broadcast map wants, and what surrounds them.

    By hash: (row, place, before, after, hash, whole, bit), `whole` being the digest of the surroundings, of which `before` bytes stand
    before the anchor and `after` from it on. Else by place: (row, place, before, content) with the surroundings themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(window, gram)
        for batch in batches:
            rows = batch.column(0).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            view = memoryview(data)
            for text, place, first, last, hashes in finder.of_texts(data, offsets):
                bit = hash_bits(hashes) if by_hash else place_bits(rows[text], first)
                some = (wanted.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                text, place, first, last, hashes = (x[some] for x in (text, place, first, last, hashes))
                before = place - first
                begin, end = offsets[text] + first, offsets[text] + last + window
                pieces = [bytes(view[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
                columns = {"row": pa.array(rows[text]), "place": pa.array(place), "before": pa.array(before)}
                if by_hash:
                    whole = [digest(p, n) for p, n in zip(pieces, before.tolist())]
                    columns |= {"after": pa.array(last + window - place), "hash": pa.array(hashes.view(np.int64)), "whole": pa.array(whole, pa.binary()), "bit": pa.array(place_bits(rows[text], first))}
                else:
                    columns |= {"content": pa.array(pieces, pa.binary())}
                yield pa.RecordBatch.from_pydict(columns)

    schema = "row long, place long, before long, after long, hash long, whole binary, bit long" if by_hash else "row long, place long, before long, content binary"
    return docs.select("row", "text").mapInArrow(run, schema)


def suffix_array(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes of all parts in order; `ends` holds the end of the part at each place, and a part's end differs from any other.

    Larsson-Sadakane: a suffix's rank is the first place of its group of suffixes with equal beginnings of the present depth; each
    round sorts the groups that are still several by the ranks that stand one depth further on."""
    n = len(data)
    rest = ends - np.arange(n)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    eight = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(np.uint64)
    cut = np.maximum(8 - rest, 0)
    head = np.where(cut > 0, (eight >> np.minimum(8 * cut, 63).astype(np.uint64)) << np.minimum(8 * cut, 63).astype(np.uint64), eight)
    # Suffixes that end within the depth come before longer ones with the same bytes and are told apart by their part.
    ended = np.where(cut > 0, ends - n - 1, 0)
    ends_first = np.where(cut > 0, rest, 8)
    order = np.lexsort((ended, ends_first, head))

    def heads(*keys: np.ndarray) -> np.ndarray:
        new = np.zeros(len(keys[0]), bool)
        new[:1] = True
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        return new

    new = heads(head[order], ends_first[order], ended[order])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    depth = 8
    open_ = np.flatnonzero(~new | ~np.append(new[1:], True))
    while len(open_):
        # A suffix that ends within twice the depth still has its own rank there: that of its part's end, which no other has.
        suffix = order[open_]
        ahead = np.where(rest[suffix] > depth, rank[np.minimum(suffix + depth, n - 1)], ends[suffix] - n - 1)
        group = rank[suffix]
        by = np.lexsort((ahead, group))
        suffix, ahead, group = suffix[by], ahead[by], group[by]
        order[open_] = suffix
        new = heads(group, ahead)
        first = np.maximum.accumulate(np.where(new, open_, 0))
        rank[suffix] = first
        open_ = open_[~new | ~np.append(new[1:], True)]
        depth *= 2
    return order


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of each suffix in `order`, the bytes it has in common with the one before it; the first has none.

    Kasai: where the bytes before two neighbours are equal, the suffixes one place earlier were neighbours too, with one byte more in
    common. So only the other places are compared, eight bytes at a time."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    starts = np.concatenate([[True], ends[1:] != ends[:-1]])
    other = np.maximum(before, 0)
    follows = (before > 0) & ~starts & ~starts[other] & (data[at - 1] == data[other - 1])
    compared = np.flatnonzero((before >= 0) & ~follows)
    most = np.minimum(ends[compared] - compared, ends[before[compared]] - before[compared])
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    eight = np.ndarray((n,), "<u8", padded, strides=(1,))
    common = np.zeros(len(compared), np.int64)
    left = np.flatnonzero(most > 0)
    while len(left):
        x, y = compared[left] + common[left], before[compared[left]] + common[left]
        apart = eight[x] ^ eight[y]
        low = apart & (~apart + np.uint64(1))
        same = np.where(apart == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) >> 3)
        common[left] += same
        left = left[(same == 8) & (common[left] < most[left])]
    prefix = np.zeros(n, np.int64)
    prefix[compared] = np.minimum(common, most)
    source = np.maximum.accumulate(np.where(follows, 0, at))
    prefix = np.maximum(prefix[source] - (at - source), 0)
    prefix[before < 0] = 0
    return prefix[order]


def repeats(group: np.ndarray, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each member's group has members at more than one place; members of a group stand together."""
    if not len(group):
        return np.zeros(0, bool)
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    several = (np.maximum.reduceat(row, heads) != np.minimum.reduceat(row, heads)) | (np.maximum.reduceat(place, heads) != np.minimum.reduceat(place, heads))
    return np.repeat(several, np.diff(heads, append=len(group)))


SHARDED = "whole binary, first long, last long, core binary, start long, beside binary, row long, place long, repeated boolean, sub int"


def shard_windows(rows: pa.Table) -> pa.Table:
    """What repeats in a shard of parts: starts, against its anchor, of a part's first and last repeated window.

    A part stands as the bytes before its core, the core's digest, and the bytes after it, so `span`, the length of its windows, is
    counted in these. Of cores that are dealt over several shards also the windows, one of each that repeats here and all others:
    core, start, the bytes beside the core, and the text and place where it stands."""
    left, core, right = (rows[c].to_pylist() for c in ("left", "core", "right"))
    low, spans, row, anchor = (rows[c].to_numpy() for c in ("low", "span", "row", "place"))
    contents = [b"".join(x) for x in zip(left, core, right)]
    sizes = np.array([len(c) for c in contents], np.int64)
    data = np.frombuffer(b"".join(contents), np.uint8)
    part_end = np.cumsum(sizes)
    ends = np.repeat(part_end, sizes)
    order = suffix_array(data, ends)
    span = np.repeat(spans, sizes)[order]
    holds = (ends - np.arange(len(data)))[order] >= span  # suffixes that begin with a window
    shared = (common_prefixes(data, ends, order) >= span)[holds]
    at = order[holds]
    group = np.cumsum(~shared)
    part = np.searchsorted(part_end, at, side="right")
    start = at - (part_end - sizes)[part] + low[part]
    row, place = row[part], anchor[part] + start
    repeated = repeats(group, row, place)
    known = np.zeros(int(group[-1]) + 1, bool)
    known[group[repeated | rows["repeated"].to_numpy(zero_copy_only=False)[part]]] = True
    repeated = known[group]

    far = np.iinfo(np.int64).max
    first, last = np.full(len(sizes), far), np.full(len(sizes), -far)
    np.minimum.at(first, part[repeated], start[repeated])
    np.maximum.at(last, part[repeated], start[repeated])
    some = np.flatnonzero(first <= last)
    kinds = {"binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in SHARDED.split(", "))])
    found = [rows["whole"].take(some), pa.array(first[some]), pa.array(last[some]), *[pa.nulls(len(some), f.type) for f in list(schema)[3:]]]
    out = [pa.table(found, schema=schema)]
    if rows["parts"][0].as_py() > 1:
        sent = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]) | ~repeated)
        whole, sub, made = rows["whole"].to_pylist(), rows["sub"][0].as_py(), []
        for i in sent.tolist():
            p, s = part[i], int(start[i])
            beside = left[p][s - low[p] :]
            beside += right[p][: spans[p] - len(core[p]) - len(beside)]
            made.append((whole[p], None, None, core[p], s, beside, int(row[i]), int(place[i]), bool(repeated[i]), sub))
        out.append(pa.table([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema))
    return pa.concat_tables(out)


def merged_windows(rows: pa.Table) -> pa.Table:
    """Windows of one core and slice, in runs by shard: which of those that do not repeat in their own shard repeat in another.

    A window's key is its start and the bytes beside the core. Each run is merged into those before it by binary search."""
    keys = np.array([(s + (1 << 30)).to_bytes(4) + b + b"\1" for s, b in zip(rows["start"].to_pylist(), rows["beside"].to_pylist())])
    sub, row, place = (rows[c].to_numpy() for c in ("sub", "row", "place"))
    known = rows["repeated"].to_numpy(zero_copy_only=False).astype(bool)
    merged = keys[:0]
    for run in np.unique(sub):
        run = np.unique(keys[sub == run])
        at = np.searchsorted(merged, run)
        new = np.ones(len(run), bool) if not len(merged) else merged[np.minimum(at, len(merged) - 1)] != run
        merged = np.insert(merged, at[new], run[new])
    group = np.searchsorted(merged, keys)
    by = np.argsort(group, kind="stable")
    several = np.zeros(len(keys), bool)
    several[by] = repeats(group[by], row[by], place[by])
    hit = np.zeros(len(merged), bool)
    hit[group[several | known]] = True
    some = np.flatnonzero(hit[group] & ~known)
    start = rows["start"].take(some)
    return pa.table({"whole": rows["whole"].take(some), "first": start, "last": start})


def _slice(content: str, begin: Column, end: Column, before: Column) -> Column:
    """Bytes of an anchor's surroundings; places are against the anchor."""
    return F.substring(F.col(content), (before + begin + 1).cast("int"), (end - begin).cast("int"))


def surrounded_parts(around: DataFrame, window: int, gram: int, parts: int) -> DataFrame:
    """Written table: the parts of surroundings, with the starts of their first and last window, the digest of the core, and the
    bytes of their windows to the left and to the right of it."""
    reach = window - gram
    cuts = [-reach + j * (reach + 1) // parts for j in range(parts + 1)]
    ranges = F.array(*[F.struct(F.lit(j).alias("part_no"), F.lit(cuts[j]).alias("least"), F.lit(cuts[j + 1] - 1).alias("most")) for j in range(parts) if cuts[j] < cuts[j + 1]])
    each = around.withColumn("after", F.length("content") - F.col("before")).select("*", F.inline(ranges))
    each = each.withColumns({"low": F.greatest("least", -F.col("before")), "high": F.least(F.col("most"), F.col("after") - window)}).filter("low <= high")
    low, high, least, most = (F.col(c) for c in ("low", "high", "least", "most"))
    core = F.unhex(F.md5(F.concat(F.encode(F.col("part_no").cast("string"), "utf-8"), _slice("content", most, least + window, F.col("before")))))
    left, right = _slice("content", low, most, F.col("before")), _slice("content", least + window, high + window, F.col("before"))
    span = (most - least + F.length("core")).cast("long").alias("span")
    columns = ["whole", "n", "row", "place", low.cast("long").alias("low"), high.cast("long").alias("high"), span, "core", left.alias("left"), right.alias("right")]
    return materialize(each.withColumn("core", core).select(*columns), "suffix-parts", "zstd")


def differing(around: DataFrame, window: int, gram: int, parts: int, shard: int, slice_rows: int) -> DataFrame:
    """(whole, from, to) of surroundings that differ from all others: the bytes, against the anchor, that repeated windows cover."""
    each = surrounded_parts(around, window, gram, parts)
    same = ["core", "low", "left", "right"]  # equal parts have equal windows
    one = F.min(F.struct("row", "place", "whole", "high", "span")).alias("one")
    distinct = materialize(each.groupBy(*same).agg(F.sum("n").alias("copies"), F.count(F.lit(1)).alias("wholes"), one), "suffix-distinct-parts", "zstd")
    covered = lambda df, a, b: df.select("whole", F.col(a).alias("from"), (F.col(b) + window).alias("to"))
    out = covered(join_uneven(each, distinct.filter("copies > 1").select(*same, "wholes"), same, "wholes"), "low", "high")

    cores = distinct.groupBy("core").agg(F.count(F.lit(1)).alias("members"), F.count_if(F.col("copies") == 1).alias("single")).filter("members > 1 and single > 0")
    in_slices = F.ceil(F.col("members") * math.ceil((window - gram + 1) / parts) / slice_rows).cast("int")
    cores = materialize(cores.select("core", "members", F.ceil(F.col("members") / shard).cast("int").alias("parts"), in_slices.alias("slices")), "suffix-cores")
    total = cores.agg(F.sum("members").alias("n")).first()["n"] or 0
    if not total:
        return out
    met = join_uneven(distinct.select(*same, (F.col("copies") > 1).alias("repeated"), "one.*"), cores, ["core"], "members")
    split = F.col("parts") > 1
    dealt = met.withColumns({
        "shard": F.when(split, F.lit(-1)).otherwise(F.pmod(F.xxhash64("core"), F.lit(-(-total // shard)))),
        "sub": F.when(split, F.pmod(F.xxhash64("left", "right", "low"), F.col("parts"))).otherwise(F.lit(0)).cast("int"),
        "of": F.when(split, F.col("core")),
    })
    wanted = ["whole", "core", "repeated", "row", "place", "low", "span", "left", "right", "parts", "shard", "sub", "of"]
    sorted_ = materialize(dealt.select(*wanted).groupBy("shard", "sub", "of").applyInArrow(shard_windows, SHARDED), "suffix-shards")
    out = out.union(covered(sorted_.filter("core is null"), "first", "last"))
    several = cores.filter(split).select("core", "slices", "members")
    windows = join_uneven(sorted_.filter("core is not null").drop("first", "last"), several, ["core"], "members")
    windows = windows.withColumn("slice", F.pmod(F.xxhash64("start", "beside"), F.col("slices"))).drop("slices")
    return out.union(covered(windows.groupBy("core", "slice").applyInArrow(merged_windows, "whole binary, first long, last long"), "first", "last"))


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int | None = None, parts: int = PARTS, shard: int = SHARD, slice_rows: int = SLICE) -> DataFrame:
    """row, spans (start and end in bytes, not yet united) of the rows of `docs` (row, text; read three times) that hold repeated windows."""
    gram = gram or max(1, window * GRAM // WINDOW)
    broadcast = docs.sparkSession.sparkContext.broadcast
    seen = anchors_of(docs, window, gram).groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    wanted = broadcast(bit_map(seen.select(F.col("hash").bitwiseAND(F.lit(MAP_BITS - 1)).alias("bit")), "bit", MAP_BITS))
    anchors = materialize(surroundings_of(docs, window, gram, wanted, True), "suffix-anchors", "zstd")
    one = F.min(F.struct("row", "place", "bit")).alias("one")
    same = ["hash", "whole", "before", "after"]  # the digest alone decides
    cells = anchors.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), one)
    cells = materialize(cells, "suffix-surroundings", "zstd")
    covered = cells.filter("n > 1").select("whole", (-F.col("before")).alias("from"), F.col("after").alias("to"))
    several = cells.groupBy("hash").agg(F.count(F.lit(1)).alias("wholes"), F.count_if(F.col("n") == 1).alias("single")).filter("wholes > 1 and single > 0")
    several = materialize(several.select("hash", "wholes"), "suffix-hashes")
    open_ = materialize(join_uneven(cells.select("hash", "whole", "before", "n", "one.*"), several, ["hash"], "wholes").select("whole", "before", "n", "row", "place", "bit"), "suffix-open")
    wanted = broadcast(bit_map(open_, "bit", MAP_BITS))
    around = surroundings_of(docs, window, gram, wanted, False).join(open_.drop("bit"), ["row", "place", "before"])
    around = materialize(around, "suffix-around", "zstd")
    covered = covered.union(differing(around, window, gram, parts, shard, slice_rows))
    ranges = covered.groupBy("whole").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    # How many anchors have these surroundings: many have if the surroundings repeat as a whole.
    ranges = materialize(ranges.join(cells.select("whole", "n"), "whole"), "suffix-ranges")
    met = join_uneven(anchors.select("row", "place", "whole"), ranges, ["whole"], "n")
    span = F.struct((F.col("place") + F.col("from")).alias("start"), (F.col("place") + F.col("to")).alias("end"))
    return met.groupBy("row").agg(F.collect_list(span).alias("spans"))


def united(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of overlapping or touching (start, end) rows."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    heads = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.column_stack([spans[heads, 0], reach[np.append(heads[1:] - 1, len(spans) - 1)]])


def _numbered(docs: DataFrame, text_col: str) -> DataFrame:
    """Written copy of `docs` with a row number, which stays the same however often it is read."""
    return materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("others")), "suffix-documents", "zstd")


def remove_repeats(docs: DataFrame, window: int = WINDOW, text_col: str = "text", **sizes: int) -> DataFrame:
    """Every row of `docs`: its other columns as the struct `others`, n_bytes, spans (the maximal removed runs, in bytes) and kept (binary)."""
    docs = _numbered(docs, text_col)
    found = repeated_ranges(docs.select("row", "text"), window, **sizes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            view, cuts, kept = memoryview(data), [], []
            for i, spans in enumerate(batch.column(2)):
                runs = np.zeros((0, 2), np.int64)
                if spans.is_valid:
                    runs = united(np.column_stack([spans.values.field("start").to_numpy(), spans.values.field("end").to_numpy()]))
                text = view[offsets[i] : offsets[i + 1]]
                edges = [0, *runs.ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                cuts.append([{"start": a, "end": b} for a, b in runs.tolist()])
            columns = [batch.column(0), pa.array(np.diff(offsets)), pa.array(cuts, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["others", "n_bytes", "spans", "kept"])

    others = docs.schema["others"].dataType.simpleString()
    return docs.join(found, "row", "left").select("others", "text", "spans").mapInArrow(cut, f"others {others}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
