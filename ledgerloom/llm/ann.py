"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors of one length whose norms differ by less than the square root of 2 are a zone. Within a zone they are
lifted by one component so that the largest inner product is the smallest distance, and a balanced bisection
of a bounded sample gives the zone's centroids. They are few (`max_lists`), so each task
holds them and searches them by a graph of their neighbours. A vector goes to its nearest list and,
if it stands near a boundary, to further ones (replicas whose distance is within `replicate` of the
nearest, and that are not much closer to a list chosen before). A query probes, in each zone, all lists whose distance
is within `prune` of the nearest, however many: the graph finds those of most queries, and where its
`beam` ends within the ratio all centroids are compared. A length's rarest norms share a zone, and
lengths beyond the most frequent ones have a single list each, found without the broadcast.

Lists follow the table's size. Short neighbouring ones are scored in one task's group, each by its own queries.
Long ones are split by centroids of their own, fitted
on the list's sample: vectors go to the nearest part and boundary replicas, queries to the parts within
the ratio. What the broadcast holds does not grow; the parts' centroids meet their list in a shuffle.

The lists of a query's best centroids are scored first. The worst of its best scores there bounds what other lists send,
and a zone whose largest norm times the query's own cannot reach it is not visited, which loses no result. A query that met
fewer than k others probes on, further lists each time, until it has k or has seen all.
Scores are inner products of the original vectors in double precision.

Rows with equal id and vector are one row. Of equal vectors only the k + 1 smallest ids can be in a
result, and a per-group limit drops the others before the shuffle. Equal queries are searched once;
very common ones take their answer from a broadcast of fewer than 2,048 of them.
This loses no result and keeps a very common vector from filling one list or task.

Defined cases: null, zero or non-finite vectors and rows without an id take no part; vectors meet only those of their own
length; of rows that repeat an id the best score counts; ties go to
the smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ledgerloom.llm.common import join_uneven, materialize


@dataclass(frozen=True)
class IndexBound:
    """Bounds of the sample, the centroids and the zones that have centroids, and the two distance ratios."""

    sample_rows: int = 32_768
    max_lists: int = 8_192
    list_rows: int = 64
    replicas: int = 3
    replicate: float = 1.15
    closer: float = 0.5
    prune: float = 1.2
    least_probes: int = 4
    beam: int = 160
    part_rows: int = 4_096
    lengths: int = 8
    norms: int = 24


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, vec and vec_hash of the rows that take part. Single-precision vectors stay so, which loses nothing."""
    element = df.schema[vector_col].dataType.elementType.simpleString()
    vec = F.col(vector_col).cast(f"array<{'float' if element == 'float' else 'double'}>")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    )
    return usable.withColumn("vec_hash", F.xxhash64("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length and their vectors."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, _matrix(column.take(pa.array(rows)))


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of rows that are not zero; no square overflows."""
    largest = np.abs(x).max(axis=1, keepdims=True, initial=0)
    with np.errstate(over="ignore"):
        return np.minimum(1e308, largest[:, 0] * np.sqrt(((x / largest) ** 2).sum(axis=1)))


def norm_bands(norm: np.ndarray) -> np.ndarray:
    """Bands of a width of the square root of 2; those of norm 1 are in the middle of one."""
    return np.floor(2 * np.log2(norm) + 0.5).astype(np.int32)


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 1) -> np.ndarray:
    """Means of `lists` parts of x whose sizes differ by little: bisection, each cut at the share of its two sides."""
    rng = np.random.default_rng(seed)
    todo, out = [(np.arange(len(x)), lists)], []
    while todo:
        rows, k = todo.pop()
        if k == 1 or len(rows) < 2:
            out.append(x[rows].mean(axis=0))
            continue
        left = k // 2
        a, b = x[rng.choice(rows, 2, replace=False)]
        cut = max(1, min(len(rows) - 1, round(len(rows) * left / k)))
        for _ in range(6):
            order = np.argsort(x[rows] @ (b - a), kind="stable")  # by distance to a less that to b
            one, two = rows[order[:cut]], rows[order[cut:]]
            a, b = x[one].mean(axis=0), x[two].mean(axis=0)
        todo += [(two, k - left), (one, left)]
    return np.array(out, np.float32)


class CentroidGraph:
    """Centroids and, for each, its nearest neighbours and some far links; searched best first, many queries at once."""

    def __init__(self, centroids: np.ndarray, degree: int = 16, far: int = 4, seed: int = 1):
        self.c = centroids.astype(np.float32)
        n = len(self.c)
        self.sq = (self.c**2).sum(axis=1)
        rng = np.random.default_rng(seed)
        near = []
        for start in range(0, n, 1024):
            d = self.sq[None] - 2 * self.c[start : start + 1024] @ self.c.T
            d[np.arange(len(d)), np.arange(start, start + len(d))] = np.inf
            k = min(degree, max(1, n - 1))
            near.append(np.argpartition(d, k - 1, axis=1)[:, :k])
        links = rng.integers(0, n, (n, far))
        self.graph = np.concatenate([np.concatenate(near), links], axis=1)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 48)).astype(np.int64))

    def _distances(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared, without the query's own square."""
        return self.sq[ids] - 2 * np.einsum("qd,qnd->qn", q, self.c[ids])

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the about `beam` nearest centroids of each query, nearest first."""
        n, beam = len(self.c), min(beam, len(self.c))
        q = q.astype(np.float32)
        rows = np.arange(len(q))[:, None]
        ids = np.tile(self.entries, (len(q), 1))
        d = self._distances(q, ids)
        seen = np.zeros((len(q), n), bool)
        seen[rows, ids] = True
        done = np.zeros(ids.shape, bool)
        if ids.shape[1] > beam:
            keep = np.argpartition(d, beam - 1, axis=1)[:, :beam]
            ids, d, done = ids[rows, keep], d[rows, keep], done[rows, keep]
        width = 4  # centroids expanded at once
        while True:
            todo = np.where(done, np.inf, d)
            k = min(width, todo.shape[1])
            pick = np.argpartition(todo, k - 1, axis=1)[:, :k] if k < todo.shape[1] else np.tile(np.arange(k), (len(q), 1))
            live = np.isfinite(todo[rows, pick])
            if not live.any():
                break
            done[rows, pick] = True
            new = np.where(live[:, :, None], self.graph[ids[rows, pick]], ids[:, :1, None]).reshape(len(q), -1)
            new.sort(axis=1)
            fresh = ~seen[rows, new]
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            seen[rows, new] = True
            nd = np.where(fresh, self._distances(q, new), np.inf)
            ids = np.concatenate([ids, new], axis=1)
            d = np.concatenate([d, nd], axis=1)
            done = np.concatenate([done, ~fresh], axis=1)
            if d.shape[1] > beam:
                keep = np.argpartition(d, beam - 1, axis=1)[:, :beam]
                ids, d, done = ids[rows, keep], d[rows, keep], done[rows, keep]
        order = np.argsort(d, axis=1, kind="stable")
        d = d[rows, order] + (q**2).sum(axis=1)[:, None]
        return ids[rows, order], np.sqrt(np.maximum(d, 0))

    def all_of(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of all centroids of each query, nearest first."""
        q = q.astype(np.float32)
        d = (q**2).sum(axis=1)[:, None] + self.sq - 2 * q @ self.c.T
        ids = np.argsort(d, axis=1, kind="stable")
        return ids, np.sqrt(np.maximum(np.take_along_axis(d, ids, axis=1), 0))


def lifted(x: np.ndarray, scale: float, stored: bool) -> np.ndarray:
    """Vectors over the largest norm, with a last component that brings stored ones to norm 1. A query's length does not
    change its order of inner products, so it is brought to norm 1 as well and distances compare with the lists'."""
    x = x / scale
    if stored:
        return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x**2).sum(axis=1)))[:, None]], axis=1)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    return np.concatenate([x / np.sqrt((x**2).sum(axis=1, keepdims=True)), np.zeros((len(x), 1))], axis=1)


def stored_lists(centroids: np.ndarray, ids: np.ndarray, d: np.ndarray, bound: IndexBound) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs of vectors whose nearest lists are `ids` at distances `d`: the nearest and boundary replicas."""
    ids, d = ids[:, : 2 * bound.replicas], d[:, : 2 * bound.replicas]
    take = (d <= bound.replicate * d[:, :1]) & np.isfinite(d)
    for j in range(1, ids.shape[1]):
        for i in range(j):  # a list that is much nearer to one chosen before adds little
            gap = np.sqrt(((centroids[ids[:, j]] - centroids[ids[:, i]]) ** 2).sum(axis=1))
            take[:, j] &= ~(take[:, i] & (gap < bound.closer * d[:, j]))
    take &= take.cumsum(axis=1) <= bound.replicas
    rows, at = np.nonzero(take)
    return rows, ids[rows, at]


def probed_lists(ids: np.ndarray, d: np.ndarray, bound: IndexBound, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs, nearest first: lists within the ratio of the nearest, `least` at least."""
    rows, at = np.nonzero((d <= bound.prune * d[:, :1]) | (np.arange(d.shape[1]) < least))
    return rows, ids[rows, at]


#: The band of those norms of a length that have no zone of their own.
_REST = -(1 << 20)


@dataclass(frozen=True)
class Zone:
    """Centroids of vectors of one length and band of norms; list numbers start at `first`."""

    graph: CentroidGraph
    scale: float  # the largest norm
    first: int


@dataclass(frozen=True)
class Index:
    zones: dict[tuple[int, int], Zone]  # by length and band
    bound: IndexBound
    lists: int
    together: int = 1  # neighbouring lists that are scored in one group

    def cells(self, lists: np.ndarray) -> np.ndarray:
        """The group of `together` lists of one zone in which each list is scored; a list without a zone is its own."""
        first = np.array([zone.first for zone in self.zones.values()])
        each = -(-np.diff(first, append=self.lists) // self.together)
        zone = np.maximum(0, np.searchsorted(first, lists, side="right") - 1)
        return np.where(lists < 0, lists, np.cumsum(each)[zone] - each[zone] + (lists - first[zone]) // self.together)

    def _stored(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, list) pairs of vectors of one length."""
        d, bands = x.shape[1], norm_bands(norms(x))
        bands[~np.isin(bands, [b for n, b in self.zones if n == d])] = _REST
        for band in np.unique(bands):
            zone, of = self.zones.get((d, int(band))), np.flatnonzero(bands == band)
            if zone is None:
                yield of, np.full(len(of), -d)
                continue
            for start in range(0, len(of), 256):
                at = of[start : start + 256]
                rows, lists = stored_lists(zone.graph.c, *zone.graph.search(lifted(x[at], zone.scale, True), 32), self.bound)
                yield at[rows], lists + zone.first

    def _probed(self, x: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(row, list, score of the list's centroid, the most that a vector of its zone can score) of queries of one length."""
        d, norm = x.shape[1], norms(x)
        zones = [zone for (n, _), zone in self.zones.items() if n == d]
        if not zones:
            yield np.arange(len(x)), np.full(len(x), -d), np.zeros(len(x)), np.full(len(x), np.inf)
        for zone in zones:
            for start in range(0, len(x), 256):
                part = lifted(x[start : start + 256], zone.scale, False)
                ids, far = zone.graph.search(part, self.bound.beam)
                # The beam may have missed some.
                more = ~(np.isfinite(far[:, -1]) & (far[:, -1] > self.bound.prune * far[:, 0])) | (least > ids.shape[1])
                for some, found in ((~more, (ids[~more], far[~more])), (more, zone.graph.all_of(part[more]))):
                    rows, lists = probed_lists(*found, self.bound, least)
                    at = np.flatnonzero(some)[rows]
                    score = np.einsum("nd,nd->n", part[at], zone.graph.c[lists]) * zone.scale
                    with np.errstate(over="ignore"):
                        yield at + start, lists + zone.first, score, norm[at + start] * zone.scale * (1 + 1e-9)

    def dealt(self, x: np.ndarray, stored: bool, least: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, list, whether it is among the row's first lists, the most that its zone can score) of vectors of one length, to store or as queries."""
        if stored:
            found = [np.concatenate(v) for v in zip((np.zeros(0, np.int64),) * 2, *self._stored(x))]
            return *found, np.zeros(len(found[0]), bool), np.zeros(len(found[0]))
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
        row, lists, score, most = (np.concatenate(v) for v in zip(none, *self._probed(x, least or self.bound.least_probes)))
        order = np.lexsort((lists, -score, row))
        row, lists, most = row[order], lists[order], most[order]
        return row, lists, np.arange(len(row)) - np.searchsorted(row, row) < self.bound.least_probes, most


def zone_sizes(points: DataFrame) -> DataFrame:
    """Rows (n) and the largest norm of each length (d) and band."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _by_length(batch.column(0)):
                norm = norms(x)
                bands, at = np.unique(norm_bands(norm), return_inverse=True)
                largest = np.zeros(len(bands))
                np.maximum.at(largest, at, norm)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(bands), x.shape[1])), pa.array(bands), pa.array(np.bincount(at, minlength=len(bands))), pa.array(largest)], names=["d", "band", "n", "largest"]
                )

    each = points.select("vec").mapInArrow(count, "d long, band int, n long, largest double")
    return each.groupBy("d", "band").agg(F.sum("n").alias("n"), F.max("largest").alias("largest"))


def indexed_zones(sizes: DataFrame, bound: IndexBound) -> DataFrame:
    """d, band, n and largest of the zones that have centroids: at most `lengths` * (`norms` + 1)."""
    lengths = sizes.groupBy("d").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "d").limit(bound.lengths).select("d")
    by_size = Window.partitionBy("d").orderBy(F.desc("n"), "band")
    placed = sizes.join(lengths, "d").withColumn("band", F.when(F.row_number().over(by_size) <= bound.norms, F.col("band")).otherwise(_REST))
    return placed.groupBy("d", "band").agg(F.sum("n").alias("n"), F.max("largest").alias("largest"))


def build_index(points: DataFrame, bound: IndexBound = IndexBound()) -> Index | None:
    """Fit each zone's centroids on its part of a bounded sample of the distinct vectors (chosen by hash of id and vector)."""
    first = points.filter("place = 1")
    rows = indexed_zones(zone_sizes(first), bound).orderBy("d", "band").collect()
    total = sum(row["n"] for row in rows)
    if not total:
        return None
    share = 0.95 * bound.sample_rows * (1 << 30) / total
    chosen = first.filter(F.pmod(F.xxhash64("vec_id", "vec"), F.lit(1 << 30)) < share) if share < (1 << 30) else first
    chosen = chosen.filter(F.size("vec").isin(sorted({row["d"] for row in rows})))
    sample = chosen.select("vec_id", "vec").limit(bound.sample_rows).toArrow().sort_by("vec_id")
    by_length = {x.shape[1]: x for _, x in _by_length(sample["vec"])}
    zones, lists = {}, 0
    for row in rows:
        x = by_length.get(row["d"], np.zeros((0, row["d"])))
        bands = norm_bands(norms(x)) if len(x) else np.zeros(0, np.int32)
        own = [other["band"] for other in rows if other["d"] == row["d"]]
        x = lifted(x[~np.isin(bands, own) if row["band"] == _REST else bands == row["band"]], row["largest"], True)
        if not len(x):  # a zone too small for the sample
            x = np.append(np.zeros(row["d"]), 1.0)[None]
        most = min(bound.max_lists * row["n"] // total, row["n"] // bound.list_rows, len(x) // 4)
        zones[row["d"], row["band"]] = Zone(CentroidGraph(balanced_centroids(x, max(1, most))), row["largest"], lists)
        lists += max(1, most)
    together = max(1, bound.part_rows * lists // (2 * total))  # bisection numbers neighbouring lists in a row
    return Index(zones, bound, lists, together)


def _dealt(df: DataFrame, index, stored: bool, least: int | None = None, grouped: bool = False) -> DataFrame:
    """(list, cell, id, vec, near, most, lists) rows of each vector's lists; `most` bounds a query's scores there.

    `grouped` gives one row for those `lists` of a cell that are alike in near and most, and no list of its own."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                for at, x in _by_length(part.column(1)):
                    rows, lists, near, most = index.value.dealt(x, stored, least)
                    cells = index.value.cells(lists)
                    begins = np.arange(len(rows))
                    if grouped:
                        order = np.lexsort((lists, near, cells, rows))
                        rows, lists, near, most, cells = rows[order], lists[order], near[order], most[order], cells[order]
                        same = (rows[1:] == rows[:-1]) & (cells[1:] == cells[:-1]) & (near[1:] == near[:-1])
                        begins = np.flatnonzero(np.append(True, ~same)[: len(rows)])  # a cell is of one zone, so `most` is the same
                    each = pa.ListArray.from_arrays(pa.array(np.append(begins, len(rows)).astype(np.int32)), pa.array(lists.astype(np.int32)))
                    take = part.take(pa.array(at[rows[begins]]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lists[begins].astype(np.int32)), pa.array(cells[begins].astype(np.int32)), take.column(0), take.column(1), pa.array(near[begins]), pa.array(most[begins]), each],
                        names=["list", "cell", "id", "vec", "near", "most", "lists"],
                    )

    return df.mapInArrow(deal, f"list int, cell int, id long, vec {df.schema['vec'].dataType.simpleString()}, near boolean, most double, lists array<int>")


def _divided(rows: DataFrame, parts: DataFrame, centers: DataFrame | None, bound: IndexBound, stored: bool, least: int = 1) -> DataFrame:
    """`rows` of `_dealt` with `part`: 0 in a list of one part, else the nearest parts by the list's own centroids.

    A long list's rows meet its centroids in groups of about `part_rows` rows."""
    if centers is None:
        return rows.withColumn("part", F.lit(0))
    kept, schema = rows.columns, StructType([*rows.schema, StructField("part", IntegerType())])

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:  # a list without a sample stays one part
            return left.select(kept).append_column("part", pa.array(np.zeros(left.num_rows, np.int32)))
        c, scale = _matrix(right["centers"].combine_chunks().flatten()).astype(np.float32), right["scale"][0].as_py()
        rows_, parts_, near_ = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        x = _matrix(left["vec"])
        for start in range(0, len(x), 1024):
            q = lifted(x[start : start + 1024], scale, stored).astype(np.float32)
            d = np.sqrt(np.maximum(0, (q**2).sum(axis=1)[:, None] + (c**2).sum(axis=1) - 2 * q @ c.T))
            ids = np.argsort(d, axis=1, kind="stable")
            d = np.take_along_axis(d, ids, axis=1)
            r, at = stored_lists(c, ids, d, bound) if stored else probed_lists(ids, d, bound, least)
            rows_.append(r + start)
            parts_.append(at)
            near_.append(at == ids[r, 0])
        out = left.select(kept).take(pa.array(np.concatenate(rows_)))
        near = np.concatenate(near_) & out["near"].to_numpy().astype(bool)
        return out.set_column(kept.index("near"), "near", pa.array(near)).append_column("part", pa.array(np.concatenate(parts_).astype(np.int32)))

    long_ = parts.filter("parts > 1").select("list")
    groups = rows.join(long_, "list").groupBy("list").agg(F.ceil(F.count(F.lit(1)) / bound.part_rows).cast("int").alias("groups"))
    salted = rows.join(groups, "list").withColumn("salt", F.pmod(F.xxhash64("id", "vec"), F.col("groups")).cast("int")).drop("groups")
    met = centers.join(groups, "list").select("list", "centers", "scale", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"))
    placed = salted.groupBy("list", "salt").cogroup(met.groupBy("list", "salt")).applyInArrow(place, schema)
    return rows.join(long_, "list", "left_anti").withColumn("part", F.lit(0)).unionByName(placed)


def list_centers(postings: DataFrame, parts: DataFrame) -> DataFrame | None:
    """Written table of the centroids of the parts of long lists (list, centers, scale), from a sample of 64 rows a part; none if no list is long."""
    long_ = materialize(parts.filter("parts > 1"), "ann-long-lists")
    if long_.isEmpty():
        return None
    sample = postings.join(long_, "list").filter(F.pmod(F.xxhash64(F.lit(5), "id", "vec"), F.lit(1 << 30)) < F.lit(64.0 * (1 << 30)) * F.col("parts") / F.col("n"))
    schema = pa.schema([("list", pa.int32()), ("centers", pa.list_(pa.list_(pa.float32()))), ("scale", pa.float64())])

    def fit(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        x = _matrix(rows["vec"])
        scale = float(norms(x).max())  # a longer vector that the sample misses counts as one of this norm
        c = balanced_centroids(lifted(x, scale, True), min(rows["parts"][0].as_py(), rows.num_rows))
        return pa.table({"list": [key[0].as_py()], "centers": [c.tolist()], "scale": [scale]}, schema=schema)

    return materialize(sample.groupBy("list").applyInArrow(fit, "list int, centers array<array<float>>, scale double"), "ann-centers")


def _best_scores(x: np.ndarray, ids: np.ndarray, q: np.ndarray, of: np.ndarray, bar: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, id, score) of one list's rows, in order of id, that may be among the best k + 1 ids of a query; an id may repeat."""
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])[: len(ids)])
    for start in range(0, len(q) if len(x) else 0, 512):
        rough = q[start : start + 512] @ x.T
        each = rough if len(first) == len(ids) else np.maximum.reduceat(rough, first, axis=1)  # the best of each id
        least = np.partition(each, -(k + 1), axis=1)[:, -(k + 1)] if each.shape[1] > k + 1 else each.min(axis=1)
        least = np.maximum(least, bar[start : start + 512])
        r, c = np.nonzero(rough >= (least - 1e-9 * (1 + np.abs(least)))[:, None])
        yield of[start + r], ids[c], (q[start + r] * x[c]).sum(axis=1)  # each row alone, so equal vectors score equally


def _scored(lists: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score of the best k + 1 ids of each query in each group of lists, above the query's `least` score.

    Lists that stand together share a task's group; each is met by its own queries alone."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        left, right = left.sort_by([("list", "ascending"), ("id", "ascending")]).combine_chunks(), right.combine_chunks()
        asks = right["lists"].combine_chunks()
        probed, row = asks.flatten().to_numpy(), pc.list_parent_indices(asks).to_numpy()
        order = np.argsort(probed, kind="stable")
        stored, probed, row = left["list"].to_numpy(), probed[order], row[order]
        for number in np.intersect1d(stored, probed):
            a, b = np.searchsorted(stored, (number, number + 1))
            rows = left.slice(a, b - a)
            a, b = np.searchsorted(probed, (number, number + 1))
            asked = right.take(pa.array(row[a:b]))
            out += _best_scores(_matrix(rows["vec"]), rows["id"].to_numpy(), _matrix(asked["vec"]), asked["id"].to_numpy(), asked["least"].to_numpy(), k)
        query, vec, value = (np.concatenate(v) for v in zip(*out))
        once = np.lexsort((-value, vec, query))  # replicas and rows that repeat an id: the best score counts
        query, vec, value = query[once], vec[once], value[once]
        new = np.append(True, (query[1:] != query[:-1]) | (vec[1:] != vec[:-1]))[: len(vec)]
        query, vec, value = query[new], vec[new], value[new]
        order = np.lexsort((vec, -value, query))
        query, vec, value = query[order], vec[order], value[order]
        top = np.arange(len(query)) - np.searchsorted(query, query) <= k
        return pa.table({"query_id": query[top], "vec_id": vec[top], "score": value[top]})

    keys = ["cell", "part", "slice"]
    return lists.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInArrow(score, "query_id long, vec_id long, score double")


def nearest(
    df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", bound: IndexBound = IndexBound()
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that `is_query` (a condition on vec_id) holds for."""
    spark = df.sparkSession
    # Every limit below counts ids, so rows that repeat an id with the same vector go first.
    vectors = materialize(usable_vectors(df, id_col, vector_col).dropDuplicates(["vec_id", "vec_hash", "vec"]), "ann-vectors")
    same = Window.partitionBy("vec_hash", "vec").orderBy("vec_id")
    points = materialize(vectors.withColumn("place", F.row_number().over(same)).filter(F.col("place") <= k + 1).drop("vec_hash"), "ann-points")
    fitted = build_index(points, bound)
    if fitted is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = spark.sparkContext.broadcast(fitted)
    postings = materialize(_dealt(points.select("vec_id", "vec"), index, stored=True), "ann-lists")
    asked = vectors.filter(is_query).select(F.col("vec_id").alias("query_id"), "vec_hash", "vec")
    # Each distinct query vector has a number of its own; an id may have several vectors.
    distinct = asked.groupBy("vec_hash", "vec").agg(F.count(F.lit(1)).alias("rows"))
    distinct = materialize(distinct.withColumn("qid", F.monotonically_increasing_id()), "ann-queries")

    # Lists of more than two parts' rows are divided; a part that is still too long is dealt in slices that all its queries meet.
    parts = materialize(postings.groupBy("list").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.when(F.col("n") > 2 * bound.part_rows, F.ceil(F.col("n") / bound.part_rows)).otherwise(1).cast("int")), "ann-list-sizes")
    centers = list_centers(postings, parts)
    stored = _divided(postings, parts, centers, bound, stored=True)
    if centers is not None:
        stored = materialize(stored, "ann-parts")
    slices = stored.groupBy("list", "part").agg(F.ceil(F.count(F.lit(1)) / (4 * bound.part_rows)).cast("int").alias("slices"))
    slices = materialize(slices, "ann-slices")
    stored = stored.join(slices, ["list", "part"]).withColumn("slice", F.pmod(F.xxhash64("id", "vec"), F.col("slices")).cast("int")).drop("slices", "near", "most", "lists")

    def probed(queries: DataFrame, least: int) -> DataFrame:
        dealt = _dealt(queries.select("qid", "vec"), index, stored=False, least=least, grouped=centers is None)
        if centers is None:  # every list is one part and one slice
            return materialize(dealt.drop("list").withColumns({"part": F.lit(0), "slice": F.lit(0)}), "ann-probes")
        probes = materialize(_divided(dealt, parts, centers, bound, stored=False, least=max(1, least // bound.least_probes)), "ann-probed-parts")
        probes = probes.join(slices, ["list", "part"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices", "list")
        return materialize(probes, "ann-probes")

    lowest = F.lit(-float("inf"))
    at_best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def searched(queries: DataFrame, least: int) -> DataFrame:
        """Written table of the best k + 1 ids met by each query."""
        probes = probed(queries, least)
        near = materialize(_scored(stored, probes.filter("near").withColumn("least", lowest), k), "ann-near")
        each = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        scores = F.sort_array(F.collect_list("score"), asc=False)  # those of a few lists
        kth = each.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) > k, F.get(scores, F.lit(k))).alias("bar"))
        rest = probes.filter("not near").join(kth, "id", "left").filter("bar is null or most >= bar")
        far = _scored(stored, rest.withColumn("least", F.coalesce("bar", lowest)).drop("bar"), k)
        top = near.union(far).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(at_best))
        return materialize(top.filter(F.col("rank") <= k + 1).select(F.col("query_id").alias("qid"), "vec_id", "score"), "ann-met")

    # Queries that met too few go on with more lists of each zone, all of them in the end.
    there = points.groupBy(F.size("vec").alias("d")).agg(F.least(F.lit(k + 1), F.countDistinct("vec_id")).alias("need"))
    there = materialize(there, "ann-needs")
    top, open_, least = searched(distinct, bound.least_probes), distinct, bound.least_probes
    most = max(16 * bound.least_probes, fitted.lists, (parts.agg(F.max("parts")).first()[0] or 1) * bound.least_probes)
    while least < most:
        met = top.groupBy("qid").agg(F.count(F.lit(1)).alias("met"))
        few = open_.withColumn("d", F.size("vec")).join(there, "d").join(met, "qid", "left").filter("coalesce(met, 0) < need")
        open_ = materialize(few.select(*distinct.columns), "ann-open")
        if open_.isEmpty():
            break
        least = min(most, 16 * least)
        top = top.join(open_, "qid", "left_anti").union(searched(open_, least))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    numbered = join_uneven(asked, distinct, ["vec_hash", "vec"], "rows").select("query_id", "qid")
    answers = materialize(top.join(distinct.select("qid", "rows"), "qid"), "ann-top")
    return (
        join_uneven(numbered, answers, ["qid"], "rows")
        .filter("vec_id <> query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
