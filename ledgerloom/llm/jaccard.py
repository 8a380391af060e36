"""Exact n-gram Jaccard self-join with set-relation skipping, and the components of its links.

A document's set holds its distinct word shingles (hashed to 64 bits). Equal sets are one node.

*Lonely shingles.* A set has at most a quarter of its shingles beyond a partner. So a set with more shingles than that
which occur in no other set is linked with nothing. This is first judged on the shingles of a fixed third of all hash
values, which every set sends whole; only what may still be linked sends all its shingles, which gives exact counts.

*Skipping by position.* The sets left are ordered by these counts, rarest first, and the prefixes in which linked sets
must meet are inverted. A set of size n with a shared shingle at place p has at most n - p shingles from there on, so it
can only match partners of sizes that follow from n and p. Index lists are cut into blocks of partner sizes; an entry
stands in the blocks of its interval, and a probe reads the blocks of its own size.

*Derived answers.* In each leader round, every node is compared with the leaders that it shares most prefix shingles
with. Nodes that resemble a first leader, or are linked with a later one, form its group, and what each has beyond its leader or
lacks of it is kept. An index list then holds one entry a group, with the widest bounds of its members, and is probed once a
group; groups that are already connected are never paired. Within a group all differences are turned to its centre C, the
shingles that most of it has. Sets x and y then share |C| - |lacked by x| - |lacked by y| + |differences that both have|, so
links follow from few differences: sets near the centre are linked whatever they share, all are compared with the
members nearest to it, and what is still apart is found by indexes over part of the differences (`derived_links`). A set of
another group is compared with this one's leader alone.

*Bitmaps.* Before whole sets are sent anywhere, a pair must pass a bound on small bitmaps: a bit is
the parity of the shingles that fall on it, so two bitmaps differ in at most as many bits as the sets
differ in shingles. The bound is exact: it never refuses a link.

Defined cases: a text without words, or null, has the empty set and is linked with nothing; a text
with fewer words than a shingle has one element, the whole; equal texts are linked; rows that repeat
an id are one document with several sets; a row without an id has component null; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import discard, join_uneven, materialize, mix64, text_bytes

WORDS = 5
#: A shingle that tasks have reported so often is frequent: its list is hot, so it is told to the tasks and never shuffled to be counted.
FREQUENT = 24
#: At most so many are told, the most frequent ones; the others are counted by a shuffle, each with a bounded share of the rows.
MOST_FREQUENT = 400_000
#: Distinct shingles of documents that a task counts together, and the count below which it reports nothing.
COUNTED, LEAST_COUNT = 1_500_000, 3
#: Leaders that each node is compared with, by round. In a loose group a node may miss any one leader, so those that are
#: left after the first round try several at once. What is still left then is derived from the groups that were found.
LEADERS = (1, 16)
#: Least similarity, in percent, to the first leader of what is in its group.
LOOSE = 40
#: Members of a group nearest to its centre that all others are compared with.
HUBS = 16
#: Bits of the map of ids that tells tasks which documents to read again, so that what is broadcast is bounded (4 MB).
#: What it lets pass by chance is dropped by a join.
ID_BITS = 1 << 25
#: Pairs of one leader that meet in one group of a join.
PAIRS_TOGETHER = 512

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_PLACES = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
#: Hashes below this are the third of all shingles that is judged first.
_THIRD = np.uint64((1 << 64) // 3)


def shingle_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, slice by slice."""
    part = np.cumsum(np.diff(text_bytes(column)[1])) >> 20
    cut = np.append(np.searchsorted(part, np.unique(part)), len(column)).tolist()
    for start, stop in zip(cut[:-1], cut[1:]):
        yield from _sets(*text_bytes(column.slice(start, stop - start)), words)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of all texts, and where each text's words begin. Eight bytes at a time are mixed with their place."""
    inside = ~_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edge] = inside[edge]  # a word never goes on into the next text
    ends[edge - 1] = inside[edge - 1]
    first = np.flatnonzero(begins)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    length = np.flatnonzero(ends) + 1 - first
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = _LOWER[data]
    eight = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    parts = (length + 7) >> 3
    start = np.cumsum(parts) - parts
    k = np.arange(int(parts.sum())) - np.repeat(start, parts)
    value = eight[np.repeat(first, parts) + 8 * k] & _MASKS[np.minimum(np.repeat(length, parts) - 8 * k, 8)]
    value = mix64(value + mix64(k.astype(np.uint64) + np.uint64(0x51ED270B)))
    total = np.add.reduceat(value, start) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix64(total), np.searchsorted(first, offsets)


def _sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    word, cut = word_hashes(data, offsets)
    grams = word * _PLACES[0]
    for k in range(1, words):
        grams[:-k] += word[k:] * _PLACES[k]
    grams = mix64(grams)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= words:
            yield np.unique(grams[a : b - words + 1])
        elif b > a:  # fewer words than a shingle: the whole sequence, told apart by its length
            yield mix64((word[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True) + _PLACES[32 + b - a : 33 + b - a])
        else:
            yield np.zeros(0, np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    cut = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(parts or [np.zeros(0, np.int64)]).view(np.int64)))


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parities of a set's shingles over a power of two of bits, two bits a shingle or more, as longs."""
    size = max(64, 1 << (2 * len(s) - 1).bit_length()) if len(s) else 64
    parity = np.bincount((mix64(s ^ np.uint64(0x3C3C3C3C)) & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1
    return np.packbits(parity, bitorder="little").view(np.int64)


def digest(s: np.ndarray, seed: int) -> int:
    """Of a set, for one seed: two sets of different digests are different."""
    return int(mix64(s ^ mix64(np.array([seed], np.uint64))).sum(dtype=np.uint64).view(np.int64))


def profiles(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """Written table of two kinds of rows: doc_id, n, d, d2, third (a set's size, its digest by two seeds, its shingles in
    the third), and token, seen (counts of shingles that repeat in a part of the corpus)."""
    names = ["doc_id", "n", "d", "d2", "third", "token", "seen"]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            tokens, seen = np.unique(np.concatenate(held), return_counts=True)
            many = seen >= LEAST_COUNT
            none = pa.nulls(int(many.sum()), pa.int64())
            return pa.RecordBatch.from_arrays([none] * 5 + [_signed(tokens[many]), pa.array(seen[many])], names=names)

        for batch in batches:
            rows = []
            for s in shingle_sets(batch.column(1), words):
                rows.append((len(s), digest(s, 2 * seed), digest(s, 2 * seed + 1), int(np.searchsorted(s, _THIRD))))
                held.append(s)
                size += len(s)
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
            columns = np.array(rows, np.int64).reshape(-1, 4)
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns.T), none, none], names=names)
        if held:
            yield counted()

    schema = ", ".join(f"{n} long" for n in names)
    return materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(profile, schema), "jaccard-profiles")


def frequent_shingles(profile: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and how often each was reported; at most MOST_FREQUENT."""
    seen = profile.filter("seen is not null").groupBy("token").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= FREQUENT)
    table = seen.orderBy(F.desc("seen"), "token").limit(MOST_FREQUENT).toArrow()
    tokens = table["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], table["seen"].to_numpy()[order]


def _among(s: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each element of s would stand in `tokens`, and whether it is there."""
    if not len(tokens):
        return np.zeros(len(s), np.int64), np.zeros(len(s), bool)
    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
    return at, tokens[at] == s


def shared_in_third(docs: DataFrame, frequent, words: int, seed: int) -> DataFrame:
    """d and shared: how many shingles of the set's third are in other sets too, times the rows with this set."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = frequent.value[0]
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                parts, owners, known = [], [], []
                for s in shingle_sets(batch.column(1).slice(start, 1024), words):
                    some = s[: np.searchsorted(s, _THIRD)]
                    often = _among(some, tokens)[1]
                    parts.append(some[~often])
                    owners.append(digest(s, 2 * seed))
                    known.append(int(often.sum()))
                counts = [len(p) for p in parts]
                owner, known = np.array(owners, np.int64), np.array(known, np.int32)
                with_known = known > 0  # frequent ones are in other sets, so they need not meet: one row counts them all
                columns = [
                    _signed(np.concatenate([*parts, owner[with_known].view(np.uint64)])),
                    pa.array(np.concatenate([np.repeat(owner, counts), owner[with_known]])),
                    pa.array(np.concatenate([np.zeros(sum(counts), np.int32), known[with_known]])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "d", "known"])

    rows = docs.select("doc_id", "text").mapInArrow(send, "token long, d long, known int")
    of = Window.partitionBy("token")
    met = rows.withColumns({"lo": F.min("d").over(of), "hi": F.max("d").over(of)}).filter("lo < hi or known > 0")
    return met.groupBy("d").agg(F.sum(F.greatest("known", F.lit(1))).alias("shared"))


def id_map(ids: DataFrame) -> np.ndarray:
    """A bitmap over hashes of the column `id`, built by the executors; ID_BITS at any size."""
    place = F.col("h") + 1
    maps = (
        ids.select(_id_bit("id").alias("h")).groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    )
    out = np.zeros((ID_BITS >> 15, 4096), np.uint8)
    for row in maps:
        out[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _id_bit(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(ID_BITS))


def alive_sets(docs: DataFrame, alive: DataFrame, frequent, words: int, seed: int) -> DataFrame:
    """Written table of the sets of `alive` (d, n, node): d, node, n, bits, light and often (its frequent shingles, rarest first)."""
    wanted = docs.sparkSession.sparkContext.broadcast(id_map(alive.select(F.col("node").alias("id"))))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, (tokens, seen) = wanted.value, frequent.value
        for batch in batches:
            h = batch.column(2).to_numpy()
            some = batch.filter(pa.array((bits[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1))
            for start in range(0, some.num_rows, 256):
                part = some.slice(start, 256)
                light, often, bitmaps, owners = [], [], [], []
                for s in shingle_sets(part.column(1), words):
                    at, there = _among(s, tokens)
                    light.append(s[~there])
                    often.append(s[there][np.argsort(seen[at[there]], kind="stable")] if len(tokens) else s[:0])
                    bitmaps.append(bitmap(s))
                    owners.append(digest(s, 2 * seed))
                columns = [pa.array(np.array(owners, np.int64)), part.column(0), _lists(light), _lists(often), _lists(bitmaps)]
                yield pa.RecordBatch.from_arrays(columns, names=["d", "doc_id", "light", "often", "bits"])

    read = docs.select("doc_id", "text", _id_bit("doc_id").alias("h")).mapInArrow(sets, "d long, doc_id long, light array<long>, often array<long>, bits array<long>")
    one = read.groupBy("d").agg(*[F.first(c).alias(c) for c in ("light", "often", "bits")])
    return materialize(alive.join(one, "d").select("d", "node", "n", "bits", "light", "often"), "jaccard-sets")


def prefix_postings(sets: DataFrame) -> DataFrame:
    """Written table token, d, node, n, p for the prefix of each set that may be linked, by exact counts."""
    counted = sets.select("d", F.explode("light").alias("token")).withColumn("seen", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("seen > 1")
    shared = counted.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("seen", "token"))).alias("shared"))
    joined = sets.select("d", "node", "n", "light", "often").join(shared, "d", "left").withColumn("shared", F.coalesce(F.col("shared.token"), F.array().cast("array<long>")))
    ordered = joined.select("d", "node", "n", (F.size("light") - F.size("shared")).cast("long").alias("alone"), F.concat("shared", "often").alias("rest"))
    length = (F.floor(F.col("n") / 4) + 1 - F.col("alone")).cast("int")
    posted = ordered.filter(4 * F.col("alone") <= F.col("n")).select("d", "node", "n", "alone", F.posexplode(F.slice("rest", F.lit(1), length)).alias("at", "token"))
    return materialize(posted.select("token", "d", "node", "n", (F.col("alone") + F.col("at")).alias("p")), "jaccard-postings")


def plausible(pairs: DataFrame, sets: DataFrame, tag: str, slack: Column | None = None) -> DataFrame:
    """Written table: those of `pairs` (a, b, ...) whose bitmaps allow a link, or one of sets that differ from them by `slack`."""
    kept = pairs.columns
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("d").alias(side), F.col("n").alias(f"size_{side}"), F.col("bits").alias(f"bits_{side}")), side)
    # The longer bitmap is folded until both are as long: parities of halves add up.
    short, long_ = F.least(F.size("bits_a"), F.size("bits_b")), F.when(F.size("bits_a") < F.size("bits_b"), F.col("bits_b")).otherwise(F.col("bits_a"))
    other = F.when(F.size("bits_a") < F.size("bits_b"), F.col("bits_a")).otherwise(F.col("bits_b"))
    pairs = pairs.select(*kept, "size_a", "size_b", other.alias("one"), long_.alias("two"), short.alias("short"))
    folded = F.when(F.size("two") == F.col("short"), F.col("two")).otherwise(
        F.transform(F.sequence(F.lit(1), F.col("short")), lambda i: F.aggregate(F.sequence(i, F.size("two"), F.col("short")), F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.element_at("two", j))))
    )
    apart = F.aggregate(F.zip_with("one", folded, lambda i, j: F.bit_count(i.bitwiseXOR(j))), F.lit(0), lambda total, x: total + x)
    most = F.col("size_a") + F.col("size_b") + (F.lit(0) if slack is None else slack)
    return materialize(pairs.filter(7 * apart <= most).select(*kept), tag)


def overlaps(sets: DataFrame, pairs: DataFrame, differences: Column | None = None) -> DataFrame:
    """Written table: `pairs` (a, b, ...; read more than once) with node_a, node_b, n_a, n_b and common, from the whole sets of both.

    Where the condition `differences` holds, also only_a and only_b: what one set has and the other has not.
    A set that is in many pairs, such as a leader's, meets them in parts of PAIRS_TOGETHER."""
    whole = sets.select("d", "node", "n", F.concat("light", "often").alias("s"))
    parts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PAIRS_TOGETHER).cast("int").alias("parts"))
    a = whole.select(F.col("d").alias("a"), F.col("node").alias("node_a"), F.col("n").alias("n_a"), F.col("s").alias("s_a"))
    b = parts.join(whole.select(F.col("d").alias("b"), F.col("node").alias("node_b"), F.col("n").alias("n_b"), F.col("s").alias("s_b")), "b")
    b = b.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    dealt = pairs.join(parts, "b").withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")).drop("parts")
    both = dealt.join(a, "a").join(b, ["b", "part"]).withColumn("common", F.size(F.array_intersect("s_a", "s_b")).cast("long"))
    more = [] if differences is None else [F.when(differences, F.array_except(f"s_{x}", f"s_{y}")).alias(f"only_{x}") for x, y in ("ab", "ba")]
    return materialize(both.select(*pairs.columns, "node_a", "node_b", "n_a", "n_b", "common", *more), "jaccard-overlaps")


def is_link(n_a: Column, n_b: Column, common: Column) -> Column:
    return 100 * common >= 75 * (n_a + n_b - common)


def _both(df: DataFrame, one: tuple, two: tuple) -> DataFrame:
    """Two rows (u, v) of each row of `df`, which is read once."""
    pair = lambda x: F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for c, name in zip(x, "uv")])
    return df.select(F.inline(F.array(pair(one), pair(two))))


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Written table (node, component) for the nodes of `edges` (u, v); component is the smallest node reached.

    Alternating stars: each node is tied to the smallest node around it until nothing changes. The rounds grow with
    the logarithm of the longest path; past `most_rounds` this raises, and a larger limit may be given."""
    edges = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    for _ in range(most_rounds):
        # Done when every node has one smaller neighbour at most, and those that are such a neighbour have none.
        ends = _both(edges, ("u", "v"), ("v", F.lit(None).cast("long"))).toDF("node", "to")
        open_ends = ends.groupBy("node").agg(F.min("to").alias("lo"), F.max("to").alias("hi"), F.count_if(F.col("to").isNull()).alias("below")).filter("lo < hi or (lo is not null and below > 0)")
        if open_ends.isEmpty():
            break
        # Large star: neighbours larger than a node go to the smallest node around it.
        around = _both(edges, ("u", "v"), ("v", "u"))
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialize(large, "cc-large")
        # Small star: a node and its smaller neighbours go to the smallest of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _both(large.join(least, "u"), ("u", "m"), ("v", "m")).filter("u <> v").distinct()
        before, edges = edges, materialize(small, "cc-small")
        discard(before, large)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds; give more")
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(edges.select("v", "v").distinct().toDF("node", "component"))


def _with_component(df: DataFrame, column: str, components: DataFrame | None, out: str) -> DataFrame:
    if components is None:
        return df.withColumn(out, F.col(column))
    named = components.select(F.col("node").alias(column), F.col("component").alias(out))
    return df.join(named, column, "left").withColumn(out, F.coalesce(out, column))


def live_postings(postings: DataFrame, components: DataFrame | None, tag: str) -> DataFrame:
    """Written table: `postings` with their component (comp), without the lists that only one component is left in."""
    placed = _with_component(postings.drop("comp"), "node", components, "comp")
    mixed = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("token")
    return materialize(placed.join(mixed, "token", "left_semi"), tag)


def leader_pairs(postings: DataFrame, round_no: int, leaders: int, loose: bool) -> DataFrame:
    """(a, b): each node with the `leaders` ones it shares most prefix shingles with, unless both are connected already.

    A list's leaders are the nodes whose hashes, seeded by the round, are least. Unless `loose`, sizes and the shingle's places
    must allow a link, as they do at the first shingle that two linked sets share."""
    node = [F.col("d").alias("b"), F.col("n").alias("n_b"), F.col("p").alias("p_b"), F.col("comp").alias("comp_b")]
    least = [F.min_by(F.struct(*node), F.xxhash64(F.lit(round_no), F.lit(k), "d")) for k in range(leaders)]
    leads = postings.groupBy("token").agg(F.array_distinct(F.array(*least)).alias("leads")).select("token", F.inline("leads"))
    met = (F.col("d") != F.col("b")) & (F.col("comp") != F.col("comp_b"))
    if not loose:
        most = F.least(F.col("n") - F.col("p"), F.col("n_b") - F.col("p_b"))
        met = met & (4 * F.col("n") >= 3 * F.col("n_b")) & (4 * F.col("n_b") >= 3 * F.col("n")) & (7 * most >= 3 * (F.col("n") + F.col("n_b")))
    votes = postings.join(leads, "token").filter(met).groupBy(F.col("d").alias("a"), "b").agg(F.count(F.lit(1)).alias("votes"))
    most = Window.partitionBy("a").orderBy(F.desc("votes"), "b")
    return votes.withColumn("place", F.row_number().over(most)).filter(F.col("place") <= leaders).select("a", "b")


def similar_groups(led: DataFrame) -> DataFrame:
    """Written table d, node, head, head_node, n_head, beyond, lacks of the members of groups: each resembles its head, which is in no
    other group; it has `beyond` more than its head and lacks `lacks` of it.

    `led` holds pairs (a, b, node_a, node_b, n_b, common, only_a, only_b) of nodes and leaders, linked ones and looser ones. A node's choice is
    its leader that leads most nodes, so that groups are few; heads are the nodes that are chosen more often than their own choice."""
    one = F.count(F.lit(1))
    followed = materialize(led.groupBy("b").agg(one.alias("times"), one.alias("rows")), "jaccard-followed")
    choice = join_uneven(led.select("a", "b", "common"), followed, ["b"], "rows").groupBy("a").agg(F.max(F.struct("times", "common", "b"))["b"].alias("b"))
    named = {"d": "a", "node": "node_a", "head": "b", "head_node": "node_b", "n_head": "n_b", "beyond": "only_a", "lacks": "only_b"}
    best = materialize(led.join(choice, ["a", "b"]).select(*[F.col(old).alias(new) for new, old in named.items()]), "jaccard-choices")
    chosen = best.groupBy(F.col("head").alias("x")).agg(F.count(F.lit(1)).alias("times"))
    weight = lambda c, out: chosen.select(F.col("x").alias(c), F.col("times").alias(out))
    rated = best.select("d", "head").join(weight("d", "own"), "d", "left").join(weight("head", "its"), "head").withColumn("own", F.coalesce("own", F.lit(0)))
    follows = materialize(rated.filter(F.struct("own", "d") < F.struct("its", "head")).select("d", "head"), "jaccard-follows")
    members = follows.join(follows.select(F.col("d").alias("head")), "head", "left_anti").select("d")  # a follower is nobody's head
    return materialize(best.join(members, "d"), "jaccard-groups")


def group_centres(groups: DataFrame) -> DataFrame:
    """Written table of a group's centre (head, members, n_c, added, removed): the set of the shingles that more than half of the group has, heads
    included, as what it has beyond the head and what it lacks of it. A centre need not be anybody's set."""
    sizes = groups.groupBy("head").agg((F.count(F.lit(1)) + 1).alias("members"), F.sum(F.size("beyond") + F.size("lacks")).alias("n"), F.first("n_head").alias("n_head"))
    sizes = materialize(sizes, "jaccard-group-counts")
    times = F.count(F.lit(1)).alias("times")
    side = lambda c, most: (
        join_uneven(groups.select("head", F.explode(c).alias("token")).groupBy("head", "token").agg(times), sizes.select("head", "members", "n"), ["head"], "n")
        .filter(2 * F.col("times") > F.col("members")).groupBy("head").agg(F.collect_list("token").alias(most))
    )
    none = F.array().cast("array<long>")
    added, removed = materialize(side("beyond", "added"), "jaccard-added"), materialize(side("lacks", "removed"), "jaccard-removed")
    both = sizes.join(added, "head", "left").join(removed, "head", "left").withColumns({c: F.coalesce(c, none) for c in ("added", "removed")})
    return materialize(both.select("head", "members", (F.col("n_head") + F.size("added") - F.size("removed")).cast("long").alias("n_c"), "added", "removed"), "jaccard-centres")


def from_centre(sets: DataFrame, centres: DataFrame) -> DataFrame:
    """`sets` (b, a head, with beyond and lacks against it) with both against the head's centre, and n_c, c = 4 lacks + 3 beyond and
    h = 3 (lacks - beyond) of their numbers. Two sets with m differences in common share n_c - lacks of both + m."""
    met = join_uneven(sets, centres.withColumnRenamed("head", "b"), ["b"], "members")
    beyond = F.concat(F.array_except("beyond", "added"), F.array_except("removed", "lacks"))
    lacks = F.concat(F.array_except("lacks", "removed"), F.array_except("added", "beyond"))
    met = met.withColumns({"beyond": beyond, "lacks": lacks}).drop("added", "removed")
    more, less = F.size("beyond").cast("long"), F.size("lacks").cast("long")
    return met.withColumns({"b_n": more, "l_n": less, "c": 4 * less + 3 * more, "h": 3 * (less - more)})


def centred_members(groups: DataFrame, centres: DataFrame) -> DataFrame:
    """Written table b, x, v, beyond, lacks, ... of the heads and members of groups against their centres; x is a set, v its node."""
    none = F.array().cast("array<long>")
    heads = groups.groupBy("head").agg(F.first("head_node").alias("v")).select(F.col("head").alias("b"), F.col("head").alias("x"), "v", none.alias("beyond"), none.alias("lacks"))
    members = groups.select(F.col("head").alias("b"), F.col("d").alias("x"), F.col("node").alias("v"), "beyond", "lacks")
    return materialize(from_centre(members.union(heads), centres), "jaccard-centred")


def hub_links(centred: DataFrame, components: DataFrame | None) -> DataFrame:
    """Written links (u, v) between members of a group and its hubs, the members nearest to the centre in each of HUBS parts of the group.

    Two sets with c(a) + c(x) <= n_c are linked whatever they share; then both are linked with the member of least c."""
    placed = _with_component(centred, "v", components, "comp")
    nearest = placed.groupBy("b", F.pmod(F.xxhash64("x"), F.lit(HUBS)).alias("part")).agg(F.min(F.struct("c", "x", "v", "comp", "beyond", "lacks")).alias("hub"), F.count(F.lit(1)).alias("n"))
    nearest = materialize(nearest.select("b", "hub", "n").withColumn("n", F.sum("n").over(Window.partitionBy("b"))), "jaccard-hubs")
    met = join_uneven(placed, nearest, ["b"], "n", most=128).filter(F.col("comp") != F.col("hub.comp"))
    shared = F.size(F.array_intersect("beyond", "hub.beyond")) + F.size(F.array_intersect("lacks", "hub.lacks"))
    met = met.filter(7 * shared >= F.col("c") + F.col("hub.c") - F.col("n_c"))
    return materialize(met.select(F.col("v").alias("u"), F.col("hub.v").alias("v")), "jaccard-hub-links")


def group_pairs(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b): heads of groups, not all of one component, of which members share a prefix shingle at places that allow a link.

    Written with n and slack of both: the smallest and largest member, and by how much one may differ from its head."""
    step = math.log(4 / 3)
    block = lambda n: F.floor(F.log(n.cast("double")) / step)
    placed = postings.join(groups, "d", "left").select(
        "token", "n", "p", "comp", F.coalesce("head", "d").alias("g"), F.coalesce("beyond", F.lit(0)).alias("beyond"), (F.coalesce("beyond", F.lit(0)) + F.coalesce("lacks", F.lit(0))).alias("slack")
    )
    rest = F.col("n") - F.col("p")
    own = F.floor(7 * rest / 3).cast("long") - F.col("n")  # the largest partner that the places allow
    entries = placed.withColumns({"own": own}).groupBy("token", "g").agg(
        F.min("comp").alias("comp"), F.max("comp").alias("last_comp"), F.min("n").alias("n"), F.max("n").alias("most_n"), F.max("own").alias("own"), F.max("slack").alias("slack"), F.max("beyond").alias("beyond")
    )
    # A probe is the smaller set of a pair; partner sizes m are within the ratio and at most `own`.
    least = F.ceil(3 * F.col("n") / 4).cast("long")
    most = F.least("most_n", "own")
    named = lambda side: [F.col(c).alias(f"{c}_{side}") for c in ("comp", "last_comp", "n", "most_n", "own", "slack", "beyond")]
    index = entries.filter(most >= least).select("token", F.explode(F.sequence(block(least), block(most))).alias("block"), F.col("g").alias("b"), *named("b"))
    probe = entries.filter(F.col("own") >= F.col("n")).select("token", F.explode(F.sequence(block(F.col("n")), block(F.col("most_n")))).alias("block"), F.col("g").alias("a"), *named("a"))
    met = probe.join(index, ["token", "block"]).filter(
        (F.col("a") != F.col("b"))
        & (F.least("comp_a", "comp_b") != F.greatest("last_comp_a", "last_comp_b"))
        & (F.col("n_a") <= F.col("most_n_b"))
        & (4 * F.col("most_n_a") >= 3 * F.col("n_b"))
        & (F.col("n_a") <= F.col("own_b"))
        & (F.col("n_b") <= F.col("own_a"))
        & ((F.col("most_n_a") > F.col("n_a")) | (F.col("most_n_b") > F.col("n_b")) | (F.col("n_a") < F.col("n_b")) | (F.col("a") < F.col("b")))
    )
    turned = F.col("a") > F.col("b")
    pick = lambda c, one, two: F.when(turned, F.col(f"{c}_{two}")).otherwise(F.col(f"{c}_{one}"))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *[pick(c, s, "ba"["ab".index(s)]).alias(f"{c}_{s}") for c in ("n", "slack", "beyond", "most_n") for s in "ab"])
    return pairs.groupBy("a", "b").agg(*[(F.min if c == "n" else F.max)(f"{c}_{s}").alias(f"{c}{'' if c != 'n' else 's'}_{s}") for c in ("n", "slack", "beyond", "most_n") for s in "ab"])


def nearest_links(everyone: DataFrame) -> DataFrame:
    """Links (u, v) of sets (b, v, c, n_c) with the one nearest to their group's centre, if they are near enough to need no shared difference."""
    least = materialize(everyone.groupBy("b").agg(F.min(F.struct("c", "v")).alias("least"), F.count(F.lit(1)).alias("n")), "jaccard-nearest")
    met = join_uneven(everyone, least, ["b"], "n").filter((F.col("c") + F.col("least.c") <= F.col("n_c")) & (F.col("v") != F.col("least.v")))
    return met.select(F.col("v").alias("u"), F.col("least.v").alias("v"))


def late_links(sets: DataFrame, postings: DataFrame, groups: DataFrame, centres: DataFrame, centred: DataFrame, components: DataFrame | None) -> DataFrame:
    """Links (u, v) between nodes of different components, after each group's hubs have been met.

    Of groups that may have links, the heads are compared first, then each member of the smaller one with the larger one's head.
    What the component of a group's member nearest to the centre does not hold is asked about its own group."""
    sizes = groups.select("d", "head", F.size("beyond").cast("long").alias("beyond"), F.size("lacks").cast("long").alias("lacks"))
    # The sizes in a pair's bitmap bound are the heads'; members may be larger by what they have beyond them.
    slack = lambda sides: sum((F.col(f"beyond_{s}") + 7 * F.col(f"slack_{s}") for s in sides), F.lit(0))
    heads = overlaps(sets, plausible(group_pairs(postings, sizes), sets, "jaccard-candidates", slack("ab")))
    linked = is_link(F.col("n_a"), F.col("n_b"), F.col("common"))
    links = heads.filter(linked).select(F.col("node_a").alias("u"), F.col("node_b").alias("v"))
    placed = materialize(_with_component(centred, "v", components, "comp"), "jaccard-members")
    # A link's worth is 7 overlap - 3 (sizes); of L and y, a member x gains 4 by what both have beyond L and 3 by what both lack of it.
    gain = groups.groupBy("head").agg(F.max(4 * F.size("beyond") + 3 * F.size("lacks")).cast("long").alias("gain"))
    members = placed.groupBy(F.col("b").alias("head")).agg((F.count(F.lit(1)) - 1).alias("members"), (F.min("comp") != F.max("comp")).alias("mixed"), F.min(F.struct("c", "x", "comp")).alias("near"))
    members = materialize(members.join(gain, "head"), "jaccard-group-sizes")
    of = lambda s: members.select(F.col("head").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("members", "gain", "mixed")])
    still = heads.filter(7 * (F.col("common") + F.col("beyond_a") + F.col("beyond_b")) >= 3 * (F.col("ns_a") + F.col("ns_b")))
    sided = still.join(of("a"), "a", "left").join(of("b"), "b", "left").filter("members_a is not null or members_b is not null")
    sided = sided.filter(~linked | F.coalesce("mixed_a", F.lit(False)) | F.coalesce("mixed_b", F.lit(False)))
    turned = F.coalesce("members_a", F.lit(0)) > F.coalesce("members_b", F.lit(0))
    pick = lambda x, y: F.when(turned, F.col(x)).otherwise(F.col(y))
    sided = sided.select(pick("b", "a").alias("small"), pick("a", "b").alias("b"), *[pick(f"{c}_a", f"{c}_b").alias(f"{c}_b") for c in ("beyond", "slack", "gain", "mixed")])
    sided = materialize(sided, "jaccard-open")
    near = members.filter("mixed").select(F.col("head").alias("b"), F.col("near.comp").alias("near_comp"), "members")
    asked = join_uneven(placed, near, ["b"], "members").filter("comp <> near_comp").select(F.col("x").alias("a"), "b", F.col("v").alias("u"), F.col("comp").alias("of"), "n_c", "beyond", "lacks", "b_n", "l_n", "c", "h")
    if not sided.isEmpty():
        own = sided.withColumnRenamed("small", "a").unionByName(sided.join(groups.select(F.col("head").alias("small"), F.col("d").alias("a")), "small").drop("small"))
        near = overlaps(sets, plausible(own.distinct(), sets, "jaccard-near", slack("b")), F.lit(True))
        links = links.union(near.filter(linked).select("node_a", "node_b"))
        worth = 7 * F.col("common") - 3 * (F.col("n_a") + F.col("n_b"))
        others = near.filter((~linked | F.coalesce("mixed_b", F.lit(False))) & (worth + F.col("gain_b") >= 0))
        others = _with_component(others, "node_a", components, "of").select("a", "b", F.col("node_a").alias("u"), "of", F.col("only_a").alias("beyond"), F.col("only_b").alias("lacks"))
        others = materialize(from_centre(others, centres).select(*asked.columns), "jaccard-others")
        links = links.union(nearest_links(placed.select("b", "v", "c", "n_c").union(others.select("b", "u", "c", "n_c"))))
        asked = asked.unionByName(others)
    asked = materialize(asked, "jaccard-rest")
    return links if asked.isEmpty() else links.union(derived_links(asked, placed))


def derived_links(asked: DataFrame, members: DataFrame) -> DataFrame:
    """Links (u, v) of sets `asked` (a, b, u, of) with `members` (b, x, v, comp) of the group b, neither in one component, derived from what both
    have beyond the group's centre and lack of it.

    With m differences in common, a and x are linked if 7 m >= c(a) + c(x) - n_c. Let e = c - n_c. If they share none beyond the centre, m
    is at most what either lacks, so h(x) >= e(a) and h(a) >= e(x). Else 7 times what they share beyond it is at least e(a) - h(x) and
    e(x) - h(a). So two indexes do: of what sets have beyond the centre, and, for the few that lack more than they have beyond or are near the
    centre, of what they lack. In an order of rarity the first shared difference stands early in both. What shares no difference has met a hub."""
    e = F.col("c") - F.col("n_c")
    bound = asked.groupBy("b").agg(F.min(e).alias("least_e"), F.max("h").alias("most_h"))
    most = members.groupBy("b").agg(F.max("h").alias("most_hx"), F.min(e).alias("least_ex"))
    bounds = materialize(bound.join(most, "b"), "jaccard-bounds")
    held, asked = members.join(bounds, "b"), asked.join(bounds, "b")
    need = lambda x: F.greatest(F.lit(1), F.ceil(x / 7))
    c, h, col = F.col("c"), F.col("h"), F.col

    def met(own: DataFrame, index: DataFrame) -> DataFrame:
        """(a, b, x) of sets (a, b, of, tokens, keep) and members (b, x, comp, tokens, keep) with a shared token early in both."""
        each = materialize(index.filter("keep > 0").select("b", "x", "comp", "keep", F.explode("tokens").alias("token")), "jaccard-differences")
        one = F.count(F.lit(1))
        seen = materialize(each.groupBy("b", "token").agg(one.alias("seen"), one.alias("times")), "jaccard-seen")
        early = lambda *key: F.row_number().over(Window.partitionBy(*key).orderBy("seen", "token")) <= col("keep")
        index = join_uneven(each, seen, ["b", "token"], "times").withColumn("early", early("b", "x")).filter("early").select("b", "token", "x", "comp")
        own = own.filter("keep > 0").select("a", "b", "of", "keep", F.explode("tokens").alias("token")).join(seen.drop("times"), ["b", "token"], "left")
        own = own.withColumn("seen", F.coalesce("seen", F.lit(0))).withColumn("early", early("a", "b")).filter("early and seen > 0").select("a", "b", "of", "token")
        own, index = materialize(own, "jaccard-asked-early"), materialize(index, "jaccard-held-early")  # plans of few scans, or the driver holds many stages at once
        return own.join(index, ["b", "token"]).filter((col("of") != col("comp")) & (col("a") != col("x"))).select("a", "b", "x").distinct()

    beyond = met(
        asked.select("a", "b", "of", col("beyond").alias("tokens"), (col("b_n") - need(e - col("most_hx")) + 1).alias("keep")),
        held.select("b", "x", "comp", col("beyond").alias("tokens"), (col("b_n") - need(F.greatest(col("least_e") - h, e - col("most_h"))) + 1).alias("keep")),
    )
    lacked = met(
        asked.filter((col("most_hx") >= e) & (h >= col("least_ex"))).select("a", "b", "of", col("lacks").alias("tokens"), (col("l_n") - need(c + col("least_ex")) + 1).alias("keep")),
        held.filter((h >= col("least_e")) & (col("most_h") >= e)).select("b", "x", "comp", col("lacks").alias("tokens"), (col("l_n") - need(c + col("least_e")) + 1).alias("keep")),
    )
    pairs = materialize(beyond.union(lacked).distinct(), "jaccard-derived")
    x_side = members.select("b", "x", "v", col("beyond").alias("beyond_x"), col("lacks").alias("lacks_x"), c.alias("c_x"))
    both = pairs.join(asked.select("a", "b", "u", "n_c", "beyond", "lacks", "c"), ["a", "b"]).join(x_side, ["b", "x"])
    shared = F.size(F.array_intersect("beyond", "beyond_x")) + F.size(F.array_intersect("lacks", "lacks_x"))
    return both.filter(7 * shared >= c + col("c_x") - col("n_c")).select("u", "v")


def _profiled(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame, int]:
    """Profiles, nodes (d, n, node: the smallest id with this set, rows) and the seed under which no two sets share a digest."""
    for seed in itertools.count():
        profile = profiles(docs, words, seed)
        filled = profile.filter("seen is null and n > 0 and doc_id is not null")
        one = F.count(F.lit(1)).alias("rows")
        nodes = filled.groupBy("d").agg(F.min("doc_id").alias("node"), F.max("n").alias("n"), F.max("third").alias("third"), F.min("n").alias("least_n"), F.min("d2").alias("lo"), F.max("d2").alias("hi"), one)
        nodes = materialize(nodes, "jaccard-nodes")
        if nodes.filter("least_n < n or lo < hi").isEmpty():
            return profile, nodes, seed


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of `docs`."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.filter("doc_id is not null")
    profile, nodes, seed = _profiled(docs, words)
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(profile))

    shared = shared_in_third(known, frequent, words, seed)
    lonely = F.col("third") - F.coalesce(F.col("shared") / F.col("rows"), F.lit(0))
    alive = nodes.join(shared, "d", "left").filter(4 * lonely <= F.col("n")).select("d", "node", "n")
    sets = alive_sets(known, materialize(alive, "jaccard-alive"), frequent, words, seed)
    postings = prefix_postings(sets)

    # A repeated id with several sets links all their nodes.
    rows = profile.filter("seen is null").select("doc_id", "n", "d")
    several = rows.filter("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).filter("lo < hi").select("doc_id")
    links = several.join(rows.filter("n > 0"), "doc_id").join(nodes.select("d", "node"), "d").select(F.col("doc_id").alias("u"), F.col("node").alias("v")).distinct()
    links = materialize(links, "jaccard-same-id")

    components = None if links.isEmpty() else connected_components(links)
    led = None
    postings = live_postings(postings, components, "jaccard-live")
    for n, each in enumerate(LEADERS):
        # A first leader heads also what only resembles it, since differences to it tell apart what is not linked.
        looser = 2 * (F.col("size_a") + F.col("size_b")) if n == 0 else None
        pairs = plausible(leader_pairs(postings, n, each, n == 0), sets, "jaccard-led-pairs", looser)
        if pairs.isEmpty():
            break
        linked = is_link(F.col("n_a"), F.col("n_b"), F.col("common"))
        near = linked if n else 100 * F.col("common") >= LOOSE * (F.col("n_a") + F.col("n_b") - F.col("common"))
        found = overlaps(sets, pairs, near).filter(near)
        links = links.union(found.filter(linked).select("node_a", "node_b"))
        led = found if led is None else led.union(found)
        if n == 0:
            components = connected_components(links)
            before, postings = postings, live_postings(postings, components, "jaccard-live")
            discard(before, pairs)
    if led is None:
        led = sets.sparkSession.createDataFrame([], "a long, b long, node_a long, node_b long, n_b long, common long, only_a array<long>, only_b array<long>")
    groups = similar_groups(led)
    centres = group_centres(groups)
    centred = centred_members(groups, centres)
    # The last leaders' links and the hubs' are joined together.
    links = links.union(hub_links(centred, components))
    components = connected_components(links)
    postings = live_postings(postings, components, "jaccard-live")
    more = materialize(late_links(sets, postings, groups, centres, centred, components), "jaccard-late-links")
    if not more.isEmpty():
        components = connected_components(links.union(more))

    named = _with_component(nodes.select("d", "node", "rows"), "node", components, "component").select(F.col("d").alias("of"), "component", F.col("rows").alias("copies"))
    named = materialize(named, "jaccard-components")
    return _with_copies(rows, named).select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _with_copies(rows: DataFrame, named: DataFrame, most: int = 2048) -> DataFrame:
    """`rows` with the component of their set. Sets of so many rows that at most `most` can be such are broadcast, so no key is hot."""
    limit = named.agg(F.sum("copies").alias("n")).first()["n"] or 0
    hot = F.broadcast(named.filter(F.col("copies") * most > limit).select("of", F.col("component").alias("hot")))
    marked = rows.join(hot, (F.col("d") == F.col("of")) & (F.col("n") > 0), "left").drop("of")
    rest = marked.filter("hot is null").join(named.select("of", "component"), (F.col("d") == F.col("of")) & (F.col("n") > 0), "left")
    columns = [F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component")]
    return rest.select("doc_id", "n", *columns).union(marked.filter("hot is not null").select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("hot"))))
