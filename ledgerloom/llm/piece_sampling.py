"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text is cut only where no piece of the vocabulary crosses, into words with their leading spaces; so its
piece lattice is the product of the words' lattices. (With a vocabulary whose pieces cross such places, a
text is one word.) Forward filtering sums, at each place of a
word, the weights of all ways to reach it; backward sampling walks from the word's end, choosing
each piece with its share of that sum. The walks of all words of a slice of texts are made together
on arrays. A draw is a hash of (seed, row key, word number, step) against whole-numbered shares that
depend on the word alone, so a row's segmentation is the same on any cluster, in any order and slice,
and after any retry.

The vocabulary is a BPE model, whose scores are ranks. Weights follow Zipf's law over the ranks:
(rank + 10) ** -alpha; a larger alpha gives fewer, longer pieces. A character without a piece is
spelled in byte pieces, together as rare as the last rank. A space is the piece symbol's bar; a bar in the text itself is spelled in
bytes, and nothing is normalised, so decoding gives the text back byte for byte.

Defined cases: a null text is encoded as the empty one (no ids, lossless) by the query, null stays
null in `decode_texts`; a null key counts as key 0; equal texts under different keys get their own
segmentations, repeated rows the same one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import mix64

BAR = "▁"
ALPHA = 1.5
_WHOLE = re.compile(r"(?s).+")
#: Shares of a node's edges are whole numbers up to this.
_SHARES = 1 << 32
_NO_PIECE = "\x00"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_pattern(pieces: list[str]) -> re.Pattern:
    """A pattern of words such that no piece crosses from one to the next: spaces, then letters or other marks, which only
    some letters join to each other: those that stand beside other marks in a piece."""
    letter = lambda c: re.match(r"\w", c) is not None
    joiners = {"_"}
    for piece in pieces:
        for a, b in zip(piece, piece[1:]):
            if b == BAR and a != BAR:
                return _WHOLE
            if a != BAR and letter(a) != letter(b):
                joiners.add(a if letter(a) else b)
    j = "".join(map(re.escape, sorted(joiners)))
    run, join = rf"(?:[^\W{j}]+|[^\w ]+)", f"[{j}]+"
    return re.compile(rf" *(?:{run}(?:{join}{run}?)*|(?:{join}{run}?)+)| +")


def _slot(h: np.ndarray) -> np.ndarray:
    """Places of hashes in a table of 65,536 bits."""
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str | None = None) -> list[tuple[str, int, bool]]:
    """(piece, id, is_byte) of every piece that may stand in a text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or default_path())
    return [
        (model.id_to_piece(i), i, model.is_byte(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]


class Lattice:
    """Lattices of words, filtered forward together, and backward sampling over them."""

    #: Words up to this length are filtered on arrays, longer ones one by one.
    SHORT = 48
    #: Every edge's weight is multiplied by this per character: all ways through a word gain the same factor.
    SCALE = 100.0

    def __init__(self, pieces: list[tuple[str, int, bool]], alpha: float = ALPHA, seed: int = 3):
        self.weight: dict[str, tuple[float, int]] = {}
        self.byte_id = np.full(256, -1, np.int64)
        text_of: dict[int, bytes] = {}
        for rank, (piece, i, is_byte) in enumerate(pieces):
            if is_byte:
                value = int(piece[3:-1], 16)
                self.byte_id[value] = i
                text_of[i] = bytes([value])
            elif _NO_PIECE not in piece:
                self.weight[piece] = ((rank + 10.0) ** -alpha, i)
                text_of[i] = piece.replace(BAR, " ").encode()
        if self.byte_id.min() < 0:
            raise ValueError("the vocabulary has no piece for some byte")
        self.text_of = [text_of.get(i, b"") for i in range(max(text_of) + 1)]
        self.longest = max(map(len, self.weight))
        self.word = word_pattern(list(self.weight))
        self.spelled_weight = (len(pieces) + 10.0) ** -alpha
        self.seed = np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
        self.by_length = [self._table(n) for n in range(1, min(self.longest, self.SHORT) + 1)]

    def _table(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the pieces of n characters: a small bit table of hashes, sorted hashes, weights and ids."""
        pieces = [p for p in self.weight if len(p) == n]
        codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64).reshape(-1, n)
        h = np.zeros(len(pieces), np.uint64)
        for k in range(n):
            h = h * _STEP + codes[:, k]
        order = np.argsort(h)
        maybe = np.zeros(1 << 16, bool)
        maybe[_slot(h)] = True
        return maybe, h[order], np.array([self.weight[p][0] for p in pieces])[order] * self.SCALE**n, np.array([self.weight[p][1] for p in pieces], np.int64)[order]

    def _edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Edges of short words' lattices: source and target node, place of the target, weight and piece; a piece
        below 0 spells a character in bytes: -1 - its code point. A word of n characters has n + 1 nodes."""
        lengths = np.array([len(w) for w in words], np.int64)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum(lengths)
        first = ends - lengths
        symbol = np.where(code == ord(BAR), 0, code)
        symbol[code == ord(" ")] = ord(BAR)
        word = np.repeat(np.arange(len(words)), lengths)
        left = ends[word] - np.arange(len(code))  # characters from here to the word's end
        at, h = np.arange(len(code)), np.zeros(len(code), np.uint64)
        symbols = symbol.astype(np.uint64)
        single = np.zeros(len(code), bool)
        out = []
        for n, (maybe, hashes, weights, ids) in enumerate(self.by_length, 1):
            if n > 1:
                keep = left[at] >= n
                at, h = at[keep], h[keep]
            if not len(at):
                break
            h = h * _STEP + symbols[at + n - 1]
            hit = np.flatnonzero(maybe[_slot(h)]) if len(hashes) else np.zeros(0, np.int64)
            place = np.minimum(np.searchsorted(hashes, h[hit]), max(0, len(hashes) - 1))
            good = hashes[place] == h[hit] if len(hit) else np.zeros(0, bool)
            start, place = at[hit[good]], place[good]
            if n == 1:
                single[start] = True
            out.append((start, np.full(len(start), n), weights[place], ids[place]))
        bare = np.flatnonzero(~single)
        out.append((bare, np.ones(len(bare), np.int64), np.full(len(bare), self.spelled_weight * self.SCALE), -1 - code[bare]))
        start, n, weight, piece = (np.concatenate(x) for x in zip(*out))
        source = start + word[start]
        return source, source + n, start - first[word[start]] + n, weight, piece

    def _filtered(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward filtering: keys (target node and cumulative share of each edge into it), sources and pieces of all edges."""
        source, target, place, weight, piece = self._edges(words)
        sums = np.zeros(sum(map(len, words)) + len(words))
        first = np.cumsum([0, *[len(w) + 1 for w in words[:-1]]])
        sums[first] = 1.0
        order = np.argsort(place.astype(np.int16), kind="stable")
        cuts = np.searchsorted(place[order], np.arange(1, place.max() + 2))
        way = np.empty(len(order))
        for a, b in zip(cuts[:-1], cuts[1:]):  # places in order: all that lead to one are known before it is left
            e = order[a:b]
            way[e] = sums[source[e]] * weight[e]
            np.add.at(sums, target[e], way[e])
        order = np.argsort(target, kind="stable")
        target, source, piece, way = target[order], source[order], piece[order], way[order]
        begins = np.flatnonzero(np.diff(target, prepend=-1))
        nth = np.arange(len(target)) - np.repeat(begins, np.diff(np.append(begins, len(target))))
        run = way.copy()
        for n in range(1, int(nth.max(initial=0)) + 1):  # each node's edges are summed by themselves
            at = np.flatnonzero(nth == n)
            run[at] += run[at - 1]
        share = np.minimum(run / sums[target] * _SHARES, _SHARES).astype(np.int64)
        share[np.append(begins[1:], len(target)) - 1] = _SHARES
        return target * _SHARES + share, source, piece

    def _filtered_long(self, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As `_filtered` for one long word; a node's sum is a fraction and a power of two, so it never vanishes beside others."""
        s = word.replace(BAR, _NO_PIECE).replace(" ", BAR)
        n, weight = len(s), self.weight
        sums, powers = [1.0] + [0.0] * n, [0] * (n + 1)
        keys, sources, ids = [], [], []
        for end in range(1, n + 1):
            edges = []
            for start in range(max(0, end - self.longest), end):
                found = weight.get(s[start:end])
                if found is not None:
                    edges.append((sums[start] * found[0], start, found[1]))
            if s[end - 1] not in weight:
                edges.append((sums[end - 1] * self.spelled_weight, end - 1, -1 - ord(word[end - 1])))
            top = max(powers[start] for _, start, _ in edges)
            edges = [(math.ldexp(w, powers[start] - top), start, piece) for w, start, piece in edges]
            total, run = sum(e[0] for e in edges), 0.0
            for w, start, piece in edges:
                run += w
                keys.append(end * _SHARES + min(_SHARES, int(run / total * _SHARES)))
                sources.append(start)
                ids.append(piece)
            keys[-1] = (end + 1) * _SHARES
            sums[end], power = math.frexp(total)
            powers[end] = top + power
        return np.array(keys, np.int64), np.array(sources, np.int64), np.array(ids, np.int64)

    def encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Sampled ids (int64) of each text."""
        found = [self.word.findall(t) for t in texts]
        number: dict[str, int] = {}
        index = [number.setdefault(w, len(number)) for words in found for w in words]
        if not index:
            return [np.zeros(0, np.int64) for _ in texts]
        words = list(number)
        lengths = np.array([len(w) for w in words], np.int64)
        short = np.flatnonzero(lengths <= self.SHORT)
        base, tables, nodes = np.empty(len(words), np.int64), [], 0
        if len(short):
            tables.append(self._filtered([words[i] for i in short]))
            base[short] = np.cumsum(lengths[short] + 1) - lengths[short] - 1
            nodes = int((lengths[short] + 1).sum())
        for i in np.flatnonzero(lengths > self.SHORT):
            key, source, piece = self._filtered_long(words[i])
            base[i] = nodes
            tables.append((key + nodes * _SHARES, source + nodes, piece))
            nodes += int(lengths[i]) + 1
        edge_key, source, piece = (np.concatenate(x) for x in zip(*tables))

        word = np.array(index, np.int64)
        counts = np.array([len(w) for w in found], np.int64)
        nth = np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts)
        row = mix64(np.array([(k or 0) & (2**64 - 1) for k in keys], np.uint64) + self.seed)
        stream = mix64(np.repeat(row, counts) + nth.astype(np.uint64))
        first = base[word]
        at = first + lengths[word]
        live = np.arange(len(word))
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        taken = np.zeros(len(word), np.int64)
        while len(live):
            step = np.uint64((len(steps) + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
            draw = (mix64(stream[live] + step) >> np.uint64(32)).astype(np.int64)
            # Edges into node p have keys above p and up to p + 1, in units of _SHARES.
            edge = np.searchsorted(edge_key, at[live] * _SHARES + draw, side="right")
            steps.append((live, piece[edge]))
            taken[live] += 1
            at[live] = source[edge]
            live = live[at[live] > first[live]]
        ends = np.cumsum(taken)
        out = np.empty(int(ends[-1]), np.int64)
        for n, (who, what) in enumerate(steps):  # walks go from a word's end to its start
            out[ends[who] - 1 - n] = what
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        out, bounds = self._spelled(out, bounds)
        return [out[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

    def _spelled(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with the bytes of spelled characters in place, and the texts' bounds in them."""
        bare = np.flatnonzero(ids < 0)
        code = -1 - ids[bare]
        width = np.ones(len(ids), np.int64)
        width[bare] = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        ends = np.cumsum(width)
        out = np.repeat(ids, width)
        for k in range(4):
            n = width[bare]
            part = n > k
            shift = 6 * (n[part] - 1 - k)
            value = code[part] >> shift
            lead = np.array([0, 0x00, 0xC0, 0xE0, 0xF0])[n[part]]
            value = np.where(n[part] == 1, value, lead | value if k == 0 else 0x80 | (value & 0x3F))
            out[ends[bare[part]] - n[part] + k] = self.byte_id[value]
        return out, np.concatenate([[0], ends])[bounds]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.text_of.__getitem__, ids.tolist()))


_LOADED: dict[tuple, Lattice] = {}


def _loaded(shared, alpha: float, seed: int) -> Lattice:
    """One lattice per worker process, kept between tasks."""
    key = (len(shared.value), hash(shared.value[-1]), alpha, seed)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Lattice(shared.value, alpha, seed)
    return _LOADED[key]


def _slices(batch: pa.RecordBatch, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `size` bytes of text, so that the walks' arrays stay small."""
    lengths = np.array([len(x) if x else 0 for x in batch.column(1).to_pylist()], np.int64)
    part = np.cumsum(lengths) // size
    for p in np.unique(part):
        rows = np.flatnonzero(part == p)
        yield batch.slice(rows[0], len(rows))


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    cut = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(ids or [np.zeros(0, np.int64)]).astype(np.int32)))


def encode_texts(
    docs: DataFrame, model_path: str | None = None, alpha: float = ALPHA, seed: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id and its sampled segmentation as array<int>."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _loaded(shared, alpha, seed)
        for batch in batches:
            for part in _slices(batch):
                ids = lattice.encode([t or "" for t in part.column(1).to_pylist()], part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), _id_lists(ids)], names=[id_col, "ids"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(encode, f"`{id_col}` long, ids array<int>")


def decode_texts(encoded: DataFrame, model_path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """id and text of (id, ids) rows."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _loaded(shared, ALPHA, 3)
        for batch in batches:
            texts = [None if x is None else lattice.decode(np.array(x, np.int64)).decode() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, "ids").mapInArrow(decode, f"`{id_col}` long, text string")


def encode_digests(docs: DataFrame, model_path: str | None = None, alpha: float = ALPHA, seed: int = 3) -> DataFrame:
    """doc_id, ids, n_pieces, ids_crc32 (little-endian uint32 ids) and lossless (the decoded ids are the text), both
    directions in one task step."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _loaded(shared, alpha, seed)
        for batch in batches:
            for part in _slices(batch):
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = lattice.encode(texts, part.column(0).to_pylist())
                columns = [
                    part.column(0),
                    _id_lists(ids),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([lattice.decode(x) == t.encode() for x, t in zip(ids, texts)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_pieces", "ids_crc32", "lossless"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(digest, "doc_id long, ids array<int>, n_pieces long, ids_crc32 long, lossless boolean")
