"""Fill-in-the-middle documents: each text is cut in three and put together again with the middle last.

Units are code points. They are found on bit sets held in big integers, one bit a byte of the text: translation tables turn
the bytes into masks of classes, shifted boolean operations mark where units begin and where a marker stands, `bit_count`
gives their number, and the byte at which unit number r begins is selected by halving the mask again and again. No text is
decoded, and a text's masks take a quarter of its bytes.

Cuts and forms come from a hash of the seed and the document's id, so any slice of a table gives the same rows.

Defined cases: a null text is the empty one; an empty text, or one that holds a marker, stays plain; a null id counts as an
id without digits; rows that repeat an id have the same random numbers, rows that repeat id and text the same result; an
empty table gives no rows; a text of any length is cut whole, in one row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of output that leave a task together, or one text that is longer.
TOGETHER = 8 << 20


def _class(members: bytes) -> bytes:
    """A translation table: '1' for the bytes of a class, '0' for others."""
    return bytes(ord("1") if b in members else ord("0") for b in range(256))


_FOLLOWS = _class(bytes(range(0x80, 0xC0)))  # bytes of UTF-8 that go on with a code point
_OPENS, _NAMES, _CLOSES = _class(b"<"), _class(b"PSM"), _class(b">")


def mask(data: bytes, table: bytes) -> int:
    """Bit i is set where byte i is of the table's class."""
    return int(data.translate(table)[::-1] or b"0", 2)


def unit_starts(data: bytes) -> int:
    """Bit i is set where byte i begins a code point."""
    return ~mask(data, _FOLLOWS) & ((1 << len(data)) - 1)


def holds_marker(data: bytes) -> bool:
    """Whether one of the markers stands anywhere in the text."""
    return data.find(b"<") >= 0 and bool(mask(data, _OPENS) & (mask(data, _NAMES) >> 1) & (mask(data, _CLOSES) >> 2))


def select(bits: int, rank: int, size: int) -> int:
    """Place of the set bit of this rank (from 0) in a mask of `size` bits; `size` if it has no more than `rank` set bits."""
    place, whole = 0, size
    if rank >= bits.bit_count():
        return whole
    while size > 1:
        half = size // 2
        low = bits & ((1 << half) - 1)
        below = low.bit_count()
        if rank < below:
            bits, size = low, half
        else:
            bits, rank, place, size = bits >> half, rank - below, place + half, size - half
    return place


def cut(text: bytes, first: int, second: int) -> tuple[int, int, int, int, int]:
    """(units, units before the smaller cut, units up to the larger one, and the bytes at which both stand)."""
    starts = unit_starts(text)
    n = starts.bit_count()
    a, b = sorted((first % (n + 1), second % (n + 1)))
    return n, a, b, select(starts, a, len(text)), select(starts, b, len(text))


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4]) for i in range(0, 16, 4)]


def transform(text: bytes, numbers: list[int], plain_percent: int, spm_percent: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    n, a, b, at, to = cut(text, numbers[0], numbers[1])
    if not n or numbers[2] % 100 >= 100 - plain_percent or holds_marker(text):
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:at], text[at:to], text[to:]
    if numbers[3] % 100 < spm_percent:
        return n, "spm", a, b - a, b"".join((b"<S>", suffix, b"<P>", prefix, b"<M>", middle))
    return n, "psm", a, b - a, b"".join((b"<P>", prefix, b"<S>", suffix, b"<M>", middle))


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars and output.

    A share of `plain_percent` stays plain; of the others `spm_percent` put the suffix first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            arrays = [pa.array(c, f.type) for c, f in zip(columns[:-1], schema)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[-1], pa.binary()).cast(pa.string())], schema=schema)

        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = text.as_buffer().to_pybytes() if text.is_valid else b""
                rows.append((doc_id, *transform(whole, draws(doc_id, seed), plain_percent, spm_percent)))
                held += len(whole)
                if held >= TOGETHER:
                    yield packed(rows)
                    rows, held = [], 0
            if rows:
                yield packed(rows)

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return given.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text from which an output was made. A text with a marker stays plain, so each marker stands once in the others."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "<[PSM]>")
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
