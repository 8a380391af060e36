"""Token ids of whole texts by a public word-level BPE tokenizer, with a bounded cache of words.

The tokenizer's pre-tokenizer never joins characters across white space and its normaliser works
character by character, so a text's ids are the ids of its white-space-separated chunks in order.
Chunks repeat, so their ids are cached; texts for which that reasoning does not hold (special-token
strings, unusual separators, text not in NFC) go to the tokenizer whole.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
from tokenizers import Tokenizer

#: White space on which Python and the tokenizer may differ.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_MARKS = frozenset(".,;:!?")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's content, read on the driver and shipped to the tasks."""
    with open(path or default_path(), encoding="utf-8") as file:
        return file.read()


def _byte_letters() -> list[str]:
    """The letter by which byte-level BPE writes each byte: printable ones themselves, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


_LETTERS = _byte_letters()


class _Chunks(dict):
    """Chunk -> little-endian uint32 ids; computes what it lacks. When full it starts afresh, but
    keeps the last generation to look into, so frequent chunks stay."""

    def __init__(self, tokenizer: Tokenizer, entries: int):
        super().__init__()
        self.tokenizer, self.model, self.entries = tokenizer, tokenizer.model, entries
        self.last: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.last.get(chunk)
        if ids is None:
            if chunk.isalpha():  # one pre-token, so the model alone gives its ids
                word = chunk if chunk.isascii() else "".join([_LETTERS[b] for b in chunk.encode()])
                ids = np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()
            elif chunk[-1] in _MARKS and chunk[:-1].isalpha():
                ids = self[chunk[:-1]] + self[chunk[-1]]
            else:
                ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) >= self.entries:
            self.last = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


class CachedTokenizer:
    def __init__(self, json: str, entries: int = 300_000):
        self.tokenizer = Tokenizer.from_str(json)
        self.chunks = _Chunks(self.tokenizer, entries)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian uint32 bytes."""
        low = self._lowered(text)
        if low is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.chunks.__getitem__, low.split()))

    @staticmethod
    def _lowered(text: str) -> str | None:
        """The text in lower case if its chunks can be encoded one by one, else None."""
        if "<|" in text or _ODD_SPACE.search(text):
            return None
        if text.isascii():
            return text.lower()
        if "Σ" in text or not unicodedata.is_normalized("NFC", text):  # capital sigma depends on its place
            return None
        low = text.lower()
        return low if unicodedata.is_normalized("NFC", low) else None


_LOADED: dict[int, CachedTokenizer] = {}


def loaded(json: str) -> CachedTokenizer:
    """One tokenizer per worker process, kept between tasks."""
    key = hash(json)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = CachedTokenizer(json)
    return _LOADED[key]
