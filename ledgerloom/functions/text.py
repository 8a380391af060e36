"""Text columns: trimming, empty and null, hashes of terms, slugs and compact page text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as white space, as a pattern and as characters.
SPACE = r"[\s\x{0085}\x{00A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


SPACES = " \t\n\x0b\f\r\x85\xa0" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trimmed(x: Column) -> Column:
    """Without white space of any kind at both ends; Spark's own trim only takes spaces."""
    return F.trim(x, F.lit(SPACES))


def bound(x: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that it uses many times: evaluated once, and the plan holds its expression once."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def null_if_empty(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def empty_if_null(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def first_non_empty(*candidates: Column) -> Column:
    """The first candidate with anything but white space, as it is; else ''."""
    return F.coalesce(*[bound(x, lambda v: F.when(trimmed(v) != "", v)) for x in candidates], F.lit(""))


def payload_hash(x: Column) -> Column:
    return F.sha2(x, 256)


def term_hash(text: Column) -> Column:
    """Terms that differ in case or outer white space share one translation."""
    return F.sha2(F.lower(trimmed(text)), 256)


def term_id(category: Column, text: Column) -> Column:
    return F.concat_ws(":", category, term_hash(text))


#: Legal forms that are no part of a company's name.
LEGAL_FORMS = [
    "private limited company", "public limited company", "aksjeselskap", "annpartselskab", "anpartsselskab", "aktieselskab",
    "aksjonærselskap", "incorporated", "corporation", "limited liability company", "limited liability partnership", "llc", "llp",
    "inc", "ltd", "plc", "corp", "co", "as", "asa", "ans", "da", "ba", "sa", "nuf", "ks", "sf", "gmbh", "ag", "kg", "ohg", "kgaa",
    "eg", "gbr", "ug", "srl", "spa", "sas", "snc", "sapa", "scarl", "sarl", "sc", "sca", "sl", "cb", "scp",
]


def company_slug(name: Column) -> Column:
    """Lower-case name without legal forms, joined by hyphens."""
    bare = F.regexp_replace(name, r"(?iU)\b(?:" + "|".join(LEGAL_FORMS) + r")\b", "")
    return F.regexp_replace(F.regexp_replace(F.lower(bare), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def compact_lines(markdown: Column, limit: int = 2500) -> Column:
    """Non-blank lines with single spaces, cut at `limit` characters."""
    lines = F.transform(F.split(markdown, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{0085}\x{2028}\x{2029}]"), lambda x: F.regexp_replace(trimmed(x), rf"{SPACE}+", " "))
    joined = F.substring(F.array_join(F.filter(lines, lambda x: x != ""), "\n"), 1, limit)
    # Lines are added until their lengths and line ends reach the limit, so a cut never ends in a line end.
    return F.regexp_replace(joined, r"\n\z", "")


def string_list(x: Column) -> Column:
    """A JSON text as a list of strings: an array's scalars, or one non-blank string."""
    items = F.from_json(x, "array<string>")
    return F.when(x.rlike(r"^\s*\["), F.filter(items, lambda v: v.isNotNull())).when(trimmed(x) != "", F.array(trimmed(x))).otherwise(
        F.array().cast("array<string>")
    )


def digits_padded(code: Column, width: int = 5) -> Column:
    """Classification codes: digits padded with zeros; longer or other codes as they are."""
    code = trimmed(code)
    return F.when(code.rlike("^[0-9]+$") & (F.length(code) < width), F.lpad(code, width, "0")).otherwise(code)


def header_key(name: str) -> str:
    """A CSV header for comparison."""
    return name.strip().lower().replace(" ", "").replace("_", "")


def registry_key(x: Column) -> Column:
    """A field name for comparison: lower case without separators, Nordic letters spelled out."""
    low = F.regexp_replace(F.lower(trimmed(x)), "[_\\- ]", "")
    return F.replace(F.replace(F.replace(low, F.lit("æ"), F.lit("ae")), F.lit("ø"), F.lit("oe")), F.lit("å"), F.lit("aa"))


def max_answer_tokens(n_items: Column) -> Column:
    """Token budget of a translation call for so many items."""
    return F.least(F.lit(4096), F.greatest(F.lit(512), 96 * n_items))
