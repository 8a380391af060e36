r"""Secret scans with multipart credential linking, in DataFrame functions only.

One regular expression finds texts with any part at all; of those, each kind's matches are located
by splitting the text at the matches, so that lengths give positions. Matches become rows, running
sums give spans. Weak candidates (a bare 40-character key, a client or user name, an endpoint) are
reported only if a complementary part stands within `SCOPE` code points in the same text: an
interval join of weak spans with all parts on (row, bin of position).

Kinds. Base: assign, access, hex. Added: key40, login, endpoint. Roles: access and login identify,
assign, hex and key40 are secrets; a weak part needs another role, and one of the two a secret.

Defined cases: a null text is the empty one; rows without any part have counts 0 and empty spans;
repeated rows are scanned each; an empty table gives no rows; other columns are ignored by
`scan_secrets` and carried by `redact_secrets`. Spans count code points, their end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize

#: Code points within which parts of one credential are looked for.
SCOPE = 256

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KEY40 = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
LOGIN = r"""(?i:access_?key_?id|client_?id|user_?name|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+_.-]+)"""
ENDPOINT = r"""https?://[^\x20\x09-\x0D"'<>]+"""

#: kind: (pattern, least length of group 1 or None, role, weak); the order ranks kinds that start together.
KINDS: dict[str, tuple[str, int | None, str, bool]] = {
    "assign": (ASSIGN, 6, "secret", False),
    "access": (ACCESS, None, "id", False),
    "hex": (HEX, None, "secret", False),
    "key40": (KEY40, None, "secret", True),
    "login": (LOGIN, 3, "id", True),
    "endpoint": (ENDPOINT, None, "endpoint", True),
}
BASE = ("assign", "access", "hex")
_ANY = "|".join(
    [r"(?i:password|passwd|secret|token|api_?key|access_?key_?id|client_?id|user_?name|login)[\"']?\x20*[:=]", "AKIA[A-Z0-9]{16}", "[0-9a-f]{24}", "[A-Za-z0-9+/]{40}", "https?://"]
)


def _matches(kind: str) -> Column:
    """array<struct<kind, place, gap, len, ok>>: each match with the length of the text since the one before."""
    pattern, least, _, _ = KINDS[kind]
    gaps = F.transform(F.split("__text", pattern, -1), F.length)
    found = F.regexp_extract_all("__text", F.lit(pattern), F.lit(0))

    # The gaps are bound once per text, not once per match.
    return F.flatten(
        F.transform(
            F.array(F.struct(gaps.alias("gaps"), found.alias("found"))),
            lambda t: F.transform(
                t["found"],
                lambda m, i: F.struct(
                    F.lit(kind).alias("kind"),
                    i.alias("place"),
                    F.get(t["gaps"], i).alias("gap"),
                    F.length(m).alias("len"),
                    (F.lit(True) if least is None else F.length(F.regexp_extract(m, pattern, 1)) >= least).alias("ok"),
                ),
            ),
        )
    )


def find_parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table with a row per row of `docs`: row_id, doc_id, text_hash and its parts."""
    text = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")
    )
    parts = F.when(F.col("__text").rlike(_ANY), F.concat(*[_matches(kind) for kind in KINDS]))
    return materialize(text.select("row_id", "doc_id", F.xxhash64("__text").alias("text_hash"), parts.alias("parts")), "secret-parts")


def locate(parts: DataFrame) -> DataFrame:
    """row_id, kind, start, end, role, weak of every match that holds."""
    rows = parts.select("row_id", F.explode("parts").alias("p")).select("row_id", "p.*")
    running = Window.partitionBy("row_id", "kind").orderBy("place")
    role = F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[2])])
    weak = [k for k, v in KINDS.items() if v[3]]
    return (
        rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(running))
        .filter("ok")
        .select("row_id", "kind", (F.col("end") - F.col("len")).alias("start"), "end", role[F.col("kind")].alias("role"), F.col("kind").isin(weak).alias("weak"))
    )


def link(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The strong spans, and the weak ones that have a complementary part within `scope`."""
    strong, weak = spans.filter(~F.col("weak")), spans.filter("weak")
    binned = weak.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))))
    # A part is seen from the bins that its surroundings touch, so a pair within reach shares one.
    reach = spans.select(
        F.col("row_id").alias("o_row"),
        F.col("start").alias("o_start"),
        F.col("end").alias("o_end"),
        F.col("role").alias("o_role"),
        F.explode(F.sequence(F.floor((F.col("start") - scope) / scope) - 1, F.floor((F.col("end") + scope) / scope))).alias("o_bin"),
    )
    near = (F.col("start") - F.col("o_end") <= scope) & (F.col("o_start") - F.col("end") <= scope)
    complementary = (F.col("role") != F.col("o_role")) & ((F.col("role") == "secret") | (F.col("o_role") == "secret"))
    apart = (F.col("end") <= F.col("o_start")) | (F.col("o_end") <= F.col("start"))
    linked = binned.join(
        reach, (F.col("row_id") == F.col("o_row")) & (F.col("bin") == F.col("o_bin")) & near & complementary & apart, "left_semi"
    )
    linked = linked.drop("bin").dropDuplicates(["row_id", "kind", "start"])
    return strong.unionByName(linked)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """A row per row of `docs`: doc_id, text_hash and its spans as array<struct<start, rank, kind, end>>."""
    parts = find_parts(docs, id_col, text_col)
    spans = materialize(locate(parts), "secret-spans")
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    by_row = (
        link(spans, scope)
        .groupBy("row_id")
        .agg(F.sort_array(F.collect_list(F.struct("start", order[F.col("kind")].alias("rank"), "kind", "end"))).alias("spans"))
    )
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return parts.select("row_id", "doc_id", "text_hash").join(by_row, "row_id", "left").select("doc_id", "text_hash", F.coalesce("spans", none).alias("spans"))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, mark: str = "[REDACTED]", id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """`docs` with every reported span of the text replaced by `mark`; all rows stay."""
    found = (
        scan_secrets(docs, id_col, text_col)
        .filter(F.size("spans") > 0)
        .groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        .agg(F.first("spans").alias("__spans"))  # rows that agree in both have the same spans
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.withColumn("__key", F.xxhash64(text)).join(
        found, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__hash")), "left"
    )
    # Spans in order; each adds the text since the last one's end and a mark, unless it begins inside that one.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    fold = F.aggregate(
        "__spans",
        start,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["out"], F.array(F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    out = joined.withColumn(text_col, F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(fold))
    if length_col:  # a column that holds the text's length follows the changed texts
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.col("__spans").isNull(), F.col(length_col)).otherwise(F.char_length(text_col).cast(kind)))
    return out.select(*docs.columns)
