"""The registered queries of the operators: whole tables in, the contracts' columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import ann, exact_dedup, fill_in_middle, importance, jaccard, langid, packing, piece_sampling, secret_scan, sharding, suffix_dedup, token_output, toxicity
from ledgerloom.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.encode_digests(read_table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sharding.write_shards(read_table(spark, sf_dir, "documents"), shards=8)
    return sharding.read_shards(spark, path).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_output.write_packed(read_table(spark, sf_dir, "documents"))
    return token_output.segments(spark, path).select(
        "doc_id", "piece", "start", "length", "sequence_id", "offset", F.crc32("ids").alias("ids_crc32")
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), capacity=2048)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_decisions(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", *map(count, secret_scan.BASE), F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"), secret_scan.span_list(F.col("spans")).alias("spans")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return cut.select(F.col("others.doc_id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))
    digests = [F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(fill_in_middle.restored().cast("binary"), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ann,
        op2_jaccard_join,
        op3_piece_sampling,
        op4_sharding,
        op5_token_output,
        op6_language_id,
        op7_best_fit_packing,
        op8_exact_dedup,
        op9_secret_scan,
        op10_toxicity,
        op11_importance_resampling,
        op12_suffix_dedup,
        op13_fill_in_middle,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op8_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id NULLS LAST) AS place,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY length(t) DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
""",
    "op13_fill_in_middle": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), h AS (
  SELECT *, CAST('0x' || x[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || x[9:16] AS BIGINT) % (n + 1) AS c2,
         CAST('0x' || x[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || x[25:32] AS BIGINT) % 100 AS h4 FROM t
), f AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1, n - b) AS suffix FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
""",
}
