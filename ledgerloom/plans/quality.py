"""Quality runs of a translator: cases of items with expected and forbidden words, and what a run adds up to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CASES = (
    "cases array<struct<name:string, category:string, source_lang:string, target_lang:string, "
    "items:array<struct<id:string, text:string, expected_any:array<string>, forbidden_any:array<string>>>>>"
)


def corpus_items(spark: SparkSession, path: str) -> DataFrame:
    """One row per item of the corpus files at a path: case, category, source_lang, target_lang, item, text, expected_any, forbidden_any.

    Raises when a file holds no case, or a case no item."""
    corpora = spark.read.schema(CASES).json(path, multiLine=True)
    # Outer explosions keep what is empty, so that it is told and not filtered away.
    fail = lambda *message: F.raise_error(F.concat(*message)).cast("int")
    cases = corpora.select(F.explode_outer("cases").alias("c")).filter(F.when(F.col("c").isNull(), fail(F.lit("a corpus without cases"))).isNull())
    language = lambda c, default: F.coalesce(F.nullif(F.col(f"c.{c}"), F.lit("")), F.lit(default)).alias(c)
    items = cases.select(F.col("c.name").alias("case"), "c.category", language("source_lang", "no"), language("target_lang", "en"), F.explode_outer("c.items").alias("i"))
    items = items.filter(F.when(F.col("i").isNull(), fail(F.lit("a case without items: "), F.coalesce("case", F.lit("<unnamed>")))).isNull())
    words = lambda c: F.coalesce(f"i.{c}", F.array().cast("array<string>")).alias(c)
    return items.select("case", "category", "source_lang", "target_lang", F.col("i.id").alias("item"), F.col("i.text").alias("text"), words("expected_any"), words("forbidden_any"))


def item_errors(text: Column, translated: Column, expected_any: Column, forbidden_any: Column) -> Column:
    """An array with one name for each thing that is wrong with an item: missing (and nothing else), copied_source, expected_missing, and
    forbidden_present for every forbidden word that it holds."""
    said = F.lower(F.trim(F.coalesce(translated, F.lit(""))))
    within = lambda w: F.contains(said, F.lower(w))
    one = lambda wrong, name: F.when(wrong, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    return F.when(said == "", F.array(F.lit("missing"))).otherwise(
        F.concat(
            one(said == F.lower(F.trim(text)), "copied_source"),
            one((F.size(expected_any) > 0) & ~F.exists(expected_any, within), "expected_missing"),
            F.transform(F.filter(forbidden_any, within), lambda _: F.lit("forbidden_present")),
        )
    )


def run_summary(items: DataFrame, calls: DataFrame) -> DataFrame:
    """A run's cases, categories and total in one pass over its items (case, category, item, text, translated, expected_any, forbidden_any).

    `calls` has one row a case: seconds, and error where the translator failed, which counts as one more. Gives level (case, category or run),
    category, case, case_count, item_count, error_count, failed_cases, ok, seconds, and the exact median and 95th percentile of the cases' seconds."""
    wrong = F.size(item_errors(F.col("text"), F.col("translated"), F.col("expected_any"), F.col("forbidden_any")))
    per_case = items.groupBy("category", "case").agg(F.count(F.lit(1)).alias("item_count"), F.sum(wrong).alias("wrong"))
    cases = per_case.join(calls.select("case", "seconds", "error"), "case").withColumn("errors", F.col("wrong") + F.col("error").isNotNull().cast("int"))
    level = F.when(F.grouping("category") == 1, "run").when(F.grouping("case") == 1, "category").otherwise("case")
    return cases.rollup("category", "case").agg(
        level.alias("level"),
        F.count(F.lit(1)).alias("case_count"),
        F.sum("item_count").alias("item_count"),
        F.sum("errors").alias("error_count"),
        F.count_if(F.col("errors") > 0).alias("failed_cases"),
        F.bool_and(F.col("errors") == 0).alias("ok"),
        F.sum("seconds").alias("seconds"),
        F.percentile("seconds", 0.5).alias("median_seconds"),
        F.percentile("seconds", 0.95).alias("p95_seconds"),
    )


def append_results(rows: DataFrame, folder: str, run_id: str) -> None:
    """Add a run's rows to a log of JSON lines. A run that is written again replaces its own lines, and one that fails leaves the log as it was:
    lines are written beside the log's runs, and take their place by one rename when all tasks have committed."""
    spark = rows.sparkSession
    staged, final = (spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}={run_id}") for name in ("_staged", "run"))
    rows.write.mode("overwrite").json(staged.toString())
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(final, True)
    if not files.rename(staged, final):
        raise OSError(f"cannot move the lines of run {run_id}")
