"""The translation loop: claim, extract, look up, translate, write, until nothing is left to claim."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import term_hash, term_id
from ledgerloom.operators import claims
from ledgerloom.operators.upsert import append_events
from ledgerloom.plans import translation
from ledgerloom.session import materialize

KEY = ["category", "original_hash", "source_lang", "target_lang", "prompt_version", "model"]


@dataclass(frozen=True)
class Tables:
    """Raw inputs (id, payload, status, created_at, lease_by, lease_until, attempts, error, payload_en, translated_at), cache and event log."""

    raw: DataFrame
    cache: DataFrame
    events: DataFrame


@dataclass(frozen=True)
class Settings:
    source: str
    worker: str
    batch: int
    target_lang: str = "en"
    prompt_version: str = "v1"
    model: str = ""


def one_batch(tables: Tables, settings: Settings, translator: translation.Translator, now: Column, rates: dict | None = None, ids: Sequence | None = None, batches: int | None = 1) -> tuple[Tables, int]:
    """The tables after one claim of so many batches (all there are, for None), written, and how many rows it claimed. Only misses reach the
    translator; results, cache and events follow from one written claim, so they agree."""
    lang = translation.source_language(settings.source)
    claimed = materialize(claims.claim(tables.raw, now, settings.worker, None if batches is None else batches * settings.batch, ids=ids), "batch-claimed")
    taken = claimed.filter("claimed")
    n = taken.count()
    if not n:
        return tables, 0
    terms = translation.extract_terms(taken, settings.source)
    hits, misses = translation.plan_batch(terms, tables.cache, lang, settings.target_lang, settings.prompt_version, settings.model)
    asked = misses.withColumn("item_id", term_id(F.col("category"), F.col("text")))
    # Terms that agree after trimming and lower-casing are one item.
    items = asked.groupBy("item_id").agg(F.min("category").alias("category"), F.min("text").alias("text"))
    answers = materialize(translation.translate(items, translator), "batch-answers")
    fresh = asked.join(answers, "item_id").select("category", "text", "original_hash", "translated_text")
    known = hits.select("category", "text", "translated_text").unionByName(fresh.select("category", "text", "translated_text"))
    ready = taken.join(translation.translation_maps(terms, known), "id", "left")
    if settings.source == "brreg":
        given = {"source_rate": None, "usd_rate": None, "rate_source": "", "rate_date": ""} | (rates or {})
        ready = ready.withColumns({k: F.lit(v).cast("double" if k in ("source_rate", "usd_rate") else "string") for k, v in given.items()})
        results = translation.brreg_english(ready)
    else:
        results = translation.other_english(ready, settings.source)
    results = materialize(results, "batch-results")
    more = fresh.select("category", "original_hash", F.lit(lang).alias("source_lang"), F.lit(settings.target_lang).alias("target_lang"), F.lit(settings.prompt_version).alias("prompt_version"), F.lit(settings.model).alias("model"), F.col("text").alias("original_text"), "translated_text")
    cache = materialize(translation.update_cache(tables.cache, more, KEY), "batch-cache")
    raw = materialize(claims.written(claimed.drop("claimed"), results, now), "batch-raw")
    events = append_events(tables.events, results.filter("error is null").select(F.col("id").cast("string").alias("action_id")), "succeeded", "translated")
    failed = results.filter("error is not null").select(F.col("id").cast("string").alias("action_id"), F.lit("failed").alias("status"), F.col("error").alias("message"))
    return Tables(raw, cache, materialize(events.unionByName(failed), "batch-events")), n


def translate_all(tables: Tables, settings: Settings, translator: translation.Translator, now: Column, rates: dict | None = None, ids: Sequence | None = None, most_batches: int | None = None) -> tuple[Tables, int]:
    """The tables after all batches, or `most_batches` of them, and the rows claimed. Given ids are one batch.

    Batches only limit what one claim of a small worker holds. Here they are claimed together: a term that several would miss is translated
    once, and every table is written once, not once a batch."""
    return one_batch(tables, settings, translator, now, rates, ids, 1 if ids is not None else most_batches)


__all__ = ["Settings", "Tables", "one_batch", "term_hash", "translate_all"]
