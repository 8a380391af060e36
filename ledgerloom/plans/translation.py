"""Translation of registry payloads: terms, cache, a pluggable translator, English payloads and results."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import capital
from ledgerloom.functions.text import term_hash, term_id, trimmed
from ledgerloom.operators.lookups import cache_lookup
from ledgerloom.operators.merge import first_per_key, numbered, unique_terms
from ledgerloom.operators.upsert import upsert

#: Language of each registry.
LANGUAGES = {"brreg": "no", "cvr": "da", "ariregister": "et"}
#: Where terms stand: (path of a scalar, or of an array and a member of its objects; category).
TERMS = {
    "brreg": [
        ("organisasjonsform.beskrivelse", None, "org_form"), ("institusjonellSektorkode.beskrivelse", None, "sector_code"),
        ("naeringskode1.beskrivelse", None, "industry_code"), ("naeringskode2.beskrivelse", None, "industry_code"),
        ("naeringskode3.beskrivelse", None, "industry_code"), ("kapital.type", None, "capital_type"), ("aktivitet", "", "activity"),
        ("vedtektsfestetFormaal", "", "statutory_purpose"), ("frivilligMvaRegistrertBeskrivelser", "", "vat_description"),
    ],
    "cvr": [
        ("company_type", None, "legal_form"), ("registration_status", None, "status"), ("industries", "description", "industry"),
        ("roles", "role", "role"), ("owners", "ownership_type", "ownership_type"), ("owners", "purpose", "purpose"),
        ("beneficial_owners", "ownership_type", "ownership_type"), ("beneficial_owners", "purpose", "purpose"),
        ("signing_rule", None, "signing_rule"), ("signing_rules", "rule", "signing_rule"), ("financials", "note", "financial_note"),
    ],
    "ariregister": [
        ("legal_form", None, "legal_form"), ("registration_status", None, "status"), ("activities", "description", "activity"),
        ("registry_card_persons", "role", "role"), ("shareholders", "ownership_type", "ownership_type"),
        ("beneficial_owners", "ownership_type", "ownership_type"), ("financials", "indicator", "financial_indicator"),
    ],
}
#: registers' fields in the English payload.
ADDRESS = {"adresse": "street", "poststed": "city", "postnummer": "postal_code", "kommune": "municipality", "kommunenummer": "municipality_number", "landkode": "country_code", "land": "country"}
STRINGS = {"organisasjonsnummer": "organization_number", "navn": "name", "hjemmeside": "website", "stiftelsesdato": "founded_date", "registreringsdatoEnhetsregisteret": "registered_date"}
BOOLEANS = {
    "konkurs": "is_bankrupt", "underAvvikling": "is_under_liquidation", "underTvangsavviklingEllerTvangsopplosning": "is_forced_dissolution",
    "erIKonsern": "is_in_group", "registrertIMvaregisteret": "in_vat_register", "registrertIForetaksregisteret": "in_business_register",
    "harRegistrertAntallAnsatte": "has_registered_employees",
}


def source_language(source: str) -> str:
    if source not in LANGUAGES:
        raise ValueError(f"unknown translation source: {source}")
    return LANGUAGES[source]


def needs_rates(payload: Column) -> Column:
    """A capital object names an amount or a currency."""
    keys = F.json_object_keys(F.get_json_object(payload, "$.kapital"))
    return F.coalesce(F.arrays_overlap(keys, F.array(F.lit("belop"), F.lit("valuta"))), F.lit(False))


def extract_terms(payloads: DataFrame, source: str, payload: str = "payload") -> DataFrame:
    """(id, place, category, text) of every non-empty term, in the payload's order."""
    p, found = F.col(payload), []
    for n, (path, member, category) in enumerate(TERMS[source]):
        value = F.get_json_object(p, f"$.{path}")
        if member is None:
            texts = F.array(value)
        else:
            items = F.when(value.startswith("["), F.from_json(value, "array<string>"))
            texts = items if member == "" else F.transform(items, _member(member))
        found.append(F.transform(texts, _as_term(n, category)))
    every = F.filter(F.flatten(F.array(*[F.coalesce(x, F.array().cast("array<struct<path:int,at:int,category:string,text:string>>")) for x in found])), lambda t: F.coalesce(t["text"], F.lit("")) != "")
    return payloads.select("id", F.posexplode(every).alias("place", "t")).select("id", "place", "t.category", "t.text")


def _member(name: str) -> Callable[[Column], Column]:
    return lambda x: F.get_json_object(x, f"$.{name}")


def _as_term(path: int, category: str):
    return lambda text, at: F.struct(F.lit(path).alias("path"), at.alias("at"), F.lit(category).alias("category"), text.alias("text"))


def plan_batch(terms: DataFrame, cache: DataFrame, source_lang: str, target_lang: str = "en", prompt_version: str = "v1", model: str = "") -> tuple[DataFrame, DataFrame]:
    """Hits (category, text, translated_text) and numbered misses (id, category, text) of a batch's distinct terms."""
    distinct = unique_terms(terms).withColumn("original_hash", term_hash(F.col("text")))
    looked = cache_lookup(distinct, cache, source_lang, target_lang, prompt_version, model)
    misses = looked.filter("translated_text is null").select("category", "text", "original_hash")
    return looked.filter("translated_text is not null"), numbered(misses, ["category"], [F.col("text")], "t", "miss_id")


def service_items(terms: DataFrame) -> DataFrame:
    """Distinct items of translation requests: the first of the terms that agree after trimming and lower-casing."""
    items = terms.withColumn("text", trimmed(F.col("text"))).filter("text <> ''").withColumn("item_id", term_id(F.col("category"), F.col("text")))
    return first_per_key(items, ["id", "item_id"], [F.col("place")])


Translator = Callable[[list[dict]], dict[str, str]]


def mock_translator(items: list[dict]) -> dict[str, str]:
    return {i["item_id"]: f"[mock-en] {i['text']}" for i in items}


def mock_translation(text: Column) -> Column:
    """The mock translator as a column, for tests and dry runs."""
    return F.concat(F.lit("[mock-en] "), text)


def translate(items: DataFrame, translator: Translator, most_attempts: int = 2, per_call: int = 50) -> DataFrame:
    """(item_id, translated_text) of distinct items; unanswered ones of a call are asked again, others stay out.

    The translator is called in the tasks, `per_call` items at a time; it gets and gives plain data."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, str] = {}
            for start in range(0, len(batch), per_call):
                left = batch.iloc[start : start + per_call].to_dict("records")
                for _ in range(most_attempts):
                    known = {i["item_id"] for i in left}
                    out |= {k: v for k, v in translator(left).items() if k in known and v and v.strip()}
                    left = [i for i in left if i["item_id"] not in out]
                    if not left:
                        break
            yield pd.DataFrame({"item_id": list(out), "translated_text": list(out.values())})

    return items.select("item_id", "category", "text").mapInPandas(run, "item_id string, translated_text string")


def update_cache(cache: DataFrame, translated: DataFrame, key: list[str]) -> DataFrame:
    """Cache after new translations. Terms that differ in case share a key: the smallest text stands for them."""
    rows = first_per_key(translated, key, [F.col("original_text")])
    return upsert(cache, rows, key, ["original_text", "translated_text"])


def record_results(records: DataFrame, items: DataFrame, translations: DataFrame) -> DataFrame:
    """id, status, missing_terms and payload: skipped without terms, failed with any term missing, else succeeded."""
    joined = items.join(translations, "item_id", "left")
    per = joined.groupBy("id").agg(
        F.array_sort(F.collect_list(F.when(F.col("translated_text").isNull(), F.col("item_id")))).alias("missing_terms"),
        F.array_sort(F.collect_list(F.struct("place", "item_id", "category", "text", "translated_text"))).alias("terms"),
    )
    none = F.array().cast("array<string>")
    status = F.when(F.col("terms").isNull(), "skipped").when(F.size("missing_terms") > 0, "failed").otherwise("succeeded")
    listed = F.coalesce(F.transform("terms", lambda t: t.dropFields("place")), F.array().cast("array<struct<item_id:string,category:string,text:string,translated_text:string>>"))
    payload = F.to_json(F.struct(F.lit("1").alias("version"), F.lit("en").alias("target_lang"), listed.alias("terms")))
    return records.select("id").join(per, "id", "left").select("id", status.alias("status"), F.coalesce("missing_terms", none).alias("missing_terms"), F.when(status != "failed", payload).alias("payload"))


# English payloads. Translations arrive as one map per row, "category\\0text" -> text, joined beforehand.


def translation_maps(terms: DataFrame, translations: DataFrame) -> DataFrame:
    """(id, translations map, missing count) of each row that has terms."""
    joined = terms.select("id", "category", "text").distinct().join(translations.select("category", "text", "translated_text"), ["category", "text"], "left")
    entry = F.struct(F.concat_ws("\0", "category", "text").alias("key"), F.col("translated_text").alias("value"))
    return joined.groupBy("id").agg(F.map_from_entries(F.collect_list(F.when(F.col("translated_text").isNotNull(), entry))).alias("translations"), F.count_if(F.col("translated_text").isNull()).alias("missing"))


def _translate(category: str, text: Column) -> Column:
    return F.col("translations")[F.concat_ws("\0", F.lit(category), text)]


def _described(p: Column, key: str, category: str) -> Column:
    code, text = F.get_json_object(p, f"$.{key}.kode"), F.get_json_object(p, f"$.{key}.beskrivelse")
    return F.when(F.get_json_object(p, f"$.{key}").startswith("{"), F.struct(code.alias("code"), _translate(category, F.nullif(text, F.lit(""))).alias("description")))


def _listed(p: Column, key: str, category: str) -> Column:
    value = F.get_json_object(p, f"$.{key}")
    texts = F.filter(F.when(value.startswith("["), F.from_json(value, "array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.coalesce(F.transform(texts, lambda x: _translate(category, x)), F.array().cast("array<string>"))


def _address(p: Column, key: str) -> Column:
    lines = F.from_json(F.get_json_object(p, f"$.{key}.adresse"), "array<string>")
    fields = [(lines if k == "adresse" else F.get_json_object(p, f"$.{key}.{k}")).alias(v) for k, v in ADDRESS.items()]
    return F.when(F.get_json_object(p, f"$.{key}").startswith("{"), F.struct(*fields))


def brreg_english(rows: DataFrame, payload: str = "payload") -> DataFrame:
    """id, payload_en or error. Rows carry translations, missing, source_rate, usd_rate, rate_source and rate_date."""
    p = F.col(payload)
    money = capital(p, F.col("source_rate"), F.col("usd_rate"), F.col("rate_source"), F.col("rate_date"), _translate("capital_type", F.get_json_object(p, "$.kapital.type")))
    flags = [F.get_json_object(p, f"$.{k}").try_cast("boolean").alias(v) for k, v in BOOLEANS.items()]
    body = F.struct(
        *[F.get_json_object(p, f"$.{k}").alias(v) for k, v in STRINGS.items()],
        *flags,
        F.get_json_object(p, "$.sisteInnsendteAarsregnskap").alias("last_annual_report_year"),
        _described(p, "organisasjonsform", "org_form").alias("organization_form"),
        _described(p, "institusjonellSektorkode", "sector_code").alias("sector_code"),
        _listed(p, "aktivitet", "activity").alias("activities"),
        _listed(p, "vedtektsfestetFormaal", "statutory_purpose").alias("statutory_purpose"),
        _listed(p, "frivilligMvaRegistrertBeskrivelser", "vat_description").alias("vat_descriptions"),
        F.col("__capital.value").alias("capital"),
    )
    # Missing codes and addresses are explicit nulls, other missing members are left out.
    explicit = F.struct(
        *[_described(p, f"naeringskode{i}", "industry_code").alias(f"industry_code_{i}") for i in (1, 2, 3)],
        _address(p, "forretningsadresse").alias("business_address"),
        _address(p, "postadresse").alias("postal_address"),
    )
    joined = F.concat(
        F.regexp_replace(F.to_json(body), r"\}$", ","), F.regexp_replace(F.to_json(explicit, {"ignoreNullFields": "false"}), r"^\{", "")
    )
    missing = F.coalesce(F.col("missing"), F.lit(0)) > 0
    error = F.when(missing, F.lit("missing translation")).otherwise(F.col("__capital.error"))
    return rows.withColumn("__capital", money).select("id", F.when(error.isNull(), joined).alias("payload_en"), error.alias("error"))


def _objects_in(p: Column, key: str, fields: dict[str, str]) -> Column:
    """An array of objects with some members translated; other entries as they are."""
    value = F.get_json_object(p, f"$.{key}")
    items = F.when(value.startswith("["), F.from_json(value, "array<string>"))

    def one(x: Column) -> Column:
        members = F.from_json(x, "map<string,string>")
        changed = F.transform_values(members, lambda k, v: F.coalesce(*[F.when(k == f, _translate(c, v)) for f, c in fields.items()], v))
        return F.when(x.startswith("{"), F.to_json(changed)).otherwise(F.to_json(F.array(x)).substr(F.lit(2), F.length(F.to_json(F.array(x))) - 2))

    return F.concat(F.lit("["), F.array_join(F.coalesce(F.transform(items, one), F.array().cast("array<string>")), ","), F.lit("]"))


def other_english(rows: DataFrame, source: str, payload: str = "payload") -> DataFrame:
    """English payloads of CVR and Ariregister: identity, contacts, translated arrays, legal form and status."""
    p = F.col(payload)
    text = lambda k: F.get_json_object(p, f"$.{k}")
    identity = {"cvr": [("cvr_number", "registration_number"), ("company_name", "name")], "ariregister": [("registry_code", "registration_number"), ("legal_name", "name"), ("vat_number", "vat_number")]}[source]
    form = "company_type" if source == "cvr" else "legal_form"
    arrays: dict[str, dict[str, str]] = {}
    for path, member, category in TERMS[source]:
        if member is not None:
            arrays.setdefault(path, {})[member] = category
    quoted = lambda c: F.regexp_replace(F.regexp_replace(F.to_json(F.array(c)), r"^\[", ""), r"\]$", "")
    parts = [
        F.concat(F.lit('"identity":'), F.to_json(F.struct(*[F.coalesce(text(k), F.lit("")).alias(v) for k, v in identity]))),
        F.concat(F.lit('"addresses":'), F.coalesce(F.when(text("addresses").startswith("["), text("addresses")), F.lit("[]"))),
        F.concat(F.lit('"contacts":'), F.to_json(F.struct(*[text(k).alias(k) for k in ("website", "email", "phone")]))),
        F.concat(F.lit('"source_fragments":'), F.to_json(F.struct(text("registration_status").alias("registration_status"), text(form).alias(form)))),
        *[F.concat(F.lit(f'"{k}":'), _objects_in(p, k, fields)) for k, fields in arrays.items()],
    ]
    for path, category, name in ((form, "legal_form", "legal_form"), ("registration_status", "status", "status"), ("signing_rule", "signing_rule", "signing_rule")):
        if (path, None, category) in TERMS[source]:
            said = _translate(category, F.nullif(text(path), F.lit("")))
            parts.append(F.when(said.isNotNull(), F.concat(F.lit(f'"{name}":'), quoted(said))))
    missing = F.coalesce(F.col("missing"), F.lit(0)) > 0
    return rows.select("id", F.when(~missing, F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))).alias("payload_en"), F.when(missing, F.lit("missing translation")).alias("error"))


# Answers of language models


def parse_answer(text: str) -> dict[str, str]:
    """item id -> translation from a model's answer: reasoning and fences dropped, doubled braces and bare keys repaired,
    and any of the accepted shapes read (a map, or a list under translations, items, terms or results)."""
    text = re.sub(r"(?s)<think>.*?</think>", "", text).strip()
    if fenced := re.search(r"(?s)```(?:json)?\s*(.*?)```", text):
        text = fenced[1].strip()
    if text.startswith("{{") and text.endswith("}}"):
        text = text[1:-1]
    repaired = re.sub(r"([{,]\s*)([A-Za-z_][A-Za-z0-9_:]*)\s*:", r'\1"\2":', text)
    for candidate in (text, repaired, re.sub(r",\s*([}\]])", r"\1", repaired)):
        try:
            value = json.loads(candidate)
            break
        except ValueError:
            continue
    else:
        raise ValueError("the answer holds no JSON")
    if isinstance(value, dict):
        value = next((value[k] for k in ("translations", "items", "terms", "results") if k in value), value)
    if isinstance(value, dict):
        return {k: v for k, v in value.items() if isinstance(v, str)}
    out = {}
    for item in value if isinstance(value, list) else []:
        if isinstance(item, dict):
            key = item.get("id") or item.get("item_id")
            said = next((item[k] for k in ("translation", "translated_text", "text_en", "text") if isinstance(item.get(k), str)), None)
            if key and said:
                out[str(key)] = said
    return out


def balanced_slices(text: str) -> list[str]:
    """The balanced objects and arrays of a text that are in no larger one, in order. Brackets inside strings do not count; a bracket that
    closes another kind than is open ends all that is open, and what never closes leaves what it holds."""
    found: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []
    inside = escaped = False
    for i, c in enumerate(text):
        if inside:
            inside, escaped = escaped or c != '"', c == "\\" and not escaped
        elif c == '"':
            inside = bool(stack)  # outside of brackets a quote is prose
        elif c in "{[":
            stack.append(("}" if c == "{" else "]", i))
        elif c in "}]" and stack:
            closer, start = stack.pop()
            if closer != c:
                stack = []
                continue
            while found and found[-1][0] > start:
                found.pop()
            found.append((start, i + 1))
    return [text[a:b] for a, b in found]


def answer_candidates(text: str) -> list[str]:
    """Texts that may be the JSON of an answer, the likeliest first, each once: fenced blocks, the whole, then balanced slices."""
    text = re.sub(r"(?si)<think>.*?</think>", "", text).strip()
    fenced = [m.strip() for m in re.findall(r"(?si)```(?:json)?\s*(.*?)```", text)]
    return list(dict.fromkeys(c for c in [*fenced, text, *balanced_slices(text)] if c))


def _read(candidate: str):
    """A candidate's value; bare keys and commas before a closing bracket are mended. Raises ValueError."""
    bare = re.sub(r"([{,]\s*)([A-Za-z_][A-Za-z0-9_:]*)\s*:", r'\1"\2":', candidate)
    for text in (candidate, re.sub(r",\s*([}\]])", r"\1", candidate), re.sub(r",\s*([}\]])", r"\1", bare)):
        try:
            return json.loads(text)
        except ValueError:
            continue
    raise ValueError("not JSON")


def parse_analysis(text: str, list_key: str | None = None) -> dict:
    """The first candidate of an answer that is an object, or, where `list_key` is given, an array, put under that key."""
    for candidate in answer_candidates(text):
        try:
            value = _read(candidate)
        except ValueError:
            continue
        if isinstance(value, list) and list_key is not None:
            return {list_key: value}
        if isinstance(value, dict):
            return value
    raise ValueError(f"the answer holds no JSON: {' '.join(text.split())[:300]}")


def parse_response(text: str, expected_ids: set[str], require_all: bool = True) -> dict[str, str]:
    """item id -> translation of the expected ids in a service's answer: a map, or a list under translations, items or translations_json.

    With `require_all` an answer that lacks one of them raises."""
    value = None
    for candidate in answer_candidates(text):
        try:
            value = _read(candidate)
            break
        except ValueError:
            continue
    else:
        raise ValueError("the answer holds no JSON")
    if isinstance(value, dict):
        listed = value.get("translations") or value.get("items")
        nested = value.get("translations_json")
        nested = _read(nested) if isinstance(nested, str) else nested
        value = listed if isinstance(listed, list) else nested if isinstance(nested, list) else value
    found: dict[str, str] = {}
    if isinstance(value, dict):
        found = {k: str(v).strip() for k, v in value.items() if k in expected_ids and str(v).strip()}
    for item in value if isinstance(value, list) else []:
        said = isinstance(item, dict) and (item.get("translation") or item.get("translated_text") or item.get("text"))
        if isinstance(said, str) and said.strip() and item.get("id") in expected_ids:
            found[item["id"]] = said.strip()
    if require_all and (missing := sorted(expected_ids - set(found))):
        raise ValueError(f"missing translations for ids: {', '.join(missing)}")
    return found


ANSWERS = "request string, item string, translation string, error string"


def read_answers(rows: DataFrame, require_all: bool = True) -> DataFrame:
    """One row per translated item of answers (request, expected_ids, content), or one with the error of an answer that cannot be read."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for request, expected, content in batch.itertuples(index=False):
                try:
                    out += [(request, k, v, None) for k, v in parse_response(content or "", set(expected), require_all).items()]
                except ValueError as error:
                    out.append((request, None, None, str(error)))
            yield pd.DataFrame(out, columns=["request", "item", "translation", "error"])

    return rows.select(F.col("request").cast("string"), "expected_ids", "content").mapInPandas(read, ANSWERS)


def validate_translations(rows: DataFrame) -> DataFrame:
    """Problems of translated items (text, translated, expected_any, forbidden_any): an array of names, empty if fine."""
    t = F.lower(F.coalesce("translated", F.lit("")))
    within = lambda words: F.exists(words, lambda w: F.contains(t, F.lower(w)))
    problems = F.array(
        F.when(F.trim(t) == "", F.lit("missing")),
        F.when((F.trim(t) != "") & (t == F.lower("text")), F.lit("copied_source")),
        F.when((F.trim(t) != "") & (F.size("expected_any") > 0) & ~within("expected_any"), F.lit("expected_missing")),
        F.when((F.trim(t) != "") & within("forbidden_any"), F.lit("forbidden_present")),
    )
    return rows.withColumn("problems", F.filter(problems, lambda p: p.isNotNull()))
