"""Registry records to raw-input rows: GLEIF, CVR, Ariregister, BRREG, Companies House and SIC codes."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import bound, digits_padded, empty_if_null, first_non_empty, header_key, null_if_empty, payload_hash, trimmed
from ledgerloom.operators.merge import first_per_key, last_non_empty, merge_fragments


def json_text(record: Column, path: str) -> Column:
    """Trimmed scalar at a JSON path; of an object its "$"; '' if it is missing or anything else. Numbers keep their text."""
    inner = F.get_json_object(record, f"{path}['$']")
    scalar = bound(F.get_json_object(record, path), lambda value: F.when(value.startswith("{"), inner).when(~value.startswith("["), value))
    return empty_if_null(trimmed(scalar))


def fragments(x: Column) -> Column:
    """A JSON text as a list of JSON texts: nothing for null, one for a scalar or object, an array's entries without nulls."""
    entries = lambda v: F.filter(F.from_json(v, "array<string>"), lambda e: e.isNotNull())
    return bound(x, lambda v: F.when(v.isNull() | (v == "null"), F.array().cast("array<string>")).when(v.startswith("["), entries(v)).otherwise(F.array(v)))


# GLEIF

GLEIF_WRAPPERS = ("data", "leiRecords", "records")
#: Delta windows of the golden copy, by the names a caller may use.
GLEIF_DELTAS = {"PT24H": "LastDay", "P1D": "LastDay", "P7D": "LastWeek", "P31D": "LastMonth", "P1M": "LastMonth"}


def gleif_mode(mode: str, window: str = "") -> str:
    """'full', or the feed's name of a delta window; raises for anything else."""
    if mode in ("", "full"):
        return "full"
    if mode == "delta" and window in GLEIF_DELTAS:
        return GLEIF_DELTAS[window]
    raise ValueError(f"unknown GLEIF mode: {mode} {window}")


def gleif_companies(records: DataFrame) -> DataFrame:
    """lei, legal_name, registration_status, country, raw_payload and payload_hash of records in any of the published shapes."""
    r = F.col("record")
    of = lambda is_api, path: F.when(is_api, json_text(r, f"$.attributes.entity.{path}")).otherwise(json_text(r, f"$.Entity.{path}"))
    fields = lambda is_api: F.struct(
        first_non_empty(json_text(r, "$.lei"), json_text(r, "$.id"), json_text(r, "$.attributes.lei"), json_text(r, "$.LEI")).alias("lei"),
        first_non_empty(*[of(is_api, p) for p in ("legalName.name", "LegalName", "LegalName.name")], json_text(r, "$.legalName")).alias("legal_name"),
        first_non_empty(*[of(is_api, p) for p in ("status", "EntityStatus")], json_text(r, "$.entityStatus")).alias("registration_status"),
        first_non_empty(*[of(is_api, p) for p in ("headquartersAddress.country", "HeadquartersAddress.Country")], json_text(r, "$.headquartersCountry")).alias("country"),
    )
    is_api = F.coalesce(F.get_json_object(r, "$.attributes.entity").startswith("{"), F.lit(False))
    # A generator's columns are computed once; a filter on plain ones would compute them again.
    out = records.select(F.inline(F.array(bound(is_api, fields))), r.alias("raw_payload"), payload_hash(r).alias("payload_hash"))
    return out.filter("lei <> ''").withColumns({c: null_if_empty(F.col(c)) for c in ("legal_name", "registration_status", "country")})


# CVR

CVR_SCALARS = ["company_name", "registration_status", "company_type", "website", "email", "phone"]
CVR_ARRAYS = ["roles", "owners", "beneficial_owners", "financials"]
#: Members that hold a record's parts in distributed files.
CVR_NESTED, CVR_PARTS = ["_source", "source", "data"], [
    "Vrvirksomhed", "Virksomhed", "Navn", "Emailadresse", "E-mailadresse", "ElektroniskPost", "Telefonnummer", "Hjemmeside",
]


def _field_key(name: str) -> str:
    name = name.strip().lower()
    for a, b in (("_", ""), ("-", ""), (" ", ""), ("æ", "ae"), ("ø", "oe"), ("å", "aa")):
        name = name.replace(a, b)
    return name


def _normal(value):
    """Objects with normalised member names (of names that agree the smallest counts); arrays and scalars as they are."""
    if isinstance(value, dict):
        out = {}
        for k in sorted(value):
            out.setdefault(_field_key(k), _normal(value[k]))
        return out
    return [_normal(v) for v in value] if isinstance(value, list) else value


def _objects(record: dict) -> Iterator[tuple[str, dict]]:
    """A distributed record's objects with their kind, in order."""
    yield "record", record
    for key in CVR_NESTED:
        if isinstance(nested := record.get(_field_key(key)), dict):
            yield from _objects(nested)
    for key in CVR_PARTS:
        nested = record.get(_field_key(key))
        for item in nested if isinstance(nested, list) else [nested]:
            if isinstance(item, dict):
                yield _field_key(key), item


def cvr_objects(records: DataFrame) -> DataFrame:
    """record rows to rows (file_ord, record_no, part, kind, object): each object's JSON with normalised names."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples():
                value = json.loads(r.record, parse_float=str, parse_int=str)  # numbers keep their text
                for part, (kind, obj) in enumerate(_objects(_normal(value)) if isinstance(value, dict) else ()):
                    rows.append((r.file_ord, r.record_no, part, kind, json.dumps(obj, ensure_ascii=False)))
            yield pd.DataFrame(rows, columns=["file_ord", "record_no", "part", "kind", "object"])

    return records.select("file_ord", "record_no", "record").mapInPandas(split, "file_ord int, record_no long, part int, kind string, object string")


def _contact(kind: str, *names: str) -> Column:
    """A contact's text: in an object of that kind the value itself, else the named member (text, object or list)."""
    o = F.col("object")
    found = [F.when(F.col("kind") == kind, first_non_empty(json_text(o, "$.kontaktoplysning"), json_text(o, "$.value")))] if kind else []
    for n in names:
        found += [json_text(o, f"$.{n}"), json_text(o, f"$.{n}.kontaktoplysning"), json_text(o, f"$.{n}.value"), json_text(o, f"$.{n}[0].kontaktoplysning"), json_text(o, f"$.{n}[0].value"), json_text(o, f"$.{n}[0]")]
    return first_non_empty(*found)


def cvr_companies(records: DataFrame) -> DataFrame:
    """One row per cvr_number over all files: last non-empty scalars, arrays in order, sorted by number."""
    r, o = F.col("record"), F.col("object")
    flat_key = json_text(r, "$.cvr_number")
    seq = lambda part: F.struct("file_ord", "record_no", part.alias("part"))
    flat = records.filter(flat_key != "").select(
        flat_key.alias("cvr_number"),
        seq(F.lit(0)).alias("seq"),
        *[empty_if_null(F.get_json_object(r, f"$.{c}")).alias(c) for c in CVR_SCALARS],
        *[fragments(F.get_json_object(r, f"$.{c}")).alias(c) for c in CVR_ARRAYS],
    )
    text = lambda *paths: first_non_empty(*[json_text(o, f"$.{p}") for p in paths])
    parts = cvr_objects(records.filter(flat_key == "")).select(
        text("cvrnumber", "cvrnummer").alias("cvr_number"),
        seq(F.col("part")).alias("seq"),
        text("companyname", "navn", "name", "virksomhedmetadata.nyestenavn.navn").alias("company_name"),
        text("registrationstatus", "virksomhedsstatus", "virksomhedstatus", "status", "virksomhedmetadata.nyestestatus").alias("registration_status"),
        text(
            "companytype", "virksomhedsformkortbeskrivelse", "virksomhedsform.kortbeskrivelse", "virksomhedsform.langbeskrivelse",
            "virksomhedmetadata.nyestevirksomhedsform.kortbeskrivelse", "virksomhedmetadata.nyestevirksomhedsform.langbeskrivelse",
        ).alias("company_type"),
        first_non_empty(text("website"), _contact("hjemmeside", "hjemmeside")).alias("website"),
        first_non_empty(text("email"), _contact("emailadresse"), _contact("elektroniskpost", "elektroniskpost", "emailadresse")).alias("email"),
        first_non_empty(text("phone"), _contact("telefonnummer", "telefonnummer")).alias("phone"),
        *[F.array().cast("array<string>").alias(c) for c in CVR_ARRAYS],
    )
    merged = merge_fragments(flat.unionByName(parts), "cvr_number", "seq", CVR_SCALARS, CVR_ARRAYS)
    return _merged_raw(merged, "cvr_number", "DK", CVR_SCALARS, CVR_ARRAYS)


def _merged_raw(merged: DataFrame, key: str, country: str, scalars: list[str], arrays: list[str]) -> DataFrame:
    """Raw-input row of a merged company. Its payload is the merged object: empty members left out, fragments as they came."""
    plain = F.to_json(F.struct(key, *[null_if_empty(F.col(c)).alias(c) for c in scalars]))
    listed = [F.when(F.size(c) > 0, F.concat(F.lit(f'"{c}":['), F.array_join(c, ","), F.lit("]"))) for c in arrays]
    payload = F.concat(F.concat_ws(",", F.regexp_replace(plain, r"\}$", ""), *listed), F.lit("}"))
    out = merged.withColumns({"country_iso2": F.lit(country), "raw_payload": payload}).withColumn("payload_hash", payload_hash(F.col("raw_payload")))
    return out.withColumns({c: null_if_empty(F.col(c)) for c in scalars}).withColumn("source_native_id", F.col(key))


# Ariregister

#: Headers of the Estonian files, by canonical name.
ARIREGISTER_HEADERS = {
    "registry_code": ["ariregistri_kood"], "legal_name": ["nimi"], "legal_form": ["ettevotja_oiguslik_vorm"], "vat_number": ["kmkr_nr"],
    "registration_status": ["ettevotja_staatus_tekstina"], "registration_status_code": ["ettevotja_staatus"], "website": ["veebileht"],
    "email": ["e_post", "e-post", "epost"], "phone": ["telefon"], "year": ["aasta"], "revenue": ["muugitulu"], "profit": ["kasum"],
    "employee_count": ["tootajate_arv"],
}
ARIREGISTER_SCALARS = ["legal_name", "registration_status", "legal_form", "vat_number", "website", "email", "phone"]


def ariregister_header(header: str) -> str:
    name = header.removeprefix("\ufeff").strip().lower()
    return next((k for k, names in ARIREGISTER_HEADERS.items() if name in names), name.replace(" ", "_"))


def ariregister_companies(records: DataFrame) -> DataFrame:
    """One row per registry_code: last non-empty scalars of basic records, financial records collected in order."""
    r = F.col("record")
    keys = F.coalesce(F.json_object_keys(r), F.array().cast("array<string>"))
    financial = F.arrays_overlap(keys, F.array(*map(F.lit, ["year", "revenue", "profit", "employee_count"])))
    rows = records.select(json_text(r, "$.registry_code").alias("registry_code"), F.struct("file_ord", "record_no").alias("seq"), financial.alias("financial"), "record").filter("registry_code <> ''")
    value = lambda c: F.when(F.col("financial"), F.lit("")).otherwise(
        first_non_empty(json_text(r, f"$.{c}"), json_text(r, f"$.{c}_code")) if c == "registration_status" else json_text(r, f"$.{c}")
    )
    rows = rows.withColumns({c: value(c) for c in ARIREGISTER_SCALARS})
    merged = rows.groupBy("registry_code").agg(
        *[last_non_empty(c, "seq").alias(c) for c in ARIREGISTER_SCALARS],
        F.transform(F.array_sort(F.collect_list(F.when(F.col("financial"), F.struct("seq", "record")))), lambda x: x["record"]).alias("financials"),
    )
    return _merged_raw(merged, "registry_code", "EE", ARIREGISTER_SCALARS, ["financials"])


# BRREG and Companies House


def brreg_status(record: Column) -> Column:
    on = lambda k: F.coalesce(F.get_json_object(record, f"$.{k}") == "true", F.lit(False))
    return F.when(on("konkurs") | on("underAvvikling"), "dissolved").otherwise("active")


def brreg_companies(records: DataFrame) -> DataFrame:
    r = F.col("record")
    return records.select(
        json_text(r, "$.organisasjonsnummer").alias("organization_number"),
        json_text(r, "$.navn").alias("name"),
        brreg_status(r).alias("status"),
        null_if_empty(json_text(r, "$.hjemmeside")).alias("website"),
        F.lit("NO").alias("country_iso2"),
        r.alias("raw_payload"),
        payload_hash(r).alias("payload_hash"),
    ).filter("organization_number <> ''")


def request_facts(records: DataFrame) -> DataFrame:
    """What a domain search may use of a BRREG payload: address, activity, purpose and industry codes."""
    r = F.col("record")
    strings = lambda p: F.filter(fragments(F.get_json_object(r, p)), lambda v: trimmed(v) != "")
    code = lambda k: null_if_empty(F.concat_ws(" ", null_if_empty(json_text(r, f"$.{k}.kode")), null_if_empty(json_text(r, f"$.{k}.beskrivelse"))))
    codes = F.filter(F.array(*map(code, ["naeringskode1", "naeringskode2", "naeringskode3", "hjelpeenhetskode"])), lambda v: v.isNotNull())
    return records.select(
        json_text(r, "$.organisasjonsnummer").alias("organization_number"),
        first_non_empty(json_text(r, "$.navn"), json_text(r, "$.organisasjonsnummer")).alias("company_name"),
        strings("$.forretningsadresse.adresse").alias("address_lines"),
        null_if_empty(json_text(r, "$.forretningsadresse.poststed")).alias("city"),
        null_if_empty(json_text(r, "$.forretningsadresse.postnummer")).alias("postal_code"),
        strings("$.aktivitet").alias("business_activity"),
        strings("$.vedtektsfestetFormaal").alias("statutory_purpose"),
        codes.alias("industry_codes"),
        null_if_empty(first_non_empty(json_text(r, "$.hjemmeside"), json_text(r, "$.website"))).alias("website"),
    )


def sic_codes(rows: DataFrame, order: str, source_url: str, sha256: str | None, retrieved_at: str) -> DataFrame:
    """Classification codes of a CSV whose headers are found by name; the last row of a code counts."""
    named = {header_key(c): c for c in rows.columns}
    if not {"siccode", "description"} <= set(named):
        raise ValueError("the file lacks a code or description header")
    code, description = digits_padded(F.col(f"`{named['siccode']}`")), trimmed(F.col(f"`{named['description']}`"))
    kept = rows.select(code.alias("code"), description.alias("description"), F.col(order).alias("__order")).filter("code <> '' and description <> ''")
    last = first_per_key(kept, ["code"], [F.col("__order").desc()]).drop("__order")
    return last.select("code", "description", F.lit(source_url).alias("source_url"), F.lit(sha256).alias("source_sha256"), F.lit(retrieved_at).cast("timestamp").alias("retrieved_at"))
