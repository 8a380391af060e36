import gzip
import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import discovery, registries, translation
from ledgerloom.sources import files, paged, pages, rates
from ledgerloom.streaming import pull


def listed(spark, *rows):
    full = [(s, d, str(p), "snap", sha, fmt, "") for s, d, p, sha, fmt in rows]
    return spark.createDataFrame(full, files.FILES)


def zipped(name, data):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("empty/", "")
        z.writestr(name, data)
    return out.getvalue()


def test_json_elements_keep_their_text():
    assert list(files.json_elements('[{"b": 1.50,  "a":1}, 2 ]', ())) == ['{"b": 1.50,  "a":1}', "2"]
    assert list(files.json_elements(' {"meta":{"data":[9]}, "data":[ {"x":1} ,{"x":2}], "n":1}', ("data",))) == ['{"x":1}', '{"x":2}']
    assert list(files.json_elements('{"x":1}', ("data",))) == ['{"x":1}'] and list(files.json_elements("[]", ())) == [] and list(files.json_elements("  ", ())) == []

    wrapped = '{"page":{"n":2}, "_embedded" : {"other":[1], "enheter": [ {"x": 1}, {"x":2} ]}, "_links":{}}'
    assert list(files.json_elements(wrapped, files.WRAPPERS)) == ['{"x": 1}', '{"x":2}']
    assert list(files.json_elements('{"_embedded":{"enheter":[]}}', files.WRAPPERS)) == []


def test_gleif_shapes(spark, tmp_path):
    records = [
        {"id": "A1", "attributes": {"lei": "A1", "entity": {"legalName": {"name": "North Ltd"}, "status": "ACTIVE", "headquartersAddress": {"country": "GB"}}}},
        {"id": "", "attributes": {"entity": {"legalName": {"name": "No LEI"}}}},
        {"lei": "B2", "legalName": "Flat AS", "entityStatus": "ACTIVE", "headquartersCountry": "DK"},
        {"LEI": {"$": "C3"}, "Entity": {"LegalName": {"$": "Golden SA"}, "EntityStatus": {"$": "INACTIVE"}, "HeadquartersAddress": {"Country": {"$": "FR"}}}},
    ]
    data = json.dumps({"data": records}, indent=1).encode()
    (tmp_path / "a.json").write_bytes(zipped("x.json", data))  # zip bytes under a json label
    sha = hashlib.sha256((tmp_path / "a.json").read_bytes()).hexdigest().upper()
    got = registries.gleif_companies(files.json_records(spark, listed(spark, ("gleif", "full", tmp_path / "a.json", sha, "json")), registries.GLEIF_WRAPPERS))
    rows = {r["lei"]: (r["legal_name"], r["registration_status"], r["country"]) for r in got.collect()}
    assert rows == {"A1": ("North Ltd", "ACTIVE", "GB"), "B2": ("Flat AS", "ACTIVE", "DK"), "C3": ("Golden SA", "INACTIVE", "FR")}
    assert all(hashlib.sha256(r["raw_payload"].encode()).hexdigest() == r["payload_hash"] for r in got.collect())
    assert registries.gleif_mode("delta", "P7D") == "LastWeek"
    with pytest.raises(ValueError):
        registries.gleif_mode("delta", "P2D")


def test_checksum_mismatch(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    with pytest.raises(Exception, match="checksum"):
        files.json_records(spark, listed(spark, ("s", "d", tmp_path / "a.json", "00", "json"))).collect()


def test_cvr_fragments_and_files(spark, tmp_path):
    flat = [
        {"cvr_number": "11", "company_name": "Old", "roles": [{"n": "Ann"}], "owners": {"n": "X"}, "financials": None},
        {"cvr_number": 11, "company_name": "", "company_type": "ApS", "roles": [{"n": "Bo"}, None]},
    ]
    (tmp_path / "a.jsonl").write_bytes(gzip.compress("\n\n".join(map(json.dumps, flat)).encode()))
    parts = [
        {"Virksomhed": {"cvrNummer": 22, "virksomhedsstatus": "NORMAL", "virksomhedsform": {"kortBeskrivelse": "A/S"}}},
        {"_source": {"Navn": [{"CVR-Nummer": "22", "navn": "Nord A/S"}]}},
        {"Emailadresse": {"cvrNummer": 22, "kontaktoplysning": "a@nord.dk"}},
        {"Telefonnummer": {"cvrNummer": 22, "kontaktoplysning": "+451"}},
        {"Hjemmeside": {"cvrNummer": 22, "kontaktoplysning": "https://nord.dk"}},
    ]
    (tmp_path / "b.json").write_text(json.dumps(parts))
    source = listed(spark, ("cvr", "flat", tmp_path / "a.jsonl", "", "jsonl"), ("cvr", "parts", tmp_path / "b.json", "", "json"))
    got = {r["cvr_number"]: r for r in registries.cvr_companies(files.json_records(spark, source, ())).collect()}
    a, b = got["11"], got["22"]
    assert (a["company_name"], a["company_type"], a["roles"], a["owners"], a["financials"]) == ("Old", "ApS", ['{"n":"Ann"}', '{"n":"Bo"}'], ['{"n":"X"}'], [])
    assert json.loads(a["raw_payload"]) == {"cvr_number": "11", "company_name": "Old", "company_type": "ApS", "roles": [{"n": "Ann"}, {"n": "Bo"}], "owners": [{"n": "X"}]}
    assert (b["company_name"], b["registration_status"], b["company_type"], b["website"], b["email"], b["phone"], b["country_iso2"]) == (
        "Nord A/S", "NORMAL", "A/S", "https://nord.dk", "a@nord.dk", "+451", "DK",
    )


def test_ariregister(spark, tmp_path):
    header = "﻿nimi;ariregistri_kood;ettevotja_oiguslik_vorm;kmkr_nr;ettevotja_staatus;ettevotja_staatus_tekstina;teabesysteemi_link\n"
    (tmp_path / "a.zip").write_bytes(zipped("x.csv", (header + "Saar OÜ;100;Osaühing;;R;Registrisse kantud;https://r.ee/100\nRagged;200\n").encode()))
    (tmp_path / "b.json").write_text(json.dumps({"data": [{"registry_code": "100", "year": 2024, "profit": 5}, {"registry_code": 200, "email": "a@b.ee"}]}))
    basic = files.csv_records(spark, listed(spark, ("ari", "basic", tmp_path / "a.zip", "", "csv.zip")), ";", registries.ariregister_header)
    more = files.json_records(spark, listed(spark, ("ari", "fin", tmp_path / "b.json", "", "json"))).withColumn("file_ord", F.lit(1))
    got = {r["registry_code"]: r for r in registries.ariregister_companies(basic.unionByName(more)).collect()}
    assert (got["100"]["legal_name"], got["100"]["registration_status"], got["100"]["website"], got["100"]["vat_number"]) == ("Saar OÜ", "Registrisse kantud", None, None)
    assert [json.loads(x)["profit"] for x in got["100"]["financials"]] == [5]
    assert (got["200"]["legal_name"], got["200"]["email"]) == ("Ragged", "a@b.ee")
    assert "website" not in json.loads(got["100"]["raw_payload"])


def test_brreg_records_and_facts(spark):
    record = {"organisasjonsnummer": "9", "navn": "Fjord AS", "konkurs": True, "forretningsadresse": {"adresse": ["Gate 1"], "poststed": "OSLO"}, "aktivitet": ["Data", " "], "naeringskode1": {"kode": "62", "beskrivelse": "IT"}}
    df = spark.createDataFrame([(json.dumps(record),), ("{}",)], "record string")
    row = registries.brreg_companies(df).collect()
    assert [(r["organization_number"], r["status"]) for r in row] == [("9", "dissolved")]
    facts = registries.request_facts(df).first()
    assert (facts["company_name"], facts["address_lines"], facts["city"], facts["business_activity"], facts["industry_codes"]) == ("Fjord AS", ["Gate 1"], "OSLO", ["Data"], ["62 IT"])


def test_sic_codes(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes(b'SIC Code,Description\r\n62012,"Software, custom"\r\n1110,Cereals\r\n,none\r\n62012,Software\r\n')
    rows = spark.read.option("header", True).csv(str(tmp_path / "s.csv")).withColumn("n", F.monotonically_increasing_id())
    got = {r["code"]: r["description"] for r in registries.sic_codes(rows, "n", "u", None, "2026-01-01 00:00:00").collect()}
    assert got == {"62012": "Software", "01110": "Cereals"}
    with pytest.raises(ValueError):
        registries.sic_codes(rows.drop("Description"), "n", "u", None, "2026-01-01 00:00:00")


def test_rates(spark):
    xml = '<E><Cube><Cube time="2026-05-20"><Cube currency="USD" rate="1.09"/></Cube><Cube time="2026-05-17"><Cube currency="USD" rate="1.08"/><Cube currency="NOK" rate="11.4"/></Cube></Cube></E>'
    feed = rates.parse_feed(spark.createDataFrame([(xml,)], "xml string"))
    assert {r["currency"]: r["rate"] for r in rates.latest(feed).collect()} == {"USD": 1.09, "EUR": 1.0}
    on = rates.on_or_before(feed, "2026-05-19").collect()
    assert {r["currency"]: r["rate"] for r in on} == {"USD": 1.08, "NOK": 11.4, "EUR": 1.0} and str(on[0]["rate_date"]) == "2026-05-17"
    with pytest.raises(ValueError):
        rates.on_or_before(feed, "2026-05-01")


def test_cursor():
    p = paged.Paging(2, 1)
    page = [{"id": 1, "date": "2026-01-01"}, {"id": 2, "date": "2026-01-31"}]
    c = {"date": "2026-01-01", "page": 0, "done": False}
    assert paged.next_cursor(c, page, p)["page"] == 1
    assert paged.next_cursor({**c, "page": 1}, page, p) == {"date": "2026-01-31", "page": 0, "done": False}
    with pytest.raises(ValueError, match="2026-01-31"):  # no record of a day is passed over
        paged.next_cursor({"date": "2026-01-31", "page": 1, "done": False}, page, p)
    assert paged.next_cursor(c, page[:1], p)["done"]


def test_paged_stream_resumes(spark, tmp_path):
    def read_page(date, page):
        every = [{"id": f"{d:02d}-{i}", "name": "n", "date": f"2026-01-{d:02d}"} for d in range(1, 4) for i in range(3)]
        rest = [r for r in every if r["date"] >= date]
        return rest[page * 2 : page * 2 + 2]

    spark.dataSource.register(paged.paged_source("test_pages", read_page, paged.Paging(2, 50), "2026-01-01"))
    rows = spark.readStream.format("test_pages").load()
    sink = pull.SnapshotSink(str(tmp_path / "t"), spark.createDataFrame([], rows.schema), lambda t, r: t.unionByName(r).dropDuplicates(["native_id"]), "native_id", buckets=4)
    query = rows.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    last = query.lastProgress["batchId"] if query.lastProgress else 0
    query.stop()
    versions = sorted(int(p.name[2:]) for p in (tmp_path / "t").iterdir() if p.name.startswith("v="))
    assert sink.snapshot(spark, versions[-1]).count() == 9 and last >= versions[-1] - 1


def test_crawled_pages(spark):
    html = '<html><title>T</title><script>x("<p>")</script><body><p>Hello &amp; <b>you</b></p><a href="/in">i</a><a href=\'https://other.no/x\'>o</a><a href="/in">i</a></body></html>'
    r = pages.crawled(spark.createDataFrame([("https://www.fjord.no/a", html), ("https://x.no", "")], "url string, html string")).collect()
    assert r[0]["markdown"].startswith("Hello & you") and r[0]["links"] == ["https://other.no/x", "https://www.fjord.no/in"]
    assert r[1]["status"] == "failed" and r[1]["error"]["code"] == "crawl_failed"


BRREG = {
    "organisasjonsnummer": "9", "navn": "Fjord AS", "konkurs": False, "sisteInnsendteAarsregnskap": "2024", "organisasjonsform": {"kode": "AS", "beskrivelse": "Aksjeselskap"},
    "kapital": {"belop": 30000, "valuta": "NOK", "type": "Aksjekapital"}, "aktivitet": ["Programvare", ""], "forretningsadresse": {"adresse": ["Gate 1"], "poststed": "OSLO"},
}


def ready(spark, payload, source):
    rows = spark.createDataFrame([("r", json.dumps(payload))], "id string, payload string")
    terms = translation.extract_terms(rows, source)
    return rows, terms


def test_brreg_english(spark):
    rows, terms = ready(spark, BRREG, "brreg")
    assert [(t["category"], t["text"]) for t in terms.orderBy("place").collect()] == [("org_form", "Aksjeselskap"), ("capital_type", "Aksjekapital"), ("activity", "Programvare")]
    known = terms.select("category", "text", translation.mock_translation(F.col("text")).alias("translated_text"))
    base = {"source_rate": F.lit(11.5), "usd_rate": F.lit(1.09), "rate_source": F.lit("ecb"), "rate_date": F.lit("2026-05-20")}
    out = translation.brreg_english(rows.join(translation.translation_maps(terms, known), "id").withColumns(base)).first()
    en = json.loads(out["payload_en"])
    assert en["organization_form"] == {"code": "AS", "description": "[mock-en] Aksjeselskap"} and en["activities"] == ["[mock-en] Programvare"]
    assert en["capital"]["amount_usd_cents"] == 284348 and en["capital"]["type"] == "[mock-en] Aksjekapital" and en["is_bankrupt"] is False
    assert en["industry_code_1"] is None and en["postal_address"] is None and en["business_address"]["street"] == ["Gate 1"]
    failed = translation.brreg_english(rows.join(translation.translation_maps(terms, known.limit(1)), "id").withColumns(base)).first()
    assert failed["payload_en"] is None and failed["error"] == "missing translation"


def test_cvr_english(spark):
    payload = {"cvr_number": "1", "company_name": "Nord", "company_type": "ApS", "website": "w", "roles": [{"name": "Ann", "role": "direktør"}, 7], "addresses": [{"x": 1}]}
    rows, terms = ready(spark, payload, "cvr")
    known = terms.select("category", "text", translation.mock_translation(F.col("text")).alias("translated_text"))
    en = json.loads(translation.other_english(rows.join(translation.translation_maps(terms, known), "id"), "cvr").first()["payload_en"])
    assert en["identity"] == {"registration_number": "1", "name": "Nord"} and en["legal_form"] == "[mock-en] ApS" and en["contacts"] == {"website": "w"}
    assert en["roles"][0] == {"name": "Ann", "role": "[mock-en] direktør"} and en["owners"] == [] and en["addresses"] == [{"x": 1}] and "status" not in en


def test_translator_retries_and_results(spark):
    def shy(items):  # answers one item in each call
        return {items[0]["item_id"]: "en", "unknown": "x"}

    rows = spark.createDataFrame([("a", '{"company_type":"X","registration_status":"Y"}'), ("b", "{}"), ("c", '{"company_type":" x "}')], "id string, payload string")
    items = translation.service_items(translation.extract_terms(rows, "cvr"))
    distinct = items.dropDuplicates(["item_id"]).coalesce(1)
    for attempts, want in ((1, {"a": "failed", "b": "skipped"}), (2, {"a": "succeeded", "b": "skipped", "c": "succeeded"})):
        got = {r["id"]: r["status"] for r in translation.record_results(rows, items, translation.translate(distinct, shy, attempts)).collect()}
        assert want.items() <= got.items()


def test_answers():
    parse = translation.parse_answer
    assert parse('<think>x</think>```json\n{"translations":[{"id":"a:1","translation":"A"}]}\n```') == {"a:1": "A"}
    assert parse('{{"a":"b"}}') == {"a": "b"} and parse('{items: [{id: "k", text_en: "v"}]}') == {"k": "v"} and parse('[{"item_id":"k","text":"v"}]') == {"k": "v"}
    with pytest.raises(ValueError):
        parse("no json")


def test_validation(spark):
    rows = spark.createDataFrame([("Sluttet", "closed", ["closed"], ["open"]), ("x", "X", [], []), ("x", "", [], []), ("x", "open", ["closed"], ["open"])], "text string, translated string, expected_any array<string>, forbidden_any array<string>")
    assert [r["problems"] for r in translation.validate_translations(rows).collect()] == [[], ["copied_source"], ["missing"], ["expected_missing", "forbidden_present"]]


def test_discovery_flow(spark):
    links = spark.createDataFrame([(1, 0, "https://duckduckgo.com/l/?uddg=https%3A%2F%2Ffjord.no%2F"), (1, 1, "https://www.proff.no/fjord"), (1, 2, "https://fjord.no/om"), (1, 3, "https://yandex.com/x")], "company_id int, pos int, link string")
    got = discovery.page_candidates(links).orderBy("pos").collect()
    assert [(r["domain"], r["excluded"]) for r in got] == [("fjord.no", None), ("proff.no", "directory_or_registry")]
    crawls = discovery.to_check(discovery.page_candidates(links)).select("company_id", "pos", "url", "domain", F.lit("succeeded").alias("crawl_status"), F.lit('{"decision":"accepted","score":90}').alias("answer"))
    out = discovery.decide(discovery.site_checks(crawls), spark.createDataFrame([(2,)], "company_id int")).orderBy("company_id").collect()
    assert (out[0]["status"], out[0]["best_domain"], out[0]["primary_site"]["url"]) == ("succeeded", "fjord.no", "https://fjord.no/") and out[1]["status"] == "failed"


def test_external_call_isolates_failures(spark):
    def call(row):
        if row["x"] == 2:
            raise OSError("down")
        return {"y": row["x"] * 10}

    out = discovery.external_call(spark.range(4).select(F.col("id").alias("x")), call, "x long, y long, error string").orderBy("x").collect()
    assert [r["y"] for r in out] == [0, 10, None, 30] and "down" in out[2]["error"]


def test_safe_name():
    assert files.safe_name("gleif", "2026-01-01") == "gleif_2026-01-01"
    for bad in ("../x", "a/b", "..", ""):
        with pytest.raises(ValueError):
            files.safe_name("a", bad)
