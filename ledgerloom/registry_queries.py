"""Registered queries of the registries, discovery and translation as whole runs. Records are JSON made of table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import domains, text
from ledgerloom.operators import upsert
from ledgerloom.operators.merge import unique_terms
from ledgerloom.plans import artifacts, batches, discovery, pulls, quality, registries, translation
from ledgerloom.registration import joined, registered
from ledgerloom.session import shared_path
from ledgerloom.sources import files, rates
from ledgerloom.sources.tables import table


def _text(*parts: Column | str) -> Column:
    """Columns and literals as one string."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _records(rows: DataFrame, number: str, record: Column) -> DataFrame:
    return rows.select(F.lit(0).alias("file_ord"), F.col(number).alias("record_no"), record.alias("record"))


# Registries


@registered("""
WITH r AS (SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY')
    THEN '{"id":"' || c_custkey || '","attributes":{"entity":{"legalName":{"name":" ' || c_name || ' "},"status":"' || c_mktsegment || '","headquartersAddress":{"country":"N' || c_nationkey || '"}}}}'
  WHEN c_mktsegment = 'FURNITURE' THEN '{"lei":"' || c_custkey || '","legalName":"' || c_name || '","entityStatus":"","headquartersCountry":"N' || c_nationkey || '"}'
  ELSE '{"LEI":{"$":"' || c_custkey || '"},"Entity":{"LegalName":{"$":"' || c_name || '"},"EntityStatus":{"$":"' || c_mktsegment || '"},"HeadquartersAddress":{"Country":{"$":"N' || c_nationkey || '"}}}}' END AS record,
  c_name, c_mktsegment, c_nationkey FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS lei, c_name AS legal_name, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS registration_status, 'N' || c_nationkey AS country, sha256(record) AS payload_hash FROM r
""")
def gleif_companies(spark: SparkSession, sf: str) -> DataFrame:
    """Records in the three published shapes; the hash is of each record's own text."""
    c, key, name, seg, land = table(spark, sf, "customer"), F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey")
    api = _text('{"id":"', key, '","attributes":{"entity":{"legalName":{"name":" ', name, ' "},"status":"', seg, '","headquartersAddress":{"country":"N', land, '"}}}}')
    flat = _text('{"lei":"', key, '","legalName":"', name, '","entityStatus":"","headquartersCountry":"N', land, '"}')
    golden = _text('{"LEI":{"$":"', key, '"},"Entity":{"LegalName":{"$":"', name, '"},"EntityStatus":{"$":"', seg, '"},"HeadquartersAddress":{"Country":{"$":"N', land, '"}}}}')
    record = F.when(seg.isin("BUILDING", "MACHINERY"), api).when(seg == "FURNITURE", flat).otherwise(golden)
    return registries.gleif_companies(_records(c, "c_custkey", record)).drop("raw_payload")


@registered("""
SELECT CAST(o_custkey AS VARCHAR) AS cvr_number, arg_max(o_orderpriority, o_orderkey) FILTER (o_orderstatus <> 'P') AS company_name,
  arg_max(o_orderstatus, o_orderkey) FILTER (o_orderstatus = 'O') AS registration_status, arg_max('T' || o_orderkey, o_orderkey) FILTER (o_orderstatus = 'F') AS phone,
  coalesce(string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY o_orderkey) FILTER (o_orderstatus = 'F'), '') AS owners
FROM orders GROUP BY 1
""")
def cvr_companies(spark: SparkSession, sf: str) -> DataFrame:
    """Flat and distributed fragments of companies: last non-empty members, arrays in order."""
    o, key, at = table(spark, sf, "orders"), F.col("o_custkey"), F.col("o_orderkey")
    flat = _text('{"cvr_number":"', key, '","company_name":"', F.col("o_orderpriority"), '","phone":"T', at, '","owners":[{"id":"', at, '"},null]}')
    whole = _text('{"Vrvirksomhed":{"CVR-nummer":"', key, '","Navn":"', F.col("o_orderpriority"), '","Virksomheds-Status":"', F.col("o_orderstatus"), '"}}')
    bare = _text('{"cvr_number":"', key, '","company_name":"","owners":[]}')
    record = F.when(F.col("o_orderstatus") == "F", flat).when(F.col("o_orderstatus") == "O", whole).otherwise(bare)
    out = registries.cvr_companies(_records(o, "o_orderkey", record))
    owners = F.transform("owners", lambda x: F.get_json_object(x, "$.id"))
    return out.select("cvr_number", "company_name", "registration_status", "phone", joined(owners).alias("owners"))


def _brreg(later: bool) -> Column:
    """A unit's record; in the later snapshot some have another name."""
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.concat("c_name", F.lit(" AS"))).otherwise(F.col("c_name")) if later else F.col("c_name")
    return _text('{"organisasjonsnummer":"', F.col("c_custkey"), '","navn":"', name, '","konkurs":', F.when(F.col("c_acctbal") < 0, "true").otherwise("false"), "}")


def _brreg_sql(name: str) -> str:
    bankrupt = "CASE WHEN c_acctbal < 0 THEN 'true' ELSE 'false' END"
    return f"""'{{"organisasjonsnummer":"' || c_custkey || '","navn":"' || {name} || '","konkurs":' || {bankrupt} || '}}'"""


_RENAMED = "CASE c_mktsegment WHEN 'BUILDING' THEN c_name || ' AS' ELSE c_name END"
_PULLED = (
    f"WITH a AS (SELECT CAST(c_custkey AS VARCHAR) AS native_id, sha256({_brreg_sql('c_name')}) AS h FROM customer), "
    f"b AS (SELECT CAST(c_custkey AS VARCHAR) AS native_id, sha256({_brreg_sql(_RENAMED)}) AS h FROM customer WHERE c_acctbal > 1000) "
)
_FIRST, _SECOND = "2026-01-01 00:00:00", "2026-02-01 00:00:00"


def _pulled(spark: SparkSession, sf: str, force: bool = True) -> pulls.Pulled:
    """Two snapshots of a registry, one after the other."""
    c = table(spark, sf, "customer")
    runs = spark.createDataFrame([(f"e{i}", "running", None, None, None) for i in (1, 2, 3)], pulls.EXECUTIONS)
    before = pulls.Pulled(spark.createDataFrame([], pulls.RAW), runs, spark.createDataFrame([], pulls.CHECKPOINTS))
    after = pulls.import_companies("brreg", _records(c, "c_custkey", _brreg(False)), before, "r1", "e1", "bulk:20260101", 1, F.lit(_FIRST))
    later = _records(c.filter("c_acctbal > 1000"), "c_custkey", _brreg(True))
    return pulls.import_companies("brreg", later, after, "r2", "e2", "bulk:20260201", 1, F.lit(_SECOND), force)


@registered(
    _PULLED + f"SELECT coalesce(a.native_id, b.native_id) AS native_id, coalesce(a.h, b.h) AS payload_hash, CASE WHEN a.h IS NULL THEN TIMESTAMP '{_SECOND}' ELSE TIMESTAMP '{_FIRST}' END AS first_seen_at, "
    f"CASE WHEN b.h IS NULL THEN TIMESTAMP '{_FIRST}' ELSE TIMESTAMP '{_SECOND}' END AS last_seen_at, CASE WHEN b.h IS NULL THEN 'r1' ELSE 'r2' END AS run_id FROM a FULL JOIN b ON a.native_id = b.native_id AND a.h = b.h"
)
def pulled_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Raw inputs after two snapshots: changed payloads are new rows, unchanged ones were seen again."""
    return _pulled(spark, sf).raw.drop("raw_payload")


@registered(_PULLED + f"SELECT native_id, h AS payload_hash, TIMESTAMP '{_FIRST}' AS last_seen_at, 'r1' AS run_id FROM a")
def pulled_known(spark: SparkSession, sf: str) -> DataFrame:
    """The same without force: companies that are known stay as they are."""
    return _pulled(spark, sf, force=False).raw.select("native_id", "payload_hash", "last_seen_at", "run_id")


@registered(f"""
WITH a AS (SELECT CAST(c_custkey AS VARCHAR) AS id, sha256({_brreg_sql('c_name')}) AS h FROM customer), b AS (SELECT CAST(c_custkey AS VARCHAR) AS id, sha256({_brreg_sql(_RENAMED)}) AS h FROM customer WHERE c_custkey % 3 <> 0),
k AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT b.* FROM b JOIN a ON a.id = b.id WHERE NOT EXISTS (SELECT 1 FROM a x JOIN k ON k.id = x.id WHERE x.id = b.id AND x.h = b.h))
SELECT true AS force, (SELECT count(*) FROM b) AS written, 0 AS skipped, (SELECT count(*) FROM n) AS new_payloads
UNION ALL SELECT false, (SELECT count(*) FROM b WHERE id NOT IN (SELECT id FROM k)), (SELECT count(*) FROM b WHERE id IN (SELECT id FROM k)), (SELECT count(*) FROM b WHERE id NOT IN (SELECT id FROM k))
""")
def written_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What a registry writer counts while it writes: written, skipped and new payloads, with and without force."""
    c = table(spark, sf, "customer")
    companies = lambda rows, later: registries.brreg_companies(_records(rows, "c_custkey", _brreg(later)))
    inputs = lambda rows, later: pulls.raw_inputs(companies(rows, later), "organization_number", F.lit(_SECOND if later else _FIRST), "r")
    known, rows = inputs(c.filter("c_custkey % 2 = 0"), False), inputs(c.filter("c_custkey % 3 <> 0"), True)
    counts = [(force, *upsert.write_inputs(known, rows, "native_id", force)[1].values()) for force in (True, False)]
    return spark.createDataFrame(counts, "force boolean, written long, skipped long, new_payloads long")


@registered(f"""
SELECT CAST(c_custkey AS VARCHAR) AS native_id, sha256({_brreg_sql('c_name')}) AS payload_hash, 'r1' AS run_id, (SELECT count(*) FROM customer) AS written FROM customer
""")
def pulled_files(spark: SparkSession, sf: str) -> DataFrame:
    """A registry's snapshot out of JSON-lines files, each cut by several tasks."""
    folder = shared_path(spark, "snapshot-files")
    table(spark, sf, "customer").select(_brreg(False).alias("value")).repartition(3).write.text(folder)
    paths = spark.read.text(folder).inputFiles()
    listed = spark.createDataFrame([("brreg", "units", p, "20260101", "", "jsonl", "") for p in paths], files.FILES)
    runs = spark.createDataFrame([("e1", "running", None, None, None)], pulls.EXECUTIONS)
    before = pulls.Pulled(spark.createDataFrame([], pulls.RAW), runs, spark.createDataFrame([], pulls.CHECKPOINTS))
    after = pulls.pull_files(spark, "brreg", listed, before, "r1", "e1", F.lit(_FIRST), snapshot="20260101", split_from=1 << 14)
    return after.raw.select("native_id", "payload_hash", "run_id").crossJoin(F.broadcast(after.executions.select(F.col("records_written").alias("written"))))


@registered(f"""
SELECT 'execution' AS kind, 'e1' AS id, 'completed' AS status, count(*) AS records, TIMESTAMP '{_FIRST}' AS at FROM customer
UNION ALL SELECT 'execution', 'e2', 'completed', count(*), TIMESTAMP '{_SECOND}' FROM customer WHERE c_acctbal > 1000
UNION ALL SELECT 'execution', 'e3', 'running', NULL, NULL
UNION ALL SELECT 'checkpoint', 'brreg', 'bulk:20260201', NULL, TIMESTAMP '{_SECOND}'
""")
def run_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Execution and checkpoint rows after both runs."""
    after = _pulled(spark, sf)
    runs = after.executions.select(F.lit("execution").alias("kind"), "id", "status", F.col("records_written").alias("records"), F.col("completed_at").alias("at"))
    return runs.union(after.checkpoints.select(F.lit("checkpoint"), "source_name", "cursor", F.lit(None).cast("long"), "last_completed_at"))


@registered("""
SELECT CAST(p_partkey AS VARCHAR) AS organization_number, p_name AS company_name, p_brand || '|' || p_type AS address_lines, p_brand AS city,
  CASE WHEN p_size > 25 THEN p_type ELSE '' END AS business_activity, CASE WHEN p_size > 25 THEN p_size || ' ' || p_type ELSE CAST(p_size AS VARCHAR) END || '|' || p_type AS industry_codes,
  CASE WHEN p_size > 10 THEN 'w' || p_size || '.no' END AS website FROM part
""")
def request_facts(spark: SparkSession, sf: str) -> DataFrame:
    """What a search may use of a register's payload: lines, city, activities, codes and website."""
    p, size, kind = table(spark, sf, "part"), F.col("p_size").cast("string"), F.col("p_type")
    big = F.col("p_size") > 25
    record = F.to_json(F.struct(
        F.col("p_partkey").cast("string").alias("organisasjonsnummer"), F.col("p_name").alias("navn"),
        F.struct(F.array("p_brand", F.lit(" "), "p_type").alias("adresse"), F.col("p_brand").alias("poststed")).alias("forretningsadresse"),
        F.when(big, F.array(kind)).alias("aktivitet"), F.struct(size.alias("kode"), F.when(big, kind).alias("beskrivelse")).alias("naeringskode1"),
        F.struct(kind.alias("beskrivelse")).alias("naeringskode3"), F.when(F.col("p_size") > 10, F.concat(F.lit("w"), size, F.lit(".no"))).alias("website"),
    ))
    facts = registries.request_facts(_records(p, "p_partkey", record))
    return facts.select("organization_number", "company_name", joined(F.col("address_lines")).alias("address_lines"), "city", joined(F.col("business_activity")).alias("business_activity"), joined(F.col("industry_codes")).alias("industry_codes"), "website")


@registered("""
SELECT lpad(CAST(p_size AS VARCHAR), 5, '0') AS code, arg_max(p_name, p_partkey) AS description FROM part GROUP BY 1
""")
def sic_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Classification codes: padded, the last description of a code counts."""
    p = table(spark, sf, "part").select(F.concat(F.lit(" "), F.col("p_size").cast("string")).alias("SIC Code"), F.col("p_name").alias("Description"), "p_partkey")
    return registries.sic_codes(p, "p_partkey", "u", None, "2026-01-01 00:00:00").select("code", "description")


@registered("""
WITH d AS (SELECT CAST(ts AS DATE) AS rate_date, event_type AS currency, CAST(count(*) AS DOUBLE) AS rate FROM events WHERE event_type <> 'view' GROUP BY 1, 2)
SELECT rate_date, currency, rate FROM d UNION ALL SELECT DISTINCT CAST(ts AS DATE), 'EUR', CAST(1 AS DOUBLE) FROM events
""")
def parsed_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Exchange rates out of a feed's XML, one feed a day; the euro is added."""
    e = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    cube = F.when(F.col("event_type") != "view", F.concat(F.lit('<Cube currency="'), F.col("event_type"), F.lit('" rate="'), F.col("n").cast("string"), F.lit('"/>')))
    days = e.groupBy("day").agg(F.array_join(F.collect_list(cube), "").alias("cubes"))
    xml = F.concat(F.lit('<E><Cube><Cube time="'), F.col("day").cast("string"), F.lit('">'), F.col("cubes"), F.lit("</Cube></Cube></E>"))
    return rates.parse_feed(days.select(xml.alias("xml"))).select("rate_date", "currency", "rate")


# Actions and batches


@registered("""
WITH l AS (SELECT o_custkey, o_orderstatus, CAST(max(o_orderkey) AS VARCHAR) AS action_id FROM orders GROUP BY 1, 2)
SELECT action_id, 'succeeded' AS status, 'done' AS message FROM l WHERE o_orderstatus = 'F' UNION ALL SELECT 'a0', 'queued', 'made'
""")
def latest_action_events(spark: SparkSession, sf: str) -> DataFrame:
    """An event for the latest action of each record, among those made for its payload."""
    o = table(spark, sf, "orders")
    actions = o.select(F.col("o_orderkey").cast("string").alias("action_id"), F.col("o_custkey").alias("raw_input_id"), F.col("o_orderstatus").alias("payload_hash"), F.lit("translate").alias("action_type"), F.col("o_orderkey").alias("attempt"))
    done = o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("raw_input_id"), F.lit("F").alias("payload_hash")).distinct()
    events = spark.createDataFrame([("a0", "queued", "made")], "action_id string, status string, message string")
    return pulls.append_to_latest(events, actions, done, "succeeded", "done")


@registered("""
SELECT o_orderpriority AS source, CAST(sum(l_linenumber) AS BIGINT) AS claimed, CAST(count(*) FILTER (l_returnflag = 'R') AS BIGINT) AS translated, CAST(count(*) FILTER (l_returnflag = 'A') AS BIGINT) AS failed,
  count(*) AS records_written, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS pages_fetched FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
""")
def run_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Running sums of a workflow's batches."""
    flag = lambda x: F.when(F.col("l_returnflag") == x, 1).otherwise(0)
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderpriority").alias("source"), F.col("l_linenumber").alias("claimed"), flag("R").alias("translated"), flag("A").alias("failed"), F.lit(1).alias("records_written"), F.col("l_quantity").cast("long").alias("pages_fetched")
    )
    return pulls.run_totals(rows, ["source"])


#: Batches that a table of raw inputs is worked off in.
_BATCHES = 3


def _raw_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Work of which a part is done, and of which some has an amount that cannot be converted."""
    c = table(spark, sf, "customer")
    payload = F.to_json(F.struct(F.struct(F.col("c_mktsegment").alias("beskrivelse")).alias("organisasjonsform"), F.struct(F.col("c_acctbal").alias("belop"), F.lit("NOK").alias("valuta")).alias("kapital")))
    none = lambda kind: F.lit(None).cast(kind)
    return c.select(
        F.col("c_custkey").alias("id"), payload.alias("payload"), F.when(F.col("c_acctbal") > 9000, "translated").otherwise("pending").alias("status"), F.col("c_custkey").alias("created_at"), F.lit(0).alias("attempts"),
        none("string").alias("error"), none("string").alias("lease_by"), none("timestamp_ntz").alias("lease_until"), none("string").alias("payload_en"), none("timestamp_ntz").alias("translated_at"),
    )


@registered("""
SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'failed' ELSE 'translated' END AS status, CASE WHEN c_acctbal > 9000 THEN 0 ELSE 1 END AS attempts,
  CASE WHEN c_acctbal < 0 THEN 'negative amount not supported' END AS error, CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN CASE WHEN c_mktsegment = 'BUILDING' THEN 'known' ELSE '[mock-en] ' || c_mktsegment END END AS form,
  CASE WHEN c_acctbal > 9000 THEN NULL WHEN c_acctbal < 0 THEN 'failed' ELSE 'succeeded' END AS event
FROM customer
""")
def translated_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The loop over batches until nothing is left: rows, leases, errors, cache hits and misses, and one event a row."""
    raw = _raw_inputs(spark, sf)
    known = spark.createDataFrame([("org_form", "BUILDING", "known")], "category string, text string, translated_text string")
    fixed = {"source_lang": "no", "target_lang": "en", "prompt_version": "v1", "model": "m"}
    cache = known.select("category", text.term_hash(F.col("text")).alias("original_hash"), *[F.lit(v).alias(k) for k, v in fixed.items()], F.col("text").alias("original_text"), "translated_text")
    events = spark.createDataFrame([], "action_id string, status string, message string")
    size = -(-raw.count() // _BATCHES)
    now = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    given = {"source_rate": 11.5, "usd_rate": 1.09, "rate_source": "ecb", "rate_date": "2026-05-20"}
    after, _ = batches.translate_all(batches.Tables(raw, cache, events), batches.Settings("brreg", "w1", size, model="m"), translation.mock_translator, now, given)
    event = after.events.select(F.col("action_id").cast("long").alias("id"), F.col("status").alias("event"))
    return after.raw.join(event, "id", "left").select("id", "status", "attempts", "error", F.get_json_object("payload_en", "$.organization_form.description").alias("form"), "event")


@registered("""
WITH t AS (SELECT p_partkey, p_type AS text, CASE WHEN p_size < 10 THEN ' ' WHEN p_size < 20 THEN lower(p_type) ELSE 'en ' || p_brand || ' ' || p_name END AS said FROM part),
v AS (SELECT *, trim(said) = '' AS missing, lower(said) = lower(text) AS copied, NOT contains(lower(said), 'brand#1') AND NOT contains(lower(said), 'brand#2') AS lacks, contains(lower(said), 'brand#11') AS bad FROM t)
SELECT p_partkey, concat_ws('|', CASE WHEN missing THEN 'missing' END, CASE WHEN NOT missing AND copied THEN 'copied_source' END, CASE WHEN NOT missing AND lacks THEN 'expected_missing' END, CASE WHEN NOT missing AND bad THEN 'forbidden_present' END) AS problems FROM v
""")
def translation_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of translated items against expected and forbidden words."""
    p, size = table(spark, sf, "part"), F.col("p_size")
    said = F.when(size < 10, F.lit(" ")).when(size < 20, F.lower("p_type")).otherwise(F.concat(F.lit("en "), "p_brand", F.lit(" "), "p_name"))
    words = lambda *x: F.array(*map(F.lit, x))
    rows = p.select("p_partkey", F.col("p_type").alias("text"), said.alias("translated"), words("brand#1", "Brand#2").alias("expected_any"), words("Brand#11").alias("forbidden_any"))
    return translation.validate_translations(rows).select("p_partkey", joined(F.col("problems")).alias("problems"))


@registered("""
WITH i AS (SELECT role AS category, conv_id || '/' || role AS c, turn, text, length(text) AS n FROM conversations),
t AS (SELECT *, lower(trim(CASE WHEN n % 5 = 0 THEN ' ' WHEN n % 7 = 0 THEN text ELSE 'said: ' || left(text, 60) END)) AS said FROM i),
w AS (SELECT category, c, n, CASE WHEN said = '' THEN 1 ELSE CAST(said = lower(trim(text)) AS INT) + CAST(NOT contains(said, 'said') AND NOT contains(said, 'and') AS INT) + CAST(contains(said, 'un') AS INT) + CAST(contains(said, ' es') AS INT) END AS wrong FROM t),
k AS (SELECT category, c, count(*) AS item_count, sum(wrong) + CAST(max(n) % 11 = 0 AS INT) AS errors, CAST(max(n) AS DOUBLE) / 8 AS seconds FROM w GROUP BY 1, 2)
SELECT category, c AS "case", CASE WHEN grouping(category) = 1 THEN 'run' WHEN grouping(c) = 1 THEN 'category' ELSE 'case' END AS level, count(*) AS case_count, CAST(sum(item_count) AS BIGINT) AS item_count,
  CAST(sum(errors) AS BIGINT) AS error_count, count(*) FILTER (errors > 0) AS failed_cases, bool_and(errors = 0) AS ok, sum(seconds) AS seconds, quantile_cont(seconds, 0.5) AS median_seconds, quantile_cont(seconds, 0.95) AS p95_seconds
FROM k GROUP BY ROLLUP (category, c)
""")
def quality_run(spark: SparkSession, sf: str) -> DataFrame:
    """A translator's run over cases of turns: errors of items, cases, categories and the run, with percentiles of the cases' seconds."""
    c, n = table(spark, sf, "conversations"), F.char_length("text")
    case = F.concat(F.col("conv_id").cast("string"), F.lit("/"), "role").alias("case")
    said = F.when(n % 5 == 0, F.lit(" ")).when(n % 7 == 0, F.col("text")).otherwise(F.concat(F.lit("said: "), F.left("text", F.lit(60))))
    words = lambda *x: F.array(*map(F.lit, x))
    items = c.select(F.col("role").alias("category"), case, F.col("turn").alias("item"), "text", said.alias("translated"), words("said", "AND").alias("expected_any"), words("Un", " es").alias("forbidden_any"))
    calls = c.groupBy(case).agg((F.max(n) / 8).alias("seconds"), F.when(F.max(n) % 11 == 0, F.lit("failed")).alias("error"))
    return quality.run_summary(items, calls)


@registered("""
WITH p AS (SELECT page_id, length(html) % 4 AS kind FROM pages)
SELECT CAST(page_id AS VARCHAR) AS request, CASE WHEN kind < 3 THEN item END AS item, CASE WHEN kind < 3 THEN item || ' {of} "' || page_id || '"' END AS translation,
  CASE WHEN kind = 3 THEN 'missing translations for ids: b' END AS error
FROM p, (VALUES ('a'), ('b')) v(item) WHERE kind < 3 OR item = 'a'
""")
def model_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Items out of answers in several shapes: fenced lists, objects within prose, nested JSON, and one that lacks an id."""
    p, i = table(spark, sf, "pages"), F.col("page_id").cast("string")
    said = lambda item: F.concat(F.lit(f'{item} {{of}} \\"'), i, F.lit('\\"'))
    listed = F.concat(F.lit('[{"id": "a", "translation": "'), said("a"), F.lit('"}, {"id": "b", "text": " '), said("b"), F.lit(' "},]'))
    mapped = F.concat(F.lit('{a: "'), said("a"), F.lit('", "b": "'), said("b"), F.lit('", "c": "x"}'))
    kind = F.char_length("html") % 4
    content = (
        F.when(kind == 0, F.concat(F.lit("<think>{</think>Here:\n```json\n"), listed, F.lit("\n```")))
        .when(kind == 1, F.concat(F.lit('The "answer" is } '), mapped, F.lit(" as {asked}.")))
        .when(kind == 2, F.to_json(F.struct(listed.alias("translations_json"))))
        .otherwise(F.concat(F.lit('{"items": [{"id": "a", "translated_text": "'), said("a"), F.lit('"}, {"id": "b", "text": " "}]}')))
    )
    answers = p.select(i.alias("request"), F.array(F.lit("a"), F.lit("b")).alias("expected_ids"), content.alias("content"))
    return translation.read_answers(answers)


# Discovery


@registered("""
WITH l AS (SELECT l_orderkey AS native_id, l_linenumber - 1 AS pos, 's' || (l_suppkey % 5) || '.no' AS domain FROM lineitem),
f AS (SELECT native_id, domain, min(pos) AS pos FROM l GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY native_id ORDER BY pos) AS n FROM f)
SELECT native_id, domain, 'duckduckgo' AS signal, 70 AS confidence, pos FROM r WHERE n <= 5
""")
def search_signal(spark: SparkSession, sf: str) -> DataFrame:
    """Domains of a search page's first links, each once, the search engine's own left out."""
    i = table(spark, sf, "lineitem")
    links = i.select(F.col("l_orderkey").alias("native_id"), (F.col("l_linenumber") - 1).alias("pos"), F.concat(F.lit("https://S"), (F.col("l_suppkey") % 5).cast("string"), F.lit(".no:443/x?y")).alias("href"))
    own = i.select(F.col("l_orderkey").alias("native_id"), F.lit(0).alias("pos"), F.lit("https://html.duckduckgo.com/l/?x").alias("href")).distinct()
    return discovery.link_signal(links.unionByName(own))


@registered("""
WITH u AS (SELECT *, CAST(l_linenumber AS BIGINT) * 100000000 + l_partkey * 1000 + l_suppkey AS pos FROM lineitem),
l AS (SELECT l_orderkey AS company_id, pos, CASE WHEN l_returnflag = 'N' THEN 's' || (l_suppkey % 4) || '.no' ELSE 'proff.no' END AS domain FROM u WHERE l_linenumber < 6 OR l_returnflag <> 'A'),
r AS (SELECT *, row_number() OVER (PARTITION BY company_id, domain ORDER BY pos) AS n FROM l), k AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY pos) AS m FROM r WHERE n = 1),
c AS (SELECT * FROM k WHERE m <= 5), s AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY pos) AS t FROM c)
SELECT company_id, domain, 'https://' || domain || '/p' || pos AS url, CASE WHEN domain = 'proff.no' THEN 'directory_or_registry' END AS excluded, pos FROM s WHERE t <= 3
""")
def checked_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates of a result page that are worth a site check: redirects unwrapped, search engines dropped, in order."""
    i, line = table(spark, sf, "lineitem"), F.col("l_linenumber")
    pos = line.cast("long") * 100_000_000 + F.col("l_partkey") * 1000 + F.col("l_suppkey")  # lines repeat their numbers
    domain = F.when(F.col("l_returnflag") == "N", F.concat(F.lit("s"), (F.col("l_suppkey") % 4).cast("string"), F.lit(".no"))).otherwise("proff.no")
    url = F.concat(F.lit("https://"), domain, F.lit("/p"), pos.cast("string"))
    wrapped = F.concat(F.lit("https://duckduckgo.com/l/?uddg="), F.url_encode(url))
    kept = (line < 6) | (F.col("l_returnflag") != "A")
    link = F.when(~kept, F.lit("https://yandex.com/search?text=a")).when(line > 2, wrapped).otherwise(url)
    links = i.select(F.col("l_orderkey").alias("company_id"), pos.alias("pos"), link.alias("link"))
    return discovery.to_check(discovery.page_candidates(links)).select("company_id", "domain", "url", "excluded", "pos")


@registered("""
SELECT page_id, CASE WHEN page_id % 4 < 3 THEN lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) END AS safe,
  'https://duckduckgo.com/html/?q=' || page_id || '%20a%26b%2A' AS page,
  CASE page_id % 4 WHEN 1 THEN 'http://t.no/' || page_id WHEN 2 THEN NULL ELSE url END AS target FROM pages
""")
def search_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """Safe hosts, result page addresses, and the targets of their links."""
    i, u = F.col("page_id"), F.col("url")
    host = F.regexp_extract("url", "^https?://([^/?#:]*)", 1)
    given = F.when(i % 4 == 0, u).when(i % 4 == 1, F.concat(F.lit("*."), host)).when(i % 4 == 2, F.concat(F.lit("//me@"), host, F.lit(".:8/x"))).otherwise(F.concat(F.lit("10.0.0."), (i % 256).cast("string")))
    link = F.when(i % 4 == 1, F.concat(F.lit("/l/?uddg=http%3A%2F%2Ft.no%2F"), i.cast("string"))).when(i % 4 == 2, F.lit("//duckduckgo.com/y.js?ad")).otherwise(u)
    return table(spark, sf, "pages").select(
        "page_id", domains.safe_domain(given).alias("safe"), domains.search_page("duckduckgo", F.concat(i.cast("string"), F.lit(" a&b*"))).alias("page"), domains.result_link(link).alias("target")
    )


@registered("""
WITH c AS (SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 's' || s_suppkey || '.no' WHEN s_acctbal > 0 THEN 'no site' ELSE '' END AS website FROM supplier)
SELECT s_suppkey, CASE WHEN contains(website, '.') THEN 'website' ELSE 'search' END AS way, CASE WHEN contains(website, '.') THEN 'https://' || website END AS url FROM c
""")
def website_or_search(spark: SparkSession, sf: str) -> DataFrame:
    """Companies whose own website is checked at once, and those that are searched for."""
    bal = F.col("s_acctbal")
    site = F.when(bal > 5000, F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit(".no"))).when(bal > 0, "no site").otherwise("")
    own, search = discovery.website_or_search(table(spark, sf, "supplier").select("s_suppkey", site.alias("website")))
    return own.select("s_suppkey", F.lit("website").alias("way"), "url").union(search.select("s_suppkey", F.lit("search"), F.lit(None).cast("string")))


_CRAWLED = """
WITH u AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#:]*)', 1) AS domain, length(html) AS n FROM pages),
c AS (SELECT domain, url, arg_max(page_id, page_id) AS page_id, max(page_id) FILTER (n % 3 = 0) AS again FROM u GROUP BY 1, 2)
"""


def _artifacts(spark: SparkSession, sf: str) -> tuple[DataFrame, artifacts.Bucketed]:
    """Result pages' links, and a bucketed table of crawls after a second crawl of some."""
    p = table(spark, sf, "pages").select("page_id", "url", F.regexp_extract("url", "^https?://([^/?#:]*)", 1).alias("domain"), (F.char_length("html") % 3).alias("n"))
    entry = lambda k: F.create_map(F.lit(k), F.col("page_id").cast("string")).alias("metadata")
    latest = [F.desc("page_id")]
    first = upsert.last_by_key(p.select("domain", "url", "page_id", F.lit("crawled").alias("status"), entry("first")), ["domain", "url"], latest)
    crawls = artifacts.write_bucketed(first, "crawls", ["domain", "url"])
    again = p.filter("n = 0").select("domain", "url", "page_id", F.lit("again").alias("status"), entry("again"))
    return p.select("page_id", "domain", "url"), artifacts.upsert_artifacts(crawls, again, latest, "crawls")


@registered(_CRAWLED + "SELECT domain, url, CASE WHEN again IS NULL THEN 'crawled' ELSE 'again' END AS status, CAST(page_id AS VARCHAR) AS first, CAST(again AS VARCHAR) AS again FROM c")
def crawl_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """Crawl artifacts after a second crawl: one row a domain and address, statuses replaced, metadata merged."""
    crawls = _artifacts(spark, sf)[1].read(spark)
    return crawls.select("domain", "url", "status", F.col("metadata")["first"].alias("first"), F.col("metadata")["again"].alias("again"))


@registered(_CRAWLED + "SELECT u.page_id, u.url, CASE WHEN again IS NULL THEN 'crawled' ELSE 'again' END AS status FROM u JOIN c ON u.domain = c.domain AND u.url = c.url")
def crawled_results(spark: SparkSession, sf: str) -> DataFrame:
    """Search artifacts with the state of their crawl."""
    search, crawls = _artifacts(spark, sf)
    return artifacts.crawled_results(search, crawls.read(spark).select("domain", "url", "status")).select("page_id", "url", "status")


@registered("SELECT DISTINCT lang || '/' || source AS text, 'c' AS category FROM documents")
def terms_of_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct terms of JSON lists or bare strings."""
    pair = F.concat("lang", F.lit("/"), "source")
    listed = F.when(F.char_length("text") % 2 == 0, F.to_json(F.array(pair, F.lit(None).cast("string")))).otherwise(F.concat(F.lit(" "), pair))
    terms = table(spark, sf, "documents").select(F.lit("c").alias("category"), F.explode(text.string_list(listed)).alias("text"))
    return unique_terms(terms).select("text", "category")
