"""Registered queries: each applies one operator of the library to whole tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import registry_queries
from ledgerloom.functions import domains, money, scoring, text
from ledgerloom.operators import claims, lookups, merge, states, upsert
from ledgerloom.plans import discovery, registries, translation
from ledgerloom.registration import ORACLE_SQL, QUERIES, joined, registered
from ledgerloom.session import shared_path
from ledgerloom.sources import pages as page_source
from ledgerloom.sources.tables import table
from ledgerloom.streaming import pull, tasks

# Upserts and sinks


def _observed(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select("event_id", F.col("user_id").cast("string").alias("native_id"), F.sha2("props", 256).alias("payload_hash"), F.col("ts").alias("last_seen_at"))


_OBSERVED = "o AS (SELECT event_id, CAST(user_id AS VARCHAR) AS native_id, sha256(props) AS payload_hash, ts AS last_seen_at FROM events)"
_OLD_NEW = (
    "WITH " + _OBSERVED + ", a AS (SELECT native_id, payload_hash, max(last_seen_at) AS t FROM o WHERE event_id % 2 = 0 GROUP BY ALL), "
    "b AS (SELECT native_id, payload_hash, max(last_seen_at) AS t FROM o WHERE event_id % 2 = 1 GROUP BY ALL) "
)


def _old_table(o: DataFrame) -> DataFrame:
    rows = upsert.last_by_key(o.filter("event_id % 2 = 0"), ["native_id", "payload_hash"], [F.desc("last_seen_at")])
    return rows.select("native_id", "payload_hash", "last_seen_at", F.lit("old").alias("run_id"))


@registered(
    _OLD_NEW + "SELECT coalesce(a.native_id, b.native_id) AS native_id, coalesce(a.payload_hash, b.payload_hash) AS payload_hash, "
    "coalesce(b.t, a.t) AS last_seen_at, CASE WHEN b.t IS NULL THEN 'old' ELSE 'new' END AS run_id "
    "FROM a FULL JOIN b ON a.native_id = b.native_id AND a.payload_hash = b.payload_hash"
)
def upsert_by_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Content-hash upsert of one half of the events into the other."""
    o = _observed(spark, sf)
    return upsert.upsert_by_hash(_old_table(o), o.filter("event_id % 2 = 1").withColumn("run_id", F.lit("new")), "native_id")


@registered(
    "WITH " + _OBSERVED + ", k AS (SELECT DISTINCT native_id FROM o WHERE event_id % 7 = 0), "
    "a AS (SELECT native_id, payload_hash, max(last_seen_at) AS last_seen_at, 'old' AS run_id FROM o WHERE event_id % 7 = 0 GROUP BY ALL) "
    "SELECT * FROM a UNION ALL SELECT native_id, payload_hash, max(last_seen_at), 'new' FROM o "
    "WHERE event_id % 7 <> 0 AND native_id <> '' AND native_id NOT IN (SELECT native_id FROM k) GROUP BY native_id, payload_hash"
)
def insert_unless_known(spark: SparkSession, sf: str) -> DataFrame:
    """Registry writer without force: known native ids are left alone."""
    o = _observed(spark, sf)
    old = o.filter("event_id % 7 = 0").select("native_id", "payload_hash", "last_seen_at", F.lit("old").alias("run_id"))
    old = upsert.last_by_key(old, ["native_id", "payload_hash"], [F.desc("last_seen_at")])
    return upsert.insert_unless_known(old, o.filter("event_id % 7 <> 0").withColumn("run_id", F.lit("new")), "native_id")


@registered("WITH " + _OBSERVED + " SELECT native_id, payload_hash, min(last_seen_at) AS first_seen_at, max(last_seen_at) AS last_seen_at FROM o GROUP BY ALL")
def seen_range(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.seen_range(_observed(spark, sf), ["native_id", "payload_hash"], "last_seen_at")


@registered(
    "SELECT o_custkey AS code, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_totalprice, o_orderkey) AS price, max(o_orderkey) AS last_key FROM orders GROUP BY 1"
)
def last_wins_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Overwriting upsert: the later half of the orders over the earlier one, the last row of a key counts."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("code"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("last_key"))
    half = F.col("last_key") % 3 == 0
    first = upsert.last_by_key(o.filter(half), ["code"], [F.desc("last_key")])
    rows = upsert.last_by_key(o.filter(~half), ["code"], [F.desc("last_key")])
    return upsert.upsert(first, rows, ["code"], ["status", "price", "last_key"], upsert.new("last_key") > upsert.old("last_key"))


@registered("""
WITH r AS (SELECT user_id AS raw_id, event_type AS domain, 'search' AS signal, event_id, CAST(least(100, greatest(1, floor(value))) AS INTEGER) AS confidence, props FROM events),
a AS (SELECT raw_id, domain, signal, arg_max(confidence, event_id) AS confidence, arg_max(props, event_id) AS props FROM r WHERE event_id % 2 = 0 GROUP BY ALL),
b AS (SELECT raw_id, domain, signal, arg_max(confidence, event_id) AS confidence, arg_max(props, event_id) AS props FROM r WHERE event_id % 2 = 1 GROUP BY ALL)
SELECT coalesce(a.raw_id, b.raw_id) AS raw_id, coalesce(a.domain, b.domain) AS domain, coalesce(a.signal, b.signal) AS signal,
  CASE WHEN a.raw_id IS NULL THEN 'active' WHEN a.raw_id % 3 = 0 THEN 'removed' ELSE 'active' END AS status,
  CASE WHEN a.raw_id IS NULL OR (b.raw_id IS NOT NULL AND a.raw_id % 3 <> 0) THEN b.confidence ELSE a.confidence END AS confidence,
  CASE WHEN a.raw_id IS NULL OR (b.raw_id IS NOT NULL AND a.raw_id % 3 <> 0) THEN b.props ELSE a.props END AS shared,
  CASE WHEN a.raw_id IS NULL THEN NULL ELSE a.props END AS before
FROM a FULL JOIN b ON a.raw_id = b.raw_id AND a.domain = b.domain AND a.signal = b.signal
""")
def upsert_domains(spark: SparkSession, sf: str) -> DataFrame:
    """Domain bridge: metadata merged, rows that are not active kept as they are."""
    r = table(spark, sf, "events").select(
        F.col("user_id").alias("raw_id"), F.col("event_type").alias("domain"), F.lit("search").alias("signal"), "event_id",
        F.greatest(F.lit(1), F.least(F.lit(100), F.floor("value"))).cast("int").alias("confidence"), "props",
    )
    last = lambda half: upsert.last_by_key(r.filter(F.col("event_id") % 2 == half), ["raw_id", "domain", "signal"], [F.desc("event_id")])
    status = F.when(F.col("raw_id") % 3 == 0, "removed").otherwise("active")
    a = last(0).withColumn("metadata", F.create_map(F.lit("before"), "props", F.lit("shared"), "props")).withColumn("status", status).drop("event_id", "props")
    b = last(1).withColumn("metadata", F.create_map(F.lit("shared"), "props")).drop("event_id", "props")
    out = upsert.upsert_domains(a, b)
    return out.select("raw_id", "domain", "signal", "status", "confidence", F.col("metadata")["shared"].alias("shared"), F.col("metadata")["before"].alias("before"))


@registered("""
SELECT CAST(o_orderkey AS VARCHAR) AS action_id, 'queued' AS status, 'made' AS message FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'failed', 'no total' FROM orders WHERE o_orderstatus = 'F'
""")
def append_events(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("action_id", F.col("o_orderkey").cast("string"))
    log = o.select("action_id", F.lit("queued").alias("status"), F.lit("made").alias("message"))
    ids = o.select(F.when(F.col("o_orderstatus") == "F", F.col("action_id")).otherwise("").alias("action_id"))
    return upsert.append_events(log, ids, "failed", "no total")


# Merges and picks


@registered("""
SELECT CAST(user_id AS VARCHAR) AS key, coalesce(arg_max(event_type, event_id) FILTER (event_type <> 'error'), '') AS event_type,
  coalesce(arg_max(CAST(CAST(value AS INTEGER) AS VARCHAR), event_id) FILTER (event_type = 'purchase'), '') AS amount,
  string_agg(props, '|' ORDER BY event_id) AS props
FROM events GROUP BY 1
""")
def merge_fragments(spark: SparkSession, sf: str) -> DataFrame:
    """Company fragments: last non-empty scalars, arrays in order."""
    e = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("key"), "event_id", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("event_type") == "purchase", F.rint("value").cast("int").cast("string")).otherwise("").alias("amount"), F.array("props").alias("props"),
    )
    return merge.merge_fragments(e, "key", "event_id", ["event_type", "amount"], ["props"]).withColumn("props", joined(F.col("props")))


@registered("""
SELECT CAST(user_id AS VARCHAR) AS registry_code, arg_max(event_type, event_id) FILTER (event_type <> 'purchase') AS legal_name,
  coalesce(len(list(event_id) FILTER (event_type = 'purchase')), 0) AS n_financials,
  coalesce(string_agg(CAST(event_id AS VARCHAR), '|' ORDER BY event_id) FILTER (event_type = 'purchase'), '') AS financial_ids
FROM events GROUP BY 1
""")
def merge_financials(spark: SparkSession, sf: str) -> DataFrame:
    """Basic records give scalars, financial records are collected, per registry code."""
    e = table(spark, sf, "events")
    code = F.col("user_id").cast("string").alias("registry_code")
    basic = F.to_json(F.struct(code, F.col("event_type").alias("legal_name")))
    financial = F.to_json(F.struct(code, F.col("event_id").cast("string").alias("profit")))
    records = e.select(F.lit(0).alias("file_ord"), F.col("event_id").alias("record_no"), F.when(F.col("event_type") == "purchase", financial).otherwise(basic).alias("record"))
    out = registries.ariregister_companies(records)
    ids = F.transform("financials", lambda x: F.get_json_object(x, "$.profit"))
    return out.select("registry_code", "legal_name", F.size("financials").cast("long").alias("n_financials"), joined(ids).alias("financial_ids"))


@registered("SELECT string_agg(DISTINCT source || ':' || lang, ', ' ORDER BY source || ':' || lang) AS datasets FROM documents")
def source_summary(spark: SparkSession, sf: str) -> DataFrame:
    return merge.source_summary(table(spark, sf, "documents").select("source", F.col("lang").alias("dataset")))


@registered("SELECT DISTINCT lang AS category, text FROM documents WHERE text <> ''")
def unique_terms(spark: SparkSession, sf: str) -> DataFrame:
    return merge.unique_terms(table(spark, sf, "documents").select(F.col("lang").alias("category"), "text"))


@registered("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """Latest action of each record."""
    return merge.first_per_key(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@registered("""
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n <= 5
""")
def top_per_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = merge.top_per_key(table(spark, sf, "lineitem"), ["l_suppkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], 5)
    return rows.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")


@registered("SELECT o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) - 1) / 50) AS BIGINT) AS chunk FROM orders")
def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return merge.chunked(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], [F.col("o_orderkey")], 50).select("o_orderkey", "chunk")


# Joins


def _cache_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf, "documents")
    terms = merge.unique_terms(d.select(F.col("lang").alias("category"), "text")).withColumn("original_hash", text.term_hash(F.col("text")))
    rows = d.filter("source = 'src0'").select(
        F.col("lang").alias("category"), text.term_hash(F.col("text")).alias("original_hash"), F.lit("no").alias("source_lang"), F.lit("en").alias("target_lang"),
        F.lit("v1").alias("prompt_version"), F.lit("m").alias("model"), translation.mock_translation(F.col("text")).alias("translated_text"),
    )
    return terms, upsert.last_by_key(rows, ["category", "original_hash"], [F.col("translated_text")])


_CACHE = (
    "WITH t AS (SELECT DISTINCT lang AS category, text, sha256(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) AS h FROM documents WHERE text <> ''), "
    "c AS (SELECT DISTINCT lang AS category, sha256(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) AS h FROM documents WHERE source = 'src0') "
)


@registered(
    _CACHE + "SELECT t.category, count(c.h) AS hits, count(*) - count(c.h) AS misses, count(c.h) / count(*) AS hit_rate "
    "FROM t LEFT JOIN c ON t.category = c.category AND t.h = c.h GROUP BY 1"
)
def cache_hit_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct terms against the translation cache: hits and misses by category."""
    terms, cache = _cache_parts(spark, sf)
    return lookups.hit_rates(lookups.cache_lookup(terms, cache, "no", "en", "v1", "m"))


@registered(
    _CACHE + "SELECT t.category, t.h AS original_hash, 't' || (row_number() OVER (PARTITION BY t.category ORDER BY t.text) - 1) AS miss_id "
    "FROM t ANTI JOIN c ON t.category = c.category AND t.h = c.h"
)
def cache_misses(spark: SparkSession, sf: str) -> DataFrame:
    """Misses, numbered within their category in order of the text."""
    terms, cache = _cache_parts(spark, sf)
    misses = lookups.cache_lookup(terms, cache, "no", "en", "v1", "m").filter("translated_text is null")
    return merge.numbered(misses, ["category"], [F.col("text")], "t", "miss_id").select("category", "original_hash", "miss_id")


@registered("SELECT doc_id, source FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def need_discovery(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.not_yet(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id")


@registered("SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")
def not_yet_of_many(spark: SparkSession, sf: str) -> DataFrame:
    """New ids against a much larger table of known ones, which is filtered where it is read."""
    known = table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return lookups.not_yet_of_many(table(spark, sf, "part").select("p_partkey", "p_name"), known, "p_partkey")


@registered("""
SELECT c_custkey AS native_id, c_custkey * 10 AS raw_id FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 400000)
""")
def need_discovery_active(spark: SparkSession, sf: str) -> DataFrame:
    """Companies without an active domain, by their raw ids."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("native_id"))
    raw = c.select("native_id", (F.col("native_id") * 10).alias("raw_id"))
    status = F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000), "active").otherwise("removed")
    bridge = table(spark, sf, "orders").select((F.col("o_custkey") * 10).alias("raw_id"), status.alias("status"))
    return lookups.need_discovery(c, raw, bridge).select("native_id", "raw_id")


@registered("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def known_ids(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.known(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").filter("toxic = 1"), "doc_id")


_HOST = "regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), '^www\\.', '')"


@registered(f"""
WITH p AS (SELECT page_id, {_HOST} AS domain FROM pages),
s AS (SELECT DISTINCT regexp_replace(domain, '^[^.]*\\.', '') AS suffix FROM p UNION SELECT 'example.com'),
m AS (SELECT page_id, arg_max(suffix, length(suffix)) AS matched FROM p, s WHERE domain = suffix OR ends_with(domain, '.' || suffix) GROUP BY 1)
SELECT p.page_id, p.domain, m.matched FROM p LEFT JOIN m USING (page_id)
""")
def suffix_match(spark: SparkSession, sf: str) -> DataFrame:
    """Longest listed parent of each page's domain, from a table of suffixes."""
    p = table(spark, sf, "pages").select("page_id", domains.domain_of_url(F.col("url")).alias("domain"))
    s = p.select(F.regexp_replace("domain", r"^[^.]*\.", "").alias("suffix")).union(spark.createDataFrame([("example.com",)], "suffix string")).distinct()
    return lookups.suffix_match(p, "domain", s)


_ENDS = lambda d, names: "(" + " OR ".join(f"{d} = '{n}' OR ends_with({d}, '.{n}')" for n in names) + ")"
_TESTED = ["www.proff.no", "m.facebook.com", "duckduckgo.com", "data.brreg.no", "no.wikipedia.org", "example.org", "notproff.no", "x.com", "links.yandex.ru", "eniro.no"]
_TESTED_SQL = "list_extract([" + ", ".join(f"'{t}'" for t in _TESTED) + "], CAST(page_id % 10 AS INTEGER) + 1)"


@registered(f"""
WITH p AS (SELECT page_id, regexp_replace({_TESTED_SQL}, '^www\\.', '') AS d FROM pages)
SELECT page_id, CASE WHEN {_ENDS('d', lookups.SEARCH_DOMAINS)} THEN 'search_provider' WHEN {_ENDS('d', lookups.DIRECTORY_DOMAINS + lookups.REGISTRY_DOMAINS)} THEN 'directory_or_registry' END AS reason,
  CASE WHEN {_ENDS('d', lookups.SOCIAL_DOMAINS)} THEN 'social_profile' WHEN {_ENDS('d', lookups.REFERENCE_DOMAINS)} THEN 'reference_page'
       WHEN {_ENDS('d', lookups.REGISTRY_DOMAINS)} THEN 'registry_profile' WHEN {_ENDS('d', lookups.DIRECTORY_DOMAINS)} THEN 'directory_profile' END AS site_type
FROM p
""")
def site_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Exclusion reason and kind of known sites; each page stands for one of ten domains."""
    d = F.element_at(F.array(*map(F.lit, _TESTED)), (F.col("page_id") % 10 + 1).cast("int"))
    p = table(spark, sf, "pages").select("page_id", d.alias("d"))
    return p.select("page_id", lookups.exclusion_reason(F.col("d"))["reason"].alias("reason"), lookups.site_kind(F.col("d"))["site_type"].alias("site_type"))


@registered("""
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts AS view_ts, event_id AS view_id FROM events WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.ts, v.view_ts, v.view_id FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts
""")
def as_of_join(spark: SparkSession, sf: str) -> DataFrame:
    """Each purchase with the user's latest view before it."""
    e = table(spark, sf, "events")
    views = e.filter("event_type = 'view'").select("user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"))
    return lookups.as_of(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), views, ["user_id"], "ts", "view_ts", ["view_id"])


@registered("""
WITH r AS (SELECT CAST(ts AS DATE) AS rate_date, event_type AS currency, max(value) AS rate FROM events WHERE event_type IN ('purchase', 'error') AND value > 60 GROUP BY 1, 2),
d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), m AS (SELECT day, max(rate_date) AS rate_date FROM d JOIN r ON rate_date <= day GROUP BY 1)
SELECT m.day, rate_date, currency, rate FROM m JOIN r USING (rate_date)
""")
def rates_on(spark: SparkSession, sf: str) -> DataFrame:
    """Rates in force on each day: the latest published day that is not later."""
    e = table(spark, sf, "events")
    rates = e.filter("event_type in ('purchase', 'error') and value > 60").groupBy(F.to_date("ts").alias("rate_date"), F.col("event_type").alias("currency")).agg(F.max("value").alias("rate"))
    return lookups.rates_on(e.select(F.to_date("ts").alias("day")), rates).select("day", "rate_date", "currency", "rate")


_RATES = {"BUILDING": 11.5, "MACHINERY": 1.09, "HOUSEHOLD": 7.46, "FURNITURE": 0.0, "AUTOMOBILE": 15.6}


@registered(
    "WITH c AS (SELECT c_custkey, c_acctbal AS a, CASE c_mktsegment WHEN 'MACHINERY' THEN 'USD' ELSE c_mktsegment END AS currency, CAST(CASE c_mktsegment "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _RATES.items())
    + " END AS DOUBLE) AS rate FROM customer) SELECT c_custkey, CASE WHEN a < 0 THEN NULL WHEN currency = 'USD' THEN CAST(round(a * CAST(100 AS DOUBLE)) AS BIGINT) "
    "WHEN rate > 0 THEN CAST(round(a / rate * CAST(1.09 AS DOUBLE) * CAST(100 AS DOUBLE)) AS BIGINT) END AS cents FROM c"
)
def usd_cents(spark: SparkSession, sf: str) -> DataFrame:
    """Balances in US cents through euro rates; negative amounts and unknown rates give null."""
    c = table(spark, sf, "customer")
    rates = F.create_map(*[F.lit(x) for pair in _RATES.items() for x in pair])
    currency = F.when(F.col("c_mktsegment") == "MACHINERY", "USD").otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", money.usd_cents(F.col("c_acctbal"), currency, rates[F.col("c_mktsegment")], F.lit(1.09)).alias("cents"))


@registered("""
SELECT c_custkey, count(DISTINCT o_orderkey) AS orders, count(DISTINCT o_orderkey) FILTER (o_orderstatus = 'F') AS finished,
  count(l_linenumber) AS lines, count(l_linenumber) FILTER (l_returnflag = 'R') AS returned
FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
""")
def domain_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Counts over two fan-outs; each side is aggregated before it is joined, so no row is multiplied."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    orders = table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    per = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.sum("lines").alias("lines"), F.sum("returned").alias("returned")
    )
    out = table(spark, sf, "customer").select("c_custkey").join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    return out.select("c_custkey", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("orders", "finished", "lines", "returned")])


# States and claims

_STATUS = "list_extract(['pending','running','succeeded','skipped','failed_retryable','failed_terminal'], CAST(event_id % 6 AS INTEGER) + 1)"


def _tasks(spark: SparkSession, sf: str) -> DataFrame:
    status = F.element_at(F.array(*map(F.lit, states.TASK_STATUSES)), (F.col("event_id") % 6 + 1).cast("int"))
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("raw_id"), F.col("event_type").alias("task_type"), status.alias("status"), "ts", "value")


_TASKS = f"t AS (SELECT event_id AS id, user_id AS raw_id, event_type AS task_type, {_STATUS} AS status, ts, value FROM events)"


@registered(
    f"WITH {_TASKS}, s AS (SELECT raw_id, task_type, count(*) AS total_count, "
    + ", ".join(f"count(*) FILTER (status = '{x}') AS {x}_count" for x in states.TASK_STATUSES)
    + ", bool_and(status IN ('succeeded', 'skipped')) AS complete, bool_or(status = 'failed_terminal') AS blocked FROM t GROUP BY ALL) "
    "SELECT *, total_count > 0 AND complete AND NOT blocked AS passed FROM s"
)
def asset_state(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of each task state, completeness, blocking and the check's verdict."""
    return states.asset_state(_tasks(spark, sf), ["raw_id", "task_type"]).withColumn("passed", states.check_passed())


@registered(f"""
WITH {_TASKS}, a AS (SELECT raw_id, arg_max(id, (ts, id)) AS artifact_id FROM t WHERE task_type = 'view' GROUP BY 1),
k AS (SELECT raw_id, arg_max(status, (ts, id)) AS task_status FROM t WHERE task_type = 'click' GROUP BY 1)
SELECT c_custkey AS raw_id, coalesce(task_status, 'pending') AS task_status, artifact_id
FROM customer LEFT JOIN k ON k.raw_id = c_custkey LEFT JOIN a ON a.raw_id = c_custkey WHERE c_acctbal >= 0
""")
def asset_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Current records with their task state and latest artifact."""
    t = _tasks(spark, sf)
    raw = table(spark, sf, "customer").select(F.col("c_custkey").alias("raw_id"), (F.col("c_acctbal") >= 0).alias("is_current"))
    tasks = merge.first_per_key(t.filter("task_type = 'click'"), ["raw_id"], [F.desc("ts"), F.desc("id")])
    artifacts = t.filter("task_type = 'view'").withColumn("created_at", F.col("ts"))
    return states.asset_rows(raw, tasks, artifacts).select("raw_id", "task_status", "artifact_id")


@registered(f"""
WITH {_TASKS} SELECT id, raw_id FROM t WHERE task_type = 'click' AND status = 'pending'
AND EXISTS (SELECT 1 FROM t d WHERE d.raw_id = t.raw_id AND d.task_type = 'signup' AND d.status IN ('succeeded', 'skipped', 'failed_terminal'))
AND NOT EXISTS (SELECT 1 FROM t u WHERE u.raw_id = t.raw_id AND u.task_type = 'view' AND u.status = 'succeeded')
""")
def claimable_after(spark: SparkSession, sf: str) -> DataFrame:
    """Pending tasks whose record has one finished task and lacks another's success."""
    t = _tasks(spark, sf)
    return states.claimable_after(t, "signup", "view", "click").select("id", "raw_id")


@registered(f"""
WITH {_TASKS}, l AS (SELECT raw_id, task_type, arg_max(status, (ts, id)) AS s FROM t GROUP BY ALL)
SELECT c_custkey AS raw_id, coalesce(a.s, 'pending') = 'succeeded' AND coalesce(b.s, 'pending') IN ('succeeded', 'skipped') AND coalesce(c.s, 'pending') IN ('succeeded', 'skipped') AS ready
FROM customer LEFT JOIN l a ON a.raw_id = c_custkey AND a.task_type = 'view' LEFT JOIN l b ON b.raw_id = c_custkey AND b.task_type = 'click'
LEFT JOIN l c ON c.raw_id = c_custkey AND c.task_type = 'signup'
""")
def ready_records(spark: SparkSession, sf: str) -> DataFrame:
    last = merge.first_per_key(_tasks(spark, sf), ["raw_id", "task_type"], [F.desc("ts"), F.desc("id")])
    of = lambda kind: last.filter(F.col("task_type") == kind)
    raw = table(spark, sf, "customer").select(F.col("c_custkey").alias("raw_id"), F.lit(True).alias("is_current"))
    return states.ready_records(raw, of("view"), of("click"), of("signup"))


@registered("SELECT event_id AS id, user_id AS native_id, CASE WHEN event_id = max(event_id) OVER (PARTITION BY user_id) THEN 'current' ELSE 'superseded' END AS state FROM events")
def superseded(spark: SparkSession, sf: str) -> DataFrame:
    built = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("native_id"), F.col("ts").alias("created_at"))
    return states.superseded(built).select("id", "native_id", "state")


@registered("""
WITH i AS (SELECT user_id, event_type, CASE WHEN event_type = 'error' AND value > 20 THEN 'failed' WHEN event_type = 'view' THEN 'skipped' WHEN value < 10 THEN 'failed' ELSE 'succeeded' END AS s FROM events),
c AS (SELECT user_id, event_type, count(*) FILTER (s = 'succeeded') AS completed, count(*) FILTER (s = 'failed') AS failed, count(*) FILTER (s = 'skipped') AS skipped FROM i GROUP BY 1, 2)
SELECT *, CASE WHEN failed = 0 THEN 'succeeded' WHEN completed + skipped = 0 THEN 'failed' ELSE 'partial' END AS status FROM c
""")
def batch_status(spark: SparkSession, sf: str) -> DataFrame:
    """Batches by user and kind of event: all well, all failed, or in part."""
    kind, value = F.col("event_type"), F.col("value")
    s = F.when((kind == "error") & (value > 20), "failed").when(kind == "view", "skipped").when(value < 10, "failed").otherwise("succeeded")
    return states.batch_status(table(spark, sf, "events").select("user_id", "event_type", s.alias("status")), ["user_id", "event_type"])


@registered("""
SELECT o_orderpriority AS engine, o_orderstatus AS status, count(*) AS records, count(*) FILTER (o_totalprice > 100000) AS domains_found,
  CAST(sum(o_custkey % 4) AS BIGINT) AS related_sites, count(*) FILTER (o_custkey % 4 > 1) AS primary_count FROM orders GROUP BY 1, 2
""")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Summary of a run by engine and status."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("engine"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_totalprice") > 100000, "d").alias("best_domain"),
        (F.col("o_custkey") % 4).alias("related_count"), (F.col("o_custkey") % 4 > 1).alias("has_primary"),
    )
    return states.run_summary(o, ["engine"])


_NOW = "TIMESTAMP '1998-06-01 00:00:00'"
_WORK = (
    "w AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'failed' ELSE 'translating' END AS status, o_orderdate AS created_at, "
    "CASE o_orderstatus WHEN 'O' THEN o_orderdate + INTERVAL 400 DAY END AS lease_until, CASE WHEN o_orderstatus = 'O' THEN 'w' || (o_custkey % 5) END AS lease_by FROM orders)"
)


def _work(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(s == "P", "pending").when(s == "F", "failed").otherwise("translating").alias("status"),
        F.col("o_orderdate").alias("created_at"), F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("error"),
        F.when(s == "O", F.col("o_orderdate") + F.make_dt_interval(days=F.lit(400))).alias("lease_until"),
        F.when(s == "O", F.concat(F.lit("w"), (F.col("o_custkey") % 5).cast("string"))).alias("lease_by"),
    )


@registered(f"""
WITH {_WORK}, c AS (SELECT id FROM w WHERE status IN ('pending', 'failed') OR (status = 'translating' AND (lease_until < {_NOW} OR lease_by = 'w3')) ORDER BY created_at, id LIMIT 500)
SELECT w.id, CASE WHEN c.id IS NULL THEN status ELSE 'translating' END AS status, CASE WHEN c.id IS NULL THEN 0 ELSE 1 END AS attempts,
  CASE WHEN c.id IS NULL THEN lease_by ELSE 'w3' END AS lease_by, CASE WHEN c.id IS NULL THEN lease_until ELSE {_NOW} + INTERVAL 10 MINUTE END AS lease_until, c.id IS NOT NULL AS claimed
FROM w LEFT JOIN c ON w.id = c.id
""")
def claim(spark: SparkSession, sf: str) -> DataFrame:
    """First-come claim of 500 rows under a lease: pending, failed, stale or the worker's own. The limit is the batch size."""
    now = F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")
    return claims.claim(_work(spark, sf), now, "w3", 500, include_failed=True).select("id", "status", "attempts", "lease_by", "lease_until", "claimed")


@registered("""
SELECT c_custkey AS id, CAST(coalesce(max(o_shippriority), 0) + 1 AS INTEGER) AS attempt FROM customer
LEFT JOIN (SELECT o_custkey, CAST(o_orderkey % 9 AS INTEGER) AS o_shippriority FROM orders WHERE o_orderstatus = 'F') ON o_custkey = c_custkey GROUP BY 1
""")
def next_attempts(spark: SparkSession, sf: str) -> DataFrame:
    actions = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("raw_input_id"), (F.col("o_orderkey") % 9).cast("int").alias("attempt"), F.when(F.col("o_orderstatus") == "F", "translate").otherwise("other").alias("action_type")
    )
    return claims.next_attempts(table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), actions)


@registered(f"""
WITH {_WORK} SELECT id, CASE WHEN id % 4 = 0 THEN 'translated' WHEN id % 4 = 1 THEN 'failed' ELSE status END AS status,
  CASE WHEN id % 4 = 0 THEN 'en' END AS payload_en, CASE WHEN id % 4 = 1 THEN 'missing translation' END AS error,
  CASE WHEN id % 4 > 1 THEN lease_by END AS lease_by, CASE WHEN id % 4 = 0 THEN {_NOW} END AS translated_at FROM w
""")
def written_results(spark: SparkSession, sf: str) -> DataFrame:
    """The table after a batch's results: successes, failures, and leases that end with them."""
    w = _work(spark, sf).withColumns({"payload_en": F.lit(None).cast("string"), "translated_at": F.lit(None).cast("timestamp_ntz")})
    good = F.col("id") % 4 == 0
    results = w.filter("id % 4 < 2").select("id", F.when(good, "en").alias("payload_en"), F.when(~good, "missing translation").alias("error"))
    now = F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")
    return claims.written(w, results, now).select("id", "status", "payload_en", "error", "lease_by", "translated_at")


@registered(f"""
WITH {_TASKS} SELECT id, raw_id, 'pending' AS status FROM t WHERE task_type = 'click'
AND ((status = 'failed_retryable' AND value > 20) OR (status = 'running' AND ts < TIMESTAMP '2024-01-10 00:00:00')) ORDER BY ts, id LIMIT 100
""")
def retry_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Failed tasks of a category and stale running ones, oldest first. The limit is the caller's."""
    t = _tasks(spark, sf).withColumns({"updated_at": F.col("ts"), "lease_until": F.col("ts"), "error_category": F.when(F.col("value") > 20, "net").otherwise("parse")})
    return claims.retryable(t, "click", "net", 100, F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).select("id", "raw_id", "status")


# Domain discovery

_CHECKS = """
k AS (SELECT user_id AS company_id, event_id AS pos, 'https://d' || (event_id % 7) || '.no/' || (event_id % 3) AS url, 'd' || (event_id % 7) || '.no' AS domain,
  CAST(floor(value) AS INTEGER) % 101 AS score, CASE event_type WHEN 'error' THEN 'rejected' WHEN 'view' THEN 'uncertain' ELSE 'accepted' END AS decision,
  CASE WHEN event_id % 5 < 2 THEN 'company_website' ELSE 'social_profile' END AS site_type,
  CASE event_id % 4 WHEN 0 THEN 'primary_web_presence' WHEN 1 THEN 'unrelated' ELSE 'evidence_profile' END AS relationship, event_id % 5 = 0 AS owned_domain FROM events)
"""


def _checks(spark: SparkSession, sf: str) -> DataFrame:
    e, i = table(spark, sf, "events"), F.col("event_id")
    domain = F.concat(F.lit("d"), (i % 7).cast("string"), F.lit(".no"))
    return e.select(
        F.col("user_id").alias("company_id"), i.alias("pos"), F.concat(F.lit("https://"), domain, F.lit("/"), (i % 3).cast("string")).alias("url"), domain.alias("domain"),
        (F.floor("value").cast("int") % 101).alias("score"), F.when(F.col("event_type") == "error", "rejected").when(F.col("event_type") == "view", "uncertain").otherwise("accepted").alias("decision"),
        F.when(i % 5 < 2, "company_website").otherwise("social_profile").alias("site_type"),
        F.when(i % 4 == 0, "primary_web_presence").when(i % 4 == 1, "unrelated").otherwise("evidence_profile").alias("relationship"), (i % 5 == 0).alias("owned_domain"),
    )


@registered(f"""
WITH {_CHECKS}, g AS (SELECT * FROM k WHERE score >= 50 AND decision <> 'rejected'),
o AS (SELECT *, row_number() OVER (PARTITION BY company_id, domain ORDER BY score DESC, pos) AS n FROM g WHERE site_type = 'company_website' AND owned_domain),
r AS (SELECT *, row_number() OVER (PARTITION BY company_id, url, domain ORDER BY score DESC, pos) AS n FROM g WHERE relationship <> 'unrelated'),
d AS (SELECT company_id, string_agg(domain, '|' ORDER BY score DESC, pos) AS domains, arg_min(domain, (-score, pos)) AS best_domain FROM o WHERE n = 1 GROUP BY 1),
s AS (SELECT company_id, string_agg(url, '|' ORDER BY score DESC, pos) AS related,
  arg_min(url, (NOT owned_domain, -score, pos)) FILTER (relationship = 'primary_web_presence') AS primary_url FROM r WHERE n = 1 GROUP BY 1)
SELECT i.company_id, CASE WHEN domains IS NOT NULL OR related IS NOT NULL THEN 'succeeded' ELSE 'not_found' END AS status, best_domain, domains, related, primary_url
FROM (SELECT DISTINCT company_id FROM k) i LEFT JOIN d USING (company_id) LEFT JOIN s USING (company_id)
""")
def discovery_decision(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted domains, related sites and primary presence of each company."""
    out = discovery.decide(_checks(spark, sf))
    return out.select(
        "company_id", "status", "best_domain", joined(F.transform("domains", lambda x: x["domain"])).alias("domains"),
        joined(F.transform("related_sites", lambda x: x["url"])).alias("related"), F.col("primary_site.url").alias("primary_url"),
    )


@registered("""
WITH s AS (SELECT user_id AS native_id, 'd' || (event_id % 40) || '.no' AS domain, CASE event_type WHEN 'view' THEN 'duckduckgo' WHEN 'click' THEN 'wikidata' WHEN 'signup' THEN 'certsh' ELSE 'heuristic' END AS signal, event_id AS pos FROM events)
SELECT native_id, domain, signal, pos FROM (SELECT *, row_number() OVER (PARTITION BY native_id, domain ORDER BY CASE signal WHEN 'duckduckgo' THEN 0 WHEN 'wikidata' THEN 1 WHEN 'certsh' THEN 2 ELSE 3 END, pos) AS n FROM s) WHERE n = 1
""")
def first_signals(spark: SparkSession, sf: str) -> DataFrame:
    """The first signal to find a domain counts, not the most confident one."""
    e = table(spark, sf, "events")
    of = {"duckduckgo": ["view"], "wikidata": ["click"], "certsh": ["signup"], "heuristic": ["error", "purchase"]}
    parts = [
        e.filter(F.col("event_type").isin(*kinds)).select(
            F.col("user_id").alias("native_id"), F.concat(F.lit("d"), (F.col("event_id") % 40).cast("string"), F.lit(".no")).alias("domain"), F.lit(name).alias("signal"), F.col("event_id").alias("pos")
        )
        for name, kinds in of.items()
    ]
    return discovery.first_signals(*parts)


@registered("""
WITH l AS (SELECT page_id, url, regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']+)["'']', 1) AS hrefs FROM pages),
f AS (SELECT page_id, url, unnest(hrefs) AS h, generate_subscripts(hrefs, 1) AS n FROM l),
g AS (SELECT page_id, n, CASE WHEN regexp_matches(h, '^(?i:https?)://') THEN h WHEN h LIKE '/%' THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || h END AS full_url,
  regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)), '^www\\.', '') AS own FROM f),
d AS (SELECT page_id, full_url, min(((regexp_replace(lower(regexp_extract(full_url, '^(?i:https?)://([^/?#:]*)', 1)), '^www\\.', '') = own)::INT) * 1000000 + n) AS place FROM g WHERE full_url IS NOT NULL GROUP BY ALL),
t AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY place) AS r FROM d)
SELECT p.page_id, CAST(count(t.r) FILTER (r <= 100) AS INTEGER) AS n_links, coalesce(string_agg(full_url, '|' ORDER BY place) FILTER (r <= 100), '') AS links
FROM pages p LEFT JOIN t USING (page_id) GROUP BY 1
""")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links of stored pages: other sites' first, each once, at most 100 as the crawler keeps."""
    p = table(spark, sf, "pages")
    links = page_source.page_links(F.col("html"), F.col("url"))
    return p.select("page_id", F.size(links).alias("n_links"), joined(links).alias("links"))


@registered()
def crawled_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Crawl responses of stored pages with their visible text's hash."""
    out = page_source.crawled(table(spark, sf, "pages"))
    return out.select("url", "final_url", "status", "markdown_hash", F.size("links").alias("n_links"), F.length("markdown").alias("n_chars"))


# Functions


@registered("""
WITH s AS (SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, ['GB', 'US', 'NO', 'JP', 'DE'][CAST(p_partkey % 5 AS INTEGER) + 1] AS c FROM part),
t AS (SELECT p_partkey, slug, replace(slug, '-', '') AS flat, CASE c WHEN 'GB' THEN '.co.uk' WHEN 'US' THEN '.com' WHEN 'JP' THEN '.co.jp' ELSE '.' || lower(c) END AS tld FROM s)
SELECT p_partkey, slug, CASE WHEN tld = '.com' THEN concat_ws('|', slug || '.com', CASE WHEN flat <> slug THEN flat || '.com' END)
  ELSE concat_ws('|', slug || tld, CASE WHEN flat <> slug THEN flat || tld END, slug || '.com', CASE WHEN flat <> slug THEN flat || '.com' END) END AS candidates FROM t
""")
def candidate_domains(spark: SparkSession, sf: str) -> DataFrame:
    """Slugs and guessed domains of names with legal forms, by country."""
    form = F.element_at(F.array(*map(F.lit, [" AS", " Limited Liability Company", " gmbh", ", Inc", " ApS & Co"])), (F.col("p_partkey") % 5 + 1).cast("int"))
    form = F.when(F.col("p_partkey") % 5 == 4, F.lit(" Co")).otherwise(form)
    country = F.element_at(F.array(*map(F.lit, ["GB", "US", "NO", "JP", "DE"])), (F.col("p_partkey") % 5 + 1).cast("int"))
    name = F.concat("p_name", form)
    p = table(spark, sf, "part")
    return p.select("p_partkey", text.company_slug(name).alias("slug"), joined(domains.candidate_domains(name, country)).alias("candidates"))


@registered("""
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower(url), '^http://', ''), '^https://', ''), '/.*$', '') AS discovery,
  regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), '^www\\.', '') AS domain, url AS normalized,
  CASE page_id % 3 WHEN 0 THEN 'https://target.example.org/a?b=1' WHEN 1 THEN url ELSE 'https://duckduckgo.com/l/?x=1' END AS unwrapped,
  ['search', 'certsh', 'heuristic', 'wikidata'][CAST(page_id % 4 AS INTEGER) + 1] AS signal, CAST(greatest(1, least(100, page_id - 20)) AS SMALLINT) AS confidence FROM pages
""")
def normalized_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """Domains, addresses, redirects, signals and confidences in normal form."""
    link = F.when(F.col("page_id") % 3 == 0, F.lit("https://duckduckgo.com/l/?uddg=https%3A%2F%2Ftarget.example.org%2Fa%3Fb%3D1&rut=9")).when(
        F.col("page_id") % 3 == 1, F.concat(F.lit("https://yandex.com/r?url="), F.url_encode("url"))
    ).otherwise("https://duckduckgo.com/l/?x=1")
    signal = F.element_at(F.array(*map(F.lit, [" DuckDuckGo", "crtsh", "unknown", "wikidata"])), (F.col("page_id") % 4 + 1).cast("int"))
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", domains.discovery_domain(u).alias("discovery"), domains.normalized_domain(u).alias("domain"), domains.normalized_url(u).alias("normalized"),
        domains.unwrapped_url(link).alias("unwrapped"), domains.discovery_signal(signal).alias("signal"), domains.clamped_confidence(F.col("page_id") - 20).alias("confidence"),
    )


@registered("""
SELECT event_id, CASE event_id % 6 WHEN 0 THEN CAST(least(100, event_id % 300) AS INTEGER) WHEN 1 THEN 95 WHEN 2 THEN 90 WHEN 3 THEN 60 WHEN 4 THEN 30 ELSE 0 END AS score,
  CASE event_type WHEN 'view' THEN 'accepted' WHEN 'click' THEN 'rejected' ELSE 'uncertain' END AS decision FROM events
""")
def scored_words(spark: SparkSession, sf: str) -> DataFrame:
    """Scores and decisions from loosely worded answers."""
    i = F.col("event_id")
    words = F.element_at(F.array(F.concat(F.lit(" about "), (i % 300).cast("string"), F.lit("%")), *map(F.lit, ["Very High", "high", "moderate match", "weak", "nothing"])), (i % 6 + 1).cast("int"))
    said = F.when(F.col("event_type") == "view", "Likely-Related").when(F.col("event_type") == "click", " no match ").otherwise("maybe")
    return table(spark, sf, "events").select("event_id", scoring.score(words).alias("score"), scoring.decision(said).alias("decision"))


@registered("""
WITH l AS (SELECT doc_id, [y FOR y IN [regexp_replace(trim(x), '\\s+', ' ', 'g') FOR x IN string_split(text, chr(10))] IF y <> ''] AS lines FROM documents)
SELECT doc_id, regexp_replace(substring(array_to_string(lines, chr(10)), 1, 2500), '\\n$', '') AS compact FROM l
""")
def compact_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Page text for a prompt: non-blank lines, single spaces; the limit is the prompt's."""
    return table(spark, sf, "documents").select("doc_id", text.compact_lines(F.col("text")).alias("compact"))


@registered("SELECT doc_id, lang || ':' || sha256(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) AS term_id, sha256(text) AS payload_hash FROM documents")
def term_ids(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select("doc_id", text.term_id(F.col("lang"), F.col("text")).alias("term_id"), text.payload_hash(F.col("text")).alias("payload_hash"))


@registered("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_id % 3 < 2 AS needs_rates, CASE WHEN length(CAST(event_id AS VARCHAR)) < 5 THEN lpad(CAST(event_id AS VARCHAR), 5, '0') ELSE CAST(event_id AS VARCHAR) END AS code,
  CAST(least(4096, greatest(512, 96 * (event_id % 60))) AS BIGINT) AS max_tokens FROM events
""")
def payload_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and members of JSON payloads, padded codes and call budgets."""
    i = F.col("event_id")
    payload = F.element_at(F.array(F.lit('{"kapital":{"belop":null}}'), F.lit('{"kapital":{"valuta":"NOK"}}'), F.lit('{"kapital":{"type":"x"}}')), (i % 3 + 1).cast("int"))
    return table(spark, sf, "events").select(
        "event_id", money.json_number(F.col("props"), "$.k").alias("k"), translation.needs_rates(payload).alias("needs_rates"),
        text.digits_padded(F.concat(F.lit(" "), i.cast("string"))).alias("code"), text.max_answer_tokens(i % 60).cast("long").alias("max_tokens"),
    )


@registered("""
WITH b AS (SELECT c_custkey, CAST(('0x' || substring(sha256('seed:translate:' || c_name), 1, 8)) AS BIGINT) % 100 AS b FROM customer)
SELECT c_custkey, CAST(b AS INTEGER) AS bucket, CASE WHEN b < 10 THEN 'failed' WHEN b < 20 THEN 'not_found' ELSE 'succeeded' END AS outcome FROM b
""")
def mock_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic outcomes of the mock service."""
    c = table(spark, sf, "customer")
    return c.select("c_custkey", scoring.bucket(F.lit("seed"), F.lit("translate"), F.col("c_name")).alias("bucket"), discovery.mock_outcome("seed", "translate", F.col("c_name")).alias("outcome"))


# Plans


@registered("""
SELECT CAST(doc_id AS BIGINT) AS id, 'succeeded' AS status, 'legal_form' AS category, lang AS text, '[mock-en] ' || lang AS translated FROM documents
UNION ALL SELECT doc_id, 'succeeded', 'status', source, '[mock-en] ' || source FROM documents
""")
def translated_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records through terms, distinct items, the injected mock translator and results."""
    d = table(spark, sf, "documents")
    payload = F.to_json(F.struct(F.col("lang").alias("company_type"), F.col("source").alias("registration_status")))
    records = d.select(F.col("doc_id").alias("id"), payload.alias("payload"))
    items = translation.service_items(translation.extract_terms(records, "cvr"))
    # Only distinct items reach the translator.
    answers = translation.translate(merge.first_per_key(items, ["item_id"], [F.col("text")]), translation.mock_translator)
    out = translation.record_results(records, items, answers)
    terms = F.from_json(F.get_json_object("payload", "$.terms"), "array<struct<category:string,text:string,translated_text:string>>")
    return out.select("id", "status", F.explode(terms).alias("t")).select("id", "status", "t.category", "t.text", F.col("t.translated_text").alias("translated"))


@registered("""
SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal < 0 THEN 'negative amount not supported' END AS error,
  CASE WHEN c_acctbal >= 0 THEN CAST(round(c_acctbal / CAST(11.5 AS DOUBLE) * CAST(1.09 AS DOUBLE) * CAST(100 AS DOUBLE)) AS BIGINT) END AS cents,
  CASE WHEN c_acctbal >= 0 THEN '[mock-en] ' || c_mktsegment END AS form FROM customer
""")
def english_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """English BRREG payloads with translated terms and converted capital."""
    c = table(spark, sf, "customer")
    payload = F.to_json(
        F.struct(F.col("c_name").alias("navn"), F.struct(F.col("c_mktsegment").alias("beskrivelse")).alias("organisasjonsform"), F.struct(F.col("c_acctbal").alias("belop"), F.lit("NOK").alias("valuta")).alias("kapital"))
    )
    rows = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), payload.alias("payload"))
    terms = translation.extract_terms(rows, "brreg")
    known = merge.unique_terms(terms).withColumn("translated_text", translation.mock_translation(F.col("text")))
    ready = rows.join(translation.translation_maps(terms, known), "id", "left").withColumns(
        {"source_rate": F.lit(11.5), "usd_rate": F.lit(1.09), "rate_source": F.lit("ecb"), "rate_date": F.lit("2026-05-20")}
    )
    out = translation.brreg_english(ready).join(rows.select("id", "name"), "id")
    field = lambda p: F.get_json_object("payload_en", p)
    return out.select("id", "name", "error", field("$.capital.amount_usd_cents").cast("long").alias("cents"), field("$.organization_form.description").alias("form"))


# Streams


@registered("SELECT CAST(user_id AS VARCHAR) AS native_id, sha256(props) AS payload_hash, max(ts) AS last_seen_at, 'stream' AS run_id FROM events GROUP BY ALL")
def streamed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of payloads into versioned snapshots, all that is there now; the last snapshot is returned."""
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = stream.select(
        F.col("user_id").cast("string").alias("native_id"), F.sha2("props", 256).alias("payload_hash"), F.col("ts").alias("last_seen_at"), F.lit("stream").alias("run_id")
    )
    empty = spark.createDataFrame([], rows.schema)
    sink = pull.SnapshotSink(shared_path(spark, "stream-snapshots"), empty, lambda t, r: upsert.upsert_by_hash(t, r, "native_id"), "native_id")
    query = pull.run_available(rows, sink, shared_path(spark, "stream-checkpoint"))
    return sink.snapshot(spark, query.lastProgress["batchId"] if query.lastProgress else 0)


@registered("""
SELECT CAST(user_id AS VARCHAR) AS key, CAST(n AS INTEGER) AS attempt, CASE WHEN n = 1 THEN 'failed' ELSE 'succeeded' END AS outcome
FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id) AS n FROM events)
""")
def streamed_fail_once(spark: SparkSession, sf: str) -> DataFrame:
    """State per key over a stream: the first call fails, later ones succeed."""
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    outcomes = pull.fail_once(stream.select(F.col("user_id").cast("string").alias("key")))
    path = shared_path(spark, "stream-outcomes")
    query = outcomes.writeStream.format("parquet").option("path", path).option("checkpointLocation", shared_path(spark, "stream-checkpoint")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(outcomes.schema).parquet(path)


@registered("SELECT o_orderkey AS item, CAST((o_custkey + o_orderkey) % 3 AS INTEGER) AS attempt FROM orders")
def retried_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items that a flaky service leaves unanswered are sent again, three rounds in all."""
    items = table(spark, sf, "orders").select(F.col("o_orderkey").alias("item"), (F.col("o_custkey") + F.col("o_orderkey")).alias("load"))
    answered = lambda left, attempt: left.filter(F.col("load") % 3 <= attempt).select("item", F.lit(attempt).alias("attempt"))
    return pull.retry_missing(items, answered, "item", 3)


@registered("""
WITH e AS (SELECT user_id || '-' || day(ts) AS task, event_id, ts AS moment, CASE event_type WHEN 'signup' THEN 'created' WHEN 'click' THEN 'claimed' WHEN 'view' THEN 'failed_retryable' WHEN 'error' THEN 'failed_terminal' ELSE 'succeeded' END AS kind FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY moment, kind) AS n FROM e), f AS (SELECT *, min(CASE WHEN kind IN ('succeeded', 'failed_terminal') THEN n END) OVER (PARTITION BY task) AS fin FROM o),
l AS (SELECT task, count(*) FILTER (kind = 'claimed') AS attempts, arg_max(kind, n) AS kind, arg_max(moment, n) + INTERVAL 1 HOUR * arg_max(event_id % 500, n) AS until FROM f WHERE fin IS NULL OR n <= fin GROUP BY 1),
d AS (SELECT *, kind IN ('claimed', 'failed_retryable') AS timed, until <= (SELECT max(ts) FROM events) AS due FROM l)
SELECT task, CAST(attempts AS INTEGER) AS attempts, timed AND NOT due AS waits, CASE WHEN kind = 'created' OR (timed AND due) THEN 'pending' WHEN kind = 'claimed' THEN 'running' ELSE kind END AS status FROM d
""")
def task_machine(spark: SparkSession, sf: str) -> DataFrame:
    """Tasks after a stream of their events: leases that ran out and retries that came due by the last event's time are pending again."""
    kinds = {"signup": "created", "click": "claimed", "view": "failed_retryable", "error": "failed_terminal", "purchase": "succeeded"}
    stream = spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("event_type")]
    until = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + (F.col("event_id") % 500) * 3_600_000_000)
    events = stream.select(F.concat(F.col("user_id").cast("string"), F.lit("-"), F.dayofmonth("ts").cast("string")).alias("task"), kind.alias("kind"), F.col("ts").cast("timestamp").alias("at"), until.alias("until"))
    done = tasks.current_tasks(tasks.run_tasks(events, shared_path(spark, "tasks")))
    return done.select("task", "attempts", F.col("until").isNotNull().alias("waits"), "status")


#: Both modules register into the same two tables.
__all__ = ["ORACLE_SQL", "QUERIES", "registry_queries"]
