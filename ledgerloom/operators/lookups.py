"""Joins against caches, domain lists and dated rates."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.domains import domain_suffixes, normalized_domain
from ledgerloom.functions.text import bound

#: Directories whose pages describe companies but are not theirs.
DIRECTORY_DOMAINS = [
    "1881.no", "21st.ai", "creditsafe.com", "dnb.com", "eniro.no", "europages.co.uk", "firmadatabasen.no", "gulesider.no", "infobel.com",
    "kompass.com", "largestcompanies.com", "nor47business.com", "norwayregistry.org", "norsktakst.no", "proff.no", "purehelp.no",
    "regnskapstall.no", "takserer.no", "webagent.no", "yra.no",
]
#: Public registries.
REGISTRY_DOMAINS = ["brreg.no", "virk.dk"]
#: Social networks.
SOCIAL_DOMAINS = ["facebook.com", "instagram.com", "linkedin.com", "tiktok.com", "twitter.com", "x.com", "youtube.com"]
#: Encyclopedias.
REFERENCE_DOMAINS = ["wikipedia.org", "wikidata.org"]
#: Search engines.
SEARCH_DOMAINS = ["duckduckgo.com", "duckduckgo.io", "yandex.com", "yandex.ru", "ya.ru"]


def not_yet(ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of `ids` whose key is not among those done."""
    return ids.join(done.select(key), key, "left_anti")


#: Bits of the filter for each new id, of which two are set, and the most that all maps together have (64 MB to broadcast).
BITS_PER_ID, MOST_BITS = 32, 1 << 29
#: Bits that Spark's bitmap functions put in one map.
MAP = 32_768


def may_hold(rows: DataFrame, key: str, of: DataFrame, n: int) -> DataFrame:
    """The rows whose key may be among those of `of` (about n): all that are, and about one of 260 others.

    A Bloom filter of two bits a key, in maps of 32,768 bits by the key's hash. Executors build the maps; they are broadcast, BITS_PER_ID
    bits a key in all, and rows are dropped where they are read."""
    maps = max(1, -(-n * BITS_PER_ID // MAP))
    if maps * MAP > MOST_BITS:
        return rows
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(maps)).cast("int")
    place = lambda c, salt: F.pmod(F.xxhash64(F.lit(salt), c), F.lit(MAP))
    bits = of.select(bucket(key).alias("__bucket"), F.explode(F.array(place(key, 1), place(key, 2))).alias("__place"))
    built = bits.groupBy("__bucket").agg(F.bitmap_construct_agg("__place").alias("__bits"))

    def is_set(salt: int) -> Column:
        at = place(key, salt)
        byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0

    met = rows.withColumn("__bucket", bucket(key)).join(F.broadcast(built), "__bucket").filter(is_set(1) & is_set(2))
    return met.select(*rows.columns)


def not_yet_of_many(ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """As `not_yet` where `done` is much larger than `ids` (read three times) and grows: of the keys done, only those that may be among the
    ids are shuffled, so what is moved follows the ids. Past 16 million ids it is a plain anti-join."""
    wanted = ids.filter(F.col(key).isNotNull())
    return ids.join(may_hold(done.select(key), key, wanted, wanted.count()), key, "left_anti")


def known(ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return ids.join(done.select(key), key, "left_semi")


def need_discovery(companies: DataFrame, raw_ids: DataFrame, bridge: DataFrame) -> DataFrame:
    """Companies without an active domain. Raises if a company has no raw id."""
    lost = companies.join(raw_ids, "native_id", "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"no raw input for {lost[0]['native_id']}")
    active = bridge.filter("status = 'active'").select("raw_id")
    return companies.join(raw_ids, "native_id").join(active, "raw_id", "left_anti")


def cache_lookup(terms: DataFrame, cache: DataFrame, source_lang: str, target_lang: str, prompt_version: str, model: str) -> DataFrame:
    """Terms (category, text, original_hash) with their cached translation, null where there is none.

    The cache's other key columns are constants of a run, so they are filters that reach its scan."""
    usable = cache.filter(
        (F.col("source_lang") == source_lang) & (F.col("target_lang") == target_lang) & (F.col("prompt_version") == prompt_version) & (F.col("model") == model)
    ).select("category", "original_hash", "translated_text")
    return terms.join(usable, ["category", "original_hash"], "left")


def hit_rates(looked_up: DataFrame) -> DataFrame:
    hits = F.count_if(F.col("translated_text").isNotNull())
    return looked_up.groupBy("category").agg(
        hits.alias("hits"), F.count_if(F.col("translated_text").isNull()).alias("misses"), (hits / F.count(F.lit(1))).alias("hit_rate")
    )


def translated(terms: DataFrame, translations: DataFrame, category: str = "category", text: str = "text", out: str = "translated") -> DataFrame:
    """Each term's translation in its category, else in any (category ''); null if it has none."""
    exact = translations.filter("category <> ''").select(F.col("category").alias("__c"), F.col("text").alias("__t"), F.col("translated_text").alias("__exact"))
    plain = translations.filter("category = ''").select(F.col("text").alias("__p"), F.col("translated_text").alias("__plain"))
    return (
        terms.join(exact, (F.col(category) == F.col("__c")) & (F.col(text) == F.col("__t")), "left")
        .join(plain, F.col(text) == F.col("__p"), "left")
        .withColumn(out, F.coalesce(F.nullif("__exact", F.lit("")), F.nullif("__plain", F.lit(""))))
        .drop("__c", "__t", "__exact", "__p", "__plain")
    )


def suffix_match(rows: DataFrame, domain: str, suffixes: DataFrame, suffix: str = "suffix", out: str = "matched") -> DataFrame:
    """The longest entry of `suffixes` that a domain equals or is below, else null.

    Every parent of a distinct domain is looked up by equality, so no pair is tried in vain."""
    parents = rows.select(F.col(domain).alias("__d")).distinct().select("__d", F.explode(domain_suffixes(F.col("__d"))).alias("__s"))
    named = suffixes.select(F.col(suffix).alias("__s")).distinct()
    best = parents.join(named, "__s").groupBy("__d").agg(F.max_by("__s", F.length("__s")).alias(out))
    return rows.join(best, F.col(domain) == F.col("__d"), "left").drop("__d")


def listed_suffix(domain: Column, listed: Sequence[str]) -> Column:
    """As `suffix_match` for a short fixed list, without a join."""
    if not listed:
        return F.lit(None).cast("string")
    # Most domains are below no entry, which one pattern tells.
    below = domain.rlike(rf"(?:^|\.)(?:{'|'.join(map(re.escape, listed))})\z")
    return F.when(below, F.get(F.filter(domain_suffixes(domain), lambda s: s.isin(*listed)), F.lit(0)))


def exclusion_reason(domain: Column, excluded: Sequence[str] = (*DIRECTORY_DOMAINS, *REGISTRY_DOMAINS), allowed: Sequence[str] = ()) -> Column:
    """struct<reason, matched>: why a domain is no candidate; null if it may be one."""

    def why(d: Column) -> Column:
        reason = lambda name, listed, other: bound(listed_suffix(d, listed), lambda at: F.when(at.isNotNull(), F.struct(F.lit(name).alias("reason"), at.alias("matched"))).otherwise(other))
        nothing = F.lit(None).cast("struct<reason:string,matched:string>")
        found = reason("search_provider", SEARCH_DOMAINS, reason("directory_or_registry", excluded, nothing))
        return F.when((d != "") & listed_suffix(d, allowed).isNull(), found)

    return bound(normalized_domain(domain), why)


def site_kind(domain: Column) -> Column:
    """struct<site_type, relationship> of well-known sites, else null; relationship may be null."""
    kind = lambda site, relation: F.struct(F.lit(site).alias("site_type"), F.lit(relation).cast("string").alias("relationship"))
    return bound(
        normalized_domain(domain),
        lambda d: F.when(listed_suffix(d, SOCIAL_DOMAINS).isNotNull(), kind("social_profile", None))
        .when(listed_suffix(d, REFERENCE_DOMAINS).isNotNull(), kind("reference_page", "supporting_reference"))
        .when(listed_suffix(d, REGISTRY_DOMAINS).isNotNull(), kind("registry_profile", "evidence_profile"))
        .when(listed_suffix(d, DIRECTORY_DOMAINS).isNotNull(), kind("directory_profile", "evidence_profile")),
    )


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], left_at: str, right_at: str, values: Sequence[str]) -> DataFrame:
    """Each left row with the values of the latest right row of its key that is not later; null if none is.

    Both sides are laid in one order per key and the last right values are carried forward: one shuffle, no pairs."""
    carried = [F.struct(F.col(right_at).alias("at"), *values)]
    r = right.select(*by, F.col(right_at).alias("__at"), F.lit(0).alias("__side"), *[c.alias("__right") for c in carried])
    l = left.select(*by, F.col(left_at).alias("__at"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__left"))  # noqa: E741
    both = l.unionByName(r, allowMissingColumns=True)
    window = Window.partitionBy(*by).orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("__right", F.last("__right", ignorenulls=True).over(window)).filter("__side = 1")
    return found.select("__left.*", F.col("__right.at").alias(right_at), *[F.col(f"__right.{v}").alias(v) for v in values])


def rates_on(dates: DataFrame, rates: DataFrame) -> DataFrame:
    """Rates (rate_date, currency, rate) in force on each day of `dates` (day): the latest day that is not later.

    The distinct days of both sides stand in one order and the last published one is carried forward. They are
    days of a calendar, some thousand at any size of the tables, so one window may hold them."""
    asked = dates.select("day", F.lit(True).alias("asked"), F.lit(None).cast("date").alias("rate_date"))
    published = rates.select(F.col("rate_date").alias("day"), F.lit(False).alias("asked"), "rate_date")
    days = asked.union(published).groupBy("day").agg(F.max("asked").alias("asked"), F.max("rate_date").alias("rate_date"))
    in_force = F.last("rate_date", ignorenulls=True).over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return days.withColumn("rate_date", in_force).filter("asked and rate_date is not null").select("day", "rate_date").join(rates, "rate_date")
