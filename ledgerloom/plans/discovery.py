"""Discovery of companies' web domains: signals, candidates, site checks and the decision."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.domains import candidate_domains, domain_of_url, normalized_url, safe_domain, unwrapped_url
from ledgerloom.functions.scoring import bucket, site_check, with_context, with_known_site
from ledgerloom.functions.text import bound
from ledgerloom.operators.lookups import exclusion_reason
from ledgerloom.operators.merge import first_per_key, top_per_key

#: Confidence of each signal, and the order in which they count.
SIGNALS = [("duckduckgo", 70), ("wikidata", 85), ("certsh", 60), ("heuristic", 40)]
CONFIDENCE, ORDER = dict(SIGNALS), {name: n for n, (name, _) in enumerate(SIGNALS)}
#: Links looked at and kept of a search page; candidates, checks and threshold of a discovery.
LINKS_SEEN, LINKS_KEPT, CANDIDATES, SITE_CHECKS, THRESHOLD = 15, 5, 5, 3, 50


def link_signal(links: DataFrame, signal: str = "duckduckgo") -> DataFrame:
    """(native_id, domain, signal, confidence, pos) from search links (native_id, pos, href): the first few domains."""
    # A generator's column is computed once; a filter on a plain one would compute it again.
    seen = links.filter(F.col("pos") < LINKS_SEEN).select("*", F.explode(F.array(safe_domain(F.col("href")))).alias("domain"))
    named = seen.filter(F.col("domain").isNotNull() & ~F.contains("domain", F.lit("duckduckgo.com")))
    firsts = first_per_key(named, ["native_id", "domain"], [F.col("pos")])
    kept = top_per_key(firsts, ["native_id"], [F.col("pos")], LINKS_KEPT)
    return kept.select("native_id", "domain", F.lit(signal).alias("signal"), F.lit(CONFIDENCE[signal]).alias("confidence"), "pos")


def heuristic_signal(companies: DataFrame, resolves: Callable[[Column], Column]) -> DataFrame:
    """Guessed domains (native_id, name, country) that `resolves` accepts."""
    guessed = companies.select("native_id", F.posexplode(candidate_domains(F.col("name"), F.col("country"))).alias("pos", "domain"))
    return guessed.filter(resolves(F.col("domain"))).select("native_id", "domain", F.lit("heuristic").alias("signal"), F.lit(CONFIDENCE["heuristic"]).alias("confidence"), "pos")


def first_signals(*signals: DataFrame) -> DataFrame:
    """One row per company and domain: the first signal that found it, whatever the others' confidence."""
    every = signals[0]
    for more in signals[1:]:
        every = every.unionByName(more)
    place = F.create_map(*[F.lit(x) for k, v in ORDER.items() for x in (k, v)])[F.col("signal")]
    return first_per_key(every, ["native_id", "domain"], [place, F.col("pos")])


def external_call(rows: DataFrame, call: Callable[[dict], dict], schema: str) -> DataFrame:
    """Rows through an injected client in the tasks; a row whose call raises gets a null answer."""
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                try:
                    answer = call(row)
                except Exception as error:  # one company's failure is not the batch's
                    answer = {"error": f"{type(error).__name__}: {error}"}
                out.append({**row, **answer})
            yield pd.DataFrame({c: pd.Series([r.get(c) for r in out], dtype=object) for c in names})

    return rows.mapInPandas(run, schema)


def page_candidates(links: DataFrame, limit: int = CANDIDATES) -> DataFrame:
    """Candidates (company_id, url, domain, score, excluded, pos) of a search page's links (company_id, pos, link)."""
    # Generators' columns are computed once; filters on plain ones would compute all that they are made of again.
    named = lambda url: F.struct(url.alias("url"), domain_of_url(url).alias("domain"))
    rows = links.select("*", F.inline(F.array(bound(unwrapped_url(F.col("link")), named)))).filter("domain <> ''")
    rows = rows.select("*", F.explode(F.array(exclusion_reason(F.col("domain"))["reason"])).alias("excluded"))
    rows = rows.filter(F.coalesce(F.col("excluded"), F.lit("")) != "search_provider")
    firsts = first_per_key(rows, ["company_id", "domain"], [F.col("pos")])
    return top_per_key(firsts, ["company_id"], [F.col("pos")], limit).select("company_id", "url", "domain", F.lit(THRESHOLD).alias("score"), "excluded", "pos")


def scored_candidates(answers: DataFrame, limit: int = CANDIDATES) -> DataFrame:
    """As `page_candidates`, from a model's scored candidates (company_id, pos, url, domain, score)."""
    rows = answers.withColumn("url", normalized_url(F.col("url"))).filter("url <> ''")
    rows = rows.withColumn("domain", F.coalesce(F.nullif(domain_of_url(F.concat(F.lit("https://"), "domain")), F.lit("")), domain_of_url(F.col("url")))).filter("domain <> ''")
    firsts = first_per_key(rows, ["company_id", "domain"], [F.col("pos")])
    kept = top_per_key(firsts, ["company_id"], [F.col("pos")], limit)
    return kept.select("company_id", "url", "domain", "score", exclusion_reason(F.col("domain"))["reason"].alias("excluded"), "pos")


def to_check(candidates: DataFrame, threshold: int = THRESHOLD, most: int = SITE_CHECKS) -> DataFrame:
    """Candidates that are worth a site check, in order."""
    good = candidates.filter((F.col("score") >= threshold) & (F.coalesce(F.col("excluded"), F.lit("")) != "search_provider"))
    return top_per_key(good, ["company_id"], [F.col("pos")], most)


def site_checks(crawls: DataFrame) -> DataFrame:
    """Checks of crawled candidates (company_id, pos, url, domain, crawl_status, answer)."""
    domain, answer = F.col("domain"), F.col("answer")
    check = with_context(with_known_site(site_check(answer, domain, F.col("crawl_status")), domain), answer)
    return crawls.withColumn("check", check).select("company_id", "pos", "url", "domain", "check.*")


def decide(checks: DataFrame, failed: DataFrame | None = None, threshold: int = THRESHOLD) -> DataFrame:
    """One row per company: status, best_domain, domains, related_sites and primary_site."""
    good = checks.filter((F.col("score") >= threshold) & (F.col("decision") != "rejected"))
    order = [F.col("score").desc(), F.col("pos")]
    owned = first_per_key(good.filter("site_type = 'company_website' and owned_domain and domain <> ''"), ["company_id", "domain"], order)
    related = first_per_key(good.filter("relationship <> 'unrelated'"), ["company_id", "url", "domain"], order)
    ranked = lambda name, *cols: F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("o"), "pos", F.struct(*cols).alias("v")))), lambda x: x["v"]).alias(name)
    domains = owned.groupBy("company_id").agg(ranked("domains", "domain", "score"))
    primary = F.col("relationship") == "primary_web_presence"
    sites = related.groupBy("company_id").agg(
        ranked("related_sites", "url", "domain", "score", "site_type", "relationship", "owned_domain"),
        F.max_by(F.when(primary, F.struct("url", "score")), F.when(primary, F.struct("owned_domain", "score", (-F.col("pos")).alias("p")))).alias("primary_site"),
    )
    ids = checks.select("company_id").distinct()
    if failed is not None:
        ids = ids.union(failed.select("company_id")).distinct()
    out = ids.join(domains, "company_id", "left").join(sites, "company_id", "left")
    if failed is not None:
        out = out.join(failed.select("company_id", F.lit(True).alias("__failed")), "company_id", "left")
    else:
        out = out.withColumn("__failed", F.lit(None).cast("boolean"))
    status = F.when(F.col("__failed"), "failed").when(F.col("domains").isNotNull() | F.col("related_sites").isNotNull(), "succeeded").otherwise("not_found")
    return out.select("company_id", status.alias("status"), F.col("domains")[0]["domain"].alias("best_domain"), "domains", "related_sites", "primary_site")


def website_or_search(companies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Companies whose own website is checked at once, and those that are searched for."""
    url = normalized_url(F.col("website"))
    split = companies.withColumn("url", url)
    return split.filter("url <> ''"), split.filter("url = ''").drop("url")


def mock_outcome(seed: str, task: str, key: Column) -> Column:
    """Outcome of the mock service: 10 of 100 fail, 10 are not found, the others succeed."""
    b = bucket(F.lit(seed), F.lit(task), key)
    return F.when(b < 10, "failed").when(b < 20, "not_found").otherwise("succeeded")
