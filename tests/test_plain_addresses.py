"""Addresses of usual form are told by one pattern; odd ones take the longer way, and both ways agree."""

from pyspark.sql import functions as F

from ledgerloom.functions import domains, text
from ledgerloom.plans import discovery, registries

ODD = [
    "", " ", "https://a.no", "https://A.No/x", "http://www.a.no:80/x", "https://www.www.a.no", "https://u:p@a.no/x", "https://a.b@c.no", "https://a.no:8@c.no", "https://-a.no", "https://a-.no",
    "https://a..no", "https://.a.no.", "https://a", "https://localhost/x", "https://10.0.0.1/x", "https://a.n0/", "https://a.no\n", "https://a.no/x y", "https://a.no/æ", "ftp://a.no", "a.no", "www.A.no", "a.no/x",
    "www", "www.", "//a.no", "HTTPS://a.no?x#y", "https://a.no?u=b.no", "https://a.no#?u=b.no", "https://a.no/?q=1&url=https%3A%2F%2Fc.no", " a.no\x85", "https://a.no:99999", "https://*.a.no/x", None,
]


def test_plain_forms_agree_with_the_longer_way(spark):
    u = F.col("u")
    trimmed = text.trimmed(text.empty_if_null(u))
    long_domain = F.when(trimmed.rlike("^(?i:https?)://[^/?#]"), domains._bare_host(domains._netloc(trimmed))).otherwise(F.lit(""))
    pairs = {
        "trimmed": (text.trimmed(u), F.regexp_replace(u, rf"^{text.SPACE}+|{text.SPACE}+$", "")),
        "normalized_url": (domains.normalized_url(u), domains._with_scheme(trimmed)), "normalized_domain": (domains.normalized_domain(u), domains._host_of(trimmed)),
        "domain_of_url": (domains.domain_of_url(u), long_domain), "safe_domain": (domains.safe_domain(u), domains._safe_host(u)),
        "unwrapped_url": (domains.unwrapped_url(u), text.bound(domains.normalized_url(u), lambda x: domains._first_target(F.regexp_extract(x, r"\?([^#]*)", 1), x))),
    }
    rows = spark.createDataFrame([(x,) for x in ODD], "u string").select("u", *[c.alias(f"{n}{i}") for n, both in pairs.items() for i, c in enumerate(both)]).collect()
    for r in rows:
        for name in pairs:
            assert r[f"{name}0"] == r[f"{name}1"], (name, r["u"])


def analyzed(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_links_are_read_once(spark):
    """Filters on columns used to be moved below them, each with all that the column is made of."""
    pages = spark.createDataFrame([(1, 1, "https://a.no")], "company_id long, pos long, link string")
    assert analyzed(discovery.page_candidates(pages)).count("uddg") <= 3
    links = pages.withColumnsRenamed({"company_id": "native_id", "link": "href"})
    assert analyzed(discovery.link_signal(links)).count("25[0-5]") <= 3


def test_members_of_records_are_read_once(spark):
    records = spark.createDataFrame([(0, 1, "{}")], "file_ord int, record_no long, record string")
    assert analyzed(registries.gleif_companies(records)).count("get_json_object") <= 45
    names = spark.createDataFrame([("a", "NO")], "n string, c string").select(domains.candidate_domains(F.col("n"), F.col("c")).alias("d"))
    assert analyzed(names).count("aksjeselskap") == 1
