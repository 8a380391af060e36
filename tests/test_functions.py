import hashlib
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import domains, money, scoring, text
from ledgerloom.operators import lookups


def one(spark, column, **values):
    schema = ", ".join(f"`{k}` {'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("r")).first()["r"]


def each(spark, f, cases):
    df = spark.createDataFrame([(k,) for k, _ in cases], "x string")
    got = [r["r"] for r in df.select(f(F.col("x")).alias("r")).collect()]
    assert got == [v for _, v in cases]


def test_normalized_domain(spark):
    """Scheme, user, port, path, outer dots and one leading www. go; case is folded."""
    hosts = ["lund.se", "a.b.lund.se", "xn--bl-wia.dk", "lund.se."]
    cases = [(f"{scheme}{user}{www}{host.upper()}{port}{path}", host.strip("."))
             for host in hosts for scheme in ("", "ftp://") for user in ("", "me:pw@") for www in ("", "www.") for port in ("", ":81") for path in ("", "/p/q")
             if not (user and not scheme)]
    each(spark, domains.normalized_domain, [*cases, (None, ""), ("\t ", ""), ("..", "")])


def test_domain_of_url(spark):
    """Only http and https addresses have one."""
    hosts = [("http://LUND.se", "lund.se"), ("https://u@lund.se:8443#f", "lund.se"), ("  https://www.lund.se?z\n", "lund.se")]
    each(spark, domains.domain_of_url, [*hosts, ("lund.se", ""), ("gopher://lund.se", ""), ("http:///", ""), (None, "")])


def test_normalized_url(spark):
    """Addresses stay as they are, bare ones get a scheme; hosts, ports and schemes that cannot be give ''."""
    kept = ["https://lund.se", "http://a-b.lund.se:65535/x?y#z", "HTTPS://LUND.SE", "http://me@lund.se/", "https://localhost:3000", "http://xn--bl-wia.dk/"]
    bare = ["lund.se", "lund.se/a?b=c", "lund.se?b"]
    bad = ["two words.se", "http://lund", "http://lund.s", "http://lund.5e/", "http://a..se/", "http://-a.se/", "http://a-.se", "http://lund.se:65536", "http://lund.se:1x/",
           f"http://{'a' * 64}.se", "ssh://lund.se", "tel:123", "http://lund.se./", "http://a_b.se/", "http://[::1]/", "   "]
    each(spark, domains.normalized_url, [*((x, x) for x in kept), *((x, f"https://{x}") for x in bare), *((x, "") for x in bad), (f"http://{'a' * 63}.se", f"http://{'a' * 63}.se")])


def test_unwrapped_url(spark):
    """The first parameter that names a proper address counts, in the fixed order, quoted once or twice; else the address itself."""
    target = "https://lund.se/om?x=1"
    once, twice = (quote(target, safe=""), quote(quote(target, safe=""), safe=""))
    cases = [(f"http://s.example.se/r?{name}={q}&n=2#f", target) for name in domains.REDIRECT_PARAMETERS for q in (once, twice)]
    both = f"http://s.example.se/r?to={quote('http://late.se', safe='')}&uddg={once}"
    each(spark, domains.unwrapped_url, [*cases, (both, target), ("http://s.example.se/r?u=nowhere", "http://s.example.se/r?u=nowhere"), ("http://s.example.se/r?xurl=" + once, "http://s.example.se/r?xurl=" + once), ("?", "")])


def test_safe_domain(spark):
    """Hosts with a dot, without wildcards, that are neither an IP address nor local."""
    each(spark, domains.safe_domain, [
        ("*.*.lund.se", "lund.se"), ("HTTP://*.LUND.SE:8/p", "lund.se"), ("//cdn.lund.se/x", "cdn.lund.se"), ("http://a:b@lund.se..", "lund.se"), ("255.1.2.3", None), ("256.1.2.3", "256.1.2.3"),
        ("http://192.168.0.1:80/", None), ("localhost:8080", None), ("lund", None), ("", None), (None, None),
    ])


def test_result_link(spark):
    """A link of the search page itself stands for its target; other links stand for themselves."""
    own = [(f"{host}/l/?kh=1&uddg={quote('http://lund.se/å', safe='')}&v", "http://lund.se/å") for host in ("", "//duckduckgo.com", "https://html.duckduckgo.com", "http://www.duckduckgo.com")]
    each(spark, domains.result_link, [*own, ("https://duckduckgo.com/about", None), ("//duckduckgo.org/l/?uddg=x", "//duckduckgo.org/l/?uddg=x"), ("https://lund.se/?uddg=x", "https://lund.se/?uddg=x")])


def test_discovery_domain_keeps_www(spark):
    each(spark, domains.discovery_domain, [(" HTTPS://www.Fjord.no/a ", "www.fjord.no"), ("fjord.no:443", "fjord.no"), ("nodot", None), (".fjord.no.", "fjord.no"), ("", None)])


def test_signals_and_confidence(spark):
    each(spark, domains.discovery_signal, [(" CrtSH ", "certsh"), ("duckduckgo", "search"), ("?", "heuristic")])
    assert [one(spark, domains.clamped_confidence(F.col("x")), x=v) for v in (-5, 50, 500)] == [1, 50, 100]


def test_candidates(spark):
    def of(name, country):
        return one(spark, domains.candidate_domains(F.col("n"), F.col("c")), n=name, c=country)

    assert of("Fjord Data AS", "NO") == ["fjord-data.no", "fjorddata.no", "fjord-data.com", "fjorddata.com"]
    assert of("Acme Ltd", "GB") == ["acme.co.uk", "acme.com"] and of("Acme Inc", "us") == ["acme.com"]
    assert of("AS", "NO") == [] and of("24 Seven", "NO")[0] == "seven.no"


def test_search_page(spark):
    assert one(spark, domains.search_page("DuckDuckGo", F.col("t")), t="a b&c").endswith("q=a%20b%26c")
    with pytest.raises(ValueError):
        domains.search_page("other", F.lit("x"))


def test_suffix_lists(spark):
    each(spark, lambda d: lookups.exclusion_reason(d)["matched"], [("www.proff.no", "proff.no"), ("notproff.no", None), ("a.b.brreg.no", "brreg.no"), ("links.duckduckgo.com", "duckduckgo.com")])
    each(spark, lambda d: lookups.exclusion_reason(d, allowed=["proff.no"])["matched"], [("www.proff.no", None)])
    each(spark, lambda d: lookups.site_kind(d)["site_type"], [("no.wikipedia.org", "reference_page"), ("facebook.com", "social_profile"), ("fjord.no", None)])


def test_term_hash(spark):
    want = hashlib.sha256("aksjeselskap".encode()).hexdigest()
    assert want.startswith("4371a971") and want.endswith("8f74")
    each(spark, text.term_hash, [(" Aksjeselskap \t", want), ("AKSJESELSKAP\n", want)])


def test_codes(spark):
    each(spark, text.digits_padded, [("1110", "01110"), (" 62012 ", "62012"), ("123456", "123456"), ("A1", "A1"), ("", "")])
    each(spark, text.registry_key, [("Virksomheds-Status", "virksomhedsstatus"), ("Blå øl_æ", "blaaoelae")])
    assert text.header_key(" SIC_Code ") == "siccode"


def test_compact_lines(spark):
    assert one(spark, text.compact_lines(F.col("x")), x=" a  b \r\n\n\t c\n") == "a b\nc"
    long = "\n".join(["x" * 99] * 40)
    assert one(spark, text.compact_lines(F.col("x")), x=long) == "\n".join(["x" * 99] * 25)


def test_usd_cents(spark):
    def cents(amount, currency, rate, strict=True):
        return one(spark, money.usd_cents(F.col("a"), F.col("c"), F.col("r"), F.lit(1.09), strict), a=amount, c=currency, r=rate)

    assert cents(30000.0, "NOK", 11.5) == 284348
    assert cents(12.345, "USD", 0.0) == 1235 and cents(-1.0, "NOK", 11.5) is None and cents(1.0, "NOK", 0.0) is None
    assert cents(-1.0, "NOK", 1.09, strict=False) == -100


def test_capital(spark):
    def of(payload, rate=11.5):
        return one(spark, money.capital(F.col("p"), F.lit(rate), F.lit(1.09), F.lit("ecb"), F.lit("2026-05-20"), F.lit("Share capital")), p=payload)

    good = of('{"kapital":{"belop":30000,"valuta":"NOK","antallAksjer":100}}')
    assert good["error"] is None and good["value"]["amount_usd_cents"] == 284348 and good["value"]["amount"] == 2843.48 and good["value"]["shares"] == 100
    assert of('{"kapital":{"belop":1}}')["error"] and of('{"kapital":{"belop":-1,"valuta":"NOK"}}')["error"]
    none = of('{"navn":"x"}')
    assert none["error"] is None and none["value"] is None


def test_scores_and_decisions(spark):
    each(spark, scoring.score, [("87", 87), ("score: 120 of 150", 100), ("Very High", 95), ("high", 90), ("moderate", 60), ("weak", 30), ("no match", 0), (None, 0), ("abc", 0)])
    each(spark, scoring.decision, [("Likely Related", "accepted"), ("no-match", "rejected"), ("hm", "uncertain"), (None, "uncertain")])


def test_site_check_rules(spark):
    def check(answer, domain="fjord.no", status="succeeded"):
        c = scoring.site_check(F.col("a"), F.col("d"), F.col("s"))
        c = scoring.with_context(scoring.with_known_site(c, F.col("d")), F.col("a"))
        return one(spark, c, a=answer, d=domain, s=status).asDict()

    assert check('{"decision":"accepted","score":90}') == {"score": 90, "decision": "accepted", "site_type": "company_website", "relationship": "primary_web_presence", "owned_domain": True}
    assert check('{"decision":"accepted","score":90}', status="failed")["decision"] == "rejected"
    assert check('{"decision":"accepted","score":90}', domain="facebook.com") == {"score": 90, "decision": "accepted", "site_type": "social_profile", "relationship": "primary_web_presence", "owned_domain": False}
    conflict = check('{"decision":"accepted","score":90,"activity_alignment":"conflicting"}')
    assert (conflict["decision"], conflict["score"], conflict["owned_domain"]) == ("uncertain", 60, False)
    named = check('{"decision":"accepted","score":90,"activity_alignment":"conflicting","identity_signals":{"legal_name":true}}')
    assert named["decision"] == "accepted"
    wider = check('{"decision":"accepted","score":90,"entity_scope":"affiliate"}')
    assert (wider["score"], wider["relationship"], wider["owned_domain"]) == (80, "supporting_reference", False)
