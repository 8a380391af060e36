"""Scores, decisions and site checks of domain discovery, over columns of a model's loosely typed answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import bound, null_if_empty, trimmed
from ledgerloom.operators.lookups import exclusion_reason, site_kind

#: Words for a score, strongest first.
SCORE_WORDS = [(("very high", "strong"), 95), (("high",), 90), (("medium", "moderate"), 60), (("low", "weak"), 30), (("none", "no match"), 0)]
#: Words for a decision.
ACCEPTED = ["accepted", "accept", "related", "matched", "match", "likely_related"]
REJECTED = ["rejected", "reject", "unrelated", "not_related", "no_match"]
#: Kinds of sites and how a site may relate to a company.
SITE_TYPES = ["company_website", "social_profile", "directory_profile", "registry_profile", "reference_page", "marketplace_profile", "unrelated"]
RELATIONSHIPS = ["primary_web_presence", "evidence_profile", "supporting_reference", "unrelated"]
#: Scopes in which a page is about another entity than the company itself.
WIDER_SCOPES = ["parent_group", "affiliate", "umbrella_organization"]


def score(value: Column) -> Column:
    """0..100 of a number, a text with one, or words for one."""
    return bound(F.lower(trimmed(value)), _points)


def _points(low: Column) -> Column:
    number = null_if_empty(F.regexp_extract(low, r"\b(\d{1,3})\b", 1)).cast("int")
    words = F.when(F.lit(False), F.lit(0))
    for said, points in SCORE_WORDS:
        hit = F.lit(False)
        for w in said:
            hit = hit | F.contains(low, F.lit(w))
        words = words.when(hit, points)
    whole = low.try_cast("int")
    return F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce(number, words, whole, F.lit(0))))


def decision(value: Column) -> Column:
    word = F.regexp_replace(F.lower(trimmed(F.coalesce(value, F.lit("uncertain")))), "[- ]", "_")
    return F.when(word.isin(*ACCEPTED), "accepted").when(word.isin(*REJECTED), "rejected").otherwise("uncertain")


def site_check(answer: Column, final_domain: Column, crawl_status: Column) -> Column:
    """struct<score, decision, site_type, relationship, owned_domain> of a verification answer (JSON text)."""
    said = lambda k: F.get_json_object(answer, f"$.{k}")
    verdict = F.when(crawl_status != "succeeded", "rejected").otherwise(decision(said("decision")))
    return bound(F.struct(verdict.alias("decision"), exclusion_reason(final_domain).isNull().alias("own")), lambda v: _check(said, v["decision"], v["own"]))


def _check(said: Callable[[str], Column], verdict: Column, own: Column) -> Column:
    accepted = verdict == "accepted"
    site = F.lower(trimmed(F.coalesce(null_if_empty(said("site_type")), F.lit("unrelated"))))
    site = F.when(accepted & said("site_type").isNull() & own, "company_website").otherwise(site)
    own_site = site == "company_website"
    relation = F.lower(trimmed(F.coalesce(null_if_empty(said("relationship")), F.lit("unrelated"))))
    relation = F.when(accepted & said("relationship").isNull() & own_site, "primary_web_presence").otherwise(relation)
    owned = F.when(accepted & said("owned_domain").isNull() & own_site, True).otherwise(F.coalesce(~said("owned_domain").isin("", "0", "false"), F.lit(False)))
    return F.struct(
        score(F.coalesce(said("score"), said("confidence"))).alias("score"),
        verdict.alias("decision"),
        F.when(site.isin(*SITE_TYPES), site).otherwise("unrelated").alias("site_type"),
        F.when(relation.isin(*RELATIONSHIPS), relation).otherwise("unrelated").alias("relationship"),
        owned.alias("owned_domain"),
    )


def with_known_site(check: Column, domain: Column) -> Column:
    """A site check after what is known of the site: never owned; a social profile counts as a presence."""
    return bound(F.struct(check.alias("check"), site_kind(domain).alias("kind")), lambda x: _known(x["check"], x["kind"]))


def _known(check: Column, kind: Column) -> Column:
    site = F.coalesce(kind["site_type"], check["site_type"])
    relation = F.coalesce(kind["relationship"], check["relationship"])
    social = (site == "social_profile") & (F.coalesce(relation, F.lit("")).isin("", "unrelated"))
    return F.when(kind.isNull(), check).otherwise(
        F.struct(
            check["score"].alias("score"), check["decision"].alias("decision"), site.alias("site_type"),
            F.when(social, "primary_web_presence").otherwise(relation).alias("relationship"), F.lit(False).alias("owned_domain"),
        )
    )


def with_context(check: Column, answer: Column) -> Column:
    """A site check after the context rules: without legal identity, a conflicting activity makes a company site
    uncertain (60 at most), and a wider scope makes it a supporting reference (80 at most)."""
    return bound(check, lambda c: _in_context(c, answer))


def _in_context(check: Column, answer: Column) -> Column:
    said = lambda k: F.lower(trimmed(F.coalesce(F.get_json_object(answer, f"$.{k}"), F.lit(""))))
    truth = lambda k: F.coalesce(~F.get_json_object(answer, f"$.identity_signals.{k}").isin("", "0", "false"), F.lit(False))
    legal = truth("legal_name") | truth("organization_number") | truth("address_or_city")
    own = (check["site_type"] == "company_website") & ~legal
    conflict, wider = own & (said("activity_alignment") == "conflicting"), own & said("entity_scope").isin(*WIDER_SCOPES)
    most = F.when(conflict, F.least(check["score"], F.lit(60))).when(wider, F.least(check["score"], F.lit(80))).otherwise(check["score"])
    return F.struct(
        most.alias("score"),
        F.when(conflict, "uncertain").otherwise(check["decision"]).alias("decision"),
        check["site_type"].alias("site_type"),
        F.when(conflict, "unrelated").when(wider, "supporting_reference").otherwise(check["relationship"]).alias("relationship"),
        (check["owned_domain"] & ~conflict & ~wider).alias("owned_domain"),
    )


def bucket(*parts: Column) -> Column:
    """0..99 from a hash of the parts: deterministic outcomes of mock services."""
    return (F.conv(F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 8), 16, 10).cast("long") % 100).cast("int")
