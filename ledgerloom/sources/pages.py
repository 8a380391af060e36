"""Crawled pages: text, links and hash from stored HTML; fetching is injected by whoever has a network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.domains import domain_of_url
from ledgerloom.functions.text import compact_lines

MOST_LINKS = 100


def page_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def page_text(html: Column) -> Column:
    """Visible text, a line per block."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|head|title|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    lines = F.regexp_replace(bare, r"(?i)</?(p|div|li|ul|ol|h[1-6]|tr|br|table|section|article|header|footer|nav)\b[^>]*>", "\n")
    plain = F.regexp_replace(lines, "(?s)<[^>]*>", "")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(sign))
    return compact_lines(plain, 2**30)


def page_links(html: Column, url: Column, most: int = MOST_LINKS) -> Column:
    """Addresses on the page: other sites' first, then its own, each once, `most` at most."""
    hrefs = F.regexp_extract_all(html, F.lit(r"(?i)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))
    own = domain_of_url(url)
    root = F.regexp_extract(url, "^(https?://[^/?#]+)", 1)
    full = F.transform(hrefs, lambda h: F.when(h.rlike("^(?i:https?)://"), h).when(h.startswith("/"), F.concat(root, h)))
    known = F.filter(full, lambda h: h.isNotNull())
    outside = F.filter(known, lambda h: domain_of_url(h) != own)
    inside = F.filter(known, lambda h: domain_of_url(h) == own)
    return F.slice(F.array_distinct(F.concat(outside, inside)), 1, most)


def crawled(pages: DataFrame) -> DataFrame:
    """Crawl responses of stored pages (url, html): succeeded with text, hash and links, or failed without HTML."""
    text = page_text(F.col("html"))
    ok = F.coalesce(F.trim("html"), F.lit("")) != ""
    return pages.select(
        "url",
        F.when(ok, F.col("url")).alias("final_url"),
        F.when(ok, "succeeded").otherwise("failed").alias("status"),
        F.when(ok, text).alias("markdown"),
        F.when(ok, F.sha2(text, 256)).alias("markdown_hash"),
        F.when(ok, page_links(F.col("html"), F.col("url"))).otherwise(F.array()).alias("links"),
        F.when(~ok, F.struct(F.lit("crawl_failed").alias("code"), F.lit("no content").alias("message"))).alias("error"),
    )
