"""URL functions: paths, domains, source tiers, post and junk filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Press and analyst domains.
TIER_B = "forbes.com gartner.com idc.com fortune.com reuters.com bloomberg.com wsj.com ft.com cnbc.com businesswire.com prnewswire.com globenewswire.com techcrunch.com hbr.org economist.com nytimes.com theguardian.com inc.com fastcompany.com venturebeat.com zdnet.com".split()
# Blog hosts and release mills.
TIER_D = "medium.com wordpress.com blogspot.com substack.com prlog.org openpr.com issuu.com".split()
# Social and user-made content.
TIER_E = "reddit.com quora.com pinterest.com facebook.com twitter.com x.com tiktok.com instagram.com glassdoor.com indeed.com scribd.com slideshare.net yelp.com".split()
# Path segments of listing, navigation and account pages.
JUNK = "tag|tags|category|categories|topic|topics|archive|archives|search|login|sign-?in|register|subscribe|cart|account|author|page"
LISTING = ("topic", "archive", "tag", "tags", "author", "page", "category")
# Locale prefixes.
LOCALES = "ru et ro sk th uk zh hu es el fr sl nb nl ko de sv da it pl tr ar ja pt he id ms vi".split()


def url_path(url: Column) -> Column:
    return F.split_part(F.split_part(F.regexp_replace(url, r"^https?://[^/]+", ""), F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))


def segments(url: Column) -> Column:
    return F.filter(F.split(url_path(url), "/"), lambda s: s != "")


def url_slug(url: Column) -> Column:
    """Last path segment."""
    return F.regexp_extract(F.split_part(F.split_part(F.regexp_replace(url, r"^[a-z]+://[^/?#]*", ""), F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1)), r"([^/]*)/*$", 1)


def plain_domain(url: Column) -> Column:
    """Host without ``www.``."""
    return F.regexp_replace(F.split_part(F.split_part(url, F.lit("//"), F.lit(2)), F.lit("/"), F.lit(1)), r"^www\.", "")


def _host(url: Column) -> Column:
    return F.lower(F.split_part(F.regexp_replace(F.coalesce(url, F.lit("")), r"^https?://", ""), F.lit("/"), F.lit(1)))


def registered_domain(url: Column) -> Column:
    """Last two labels of the host."""
    return F.substring_index(F.regexp_replace(F.split_part(_host(url), F.lit(":"), F.lit(1)), r"^www\.", ""), ".", -2)


def source_tier(url: Column, official: Iterable[str] = ("sec.gov",)) -> Column:
    """Authority of a source: A official, B press, E social, D blogs, C others; judged in this order."""
    host, domain = _host(url), registered_domain(url)
    top = host.endswith(".gov") | host.endswith(".edu")
    for name in official:
        top = top | host.contains(name)
    return F.when(top, "A").when(domain.isin(*TIER_B), "B").when(domain.isin(*TIER_E), "E").when(domain.isin(*TIER_D), "D").otherwise("C")


def is_junk_url(url: Column) -> Column:
    return url.rlike(rf"(?i)/({JUNK})(/|$|\?|=)")


def is_post(url: Column, section: str = "blog") -> Column:
    """Whether a url is an article of a section, and no listing of it."""
    s = segments(url)
    first, second = F.lower(F.get(s, F.lit(0))), F.lower(F.get(s, F.lit(1)))
    return F.coalesce((F.size(s) >= 2) & ~first.isin(*LOCALES) & (first == section) & ~second.isin(*LISTING), F.lit(False))
