"""Discovery of product URLs from captured documents, by the strategy of each site.

A strategy is a function (documents, options) -> DataFrame of ``url``. Documents
have url and one of xml, html or body. Fetching them is not done here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.functions import extract
from tarifa.operators import urlqueue
from tarifa.sources import readers

Strategy = Callable[[DataFrame, dict], DataFrame]
STRATEGIES: dict[str, Strategy] = {}


def strategy(name: str) -> Callable[[Strategy], Strategy]:
    """Register a strategy under a name; sites name it in their configuration."""

    def add(f: Strategy) -> Strategy:
        STRATEGIES[name] = f
        return f

    return add


@strategy("sitemap")
def sitemap(documents: DataFrame, options: dict) -> DataFrame:
    """Pages of the sitemaps under ``roots``; ``kind`` is one of SITEMAP_KINDS, ``since`` the least lastmod."""
    return readers.sitemap_pages(documents.where("xml is not null"), options["roots"], kind=options.get("kind"), since=options.get("since"))


@strategy("category")
def category(documents: DataFrame, options: dict) -> DataFrame:
    """Links of captured listing pages whose URL has one of the ``categories`` in it.

    With ``category_urls`` these are walked page by page in place of that: ``product_selector``,
    ``next_page_selector``, ``max_pages`` and ``url_prefix`` say how.
    """
    pages = documents.where("html is not null")
    if "category_urls" in options:
        selector = lambda name, otherwise: options.get(name, otherwise) + "@href"
        return extract.category_pages(pages, options["category_urls"], selector("product_selector", "a"), selector("next_page_selector", "a.next"), options.get("max_pages", 200), options.get("url_prefix"))
    return extract.links(readers.matching(pages, options.get("categories", [])))


@strategy("api")
def api(documents: DataFrame, options: dict) -> DataFrame:
    return readers.api_urls(documents.where("body is not null"), options.get("url_field", "url"))


@strategy("json_ld")
def json_ld(documents: DataFrame, options: dict) -> DataFrame:
    return extract.entity_urls(documents.where("html is not null"))


@strategy("hybrid")
def hybrid(documents: DataFrame, options: dict) -> DataFrame:
    return readers.hybrid(sitemap(documents, options), category(documents, options))


@dataclass
class Site:
    site_id: str
    domain: str
    strategy: str
    status: str = "active"
    options: dict = field(default_factory=dict)
    patterns: list[str] = field(default_factory=list)


def urls_of(site: Site, documents: DataFrame) -> DataFrame:
    """(site_id, url): distinct URLs of a site that fit its patterns."""
    own = documents.where(F.col("site_id") == site.site_id)
    found = readers.matching(STRATEGIES[site.strategy](own, site.options), site.patterns)
    return found.select(F.lit(site.site_id).alias("site_id"), "url").distinct()


def run(sites: list[Site], documents: DataFrame, queue: DataFrame, now: Column, rescrape: bool = False, enqueue: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """The queue after discovery on all active sites, and the errors of sites that failed; a failure leaves the other sites alone."""
    found, errors = None, {}
    for site in sites:  # configuration: a few sites, each one plan
        if site.status != "active":
            continue
        try:
            own = urls_of(site, documents)
            own.schema  # noqa: B018  analysis errors belong to the site
        except (KeyError, PySparkException) as e:
            errors[site.domain] = f"{type(e).__name__}: {e}"
            continue
        found = own if found is None else found.unionByName(own)
    if found is None:
        return queue.withColumn("change", F.lit("kept")), errors
    out = urlqueue.discovered(queue, found, now, rescrape)
    return (urlqueue.enqueued(out) if enqueue and "job_id" in out.columns else out), errors
