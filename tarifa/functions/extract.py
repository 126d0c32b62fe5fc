"""Product fields from captured pages: JSON-LD, Open Graph and a few CSS paths.

All of it is regular expressions and VARIANT paths in the JVM. An absent field
is null. Each method gives a struct of FIELDS; ``listing_fields`` merges them,
JSON-LD first, field by field.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.functions import prices, selectors, text
from tarifa.session import written

SCRIPT = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"
META = r"(?is)<meta\s[^>]*>"
LINK = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"'#]+)"
FIELDS = {
    "raw_name": "string", "raw_brand": "string", "raw_price_str": "string", "raw_currency": "string", "in_stock": "boolean",
    "raw_ean": "string", "raw_sku": "string", "raw_images": "array<string>", "raw_rating": "double", "raw_review_count": "int",
    "raw_category": "string", "raw_attributes": "map<string,string>", "raw_stock_qty": "int", "raw_description": "string",
}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def unescape(c: Column) -> Column:
    for mark, char in (("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(mark), F.lit(char))
    return c


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _first(v: Column, *paths: str, kind: str = "string") -> Column:
    return F.coalesce(*[_get(v, p, kind) for p in paths])


def _is(v: Column, kinds: tuple[str, ...]) -> Column:
    one = _get(v, '$["@type"]').isin(*kinds)
    return F.coalesce(one, F.lit(False)) | F.coalesce(F.exists(_get(v, '$["@type"]', "array<string>"), lambda t: t.isin(*kinds)), F.lit(False))


def scripts(html: Column) -> Column:
    """Texts of the page's JSON-LD scripts."""
    return F.coalesce(F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(1)), F.array().cast("array<string>"))


def entities(html: Column, kinds: tuple[str, ...] = ("Product",)) -> Column:
    """All JSON-LD records of the kinds: on top, in a list, or in @graph."""
    parsed = F.filter(F.transform(scripts(html), lambda s: F.try_parse_json(F.trim(s))), lambda v: v.isNotNull())
    spread = F.flatten(F.transform(parsed, lambda v: F.coalesce(_get(v, '$["@graph"]', "array<variant>"), _get(v, "$", "array<variant>"), F.array(v))))
    return F.filter(spread, lambda v: _is(v, kinds))


def json_ld_errors(html: Column) -> Column:
    """One message for each script that is not JSON."""
    bad = F.filter(scripts(html), lambda s: (F.trim(s) != "") & F.try_parse_json(F.trim(s)).isNull())
    return F.transform(bad, lambda s: F.concat(F.lit("json_ld: "), F.substring(F.trim(s), 1, 60)))


def json_ld(html: Column) -> Column:
    """Struct of FIELDS of the first Product; null without one."""
    return let(F.try_element_at(entities(html), F.lit(1)), lambda v: F.when(v.isNotNull(), _with_offer(v)))


def _with_offer(v: Column) -> Column:
    def with_sale(offer: Column) -> Column:
        specs = F.coalesce(_get(offer, "$.priceSpecification", "array<variant>"), F.array(_get(offer, "$.priceSpecification", "variant")))
        sale = F.try_element_at(F.filter(specs, lambda s: s.isNotNull() & ~F.coalesce(_get(s, "$.priceType"), F.lit("")).contains("ListPrice")), F.lit(1))
        return let(sale, lambda found: _product(v, offer, found))

    return let(F.coalesce(_get(v, "$.offers[0]", "variant"), _get(v, "$.offers", "variant")), with_sale)


def _product(v: Column, offer: Column, sale: Column) -> Column:
    images = F.coalesce(
        F.filter(F.transform(_get(v, "$.image", "array<variant>"), lambda i: F.coalesce(_get(i, "$.url"), _get(i, "$"))), lambda u: u.isNotNull()),
        F.when(_first(v, "$.image.url", "$.image").isNotNull(), F.array(_first(v, "$.image.url", "$.image"))),
    )
    pairs = F.filter(F.transform(_get(v, "$.additionalProperty", "array<variant>"), lambda p: F.struct(_get(p, "$.name").alias("k"), _get(p, "$.value").alias("v"))), lambda p: p["k"].isNotNull())
    last = let(pairs, lambda all_: F.map_from_entries(F.filter(all_, lambda p, i: ~F.exists(F.slice(all_, i + 2, F.greatest(F.size(all_), F.lit(1))), lambda q: q["k"] == p["k"]))))
    return F.struct(
        _get(v, "$.name").alias("raw_name"),
        _first(v, "$.brand.name", "$.brand[0].name", "$.brand[0]", "$.brand").alias("raw_brand"),
        F.coalesce(_get(offer, "$.price"), _get(sale, "$.price"), _get(offer, "$.lowPrice")).alias("raw_price_str"),
        F.coalesce(_get(offer, "$.priceCurrency"), _get(sale, "$.priceCurrency")).alias("raw_currency"),
        prices.in_stock(_get(offer, "$.availability")).alias("in_stock"),
        _first(v, "$.gtin13", "$.gtin8", "$.gtin14", "$.gtin").alias("raw_ean"),
        _get(v, "$.sku").alias("raw_sku"),
        images.alias("raw_images"),
        _get(v, "$.aggregateRating.ratingValue").try_cast("double").alias("raw_rating"),
        F.coalesce(_get(v, "$.aggregateRating.reviewCount"), _get(v, "$.aggregateRating.ratingCount")).try_cast("int").alias("raw_review_count"),
        _get(v, "$.category").alias("raw_category"),
        last.alias("raw_attributes"),
        F.lit(None).cast("int").alias("raw_stock_qty"),
        _get(v, "$.description").alias("raw_description"),
    )


def meta(html: Column) -> Column:
    """Map of the page's meta names and properties to contents, the first of each."""
    tags = F.coalesce(F.regexp_extract_all(html, F.lit(META), F.lit(0)), F.array().cast("array<string>"))
    value = lambda tag, name: F.coalesce(text.text_or_null(F.regexp_extract(tag, rf'(?is)\s(?:{name})\s*=\s*"([^"]*)"', 1)), text.text_or_null(F.regexp_extract(tag, rf"(?is)\s(?:{name})\s*=\s*'([^']*)'", 1)))
    pairs = F.filter(F.transform(tags, lambda t: F.struct(F.lower(value(t, "property|name")).alias("k"), unescape(value(t, "content")).alias("v"))), lambda p: p["k"].isNotNull() & p["v"].isNotNull())
    firsts = lambda all_: let(F.transform(all_, lambda p: p["k"]), lambda keys: F.map_from_entries(F.filter(all_, lambda p, i: F.array_position(keys, p["k"]) == i + 1)))
    return let(pairs, firsts)


def open_graph(html: Column) -> Column:
    """Struct of FIELDS from Open Graph, product and card metas; null if there are none."""
    return let(meta(html), _from_metas)


def _from_metas(tags: Column) -> Column:
    get = lambda k: F.try_element_at(tags, F.lit(k))
    empty = {"raw_sku", "raw_rating", "raw_review_count", "raw_category", "raw_attributes"}
    own = {
        "raw_name": text.title_without_site(get("og:title")),
        "raw_brand": get("product:brand"),
        "raw_price_str": get("product:price:amount"),
        "raw_currency": get("product:price:currency"),
        "in_stock": prices.in_stock(get("product:availability")),
        "raw_ean": text.valid_ean(get("product:retailer_item_id")),
        "raw_images": F.when(get("og:image").isNotNull(), F.array(get("og:image"))),
        "raw_stock_qty": text.first_number(get("twitter:data2")),
        "raw_description": get("og:description"),
    }
    found = F.struct(*[(F.lit(None).cast(kind) if k in empty else own[k]).alias(k) for k, kind in FIELDS.items()])
    any_ = F.exists(F.map_keys(tags), lambda k: k.startswith("og:") | k.startswith("product:") | (k == "twitter:data2"))
    return F.when(any_, found)


def first_text(html: Column, tag: str, cls: str | None = None) -> Column:
    """Text of the first element, one with the class if given; null if none."""
    named = rf"[^>]*class\s*=\s*[\"'](?:[^\"']*\s)?{cls}(?:\s[^\"']*)?[\"'][^>]*" if cls else r"(?:\s[^>]*)?"
    inner = F.regexp_extract(html, rf"(?is)<{tag}{named}>(.*?)</{tag}>", 1)
    return text.text_or_null(F.trim(F.regexp_replace(unescape(F.regexp_replace(inner, r"(?s)<[^>]*>", " ")), r"\s+", " ")))


# Where a price is usually found.
PRICE_SELECTOR = ".product-prices .price, .current-price .price, span.price"


def css(html: Column, site: Column | None = None, sites: dict[str, dict[str, str]] | None = None) -> Column:
    """Struct of FIELDS from the h1 and the usual price elements; null if there is neither.

    ``sites`` has selectors of its own for a site's fields of text; they come first. Only pages
    with a class that names a price, or of such a site, are parsed outside the JVM.
    """
    site = F.lit(None).cast("string") if site is None else site
    asked = html.rlike(r"(?i)class\s*=[^>]*price") | F.coalesce(site.isin(*(sites or {"": {}})), F.lit(False))
    own_fields = selectors.first(F.when(asked, html), site, {"raw_price_str": PRICE_SELECTOR}, sites)
    price = F.coalesce(own_fields["raw_price_str"], first_text(html, "div", "price"), first_text(html, "p", "price"))
    told = {n for fields in (sites or {}).values() for n in fields}
    own = {n: own_fields[n].try_cast(FIELDS[n]) for n in sorted(told)} | {"raw_price_str": price}
    own["raw_name"] = F.coalesce(own_fields["raw_name"], first_text(html, "h1")) if "raw_name" in told else first_text(html, "h1")
    found = F.struct(*[own.get(k, F.lit(None).cast(kind)).alias(k) for k, kind in FIELDS.items()])
    return F.when(own["raw_name"].isNotNull() | price.isNotNull(), found)


METHODS = (("json_ld", json_ld), ("og_meta", open_graph), ("css_selectors", css))


def listing_fields(pages: DataFrame, html_col: str = "html", default_currency: str = "MAD", sites: dict[str, dict[str, str]] | None = None, site_col: str = "domain") -> DataFrame:
    """The pages with FIELDS merged, raw_price, extraction_method and parse_errors (JSON, '[]' if none).

    ``sites``: selectors of fields by site, the value of ``site_col``.
    """
    out = pages
    for name, method in METHODS:
        made = method(F.col(html_col)) if method is not css or sites is None else css(F.col(html_col), F.col(site_col), sites)
        out = out.withColumn(f"_{name}", made)
    merged = [F.coalesce(*[F.col(f"_{name}.{k}") for name, _ in METHODS]).alias(k) for k in FIELDS]
    used = F.array_compact(F.array(*[F.when(F.col(f"_{name}").isNotNull(), F.lit(name)) for name, _ in METHODS]))
    # the label names each method that found something; css alone is used where the others found nothing
    label = F.when(F.size(used) == 0, "failed").otherwise(F.array_join(used, "+"))
    out = out.select(*pages.columns, *merged, label.alias("extraction_method"))
    price = prices.price(F.col("raw_price_str"), default_currency)
    errors = F.concat(json_ld_errors(F.col(html_col)), price["errors"])
    out = out.withColumn("raw_price", price["price"]).withColumn("parse_errors", F.to_json(errors))
    out = out.withColumn("raw_currency", F.coalesce(text.text_or_null(F.col("raw_currency")), price["currency"]))
    return out.withColumn("raw_description", text.clean_description(F.col("raw_description"))).withColumn("raw_name", F.coalesce("raw_name", F.lit("")))


def entity_urls(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Distinct ``url``s of the Product and ItemList records of pages: url, else @id."""
    found = pages.select(F.explode(entities(F.col(html_col), ("Product", "ItemList"))).alias("v"))
    return found.select(_first(F.col("v"), "$.url", '$["@id"]').alias("url")).where("url is not null").distinct()


def category_pages(pages: DataFrame, seeds: list[str], product: str = "a@href", following: str = "a.next@href", most: int = 200, prefix: str | None = None, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Distinct absolute ``url``s of products that the captured pages of categories link to.

    A category is its seed and the pages after it, by the first link of ``following``, ``most`` pages at most.
    Each page is parsed once; only URLs take part in the joins of the walk, one a page number.
    """
    full = (lambda h, base: F.when(h.startswith("http"), h).otherwise(F.concat(F.lit(prefix.rstrip("/")), h))) if prefix else text.absolute_url
    after = selectors.first(F.col(html_col), F.lit(None).cast("string"), {"next": following})["next"]
    read = pages.select(F.col(url_col).alias("at"), selectors.every(F.col(html_col), product).alias("hrefs"), after.alias("next"))
    read = written(read.select("at", "hrefs", full(F.col("next"), F.col("at")).alias("next")), "category-pages")
    level = seen = written(pages.sparkSession.createDataFrame([(s,) for s in seeds], "at string").distinct(), "category-walk")
    for _ in range(1, most):
        level = read.join(level, "at", "left_semi").select(F.col("next").alias("at")).where("at is not null").distinct().join(seen, "at", "left_anti")
        level = written(level, "category-walk")
        if level.isEmpty():
            break
        seen = seen.unionByName(level)
    found = read.join(seen, "at", "left_semi").select("at", F.explode("hrefs").alias("href"))
    return found.select(full(F.col("href"), F.col("at")).alias("url")).distinct()


def links(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Distinct absolute ``url``s to which pages link."""
    found = pages.select(url_col, F.explode(F.regexp_extract_all(html_col, F.lit(LINK), F.lit(1))).alias("href"))
    return found.select(text.absolute_url(unescape(F.col("href")), F.col(url_col)).alias("url")).distinct()


def page_summary(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """id, h1, title, links and scripts of each page."""
    html = F.col(html_col)
    return pages.select(id_col, first_text(html, "h1").alias("h1"), first_text(html, "title").alias("title"), F.regexp_count(html, F.lit(LINK)).alias("links"), F.regexp_count(html, F.lit("(?i)<script")).alias("scripts"))
