"""Analysis of listings: the views, the ad-hoc result sets, the manifest and the data-quality assertions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarifa.functions.prices import band, per_cent, two_places
from tarifa.functions.text import present

KEPT = ("scraped_url_id site_id url raw_name raw_brand raw_price raw_currency raw_description raw_ean raw_sku raw_mpn raw_images in_stock raw_stock_qty raw_rating raw_review_count raw_category raw_tags raw_attributes extraction_method parse_errors fetched_at_utc bronze_source_key").split()


def raw(listings: DataFrame) -> DataFrame:
    """The stored columns and the flags derived from them."""
    stored = [F.col(c) for c in ("domain", "fetched_date", *KEPT)]
    return listings.select(
        *stored,
        F.timestamp_seconds("fetched_at_utc").alias("fetched_at"),
        F.col("raw_price").isNotNull().alias("has_price"),
        present(F.col("raw_ean")).alias("has_ean"),
        present(F.col("raw_brand")).alias("has_brand"),
        ((F.col("parse_errors") != "[]") & F.col("parse_errors").isNotNull()).alias("has_errors"),
    )


def _share(flag: str) -> Column:
    """Per cent of the rows with a value whose flag is set."""
    return per_cent(F.count_if(F.col(flag)), F.count(F.col(flag)))


def _paid(aggregate: Callable[[Column], Column]) -> Column:
    return aggregate(F.when(F.col("raw_price") > 0, F.col("raw_price")))


def _money(c: Column) -> Column:
    return F.round(c.cast("decimal(18,6)"), 2).cast("double")


def overview(listings: DataFrame) -> DataFrame:
    return raw(listings).agg(
        F.count("*").alias("total_records"),
        F.countDistinct("domain").alias("total_sites"),
        F.countDistinct("fetched_date").alias("total_dates"),
        F.min("fetched_date").alias("earliest_date"),
        F.max("fetched_date").alias("latest_date"),
        F.countDistinct(F.when(F.col("has_ean"), F.col("raw_ean"))).alias("unique_eans"),
        F.countDistinct(F.when(F.col("has_brand"), F.col("raw_brand"))).alias("unique_brands"),
        _share("has_price").alias("price_coverage_pct"),
        _share("has_ean").alias("ean_coverage_pct"),
        _share("has_brand").alias("brand_coverage_pct"),
        _share("in_stock").alias("in_stock_pct"),
        two_places(_paid(F.avg)).alias("global_avg_price_mad"),
    )


def by_site(listings: DataFrame) -> DataFrame:
    out = raw(listings).groupBy("domain").agg(
        F.count("*").alias("records"),
        F.min("fetched_date").alias("first_scraped"),
        F.max("fetched_date").alias("last_scraped"),
        _money(_paid(F.min)).alias("min_price"),
        two_places(_paid(F.avg)).alias("avg_price"),
        _money(F.max("raw_price")).alias("max_price"),
        _share("has_price").alias("price_pct"),
        _share("has_ean").alias("ean_pct"),
        _share("has_brand").alias("brand_pct"),
        _share("in_stock").alias("in_stock_pct"),
        _share("has_errors").alias("error_pct"),
        *_methods("via_css_only"),
    )
    return out.orderBy(F.desc("records"), "domain")


def _methods(css: str) -> list[Column]:
    method = F.col("extraction_method")
    return [F.count_if(method.like(f"%{x}%")).alias(name) for x, name in (("json_ld", "via_json_ld"), ("og_meta", "via_og_meta"), ("css", css))]


def by_brand(listings: DataFrame) -> DataFrame:
    out = raw(listings).where("has_brand").groupBy(F.col("raw_brand").alias("brand")).agg(
        F.countDistinct("domain").alias("sites_count"),
        F.count("*").alias("total_listings"),
        F.array_sort(F.collect_set("domain")).alias("found_on"),
        _money(_paid(F.min)).alias("min_price"),
        two_places(_paid(F.avg)).alias("avg_price"),
        _money(F.max("raw_price")).alias("max_price"),
        _share("has_ean").alias("ean_pct"),
    )
    return out.orderBy(F.desc("total_listings"), "brand")


def _cross_site(listings: DataFrame, low: Column) -> DataFrame:
    high = F.max("raw_price")
    rows = raw(listings).where(F.col("has_ean") & F.length("raw_ean").between(8, 14)).groupBy("raw_ean")
    out = rows.agg(
        F.countDistinct("domain").alias("site_count"),
        F.array_sort(F.collect_set("domain")).alias("sites"),
        F.min("raw_name").alias("sample_name"),  # any would do; the smallest is the same on each run
        F.min("raw_brand").alias("brand"),
        F.min("raw_currency").alias("currency"),
        low.alias("low"),
        high.alias("high"),
    )
    return out.where("site_count >= 2").select(
        "raw_ean", "site_count", "sites", "sample_name", "brand", "currency",
        _money(F.col("low")).alias("min_price"),
        _money(F.col("high")).alias("max_price"),
        _money(F.col("high") - F.col("low")).alias("price_spread"),
        F.round(((1 - F.col("low").cast("double") / F.nullif(F.col("high").cast("double"), F.lit(0.0))) * 100).cast("decimal(18,6)"), 1).cast("double").alias("saving_pct"),
    )


def cross_site_eans(listings: DataFrame) -> DataFrame:
    return _cross_site(listings, _paid(F.min)).orderBy(F.desc_nulls_last("price_spread"), "raw_ean")


def cross_site_top(listings: DataFrame, k: int = 20) -> DataFrame:
    """The widest spreads over all prices."""
    return _cross_site(listings, F.min("raw_price")).orderBy(F.desc_nulls_last("price_spread"), "raw_ean").limit(k)


def extraction_quality(listings: DataFrame) -> DataFrame:
    out = raw(listings).groupBy("domain", "extraction_method").agg(F.count("*").alias("records"), _share("has_price").alias("price_pct"), _share("has_ean").alias("ean_pct"))
    share = per_cent(F.col("records"), F.sum("records").over(Window.partitionBy("domain")))
    return out.withColumn("pct_of_site", share).orderBy("domain", F.desc("records"), "extraction_method")


def price_bands(listings: DataFrame) -> DataFrame:
    rows = listings.where("raw_price > 0").groupBy("domain", band(F.col("raw_price")).alias("price_band"))
    return rows.agg(F.count("*").alias("products"), two_places(F.avg("raw_price")).alias("avg_price")).orderBy("domain", "price_band")


def recent(listings: DataFrame) -> DataFrame:
    """Rows of each site's latest date; the dates are one small row a site."""
    rows = raw(listings)
    last = rows.groupBy("domain").agg(F.max("fetched_date").alias("fetched_date"))
    return rows.join(last, ["domain", "fetched_date"], "left_semi")


def site_breakdown(listings: DataFrame) -> DataFrame:
    out = raw(listings).groupBy("domain").agg(
        F.count("*").alias("records"),
        two_places(F.avg("raw_price")).alias("avg_price"),
        F.min("raw_price").cast("double").alias("min_price"),
        F.max("raw_price").cast("double").alias("max_price"),
        F.count_if("has_price").alias("priced"),
        F.count_if("has_ean").alias("with_ean"),
        F.count_if("has_brand").alias("with_brand"),
        F.count_if("in_stock").alias("in_stock"),
        per_cent(F.count_if("has_ean"), F.count("*")).alias("ean_pct"),
        *_methods("via_css"),
    )
    return out.orderBy(F.desc("records"), "domain")


def adhoc_overview(listings: DataFrame) -> DataFrame:
    return raw(listings).agg(
        F.count("*").alias("total_records"),
        F.countDistinct("domain").alias("sites"),
        F.countDistinct("fetched_date").alias("dates_covered"),
        F.min("fetched_date").alias("earliest_date"),
        F.max("fetched_date").alias("latest_date"),
        per_cent(F.count_if("has_price"), F.count("*")).alias("price_coverage_pct"),
        per_cent(F.count_if("has_ean"), F.count("*")).alias("ean_coverage_pct"),
        per_cent(F.count_if("in_stock"), F.count("*")).alias("in_stock_pct"),
    )


def extraction_methods(listings: DataFrame) -> DataFrame:
    out = listings.groupBy("domain", "extraction_method").agg(F.count("*").alias("records"))
    share = per_cent(F.col("records"), F.sum("records").over(Window.partitionBy("domain")))
    return out.withColumn("pct_of_site", share).orderBy("domain", F.desc("records"), "extraction_method")


def price_distribution(listings: DataFrame) -> DataFrame:
    value = F.col("raw_price").cast("double")
    rows = listings.where("raw_price > 0").groupBy("domain", "raw_currency")
    quantiles = [F.round(F.percentile(value, q).cast("decimal(18,6)"), 2).cast("double").alias(n) for q, n in ((0.25, "p25"), (0.5, "median"), (0.75, "p75"))]
    out = rows.agg(F.count("*").alias("products"), _money(F.min("raw_price")).alias("min_price"), *quantiles, _money(F.max("raw_price")).alias("max_price"), two_places(F.avg("raw_price")).alias("avg_price"))
    return out.orderBy("domain", "raw_currency")


def top_brands(listings: DataFrame, k: int = 20) -> DataFrame:
    rows = listings.where(present(F.col("raw_brand"))).groupBy("raw_brand")
    out = rows.agg(F.countDistinct("domain").alias("sites_count"), F.count("*").alias("total_listings"), two_places(F.avg("raw_price")).alias("avg_price"), F.array_sort(F.collect_set("domain")).alias("found_on"))
    return out.orderBy(F.desc("total_listings"), "raw_brand").limit(k)


def ean_coverage(listings: DataFrame) -> DataFrame:
    out = raw(listings).groupBy("domain").agg(F.count("*").alias("total"), F.count_if("has_ean").alias("with_ean"), per_cent(F.count_if("has_ean"), F.count("*")).alias("ean_pct"))
    return out.orderBy(F.desc("ean_pct"), "domain")


def parse_errors(listings: DataFrame) -> DataFrame:
    out = raw(listings).groupBy("domain").agg(F.count("*").alias("total"), F.count_if("has_errors").alias("with_errors"), per_cent(F.count_if("has_errors"), F.count("*")).alias("error_pct"))
    return out.orderBy(F.desc("error_pct"), "domain")


SAMPLED = "domain raw_name raw_brand raw_ean raw_price raw_currency in_stock raw_category extraction_method fetched_date".split()


def stratified_sample(listings: DataFrame, k: int = 10, order: list[Column] | None = None, seed: int = 42) -> DataFrame:
    """``k`` named and priced rows of each site: at random by a hash, or first in ``order``."""
    rows = listings.where(F.col("raw_price").isNotNull() & present(F.col("raw_name")))
    order = order or [F.xxhash64("url", "scraped_url_id", "fetched_at_utc", F.lit(seed)), F.col("scraped_url_id")]
    first = F.row_number().over(Window.partitionBy("domain").orderBy(*order))  # planned as a group limit before the shuffle
    return rows.withColumn("rn", first).where(F.col("rn") <= k).select(*SAMPLED).orderBy("domain", "raw_brand", "raw_name")


def daily_progress(listings: DataFrame) -> DataFrame:
    out = listings.groupBy("fetched_date", "domain").agg(F.count("*").alias("records"), F.count_if("in_stock").alias("in_stock"), two_places(F.avg("raw_price")).alias("avg_price"))
    return out.orderBy(F.desc("fetched_date"), "domain")


def manifest(listings: DataFrame, run_id: str, exported_at: Column | None = None) -> DataFrame:
    """Counters of each site and date of a run, failed rows left out."""
    rows = raw(listings).where("extraction_method != 'failed'").groupBy("domain", "fetched_date")
    return rows.agg(
        F.count("*").alias("row_count"),
        F.count_if("has_price").alias("priced_rows"),
        F.count_if("has_ean").alias("ean_rows"),
        F.count_if("has_brand").alias("branded_rows"),
        F.count_if("in_stock").alias("in_stock_rows"),
        F.count_if(F.col("raw_rating").isNotNull()).alias("rated_rows"),
        *[F.count_if(F.col("extraction_method").like(f"%{x}%")).alias(f"{n}_rows") for x, n in (("json_ld", "json_ld"), ("og_meta", "og_meta"), ("css_selectors", "css"))],
        F.min("fetched_at_utc").alias("earliest_fetch"),
        F.max("fetched_at_utc").alias("latest_fetch"),
    ).withColumn("run_id", F.lit(run_id)).withColumn("exported_at", exported_at if exported_at is not None else F.current_timestamp())


def dq_failure_rate(listings: DataFrame, most: float = 10.0) -> DataFrame:
    """Sites where more than ``most`` per cent of the pages failed; none is good."""
    out = listings.groupBy("domain").agg(F.count("*").alias("total_rows"), F.count_if(F.col("extraction_method") == "failed").alias("failed_rows"))
    out = out.withColumn("failure_pct", per_cent(F.col("failed_rows"), F.col("total_rows"), 2))
    return out.where(F.col("failure_pct") > most).orderBy(F.desc("failure_pct"), "domain")


def dq_null_price(listings: DataFrame, most: float = 20.0) -> DataFrame:
    out = listings.where("extraction_method != 'failed'").groupBy("domain").agg(F.count("*").alias("total_rows"), F.count_if(F.col("raw_price").isNull()).alias("null_price_rows"))
    out = out.withColumn("null_price_pct", per_cent(F.col("null_price_rows"), F.col("total_rows"), 2))
    return out.where(F.col("null_price_pct") > most).orderBy(F.desc("null_price_pct"), "domain")


VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "listing_raw": raw, "listing_overview": overview, "listing_by_site": by_site, "listing_by_brand": by_brand, "listing_cross_site_eans": cross_site_eans,
    "listing_extraction_quality": extraction_quality, "listing_price_bands": price_bands, "listing_recent": recent,
}


def register_views(listings: DataFrame) -> list[str]:
    """Make all views anew as temporary views; returns the names that the catalog has."""
    spark: SparkSession = listings.sparkSession
    for name, view in VIEWS.items():
        view(listings).createOrReplaceTempView(name)
    return sorted(t.name for t in spark.catalog.listTables() if t.isTemporary and t.name in VIEWS)
