"""The serving queries: price comparison, margins, queues and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarifa.functions import prices
from tarifa.functions.text import clipped

PAGE = 50
DEFAULT_CURRENCY = "MAD"
STATUS_GROUPS = {"needs_work": ("pending", "failed"), "in_flight": ("in_progress",), "terminal": ("blocked", "not_found"), "done": ("done",)}


def page(rows: DataFrame, *order: Column | str, number: int = 1, size: int = PAGE) -> DataFrame:
    """One page of the rows; the order must be total. Spark keeps number * size rows a task."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def contains(c: Column, part: str | None) -> Column:
    """Case-insensitive; no wildcards; anything matches None."""
    return F.lit(True) if not part else F.lower(c).contains(part.lower())


def search(rows: DataFrame, term: str, *columns: str) -> DataFrame:
    """Rows with the term in one of the columns."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(contains(F.col(c), term), F.lit(False))
    return rows.where(hit)


# prices of a product on all sites


def price_pools(offers: DataFrame) -> DataFrame:
    """One row a product: prices over the offers in stock, or over all priced ones if none is.

    One grouping of the offers on the product; the list of sites is in order of
    price, unpriced ones last.
    """
    site = F.struct(
        F.col("current_price").isNull().alias("unpriced"), F.col("current_price").alias("price"), "domain", "site_id",
        F.col("currency"), F.col("in_stock"), F.col("product_url"), F.col("last_scraped"),
    )
    rows = offers.groupBy("master_id").agg(F.array_sort(F.collect_list(site)).alias("all"))
    priced = F.filter("all", lambda x: x["price"].isNotNull())
    ready = F.filter("all", lambda x: x["price"].isNotNull() & x["in_stock"])
    rows = rows.withColumn("priced", priced).withColumn("pool", F.when(F.size(ready) > 0, ready).otherwise(priced))
    first = F.try_element_at("pool", F.lit(1))
    total = F.aggregate("pool", F.lit(0).cast("decimal(18,2)"), lambda s, x: (s + x["price"]).cast("decimal(18,2)"))
    return rows.select(
        "master_id",
        first["price"].alias("price_min"),
        F.try_element_at("pool", F.lit(-1))["price"].alias("price_max"),
        F.when(F.size("pool") > 0, F.bround((total / F.size("pool")).cast("decimal(18,6)"), 2)).cast("double").alias("price_avg"),
        F.coalesce(F.try_element_at("priced", F.lit(1))["currency"], F.lit(DEFAULT_CURRENCY)).alias("price_currency"),
        F.size("all").alias("sites_count"),
        F.size(F.filter("all", lambda x: x["in_stock"])).alias("in_stock_count"),
        first["domain"].alias("cheapest_site"),
        first["product_url"].alias("cheapest_url"),
        F.transform("all", lambda x: x.dropFields("unpriced")).alias("sites"),
    )


def price_comparison(masters: DataFrame, offers: DataFrame, master_id: str) -> DataFrame:
    """The prices of one product; a product without offers has a row too."""
    own = price_pools(offers.where(F.col("master_id") == master_id))
    rows = masters.where(F.col("id") == master_id).join(own, F.col("id") == F.col("master_id"), "left").drop("master_id")
    rows = rows.fillna({"price_currency": DEFAULT_CURRENCY, "sites_count": 0, "in_stock_count": 0})
    rows = rows.withColumn("price_avg", F.nullif(F.col("price_avg"), F.lit(0.0)))
    return rows.withColumn("sites", F.coalesce("sites", F.array().cast(rows.schema["sites"].dataType)))


def price_comparisons(masters: DataFrame, offers: DataFrame, brand: str | None = None, category: str | None = None, name: str | None = None, in_stock_only: bool = False, multi_site_only: bool = True) -> DataFrame:
    """The prices of all active products that match; page it with ``page(..., "brand", "name", "id")``."""
    own = masters.where((F.col("status") == "active") & contains(F.col("brand"), brand) & contains(F.col("category"), category) & contains(F.col("name"), name))
    rows = own.select("id", "name", "brand", "ean", "category").join(price_pools(offers), F.col("id") == F.col("master_id"), "inner" if multi_site_only or in_stock_only else "left").drop("master_id")
    if multi_site_only:
        rows = rows.where("sites_count >= 2")
    return rows.where("in_stock_count >= 1") if in_stock_only else rows


def cheapest_now(offers: DataFrame) -> DataFrame:
    """The cheapest site of each product: in stock first, then any; ties to the smaller domain."""
    best = F.min(F.when(F.col("current_price").isNotNull(), F.struct((~F.col("in_stock")).alias("out"), "current_price", "domain", "product_url")))
    return offers.groupBy("master_id").agg(best.alias("b")).where("b is not null").select("master_id", F.col("b.domain").alias("cheapest_site"), F.col("b.current_price").alias("price"), (~F.col("b.out")).alias("in_stock"))


def ranked_offers(offers: DataFrame) -> DataFrame:
    """Offers of each product from the cheapest on, those in stock first, with a flag on the first."""
    order = [F.when(F.col("in_stock"), 0).otherwise(1), F.coalesce(F.col("current_price"), F.lit(9999).cast("decimal(12,2)")), F.col("domain")]
    rank = F.row_number().over(Window.partitionBy("master_id").orderBy(*order))
    return offers.withColumn("rank", rank).withColumn("is_cheapest", F.col("rank") == 1)


def price_range(offers: DataFrame) -> DataFrame:
    """Lowest and highest price of each product and the saving between them."""
    rows = offers.where("current_price is not null").groupBy("master_id").agg(F.min("current_price").alias("price_min"), F.max("current_price").alias("price_max"))
    return rows.withColumn("saving_pct", prices.saving_pct(F.col("price_min"), F.col("price_max")))


def offer_stats(masters: DataFrame, offers: DataFrame) -> DataFrame:
    """Every product with the number of its sites and the range of its prices; none counts 0."""
    rows = offers.groupBy("master_id").agg(
        F.countDistinct("id").alias("site_count"), F.countDistinct(F.when(F.col("in_stock"), F.col("id"))).alias("in_stock_sites"),
        F.min("current_price").alias("current_min"), F.max("current_price").alias("current_max"), prices.two_places(F.avg("current_price")).alias("current_avg"),
    )
    return masters.join(rows.withColumnRenamed("master_id", "id"), "id", "left").fillna(0, ["site_count", "in_stock_sites"])


# wholesale


def wholesale_range(supplier_products: DataFrame) -> DataFrame:
    rows = supplier_products.where("master_id is not null and prix_pharmacien is not null")
    return rows.groupBy("master_id").agg(F.min("prix_pharmacien").alias("wholesale_min"), F.max("prix_pharmacien").alias("wholesale_max"), F.countDistinct("supplier").alias("sources"))


def best_buy(supplier_products: DataFrame) -> DataFrame:
    """The supplier with the lowest price of each product; ties to the smaller name."""
    rows = supplier_products.where("master_id is not null and prix_pharmacien is not null")
    return rows.groupBy("master_id").agg(F.min(F.struct("prix_pharmacien", "supplier")).alias("b")).select("master_id", F.col("b.supplier").alias("best_supplier"), F.col("b.prix_pharmacien").alias("buy_price"))


def margins(offers: DataFrame, supplier_products: DataFrame) -> DataFrame:
    """Lowest retail against lowest wholesale price of the products that have both."""
    retail = offers.where("current_price is not null").groupBy("master_id").agg(F.min("current_price").alias("retail_min"))
    rows = wholesale_range(supplier_products).join(retail, "master_id")
    margin = (F.col("retail_min") - F.col("wholesale_min")).cast("decimal(14,2)")
    pct = prices.margin_pct(F.col("retail_min"), F.col("wholesale_min"))
    return rows.withColumn("margin", margin).withColumn("margin_pct", pct).withColumn("margin_band", prices.margin_band(F.col("margin_pct"))).withColumn("below_cost", F.col("retail_min") <= F.col("wholesale_min"))


def pricing_panel(offers: DataFrame, supplier_products: DataFrame) -> DataFrame:
    """Where to buy, where it sells cheapest, and what lies between."""
    rows = margins(offers, supplier_products).select("master_id", "retail_min", "wholesale_min", "margin", "margin_pct", "margin_band")
    return rows.join(best_buy(supplier_products).drop("buy_price"), "master_id").join(cheapest_now(offers).select("master_id", "cheapest_site"), "master_id")


def margin_alert(masters: DataFrame, offers: DataFrame, supplier_products: DataFrame, below: bool = True) -> DataFrame:
    """Products that sell at or below their buy price, or with ``below=False`` above it."""
    rows = margins(offers, supplier_products).where(F.col("below_cost") if below else ~F.col("below_cost"))
    return masters.join(rows.select(F.col("master_id").alias("id"), "retail_min", "wholesale_min"), "id")


def with_wholesale(masters: DataFrame, supplier_products: DataFrame, has: bool = True) -> DataFrame:
    linked = supplier_products.where("master_id is not null").select(F.col("master_id").alias("id"))
    return masters.join(linked, "id", "left_semi" if has else "left_anti")


def supplier_summary(supplier_products: DataFrame) -> DataFrame:
    return supplier_products.groupBy("supplier").agg(
        F.count("*").alias("products"), F.count("master_id").alias("matched"), F.count_if("in_stock").alias("in_stock"),
        F.count("vendor_product_id").alias("with_vendor_id"), F.bround(100.0 * F.count("master_id") / F.count("*"), 0).cast("int").alias("matched_pct"),
    )


def linked(supplier_products: DataFrame, column: str = "master_id", has: bool = True) -> DataFrame:
    return supplier_products.where(F.col(column).isNotNull() if has else F.col(column).isNull())


# lists


def master_list(masters: DataFrame, brand: str | None = None, status: str = "active", needs_review: bool = False) -> DataFrame:
    rows = masters.where((F.col("status") == status) & (F.lower("brand") == brand.lower() if brand else F.lit(True)))
    return rows.where((F.col("match_confidence") < 0.85) & ~F.col("manually_verified")) if needs_review else rows


def master(masters: DataFrame, id_: str) -> DataFrame:
    """One product by its id; no row if there is none."""
    return masters.where(F.col("id") == id_)


def offers_of(offers: DataFrame, master_id: str) -> DataFrame:
    """The offers of one product, cheapest first, those without a price last."""
    return offers.where(F.col("master_id") == master_id).orderBy(F.col("current_price").asc_nulls_last(), "domain")


def by_confidence(masters: DataFrame, band: str | None = None) -> DataFrame:
    rows = masters.withColumn("band", prices.confidence_band(F.col("match_confidence")))
    return rows if band is None else rows.where(F.col("band") == band)


def by_coverage(masters: DataFrame, offers: DataFrame, band: str | None = None) -> DataFrame:
    rows = offer_stats(masters, offers).withColumn("band", prices.site_band(F.col("site_count")))
    return rows if band is None else rows.where(F.col("band") == band)


def orphans(masters: DataFrame, offers: DataFrame) -> DataFrame:
    return masters.join(offers.select(F.col("master_id").alias("id")), "id", "left_anti")


def price_history(log: DataFrame, master_id: str, site_id: str | None = None) -> DataFrame:
    rows = log.where(F.col("master_id") == master_id)
    return rows.where(F.col("site_id") == site_id) if site_id else rows


def pending_urls(queue: DataFrame, now: Column, site_id: str | None = None, limit: int = 500) -> DataFrame:
    """The next product pages to fetch: highest priority, then longest known; ids break ties."""
    due = (F.col("status") == "pending") & (F.col("url_type") == "product") & (F.col("next_scrape_after").isNull() | (F.col("next_scrape_after") <= now))
    rows = queue.where(due & (F.col("site_id") == site_id if site_id else F.lit(True)))
    return rows.orderBy(F.desc("priority"), "discovered_at", "id").limit(limit)


def status_group(queue: DataFrame, group: str) -> DataFrame:
    return queue.where(F.col("status").isin(*STATUS_GROUPS[group])) if group in STATUS_GROUPS else queue


def status_histogram(queue: DataFrame, statuses: tuple[str, ...]) -> DataFrame:
    """Number of URLs in each status, 0 for one without any."""
    known = queue.sparkSession.createDataFrame([(s,) for s in statuses], "status string")
    return known.join(queue.groupBy("status").count(), "status", "left").select("status", F.coalesce("count", F.lit(0)).alias("urls"))


def fetch_logs(log: DataFrame, site_id: str | None = None, status: str | None = None, year: int | None = None, month: int | None = None, day: int | None = None) -> DataFrame:
    """Fetches of a site, status and date; page it with ``page(..., desc("fetched_at"), "url_id")``."""
    for column, value in (("site_id", site_id), ("status", status)):
        log = log if value is None else log.where(F.col(column) == value)
    for part, value in ((F.year, year), (F.month, month), (F.dayofmonth, day)):
        log = log if value is None else log.where(part("fetched_at") == value)
    return log


def sites(site_table: DataFrame, status: str = "active") -> DataFrame:
    return site_table.where(F.col("status") == status).orderBy("domain")


def proxies_for(proxies: DataFrame, sites_: DataFrame) -> DataFrame:
    """Active proxies of each site: its own ones, or those without a site where it has none."""
    active = proxies.where("is_active")
    own = active.select("proxy_id", "dsn", F.explode("domains").alias("domain"))
    shared = active.where(F.size("domains") == 0).select("proxy_id", "dsn")
    left = sites_.select("domain").join(own.select("domain"), "domain", "left_anti").distinct()
    # shared proxies times sites without their own: both are configuration
    spread = left.withColumn("j", F.lit(1)).join(shared.withColumn("j", F.lit(1)), "j").select("proxy_id", "dsn", "domain")
    return sites_.select("domain").distinct().join(own, "domain").select("proxy_id", "dsn", "domain").unionByName(spread)


def proxy_pools(proxies: DataFrame) -> DataFrame:
    """Lists of proxies by domain; those without one are 'global'."""
    rows = proxies.where("is_active").select("dsn", F.explode_outer("domains").alias("domain"))
    return rows.groupBy(F.coalesce("domain", F.lit("global")).alias("domain")).agg(F.array_sort(F.collect_list("dsn")).alias("dsns"))


def short(rows: DataFrame, column: str, n: int = 60) -> DataFrame:
    return rows.withColumn(column, clipped(F.col(column), n, "…"))
