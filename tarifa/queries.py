"""The registered queries of the engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa import testkit as kit
from tarifa.functions import extract, prices, similarity, text
from tarifa.operators import gold, matching, urlqueue, vector_index, wholesale
from tarifa.operators.upsert import SnapshotTable
from tarifa.plans import analytics, serve
from tarifa.session import folder, table, written
from tarifa.sources import readers
from tarifa.streaming import rollup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NOW = "2025-01-01 00:00:00"
L, M, SP, W = f"l AS ({kit.LISTINGS})", f"m AS ({kit.MASTERS})", f"sp AS ({kit.SITE_PRODUCTS})", f"w AS ({kit.SUPPLIER_PRODUCTS})"
PL, Q, FL = f"pl AS ({kit.PRICE_LOG})", f"q AS ({kit.URL_QUEUE})", f"fl AS ({kit.FETCH_LOG})"

RUN = f"run AS ({kit.RUN})"


def query(name: str, sql: str | None = None, *relations: str):
    """Register a query; ``relations`` go before its SQL as common table expressions."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = (f"WITH {', '.join(relations)} " if relations else "") + sql
        return f

    return add


def _pct(part: str, whole: str, places: int = 1) -> str:
    return f"CAST(round(CAST(100.0 * {part} / nullif({whole}, 0) AS DECIMAL(18,6)), {places}) AS DOUBLE)"


def _r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(18,6)), 2) AS DOUBLE)"


EAN, BRAND, PRICED = "(raw_ean IS NOT NULL AND raw_ean <> '')", "(raw_brand IS NOT NULL AND raw_brand <> '')", "raw_price IS NOT NULL"
ERRS = "(parse_errors IS NOT NULL AND parse_errors <> '[]')"
PAID = "FILTER (WHERE raw_price > 0)"


def _if(p: str) -> str:
    return f"count(*) FILTER (WHERE {p})"


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and lists as strings, so that both engines print them alike."""
    made = {}
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind == "decimal":
            made[f.name] = F.col(f.name).cast("double")
        elif kind == "date":
            made[f.name] = F.col(f.name).cast("string")
        elif kind == "array":
            made[f.name] = F.array_join(f.name, ",")
    return df.withColumns(made)


def _view(name: str, f: Callable[[DataFrame], DataFrame], sql: str, dates: str = "", lists: str = "") -> None:
    made = [f"CAST({d} AS VARCHAR) AS {d}" for d in dates.split()] + [f"array_to_string({c}, ',') AS {c}" for c in lists.split()]
    sql = f"SELECT * REPLACE ({', '.join(made)}) FROM ({sql})" if made else sql
    query(name, sql, L)(lambda spark, sf_dir: _plain(f(kit.listings(spark, sf_dir))))


# analysis of listings

_view("overview", analytics.overview, f"""
    SELECT count(*) AS total_records, count(DISTINCT domain) AS total_sites, count(DISTINCT fetched_date) AS total_dates, min(fetched_date) AS earliest_date, max(fetched_date) AS latest_date,
           count(DISTINCT raw_ean) FILTER (WHERE {EAN}) AS unique_eans, count(DISTINCT raw_brand) FILTER (WHERE {BRAND}) AS unique_brands,
           {_pct(_if(PRICED), "count(*)")} AS price_coverage_pct, {_pct(_if(EAN), "count(*)")} AS ean_coverage_pct, {_pct(_if(BRAND), "count(*)")} AS brand_coverage_pct,
           {_pct(_if("in_stock"), "count(in_stock)")} AS in_stock_pct, {_r2(f"avg(raw_price) {PAID}")} AS global_avg_price_mad FROM l""", dates="earliest_date latest_date")
_view("by_site", analytics.by_site, f"""
    SELECT domain, count(*) AS records, min(fetched_date) AS first_scraped, max(fetched_date) AS last_scraped, {_r2(f"min(raw_price) {PAID}")} AS min_price, {_r2(f"avg(raw_price) {PAID}")} AS avg_price,
           {_r2("max(raw_price)")} AS max_price, {_pct(_if(PRICED), "count(*)")} AS price_pct, {_pct(_if(EAN), "count(*)")} AS ean_pct, {_pct(_if(BRAND), "count(*)")} AS brand_pct,
           {_pct(_if("in_stock"), "count(in_stock)")} AS in_stock_pct, {_pct(_if(ERRS), "count(*)")} AS error_pct, {_if("extraction_method LIKE '%json_ld%'")} AS via_json_ld,
           {_if("extraction_method LIKE '%og_meta%'")} AS via_og_meta, {_if("extraction_method LIKE '%css%'")} AS via_css_only FROM l GROUP BY domain""", dates="first_scraped last_scraped")
_view("by_brand", analytics.by_brand, f"""
    SELECT raw_brand AS brand, count(DISTINCT domain) AS sites_count, count(*) AS total_listings, list(DISTINCT domain ORDER BY domain) AS found_on, {_r2(f"min(raw_price) {PAID}")} AS min_price,
           {_r2(f"avg(raw_price) {PAID}")} AS avg_price, {_r2("max(raw_price)")} AS max_price, {_pct(_if(EAN), "count(*)")} AS ean_pct FROM l WHERE {BRAND} GROUP BY raw_brand""", lists="found_on")


def _cross(low: str, tail: str = "") -> str:
    return f"""
    SELECT raw_ean, count(DISTINCT domain) AS site_count, list(DISTINCT domain ORDER BY domain) AS sites, min(raw_name) AS sample_name, min(raw_brand) AS brand, min(raw_currency) AS currency,
           {_r2(low)} AS min_price, {_r2("max(raw_price)")} AS max_price, {_r2(f"max(raw_price) - {low}")} AS price_spread,
           CAST(round(CAST((1 - CAST({low} AS DOUBLE) / nullif(CAST(max(raw_price) AS DOUBLE), 0)) * 100 AS DECIMAL(18,6)), 1) AS DOUBLE) AS saving_pct
    FROM l WHERE {EAN} AND length(raw_ean) BETWEEN 8 AND 14 GROUP BY raw_ean HAVING count(DISTINCT domain) >= 2 {tail}"""


_view("cross_site_eans", analytics.cross_site_eans, _cross(f"min(raw_price) {PAID}"), lists="sites")
_view("cross_site_top", analytics.cross_site_top, _cross("min(raw_price)", "ORDER BY price_spread DESC NULLS LAST, raw_ean LIMIT 20"), lists="sites")
_view("extraction_quality", analytics.extraction_quality, f"""
    SELECT domain, extraction_method, count(*) AS records, {_pct("count(*)", "sum(count(*)) OVER (PARTITION BY domain)")} AS pct_of_site,
           {_pct(_if(PRICED), "count(*)")} AS price_pct, {_pct(_if(EAN), "count(*)")} AS ean_pct FROM l GROUP BY domain, extraction_method""")
_view("extraction_methods", analytics.extraction_methods, f"""
    SELECT domain, extraction_method, count(*) AS records, {_pct("count(*)", "sum(count(*)) OVER (PARTITION BY domain)")} AS pct_of_site FROM l GROUP BY domain, extraction_method""")
BAND = "CASE WHEN raw_price < 50 THEN '1. < 50 MAD' WHEN raw_price < 100 THEN '2. 50-100 MAD' WHEN raw_price < 200 THEN '3. 100-200 MAD' WHEN raw_price < 500 THEN '4. 200-500 MAD' WHEN raw_price < 1000 THEN '5. 500-1000 MAD' ELSE '6. > 1000 MAD' END"
_view("price_bands", analytics.price_bands, f"SELECT domain, {BAND} AS price_band, count(*) AS products, {_r2('avg(raw_price)')} AS avg_price FROM l WHERE raw_price > 0 GROUP BY 1, 2")
_view("recent", lambda x: analytics.recent(x).select("domain", "fetched_date", "scraped_url_id", "url", F.col("raw_price").cast("double").alias("raw_price"), "has_price", "has_ean", "has_brand", "has_errors"), f"""
    SELECT l.domain, fetched_date, scraped_url_id, url, CAST(raw_price AS DOUBLE) AS raw_price, {PRICED} AS has_price, {EAN} AS has_ean, {BRAND} AS has_brand, {ERRS} AS has_errors
    FROM l JOIN (SELECT domain, max(fetched_date) AS last FROM l GROUP BY domain) d ON l.domain = d.domain AND fetched_date = last""", dates="fetched_date")
_view("listing_raw", lambda x: analytics.raw(x).select("scraped_url_id", "url", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), "has_price", "has_ean", "has_brand", "has_errors"), f"""
    SELECT scraped_url_id, url, strftime(make_timestamp(CAST(fetched_at_utc * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS fetched_at, {PRICED} AS has_price, {EAN} AS has_ean, {BRAND} AS has_brand, {ERRS} AS has_errors FROM l""")
_view("site_breakdown", analytics.site_breakdown, f"""
    SELECT domain, count(*) AS records, {_r2("avg(raw_price)")} AS avg_price, CAST(min(raw_price) AS DOUBLE) AS min_price, CAST(max(raw_price) AS DOUBLE) AS max_price, {_if(PRICED)} AS priced, {_if(EAN)} AS with_ean,
           {_if(BRAND)} AS with_brand, {_if("in_stock")} AS in_stock, {_pct(_if(EAN), "count(*)")} AS ean_pct, {_if("extraction_method LIKE '%json_ld%'")} AS via_json_ld,
           {_if("extraction_method LIKE '%og_meta%'")} AS via_og_meta, {_if("extraction_method LIKE '%css%'")} AS via_css FROM l GROUP BY domain""")
_view("adhoc_overview", analytics.adhoc_overview, f"""
    SELECT count(*) AS total_records, count(DISTINCT domain) AS sites, count(DISTINCT fetched_date) AS dates_covered, min(fetched_date) AS earliest_date, max(fetched_date) AS latest_date,
           {_pct(_if(PRICED), "count(*)")} AS price_coverage_pct, {_pct(_if(EAN), "count(*)")} AS ean_coverage_pct, {_pct(_if("in_stock"), "count(*)")} AS in_stock_pct FROM l""", dates="earliest_date latest_date")
_quant = ", ".join(f"CAST(round(CAST(quantile_cont(CAST(raw_price AS DOUBLE), {q}) AS DECIMAL(18,6)), 2) AS DOUBLE) AS {n}" for q, n in ((0.25, "p25"), (0.5, "median"), (0.75, "p75")))
_view("price_distribution", analytics.price_distribution, f"""
    SELECT domain, raw_currency, count(*) AS products, {_r2("min(raw_price)")} AS min_price, {_quant}, {_r2("max(raw_price)")} AS max_price, {_r2("avg(raw_price)")} AS avg_price
    FROM l WHERE raw_price > 0 GROUP BY domain, raw_currency""")
_view("top_brands", analytics.top_brands, f"""
    SELECT raw_brand, count(DISTINCT domain) AS sites_count, count(*) AS total_listings, {_r2("avg(raw_price)")} AS avg_price, list(DISTINCT domain ORDER BY domain) AS found_on
    FROM l WHERE {BRAND} GROUP BY raw_brand ORDER BY total_listings DESC, raw_brand LIMIT 20""", lists="found_on")
_view("ean_coverage", analytics.ean_coverage, f"SELECT domain, count(*) AS total, {_if(EAN)} AS with_ean, {_pct(_if(EAN), 'count(*)')} AS ean_pct FROM l GROUP BY domain")
_view("parse_errors", analytics.parse_errors, f"SELECT domain, count(*) AS total, {_if(ERRS)} AS with_errors, {_pct(_if(ERRS), 'count(*)')} AS error_pct FROM l GROUP BY domain")
_ORDER = "fetched_date, scraped_url_id, url, raw_price"
_view("stratified_sample", lambda x: analytics.stratified_sample(x, order=[F.col(c.strip()) for c in _ORDER.split(",")]).withColumn("raw_price", F.col("raw_price").cast("double")), f"""
    SELECT domain, raw_name, raw_brand, raw_ean, CAST(raw_price AS DOUBLE) AS raw_price, raw_currency, in_stock, raw_category, extraction_method, fetched_date
    FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY {_ORDER}) AS rn FROM l WHERE {PRICED} AND raw_name <> '') WHERE rn <= 10""", dates="fetched_date")
_view("daily_progress", analytics.daily_progress, f"SELECT fetched_date, domain, count(*) AS records, {_if('in_stock')} AS in_stock, {_r2('avg(raw_price)')} AS avg_price FROM l GROUP BY fetched_date, domain", dates="fetched_date")
_view("manifest", lambda x: analytics.manifest(x, "run", F.lit(NOW)), f"""
    SELECT domain, fetched_date, count(*) AS row_count, {_if(PRICED)} AS priced_rows, {_if(EAN)} AS ean_rows, {_if(BRAND)} AS branded_rows, {_if("in_stock")} AS in_stock_rows, CAST(0 AS BIGINT) AS rated_rows,
           {_if("extraction_method LIKE '%json_ld%'")} AS json_ld_rows, {_if("extraction_method LIKE '%og_meta%'")} AS og_meta_rows, {_if("extraction_method LIKE '%css_selectors%'")} AS css_rows,
           min(fetched_at_utc) AS earliest_fetch, max(fetched_at_utc) AS latest_fetch, 'run' AS run_id, '{NOW}' AS exported_at FROM l WHERE extraction_method <> 'failed' GROUP BY domain, fetched_date""", dates="fetched_date")
_view("dq_failure_rate", analytics.dq_failure_rate, f"""
    SELECT * FROM (SELECT domain, count(*) AS total_rows, {_if("extraction_method = 'failed'")} AS failed_rows, {_pct(_if("extraction_method = 'failed'"), "count(*)", 2)} AS failure_pct FROM l GROUP BY domain) WHERE failure_pct > 10""")
_view("dq_null_price", lambda x: analytics.dq_null_price(x, 10.0), f"""
    SELECT * FROM (SELECT domain, count(*) AS total_rows, {_if("raw_price IS NULL")} AS null_price_rows, {_pct(_if("raw_price IS NULL"), "count(*)", 2)} AS null_price_pct FROM l WHERE extraction_method <> 'failed' GROUP BY domain) WHERE null_price_pct > 10""")

# serving

POOL = """pool AS (SELECT *, row_number() OVER (PARTITION BY master_id ORDER BY current_price, domain) AS k FROM
    (SELECT *, max(CASE WHEN in_stock THEN 1 ELSE 0 END) OVER (PARTITION BY master_id) AS ready FROM sp WHERE current_price IS NOT NULL) WHERE ready = 0 OR in_stock),
    pools AS (SELECT s.master_id, p.price_min, p.price_max, p.price_avg, coalesce(c.currency, 'MAD') AS price_currency, s.sites_count, s.in_stock_count, p.cheapest_site, p.cheapest_url
      FROM (SELECT master_id, CAST(count(*) AS INTEGER) AS sites_count, CAST(count(*) FILTER (WHERE in_stock) AS INTEGER) AS in_stock_count FROM sp GROUP BY master_id) s
      LEFT JOIN (SELECT master_id, CAST(min(current_price) AS DOUBLE) AS price_min, CAST(max(current_price) AS DOUBLE) AS price_max, CAST(round_even(CAST(avg(current_price) AS DECIMAL(18,6)), 2) AS DOUBLE) AS price_avg,
                 min(CASE WHEN k = 1 THEN domain END) AS cheapest_site, min(CASE WHEN k = 1 THEN product_url END) AS cheapest_url FROM pool GROUP BY master_id) p ON s.master_id = p.master_id
      LEFT JOIN (SELECT master_id, currency FROM (SELECT *, row_number() OVER (PARTITION BY master_id ORDER BY current_price, domain) AS k FROM sp WHERE current_price IS NOT NULL) WHERE k = 1) c ON s.master_id = c.master_id)"""
POOLED = "price_min, price_max, price_avg, price_currency, sites_count, in_stock_count, cheapest_site, cheapest_url"


def _comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(serve.price_comparisons(kit.masters(spark, sf_dir), kit.site_products(spark, sf_dir)).drop("sites"))


query("price_comparison_list", f"SELECT m.id, name, brand, ean, category, {POOLED} FROM m JOIN pools ON m.id = master_id WHERE status = 'active' AND sites_count >= 2", L, M, SP, POOL)(_comparisons)


@query("price_comparison", f"SELECT m.id, name, brand, {POOLED} FROM m JOIN pools ON m.id = master_id WHERE m.id = '7'", M, SP, POOL)
def _(spark, sf_dir):
    return _plain(serve.price_comparison(kit.masters(spark, sf_dir), kit.site_products(spark, sf_dir), "7").select("id", "name", "brand", *POOLED.split(", ")))


@query("cheapest_site", "SELECT master_id, domain AS cheapest_site, CAST(current_price AS DOUBLE) AS price, in_stock FROM (SELECT *, row_number() OVER (PARTITION BY master_id ORDER BY in_stock DESC, current_price, domain) AS k FROM sp WHERE current_price IS NOT NULL) WHERE k = 1", SP)
def _(spark, sf_dir):
    return _plain(serve.cheapest_now(kit.site_products(spark, sf_dir)))


@query("ranked_offers", "SELECT id, CAST(row_number() OVER (PARTITION BY master_id ORDER BY in_stock DESC, coalesce(current_price, 9999), domain) AS INTEGER) AS rank, row_number() OVER (PARTITION BY master_id ORDER BY in_stock DESC, coalesce(current_price, 9999), domain) = 1 AS is_cheapest FROM sp", SP)
def _(spark, sf_dir):
    return serve.ranked_offers(kit.site_products(spark, sf_dir)).select("id", "rank", "is_cheapest")


@query("price_range_saving", "SELECT master_id, CAST(min(current_price) AS DOUBLE) AS price_min, CAST(max(current_price) AS DOUBLE) AS price_max, CAST(round_even((1 - CAST(min(current_price) AS DOUBLE) / nullif(CAST(max(current_price) AS DOUBLE), 0)) * 100, 0) AS INTEGER) AS saving_pct FROM sp WHERE current_price IS NOT NULL GROUP BY master_id", SP)
def _(spark, sf_dir):
    return _plain(serve.price_range(kit.site_products(spark, sf_dir)))


@query("offer_stats", f"SELECT m.id, coalesce(site_count, 0) AS site_count, coalesce(in_stock_sites, 0) AS in_stock_sites, lo AS current_min, hi AS current_max, mean AS current_avg FROM m LEFT JOIN (SELECT master_id, count(DISTINCT id) AS site_count, count(DISTINCT id) FILTER (WHERE in_stock) AS in_stock_sites, CAST(min(current_price) AS DOUBLE) AS lo, CAST(max(current_price) AS DOUBLE) AS hi, {_r2('avg(current_price)')} AS mean FROM sp GROUP BY master_id) s ON m.id = s.master_id", M, SP)
def _(spark, sf_dir):
    out = serve.offer_stats(kit.masters(spark, sf_dir), kit.site_products(spark, sf_dir))
    return _plain(out.select("id", "site_count", "in_stock_sites", "current_min", "current_max", "current_avg"))


WR = "wr AS (SELECT master_id, min(prix_pharmacien) AS wholesale_min, max(prix_pharmacien) AS wholesale_max, count(DISTINCT supplier) AS sources FROM w WHERE master_id IS NOT NULL AND prix_pharmacien IS NOT NULL GROUP BY master_id)"
RM = "rm AS (SELECT master_id, min(current_price) AS retail_min FROM sp WHERE current_price IS NOT NULL GROUP BY master_id)"
PCT = "CAST(round_even((CAST(retail_min AS DOUBLE) - CAST(wholesale_min AS DOUBLE)) / nullif(CAST(wholesale_min AS DOUBLE), 0) * 100, 0) AS INTEGER)"


@query("wholesale_range", "SELECT master_id, CAST(wholesale_min AS DOUBLE) AS wholesale_min, CAST(wholesale_max AS DOUBLE) AS wholesale_max, sources FROM wr", W, WR)
def _(spark, sf_dir):
    return _plain(serve.wholesale_range(kit.supplier_products(spark, sf_dir)))


@query("margin_pct", f"SELECT wr.master_id, CAST(retail_min AS DOUBLE) AS retail_min, CAST(wholesale_min AS DOUBLE) AS wholesale_min, CAST(retail_min - wholesale_min AS DOUBLE) AS margin, {PCT} AS margin_pct, CASE WHEN {PCT} >= 30 THEN 'good' WHEN {PCT} >= 10 THEN 'fair' ELSE 'poor' END AS margin_band, retail_min <= wholesale_min AS below_cost FROM wr JOIN rm ON wr.master_id = rm.master_id", SP, W, WR, RM)
def _(spark, sf_dir):
    return _plain(serve.margins(kit.site_products(spark, sf_dir), kit.supplier_products(spark, sf_dir)).drop("wholesale_max", "sources"))


@query("pricing_panel", "SELECT rm.master_id, CAST(retail_min - wholesale_min AS DOUBLE) AS margin, best_supplier, cheapest_site FROM wr JOIN rm ON wr.master_id = rm.master_id JOIN (SELECT master_id, supplier AS best_supplier FROM (SELECT *, row_number() OVER (PARTITION BY master_id ORDER BY prix_pharmacien, supplier) AS k FROM w WHERE master_id IS NOT NULL AND prix_pharmacien IS NOT NULL) WHERE k = 1) b ON b.master_id = rm.master_id JOIN (SELECT master_id, domain AS cheapest_site FROM (SELECT *, row_number() OVER (PARTITION BY master_id ORDER BY in_stock DESC, current_price, domain) AS k FROM sp WHERE current_price IS NOT NULL) WHERE k = 1) c ON c.master_id = rm.master_id", SP, W, WR, RM)
def _(spark, sf_dir):
    return _plain(serve.pricing_panel(kit.site_products(spark, sf_dir), kit.supplier_products(spark, sf_dir)).select("master_id", "margin", "best_supplier", "cheapest_site"))


def _alert(name: str, below: bool) -> None:
    sql = f"SELECT m.id, m.name, CAST(retail_min AS DOUBLE) AS retail_min, CAST(wholesale_min AS DOUBLE) AS wholesale_min FROM m JOIN wr ON m.id = wr.master_id JOIN rm ON m.id = rm.master_id WHERE retail_min {'<=' if below else '>'} wholesale_min"
    query(name, sql, M, SP, W, WR, RM)(lambda spark, sf_dir: _plain(serve.margin_alert(kit.masters(spark, sf_dir), kit.site_products(spark, sf_dir), kit.supplier_products(spark, sf_dir), below).select("id", "name", "retail_min", "wholesale_min")))


_alert("margin_alert_below", True)
_alert("margin_alert_ok", False)


def _has(name: str, has: bool) -> None:
    sql = f"SELECT id, name FROM m WHERE id {'' if has else 'NOT'} IN (SELECT master_id FROM w WHERE master_id IS NOT NULL)"
    query(name, sql, M, W)(lambda spark, sf_dir: serve.with_wholesale(kit.masters(spark, sf_dir), kit.supplier_products(spark, sf_dir), has).select("id", "name"))


_has("has_wholesale_semi", True)
_has("no_wholesale_anti", False)


@query("supplier_summary", "SELECT supplier, count(*) AS products, count(master_id) AS matched, count(*) FILTER (WHERE in_stock) AS in_stock, count(vendor_product_id) AS with_vendor_id, CAST(round_even(100.0 * count(master_id) / count(*), 0) AS INTEGER) AS matched_pct FROM w GROUP BY supplier", W)
def _(spark, sf_dir):
    return serve.supplier_summary(kit.supplier_products(spark, sf_dir))


@query("confidence_bands", "SELECT CASE WHEN match_confidence >= 0.95 THEN 'high' WHEN match_confidence >= 0.85 THEN 'medium' ELSE 'low' END AS band, count(*) AS products FROM m GROUP BY 1", M)
def _(spark, sf_dir):
    return serve.by_confidence(kit.masters(spark, sf_dir)).groupBy("band").agg(F.count("*").alias("products"))


@query("review_queue", "SELECT id, name FROM m WHERE status = 'active' AND match_confidence < 0.85 AND NOT manually_verified", M)
def _(spark, sf_dir):
    return serve.master_list(kit.masters(spark, sf_dir), needs_review=True).select("id", "name")


@query("master_search", "SELECT id, name FROM m WHERE contains(lower(name), 'an') OR contains(lower(brand), '12') ORDER BY name, id OFFSET 50 LIMIT 50", M)
def _(spark, sf_dir):
    return serve.page(serve.search(kit.masters(spark, sf_dir), "AN", "name").unionByName(serve.search(kit.masters(spark, sf_dir), "12", "brand")).distinct(), "name", "id", number=2, size=50).select("id", "name")


COVER = "cover AS (SELECT m.id, count(DISTINCT sp.id) AS n FROM m LEFT JOIN sp ON m.id = sp.master_id GROUP BY m.id)"


@query("site_coverage_bands", "SELECT CASE WHEN n >= 2 THEN 'multi' WHEN n = 1 THEN 'single' ELSE 'none' END AS band, count(*) AS products FROM cover GROUP BY 1", M, SP, COVER)
def _(spark, sf_dir):
    return serve.by_coverage(kit.masters(spark, sf_dir), kit.site_products(spark, sf_dir)).groupBy("band").agg(F.count("*").alias("products"))


@query("orphan_masters", "SELECT id FROM m WHERE id NOT IN (SELECT master_id FROM sp WHERE in_stock AND current_price IS NOT NULL)", M, SP)
def _(spark, sf_dir):
    return serve.orphans(kit.masters(spark, sf_dir), kit.site_products(spark, sf_dir).where("in_stock and current_price is not null")).select("id")


@query("price_history", "SELECT site_product_id, CAST(price AS DOUBLE) AS price, in_stock, CAST(fetched_date AS VARCHAR) AS day FROM pl WHERE master_id = '5'", PL)
def _(spark, sf_dir):
    return _plain(serve.price_history(kit.price_log(spark, sf_dir), "5").select("site_product_id", "price", "in_stock", F.date_format("logged_at", "yyyy-MM-dd").alias("day")))


@query("daily_price_summary", f"SELECT CAST(fetched_date AS VARCHAR) AS day, master_id, site_id, CAST(min(price) AS DOUBLE) AS price_min, CAST(max(price) AS DOUBLE) AS price_max, {_r2('avg(price)')} AS price_avg, bool_or(in_stock) AS any_in_stock FROM pl GROUP BY 1, 2, 3", PL)
def _(spark, sf_dir):
    return _plain(rollup.daily(kit.price_log(spark, sf_dir)).withColumn("day", F.date_format("day", "yyyy-MM-dd")))


# the queue

NOW_TS = "TIMESTAMP '1997-01-01 00:00:00'"


@query("pending_queue_topk", f"SELECT id, site_id, priority FROM q WHERE status = 'pending' AND url_type = 'product' AND (next_scrape_after IS NULL OR next_scrape_after <= {NOW_TS}) ORDER BY priority DESC, discovered_at, id LIMIT 500", Q)
def _(spark, sf_dir):
    return serve.pending_urls(kit.url_queue(spark, sf_dir), F.lit("1997-01-01 00:00:00").cast("timestamp")).select("id", "site_id", "priority")


@query("status_histogram", "SELECT s AS status, count(id) AS urls FROM (VALUES ('pending'), ('in_progress'), ('done'), ('failed')) t(s) LEFT JOIN q ON status = s GROUP BY s", Q)
def _(spark, sf_dir):
    return serve.status_histogram(kit.url_queue(spark, sf_dir), ("pending", "in_progress", "done", "failed"))


@query("status_group", "SELECT status, count(*) AS urls FROM q WHERE status IN ('pending', 'failed') GROUP BY status", Q)
def _(spark, sf_dir):
    return serve.status_group(kit.url_queue(spark, sf_dir), "needs_work").groupBy("status").agg(F.count("*").alias("urls"))


@query("queue_upsert", f"""SELECT url, CASE WHEN s.id IS NULL THEN 'created' WHEN t.url IS NOT NULL AND s.status IN ('done', 'failed', 'blocked', 'not_found') AND (s.next_scrape_after IS NULL OR s.next_scrape_after <= {NOW_TS}) THEN 'reset' ELSE 'kept' END AS change,
    CASE WHEN s.id IS NULL OR (t.url IS NOT NULL AND s.status IN ('done', 'failed', 'blocked', 'not_found') AND (s.next_scrape_after IS NULL OR s.next_scrape_after <= {NOW_TS})) THEN 'pending' ELSE s.status END AS status
    FROM (SELECT * FROM q WHERE status <> 'pending') s FULL JOIN (SELECT site_id, url FROM q WHERE url_type = 'product') t USING (site_id, url)""", Q)
def _(spark, sf_dir):
    queue = kit.url_queue(spark, sf_dir)
    known = queue.where("status != 'pending'")  # those that wait are new to the queue
    found = queue.where("url_type = 'product'").select("site_id", "url")
    return urlqueue.discovered(known, found, F.lit("1997-01-01 00:00:00").cast("timestamp")).select("url", "change", "status")


OUTCOME = "CASE WHEN http_status_code BETWEEN 200 AND 299 THEN 'success' WHEN http_status_code = 403 THEN 'blocked' WHEN http_status_code IN (404, 410, 451) THEN 'not_found' WHEN http_status_code = 429 THEN 'rate_limited' ELSE 'http_error' END"


@query("url_status_transition", f"SELECT outcome, CASE outcome WHEN 'success' THEN 'done' WHEN 'blocked' THEN 'blocked' WHEN 'not_found' THEN 'not_found' ELSE 'failed' END AS status, count(*) AS fetches FROM (SELECT {OUTCOME} AS outcome FROM fl) GROUP BY 1, 2", FL)
def _(spark, sf_dir):
    rows = kit.fetch_log(spark, sf_dir).select(urlqueue.outcome(F.col("http_status_code")).alias("outcome"))
    return rows.groupBy("outcome", urlqueue.status_after(F.col("outcome")).alias("status")).agg(F.count("*").alias("fetches"))


@query("scrape_log_page", f"SELECT url_id, site_id, {OUTCOME} AS status FROM fl WHERE site_id = '3' ORDER BY fetched_at DESC, url_id LIMIT 100", FL)
def _(spark, sf_dir):
    rows = serve.fetch_logs(urlqueue.fetch_logged(kit.fetch_log(spark, sf_dir), "w1"), site_id="3")
    return serve.page(rows, F.desc("fetched_at"), "url_id", size=100).select("url_id", "site_id", "status")


# matching

MI = "mi AS (SELECT * FROM m WHERE status IN ('active', 'under_review'))"
# names of the test data are plain lower-case words, so sorting their words is all that normalising does
NORM = "array_to_string(list_sort(list_filter(string_split(lower({0}), ' '), lambda w: length(w) > 1 AND w NOT IN ('{1}'))), ' ')"


_STOP = "', '".join(text.STOP_WORDS)


def _norm(c: str) -> str:
    return NORM.format(f"regexp_replace(strip_accents({c}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')", _STOP)


def _rows(spark, sf_dir) -> DataFrame:
    return matching.prepared(kit.listings(spark, sf_dir))


@query("match_tier1_ean", "SELECT scraped_url_id AS row_id, id AS master_id, count(*) AS n FROM l JOIN (SELECT ean, max(id) AS id FROM mi WHERE ean <> '' GROUP BY ean) e ON raw_ean = ean GROUP BY 1, 2", L, M, MI)
def _(spark, sf_dir):
    found = matching.by_ean(_rows(spark, sf_dir), matching.indexed(kit.masters(spark, sf_dir)))
    return found.groupBy("row_id", "master_id").agg(F.count("*").alias("n"))


LAST = f"last AS (SELECT * FROM (SELECT *, {_norm('name')} AS norm, row_number() OVER (PARTITION BY {_norm('name')} ORDER BY brand DESC, name DESC, id DESC) AS k FROM mi) WHERE k = 1)"


@query("match_tier3_exact_gate", f"SELECT scraped_url_id AS row_id, l.domain, last.id AS master_id, count(*) AS n FROM l JOIN last ON {_norm('raw_name')} = norm AND (raw_brand = '' OR brand = '' OR {_norm('raw_brand')} = {_norm('brand')}) WHERE norm <> '' AND (l.domain, last.id) NOT IN (SELECT domain, master_id FROM sp WHERE in_stock) GROUP BY 1, 2, 3", L, M, MI, SP, LAST)
def _(spark, sf_dir):
    links = kit.site_products(spark, sf_dir).where("in_stock").select("domain", "master_id")
    rows = _rows(spark, sf_dir)
    found = matching.by_name(rows, matching.indexed(kit.masters(spark, sf_dir)), links)
    return found.join(rows.select("row_id", "domain"), "row_id").groupBy("row_id", "domain", "master_id").agg(F.count("*").alias("n"))


VOLUME_NAME = "p_name || ' ' || CAST(p_size AS VARCHAR) || ' ml'"


@query("extract_volume", f"SELECT p_partkey, regexp_extract({VOLUME_NAME}, '([0-9]+) ml', 1) || 'ml' AS volume FROM part")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.extract_volume(F.concat("p_name", F.lit(" "), "p_size", F.lit(" ml"))).alias("volume"))


@query("fingerprint", f"SELECT p_partkey, replace({_norm('p_brand')}, ' ', '') || '_' || CAST(p_size AS VARCHAR) || 'ml_' || list_filter(list_sort(string_split(lower(p_name), ' ')), lambda w: length(w) > 1 AND NOT regexp_full_match(w, '[0-9]+[a-z]+') AND w NOT IN ('{_STOP}'))[1] AS fp FROM part")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", text.fingerprint(F.col("p_brand"), F.concat("p_name", F.lit(" "), "p_size", F.lit(" ml"))).alias("fp"))


UNITS = text.JOINED_UNITS


@query("normalise_name", f"SELECT doc_id, md5({_norm('text')}) AS digest FROM (SELECT doc_id, regexp_replace(lower(strip_accents(text)), '([0-9]+)\\s+({UNITS})', '\\1\\2', 'g') AS text FROM documents)")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.normalise_name(F.col("text"))).alias("digest"))


FP = f"fp AS (SELECT p_partkey, p_brand, p_name, replace({_norm('p_brand')}, ' ', '') || '_' || CAST(p_size AS VARCHAR) || 'ml_' || list_filter(list_sort(string_split(lower(p_name), ' ')), lambda w: length(w) > 1 AND NOT regexp_full_match(w, '[0-9]+[a-z]+') AND w NOT IN ('{_STOP}'))[1] AS fp FROM part)"


@query("match_tier35_fingerprint", "SELECT CAST(a.p_partkey AS VARCHAR) AS row_id, CAST(b.p_partkey AS VARCHAR) AS master_id, 4 AS tier, CAST(0.92 AS DOUBLE) AS confidence, false AS needs_review FROM fp a JOIN (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY p_brand DESC, p_name DESC, CAST(p_partkey AS VARCHAR) DESC) AS k FROM fp) b ON a.fp = b.fp AND k = 1", FP)
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = F.concat("p_name", F.lit(" "), "p_size", F.lit("ml"))
    key = text.fingerprint(F.col("p_brand"), name)
    rows = part.select(F.col("p_partkey").cast("string").alias("row_id"), F.lit("").alias("domain"), key.alias("fingerprint"))
    index = part.select(F.col("p_partkey").cast("string").alias("master_id"), F.struct("p_brand", "p_name", F.col("p_partkey").cast("string")).alias("place"), F.lit("").alias("m_brand"), key.alias("m_fingerprint"))
    return matching.by_fingerprint(rows, index, None, 0.92)


@query("match_fuzzy_topk", "SELECT CAST(p_partkey AS VARCHAR) || '-2' AS row_id, CAST(p_partkey AS VARCHAR) AS master_id, 3 AS tier, confidence, false AS needs_review FROM run WHERE kind = 2 AND known", RUN)
def _(spark, sf_dir):
    """A letter is missing in each name."""
    rows = matching.prepared(kit.run_listings(spark, sf_dir).where("kind = 2"))
    return matching.by_similarity(rows, matching.indexed(kit.catalogue(spark, sf_dir)), None, 90.0)


@query("run_tiers", "SELECT row_id, master_id, tier, confidence, needs_review, is_new FROM run", RUN)
def _(spark, sf_dir):
    return matching.match(kit.run_listings(spark, sf_dir), kit.catalogue(spark, sf_dir), kit.run_links(spark, sf_dir))


@query("run_tier_counts", "SELECT tier, count(*) AS listings, count(*) FILTER (WHERE is_new) AS new, count(*) FILTER (WHERE needs_review) AS review FROM run GROUP BY tier", RUN)
def _(spark, sf_dir):
    return matching.run_stats(matching.match(kit.run_listings(spark, sf_dir), kit.catalogue(spark, sf_dir), kit.run_links(spark, sf_dir)))


@query("run_new_products", "SELECT row_id, CASE WHEN kind = 2 THEN CAST(p_partkey AS VARCHAR) || '-1' ELSE row_id END AS first_row, CASE WHEN kind IN (1, 2) AND NOT known THEN 2 ELSE 1 END AS listings FROM run WHERE is_new", RUN)
def _(spark, sf_dir):
    """The listings of a new product: its name with the words in another order, and with a letter missing."""
    rows = kit.run_listings(spark, sf_dir)
    found = written(matching.match(rows, kit.catalogue(spark, sf_dir), kit.run_links(spark, sf_dir)), "run-matches")
    ids = written(matching.new_products(rows, found), "run-products")
    groups = ids.groupBy("master_id").agg(F.min("row_id").alias("first_row"), F.count("*").cast("int").alias("listings"))
    return ids.join(groups, "master_id").select("row_id", "first_row", "listings")


VEC = "v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)"


NEAREST = VEC, "n AS (SELECT a.vec_id, b.vec_id AS other, list_cosine_similarity(a.e, b.e) AS s, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.e, b.e) DESC, CAST(b.vec_id AS VARCHAR)) AS k FROM v a JOIN v b ON a.vec_id % 50 = 0 AND (b.vec_id <> a.vec_id OR a.vec_id % 100 = 0))"


def _vectors(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The search's queries are the vectors with an id divisible by 50; each asks as a site of its own, and half of these carry the vector itself."""
    v = table(spark, sf_dir, "embeddings").withColumn("id", F.col("vec_id").cast("string"))
    rows = v.where("vec_id % 50 = 0").select(F.col("id").alias("row_id"), F.col("id").alias("domain"), F.lit("").alias("brand_norm"), F.col("embedding").alias("name_embedding"))
    index = v.select(F.col("id").alias("master_id"), F.struct("id").alias("place"), F.lit("").alias("m_brand"), F.col("embedding").alias("m_embedding"))
    return rows, index, rows.where("cast(row_id as long) % 100 != 0").select("domain", F.col("domain").alias("master_id"))


@query("match_vector_knn", "SELECT CAST(vec_id AS VARCHAR) AS row_id, CAST(other AS VARCHAR) AS master_id, round(s, 6) AS score FROM n WHERE k = 1 AND s >= 0.1", *NEAREST)
def _(spark, sf_dir):
    return matching.nearest(*_vectors(spark, sf_dir), 0.1).select("row_id", "master_id", F.round("score", 6).alias("score"))


@query("match_vector_tiers", "SELECT CAST(vec_id AS VARCHAR) AS row_id, CAST(other AS VARCHAR) AS master_id, CASE WHEN s >= 0.9 THEN 4 ELSE 5 END AS tier, round(s, 4) AS confidence, s < 0.9 AS needs_review FROM n WHERE k = 1 AND s >= 0.3", *NEAREST)
def _(spark, sf_dir):
    return matching.by_vector(*_vectors(spark, sf_dir), matching.Thresholds(review=0.3))


@query("vector_search", "SELECT CAST(vec_id AS VARCHAR) AS query, CAST(k AS INTEGER) AS rank, CAST(other AS VARCHAR) AS id, round(s, 6) AS score, true AS recalled FROM (SELECT a.vec_id, b.vec_id AS other, list_cosine_similarity(a.e, b.e) AS s, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.e, b.e) DESC, CAST(b.vec_id AS VARCHAR)) AS k FROM v a JOIN v b ON a.vec_id % 50 = 0) WHERE k <= 10", VEC)
def _(spark, sf_dir):
    """The ten nearest of each vector with an id divisible by 50, exactly, and whether the index finds nine tenths of them in the lists that it was told to probe."""
    v = table(spark, sf_dir, "embeddings")
    index = vector_index.build(v, id_col="vec_id", vector_col="embedding")
    asked = vector_index.asked_of(v.where("vec_id % 50 = 0"), "vec_id", "embedding")
    exact = written(vector_index.search(index, asked, 10, exact=True), "vector-exact")
    probed = vector_index.search(index, asked, 10, probes=vector_index.probes_for(index, 0.95))
    recall = exact.join(probed.select("query", "id", F.lit(1).alias("hit")), ["query", "id"], "left").agg(F.count("hit") / F.count("*")).first()[0]
    return exact.select("query", "rank", "id", F.round("score", 6).alias("score"), F.lit(recall >= 0.9).alias("recalled"))


@query("match_cascade")
def _(spark, sf_dir):
    links = kit.site_products(spark, sf_dir).where("in_stock").select("domain", "master_id")
    return matching.match(kit.listings(spark, sf_dir), kit.masters(spark, sf_dir), links)


@query("wholesale_match_ean", "SELECT supplier, code, id AS master_id FROM w JOIN m ON ltrim(regexp_extract(w.name, '([0-9]{13})', 1)) = m.ean WHERE master_id IS NULL AND status = 'active' AND ean <> ''", W, M)
def _(spark, sf_dir):
    return matching.wholesale_by_ean(*matching.wholesale_keys(kit.supplier_products(spark, sf_dir), kit.masters(spark, sf_dir))).select("supplier", "code", "master_id")


@query("wholesale_match_fuzzy", "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS supplier, 'C' || CAST(l_partkey AS VARCHAR) AS code, CAST(l_partkey AS VARCHAR) AS master_id, confidence, confidence >= 0.95 AS manually_verified FROM lineitem JOIN run ON l_partkey = p_partkey AND kind = 2 AND known", RUN)
def _(spark, sf_dir):
    """No offer has an identifier, and in each name a letter is missing: similarity decides all."""
    return matching.match_wholesale(kit.offered_names(spark, sf_dir), kit.catalogue(spark, sf_dir))


@query("token_sort_ratio")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", similarity.scorer(similarity.token_sort_ratio)(F.col("p_name"), F.col("p_type")).alias("score"))


# the catalogue


@query("tag_union", "SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat(string_split(p_name, ' '), string_split(p_type, ' ')))), ',') AS tags FROM part")
def _(spark, sf_dir):
    return _plain(table(spark, sf_dir, "part").select("p_partkey", gold.tag_union(F.split("p_name", " "), F.split("p_type", " ")).alias("tags")))


@query("best_image", "SELECT p_partkey, CASE WHEN p_size % 3 < p_size % 2 + 1 OR (p_size % 3 = p_size % 2 + 1 AND p_size % 5 + 1 > p_size % 4 + 1) THEN 'new' ELSE 'old' END AS images FROM part")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = {"zero.example": 0, "one.example": 1, "two.example": 2}
    pick = lambda c: F.element_at(F.array(*[F.lit(n) for n in names]), (c + 1).cast("int"))
    old = F.array_repeat(F.concat(F.lit("https://"), pick(F.col("p_size") % 2 + 1), F.lit("/old")), (F.col("p_size") % 4 + 1).cast("int"))
    new = F.array_repeat(F.lit("https://x/new"), (F.col("p_size") % 5 + 1).cast("int"))
    chosen = gold.best_images(old, new, pick(F.col("p_size") % 3), names)
    return part.select("p_partkey", F.substring_index(chosen[0], "/", -1).alias("images"))


NEWS = "n AS (SELECT master_id, min(nullif(raw_brand, '')) AS b, min(nullif(raw_ean, '')) AS e FROM l GROUP BY master_id)"


@query("enrich_fill_missing", "SELECT id, coalesce(nullif(brand, ''), b, brand) AS brand, coalesce(nullif(ean, ''), e, ean) AS ean FROM (SELECT id, '' AS brand, ean FROM m) m LEFT JOIN n ON id = master_id", L, M, NEWS)
def _(spark, sf_dir):
    masters = kit.masters(spark, sf_dir).withColumn("brand", F.lit("")).withColumn("last_matched_at", F.lit(None).cast("timestamp"))
    rows = kit.listings(spark, sf_dir)
    found = rows.select(F.col("scraped_url_id").alias("row_id"), "master_id", F.lit(1.0).alias("confidence"), F.lit(False).alias("needs_review"))
    keyed = rows.withColumn("scraped_url_id", F.concat_ws("|", "scraped_url_id", "url", "raw_price", "fetched_date"))
    found = keyed.select(F.col("scraped_url_id").alias("row_id"), F.col("master_id"), F.lit(1.0).alias("confidence"), F.lit(False).alias("needs_review")).distinct()
    out = gold.enriched(masters, keyed.drop("master_id").dropDuplicates(["scraped_url_id"]), found, F.lit(NOW).cast("timestamp"), {})
    return out.select("id", "brand", "ean")


@query("offer_upsert", "SELECT coalesce(o.product_url, n.url) AS product_url, CAST(coalesce(n.price, o.current_price) AS DOUBLE) AS current_price, o.product_url IS NULL AS is_new FROM (SELECT * FROM sp WHERE in_stock) o FULL JOIN (SELECT product_url AS url, current_price + 1 AS price FROM sp WHERE currency = 'MAD') n ON o.product_url = n.url", SP)
def _(spark, sf_dir):
    offers = kit.site_products(spark, sf_dir)
    old = offers.where("in_stock").select("product_url", "current_price").withColumn("is_new", F.lit(False))
    new = offers.where("currency = 'MAD'").select("product_url", (F.col("current_price") + 1).cast("decimal(12,2)").alias("current_price"))
    return _plain(gold.upsert_offers(old, new).withColumn("is_new", F.col("is_new").isNull()))


# scalars, pages and sources


@query("normalise_price", "SELECT p_partkey, round(CAST(p_retailprice AS DECIMAL(12,2)), 2)::DOUBLE AS price, CASE p_size % 3 WHEN 0 THEN 'MAD' WHEN 1 THEN 'EUR' ELSE 'USD' END AS currency FROM part")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    sign = F.when(F.col("p_size") % 3 == 0, " DH").when(F.col("p_size") % 3 == 1, " €").otherwise("")
    raw = F.concat(F.replace(F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")), sign)
    p = prices.price(raw, "USD")
    return part.select("p_partkey", p["price"].alias("price"), p["currency"].alias("currency"))


_noise = "regexp_replace(regexp_replace(regexp_replace({0}, '(?is)Commandez\\b.*?à seulement.*?(?:د\\.م\\.|MAD|DH)\\s*chez\\s+[^\\s.]+(?:\\.[a-z]{{2,3}})?\\.?', '', 'g'), '(?i)Livraison\\b[^.]*\\.?', '', 'g'), '(?i)Produits?\\s+100\\s*%\\s*origina(?:ux|l)\\.?', '', 'g')"


@query("clean_description", f"SELECT doc_id, substr(trim({_noise.format("text || ' Livraison gratuite partout. Produits 100% original.'")}, ' '), 1, 2000) AS description FROM documents")
def _(spark, sf_dir):
    noisy = F.concat("text", F.lit(" Livraison gratuite partout. Produits 100% original."))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_description(noisy).alias("description"))


@query("host_from_url", "SELECT page_id, lower(regexp_extract(url, '://([^/?#]+)', 1)) AS host FROM pages")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.url_host(F.col("url")).alias("host"))


@query("hybrid_gap_fill", "SELECT DISTINCT url FROM pages WHERE starts_with(url, 'https') OR contains(url, '/en/')")
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return readers.hybrid(pages.where("startswith(url, 'https')"), pages.where("contains(url, '/en/')")).distinct()


def _text_of(tag: str) -> str:
    inner = f"regexp_replace(regexp_extract(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>', 1), '(?s)<[^>]*>', ' ', 'g')"
    for mark, char in (("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")):
        inner = f"replace({inner}, '{mark}', '{char}')"
    return f"nullif(trim(regexp_replace({inner}, '\\s+', ' ', 'g')), '')"


HREF = r"""'(?is)<a\s[^>]*?href\s*=\s*["'']([^"''#]+)'"""


@query("html_h1_title_links", f"SELECT page_id, {_text_of('h1')} AS h1, {_text_of('title')} AS title, len(regexp_extract_all(html, {HREF})) AS links, len(regexp_extract_all(html, '(?i)<script')) AS scripts FROM pages")
def _(spark, sf_dir):
    return extract.page_summary(table(spark, sf_dir, "pages"))


@query("page_links", f"SELECT DISTINCT CASE WHEN starts_with(h, 'http') THEN h WHEN starts_with(h, '/') THEN origin || h ELSE origin || '/' || h END AS url FROM (SELECT replace(h, '&amp;', '&') AS h, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) AS origin FROM (SELECT url, unnest(regexp_extract_all(html, {HREF}, 1)) AS h FROM pages))")
def _(spark, sf_dir):
    return extract.links(table(spark, sf_dir, "pages"))


@query("jsonld_extract", "SELECT p_partkey, p_name AS raw_name, p_brand AS raw_brand, p_retailprice AS raw_price, 'MAD' AS raw_currency, 'json_ld' AS extraction_method FROM part")
def _(spark, sf_dir):
    """Product pages made from the parts."""
    record = F.to_json(F.struct(F.lit("Product").alias("@type"), F.col("p_name").alias("name"), F.struct(F.col("p_brand").alias("name")).alias("brand"), F.struct(F.col("p_retailprice").alias("price"), F.lit("MAD").alias("priceCurrency")).alias("offers")))
    html = F.concat(F.lit('<html><script type="application/ld+json">'), record, F.lit("</script></html>"))
    return extract.listing_fields(table(spark, sf_dir, "part").select("p_partkey", html.alias("html"))).select("p_partkey", "raw_name", "raw_brand", "raw_price", "raw_currency", "extraction_method")


@query("sitemap_parse", "SELECT url, CASE WHEN page_id % 3 = 0 THEN '2024-01-01' END AS lastmod FROM pages WHERE page_id % 3 <> 1")
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    entry = F.concat(F.lit("<url><loc>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</loc>"), F.when(F.col("page_id") % 3 == 0, "<lastmod>2024-01-01</lastmod>").when(F.col("page_id") % 3 == 1, "<lastmod>2022-06-01</lastmod>").otherwise(""), F.lit("</url>"))
    maps = pages.groupBy(F.pmod("page_id", F.lit(8)).alias("n")).agg(F.concat(F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>")).alias("xml"))
    return readers.sitemap_urls(maps, since="2023-01-01").select(F.col("loc").alias("url"), "lastmod")


@query("js_catalogue_parse", "SELECT 'C' || CAST(p_partkey AS VARCHAR) AS code, p_name AS name, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS prix_pharmacien FROM part WHERE p_size % 4 <> 0")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    item = F.to_json(F.struct(F.when(F.col("p_size") % 4 != 0, F.concat(F.lit("C"), "p_partkey")).otherwise("").alias("CODE_PRODU"), F.col("p_name").alias("NOM_PRODUI"), F.replace(F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(",")).alias("PRIX_PHAR"), F.lit("0").alias("PPM"), F.lit("CR").alias("FORME_PROD")))
    files = part.groupBy(F.pmod("p_partkey", F.lit(4)).alias("n")).agg(F.concat(F.lit("var products = ["), F.array_join(F.collect_list(item), ","), F.lit("];")).alias("body"))
    return _plain(wholesale.catalogue_rows(files.select(F.inline(readers.catalogue_items(F.col("body")))), "s").select("code", "name", "prix_pharmacien"))


@query("api_items", "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    bodies = events.select(F.concat(F.lit('{"items":['), "props", F.lit("]}")).alias("body"))
    return readers.api_items(bodies).select(readers.field(F.col("item"), "k").alias("k")).groupBy("k").agg(F.count("*").alias("n"))


@query("availability_parse", "SELECT event_id, event_id % 3 <> 0 AS in_stock FROM events")
def _(spark, sf_dir):
    body = F.concat(F.lit('{"stock": '), F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("event_id") % 3), F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", prices.availability(body).alias("in_stock"))


@query("order_payload", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '0.00' ELSE CAST(p_retailprice AS VARCHAR) END AS unit_price, CASE WHEN p_size % 3 = 0 THEN 0.0 ELSE p_retailprice END AS purchase_price, CASE WHEN p_size % 4 = 0 THEN 'note' END AS comment, CAST(p_size AS VARCHAR) AS quantity FROM part")
def _(spark, sf_dir):
    size = F.col("p_size")
    price = F.when(size % 3 != 0, F.col("p_retailprice")).when(size % 2 == 0, 0.0)  # of those without a price, some have none and some have 0
    rows = table(spark, sf_dir, "part").select("p_partkey", F.lit(1).alias("supplier_id"), F.col("p_partkey").alias("product_id"), size.alias("quantity"), price.alias("unit_price"), F.lit(None).cast("double").alias("sale_price"), F.when(size % 4 == 0, "note").otherwise("").alias("notes"))
    body = wholesale.order_payload(F.lit("2024-01-01"))
    get = lambda p: F.get_json_object(body, f"$.{p}")
    return rows.select("p_partkey", get("products[0].unit_price").alias("unit_price"), get("products[0].purchase_price").cast("double").alias("purchase_price"), get("comment").alias("comment"), get("products[0].quantity").alias("quantity"))


# streams


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    events = spark.readStream.schema(schema).parquet(f"{path}*")  # a pattern, as a stream reads folders
    return events.select(F.col("user_id").cast("string").alias("master_id"), F.col("event_type").alias("site_id"), F.col("value").cast("decimal(12,2)").alias("price"), (F.col("event_id") % 2 == 0).alias("in_stock"), F.col("ts").cast("timestamp").alias("logged_at"), "event_id")


def _drained(stream: DataFrame, mode: str, name: str, keys: list[str] | None = None) -> DataFrame:
    """Run a stream over all there is into the shared folder, and read the result; with ``keys`` a batch changes the rows of its keys."""
    spark = stream.sparkSession
    root = folder(spark, name)
    if keys:
        kept = SnapshotTable(spark, f"{root}/out")
        rollup.start(stream, rollup.into_snapshot(kept, keys), f"{root}/checkpoint", mode).awaitTermination()
        return kept.read()

    def sink(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={n}")

    rollup.start(stream, sink, f"{root}/checkpoint", mode).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out/batch=*")


EVENTS = "e AS (SELECT CAST(user_id AS VARCHAR) AS master_id, event_type AS site_id, CAST(value AS DECIMAL(12,2)) AS price, event_id % 2 = 0 AS in_stock, ts, event_id FROM events)"


@query("stream_daily_rollup", f"SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, site_id, CAST(min(price) AS DOUBLE) AS price_min, CAST(max(price) AS DOUBLE) AS price_max, {_r2('avg(price)')} AS price_avg, bool_or(in_stock) AS any_in_stock FROM e GROUP BY 1, 2", EVENTS)
def _(spark, sf_dir):
    out = _drained(rollup.daily_stream(_stream(spark, sf_dir), ("site_id",)), "update", "rollup", ["day", "site_id"])
    return _plain(out.withColumn("day", F.date_format("day", "yyyy-MM-dd")))


@query("stream_dedupe", "SELECT DISTINCT event_id FROM events")
def _(spark, sf_dir):
    twice = _stream(spark, sf_dir).withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    return _drained(rollup.deduplicated(twice, ["event_id"], "logged_at", "400 days").select("event_id"), "append", "dedupe")
