"""The stored relations made from the star-schema test tables, in Spark and in SQL."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.session import table


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its supplier's nation. Suppliers come first, alone: the planner then knows how small they are, and rows are narrow where it shuffles them."""
    line, supplier, nation = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    sites = nation.select("n_nationkey", F.lower("n_name").alias("domain"))
    return line.join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(F.broadcast(sites), F.col("s_nationkey") == F.col("n_nationkey"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of all sites: lineitem with its part, the supplier's nation as the site."""
    rows = _lines(spark, sf_dir).join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    c = F.col
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(c("l_extendedprice") * 100).cast("long")).alias("scraped_url_id"),
        c("n_nationkey").cast("string").alias("site_id"),
        F.concat(F.lit("https://"), c("domain"), F.lit("/p/"), c("l_partkey")).alias("url"),
        c("p_name").alias("raw_name"),
        F.when(c("p_size") % 5 == 0, "").otherwise(c("p_brand")).alias("raw_brand"),
        F.when(c("p_size") % 7 != 0, c("l_extendedprice").cast("decimal(12,2)")).alias("raw_price"),
        F.when(c("p_size") % 4 == 0, "EUR").otherwise("MAD").alias("raw_currency"),
        c("p_type").alias("raw_description"),
        F.when(c("p_size") % 3 == 0, "").otherwise(F.lpad(c("p_partkey").cast("string"), 13, "0")).alias("raw_ean"),
        F.concat(F.lit("S"), c("l_suppkey")).alias("raw_sku"),
        F.lit("").alias("raw_mpn"),
        F.lit("[]").alias("raw_images"),
        (c("l_linestatus") == "O").alias("in_stock"),
        c("l_quantity").cast("int").alias("raw_stock_qty"),
        F.lit(None).cast("double").alias("raw_rating"),
        c("l_linenumber").cast("int").alias("raw_review_count"),
        c("p_type").alias("raw_category"),
        F.concat(F.lit('["'), c("p_type"), F.lit('"]')).alias("raw_tags"),
        F.lit("{}").alias("raw_attributes"),
        F.when(c("l_returnflag") == "A", "json_ld").when(c("l_returnflag") == "N", "og_meta+css_selectors").otherwise("failed").alias("extraction_method"),
        F.when(c("l_tax") >= 0.08, '["price"]').otherwise("[]").alias("parse_errors"),
        F.unix_timestamp(c("l_shipdate").cast("timestamp")).cast("double").alias("fetched_at_utc"),
        F.lit("bronze").alias("bronze_source_key"),
        "domain",
        c("l_shipdate").cast("date").alias("fetched_date"),
        c("l_partkey").cast("string").alias("master_id"),
    )


LISTINGS = """
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS scraped_url_id, CAST(n_nationkey AS VARCHAR) AS site_id,
           'https://' || lower(n_name) || '/p/' || CAST(l_partkey AS VARCHAR) AS url, p_name AS raw_name,
           CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS raw_brand,
           CASE WHEN p_size % 7 <> 0 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS raw_price,
           CASE WHEN p_size % 4 = 0 THEN 'EUR' ELSE 'MAD' END AS raw_currency, p_type AS raw_description,
           CASE WHEN p_size % 3 = 0 THEN '' ELSE lpad(CAST(p_partkey AS VARCHAR), 13, '0') END AS raw_ean,
           'S' || CAST(l_suppkey AS VARCHAR) AS raw_sku, l_linestatus = 'O' AS in_stock, p_type AS raw_category,
           CASE l_returnflag WHEN 'A' THEN 'json_ld' WHEN 'N' THEN 'og_meta+css_selectors' ELSE 'failed' END AS extraction_method,
           CASE WHEN l_tax >= 0.08 THEN '["price"]' ELSE '[]' END AS parse_errors,
           CAST(epoch(l_shipdate) AS DOUBLE) AS fetched_at_utc, lower(n_name) AS domain, CAST(l_shipdate AS DATE) AS fetched_date,
           CAST(l_partkey AS VARCHAR) AS master_id, l_linenumber AS raw_review_count
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""


def masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "part").select(
        c("p_partkey").cast("string").alias("id"),
        c("p_name").alias("name"),
        F.when(c("p_size") % 5 == 0, "").otherwise(c("p_brand")).alias("brand"),
        F.when(c("p_size") % 3 == 0, "").otherwise(F.lpad(c("p_partkey").cast("string"), 13, "0")).alias("ean"),
        c("p_type").alias("category"),
        F.when(c("p_size") % 11 == 0, "under_review").when(c("p_size") % 13 == 0, "discontinued").otherwise("active").alias("status"),
        (c("p_size") / 50.0).alias("match_confidence"),
        (c("p_size") % 2 == 0).alias("manually_verified"),
    )


MASTERS = """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS brand,
           CASE WHEN p_size % 3 = 0 THEN '' ELSE lpad(CAST(p_partkey AS VARCHAR), 13, '0') END AS ean, p_type AS category,
           CASE WHEN p_size % 11 = 0 THEN 'under_review' WHEN p_size % 13 = 0 THEN 'discontinued' ELSE 'active' END AS status,
           p_size / 50.0 AS match_confidence, p_size % 2 = 0 AS manually_verified
    FROM part"""


def site_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current offer of each product and site: the lowest price at the latest date. Of ten products one has no offer, one those of one site at most.

    Rows are dealt by product once, before they get its columns; join and groups stay where they are.
    """
    c, ten = F.col, F.col("l_partkey") % 10
    lines = _lines(spark, sf_dir).where((ten > 1) | ((ten == 1) & (c("n_nationkey") == c("l_partkey") % 25)))
    lines = lines.select("l_partkey", "n_nationkey", "domain", "l_extendedprice", (c("l_linestatus") == "O").alias("in_stock"), c("l_shipdate").cast("date").alias("fetched_date")).repartition("l_partkey")
    rows = lines.join(table(spark, sf_dir, "part"), c("l_partkey") == c("p_partkey"))
    key = ["l_partkey", "n_nationkey", "domain"]
    price, euro = F.when(c("p_size") % 7 != 0, c("l_extendedprice").cast("decimal(12,2)")), F.bool_or(c("p_size") % 4 == 0)
    daily = rows.groupBy(*key, "fetched_date").agg(F.min(price).alias("price"), euro.alias("euro"), F.bool_or("in_stock").alias("in_stock"))
    last = daily.groupBy(*key).agg(F.max(F.struct("fetched_date", "price", "euro", "in_stock")).alias("m"))
    master, site = c("l_partkey").cast("string"), c("n_nationkey").cast("string")
    return last.select(
        F.concat_ws("@", master, site).alias("id"), master.alias("master_id"), site.alias("site_id"), "domain", F.concat(F.lit("https://"), c("domain"), F.lit("/p/"), master).alias("product_url"), c("m.price").alias("current_price"),
        F.when(c("m.euro"), "EUR").otherwise("MAD").alias("currency"), c("m.in_stock").alias("in_stock"), c("m.fetched_date").alias("last_scraped"),
    )


SITE_PRODUCTS = f"""
    SELECT master_id || '@' || site_id AS id, master_id, site_id, domain, min(url) AS product_url, min(raw_price) AS current_price,
           min(raw_currency) AS currency, bool_or(in_stock) AS in_stock, min(fetched_date) AS last_scraped
    FROM (SELECT *, max(fetched_date) OVER (PARTITION BY master_id, site_id) AS last FROM ({LISTINGS})
          WHERE CAST(master_id AS BIGINT) % 10 > 1 OR (CAST(master_id AS BIGINT) % 10 = 1 AND CAST(site_id AS BIGINT) = CAST(master_id AS BIGINT) % 25)) WHERE fetched_date = last
    GROUP BY master_id, site_id, domain"""


def supplier_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wholesale offers: each part of each supplier, a case of 1 to 9 at a share of 60 to 119 per cent of the retail price."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    pairs = line.select("l_suppkey", "l_partkey").distinct().join(part, F.col("l_partkey") == F.col("p_partkey"))
    c = F.col
    share = (60 + c("l_suppkey") % 60).cast("decimal(5,0)") * (1 + c("p_size") % 9).cast("decimal(2,0)") * F.lit(Decimal("0.01"))
    price = (c("p_retailprice").cast("decimal(12,2)") * share).cast("decimal(14,2)")
    return pairs.select(
        c("l_suppkey").cast("string").alias("supplier"),
        F.concat(F.lit("C"), c("l_partkey")).alias("code"),
        F.concat(c("p_name"), F.lit(" "), F.lpad(c("p_partkey").cast("string"), 13, "0")).alias("name"),
        F.when(c("p_size") % 9 != 0, price).alias("prix_pharmacien"),
        F.when((c("l_suppkey") % 4 != 0) & (c("l_partkey") % 6 != 0), c("l_partkey").cast("string")).alias("master_id"),
        F.when(c("l_suppkey") % 3 == 0, F.lit(None).cast("boolean")).otherwise(c("p_size") % 2 == 0).alias("in_stock"),
        F.when(c("l_suppkey") % 5 == 0, c("l_partkey")).alias("vendor_product_id"),
    )


SUPPLIER_PRODUCTS = """
    SELECT CAST(l_suppkey AS VARCHAR) AS supplier, 'C' || CAST(l_partkey AS VARCHAR) AS code,
           p_name || ' ' || lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS name,
           CASE WHEN p_size % 9 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(60 + l_suppkey % 60 AS DECIMAL(5,0)) * CAST(1 + p_size % 9 AS DECIMAL(2,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) END AS prix_pharmacien,
           CASE WHEN l_suppkey % 4 <> 0 AND l_partkey % 6 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS master_id,
           CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE p_size % 2 = 0 END AS in_stock,
           CASE WHEN l_suppkey % 5 = 0 THEN l_partkey END AS vendor_product_id
    FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey"""


def price_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listings(spark, sf_dir).where("raw_price is not null")
    return rows.select(F.concat_ws("@", "master_id", "site_id").alias("site_product_id"), "master_id", "site_id", F.col("raw_price").alias("price"), "in_stock", F.timestamp_seconds("fetched_at_utc").alias("logged_at"))


PRICE_LOG = f"""
    SELECT master_id || '@' || site_id AS site_product_id, master_id, site_id, raw_price AS price, in_stock, to_timestamp(fetched_at_utc) AS logged_at, fetched_date
    FROM ({LISTINGS}) WHERE raw_price IS NOT NULL"""


def url_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "orders").select(
        c("o_orderkey").cast("string").alias("id"),
        (c("o_custkey") % 25).cast("string").alias("site_id"),
        F.concat(F.lit("https://shop"), c("o_custkey") % 25, F.lit(".example/p/"), c("o_orderkey")).alias("url"),
        F.when(c("o_orderkey") % 4 == 0, "category").otherwise("product").alias("url_type"),
        F.when(c("o_orderstatus") == "F", "done").when(c("o_orderstatus") == "O", "pending").otherwise("failed").alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        c("o_orderdate").cast("timestamp").alias("discovered_at"),
        F.when(c("o_orderkey") % 3 == 0, c("o_orderdate").cast("timestamp") + F.expr("interval 30 days")).alias("next_scrape_after"),
    )


URL_QUEUE = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey % 25 AS VARCHAR) AS site_id,
           'https://shop' || CAST(o_custkey % 25 AS VARCHAR) || '.example/p/' || CAST(o_orderkey AS VARCHAR) AS url,
           CASE WHEN o_orderkey % 4 = 0 THEN 'category' ELSE 'product' END AS url_type,
           CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status,
           CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS priority, o_orderdate AS discovered_at,
           CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 30 DAY END AS next_scrape_after
    FROM orders"""


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetches made from the event stream."""
    c = F.col
    code = F.element_at(F.array(*[F.lit(x) for x in (200, 403, 404, 429, 500, 301)]), (c("event_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(c("event_id").cast("string").alias("url_id"), (c("user_id") % 25).cast("string").alias("site_id"), code.alias("http_status_code"), c("ts").cast("timestamp").alias("fetched_at"), c("value").alias("elapsed_seconds"))


FETCH_LOG = """
    SELECT CAST(event_id AS VARCHAR) AS url_id, CAST(user_id % 25 AS VARCHAR) AS site_id,
           [200, 403, 404, 429, 500, 301][CAST(event_id % 6 + 1 AS INTEGER)] AS http_status_code, ts AS fetched_at, value AS elapsed_seconds
    FROM events"""


#: A product's name with a word of its own: its part's words, and ten letters of a hash. The same in Spark and in SQL.
CODE = "translate(substring(md5(CAST(p_partkey AS STRING)), 1, 10), '0123456789', 'ghijklmnop')"
NAME = "concat(p_name, ' ', lower(p_type), ' ', {code}, ' ', CAST(p_size AS STRING), '0ml')"


def _sql(expression: str) -> str:
    return expression.replace("AS STRING", "AS VARCHAR")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with names that differ: two thirds of the parts."""
    part = table(spark, sf_dir, "part").where("p_partkey % 3 <> 2")
    return part.selectExpr("CAST(p_partkey AS STRING) AS id", f"{NAME.format(code=CODE)} AS name", "p_brand AS brand", "CASE WHEN p_size % 3 = 0 THEN '' ELSE lpad(CAST(p_partkey AS STRING), 13, '0') END AS ean", "'active' AS status")


def run_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's listings of all parts, of four kinds, each from a shop of its own.

    0: another name, but the identifier; 1: the words in another order; 2: a letter is missing, 3: other words, but the brand, the volume and the word that comes first.
    """
    part = table(spark, sf_dir, "part").selectExpr("*", "explode(sequence(0, 3)) AS kind").where("kind > 0 OR p_size % 3 <> 0")
    name, short = NAME.format(code=CODE), NAME.format(code=f"substring({CODE}, 1, 9)")
    first = f"array_min(filter(split({name}, ' '), w -> NOT w RLIKE '^[0-9]+[a-z]+$'))"
    other = "substring(md5(concat('other', CAST(p_partkey AS STRING))), 1, {n})"
    names = f"CASE kind WHEN 0 THEN concat('unnamed ', {other.format(n=32)}) WHEN 1 THEN array_join(reverse(split({name}, ' ')), '  ') WHEN 2 THEN {short} ELSE concat('zz', {other.format(n=12)}, 'z ', {first}, ' ', CAST(p_size AS STRING), '0 ml') END"
    return part.selectExpr(
        "concat(CAST(p_partkey AS STRING), '-', CAST(kind AS STRING)) AS scraped_url_id", "CAST(kind AS STRING) AS site_id", "concat('shop', CAST(kind AS STRING)) AS domain", f"{names} AS raw_name",
        "CASE WHEN kind = 3 THEN p_brand ELSE '' END AS raw_brand", "CASE WHEN kind = 0 THEN lpad(CAST(p_partkey AS STRING), 13, '0') ELSE '' END AS raw_ean", "'' AS raw_sku", "p_partkey", "kind",
    )


def run_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first shop has a seventh of the products already."""
    return catalogue(spark, sf_dir).where("CAST(id AS BIGINT) % 7 = 0").selectExpr("'shop1' AS domain", "id AS master_id")


#: What a run must find, by the way in which its listings were made.
RUN = f"""
    WITH p AS (SELECT *, {_sql(NAME.format(code=CODE))} AS name, CASE WHEN length(p_brand) = 7 THEN 'brand' ELSE substring(p_brand, 7) || 'brand' END AS own, p_partkey % 3 <> 2 AS known FROM part),
    f AS (SELECT *, own || '_' || CAST(p_size AS VARCHAR) || '0ml_' || list_min(list_filter(string_split(name, ' '), lambda w: NOT regexp_matches(w, '^[0-9]+[a-z]+$'))) AS fp FROM p),
    last AS (SELECT fp, arg_max(CAST(p_partkey AS VARCHAR), (p_brand, name, CAST(p_partkey AS VARCHAR))) AS id FROM f WHERE known GROUP BY fp),
    k AS (SELECT f.*, kind, last.id AS like_it, CASE WHEN kind = 3 AND last.id IS NOT NULL THEN 4 WHEN NOT known OR kind = 3 OR (kind = 1 AND p_partkey % 7 = 0) THEN 6 WHEN kind = 0 THEN 1 ELSE 3 END AS tier
          FROM f CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS kind) LEFT JOIN last USING (fp) WHERE kind > 0 OR p_size % 3 <> 0)
    SELECT CAST(p_partkey AS VARCHAR) || '-' || CAST(kind AS VARCHAR) AS row_id, CASE tier WHEN 4 THEN like_it WHEN 6 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS master_id, CAST(tier AS INTEGER) AS tier,
           CASE WHEN tier = 4 THEN 0.92 WHEN tier = 6 THEN 0.0 WHEN kind = 2 THEN round(2.0 * (length(name) - 1) / (2 * length(name) - 1), 4) ELSE 1.0 END::DOUBLE AS confidence, false AS needs_review, tier = 6 AS is_new,
           p_partkey, kind, length(name) AS letters, known FROM k"""


def offered_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wholesale offers of the catalogue's products without links and identifiers, a letter missing in each name."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").where("p_partkey % 3 <> 2")
    pairs = line.select("l_suppkey", "l_partkey").distinct().join(part, F.col("l_partkey") == F.col("p_partkey"))
    return pairs.selectExpr("CAST(l_suppkey AS STRING) AS supplier", "concat('C', CAST(l_partkey AS STRING)) AS code", f"{NAME.format(code=f'substring({CODE}, 1, 9)')} AS name", "CAST(NULL AS STRING) AS master_id")
