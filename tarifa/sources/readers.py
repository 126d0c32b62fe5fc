"""Readers of stored listings, fetch records, sitemaps, catalogues and API documents."""

from __future__ import annotations

import datetime as dt
import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarifa import schemas
from tarifa.functions import prices, text
from tarifa.session import written

#: Settings for object stores with path-style addresses, to be given to the session.
OBJECT_STORE = {"spark.hadoop.fs.s3a.path.style.access": "true", "spark.hadoop.fs.s3a.connection.ssl.enabled": "true"}

# Keys under which API documents hold their items, and what product sitemaps and pages are called.
ITEM_KEYS = ("products", "items", "results", "data", "hits")
SITEMAP_KINDS = {
    "numbered": (r"^https?://[^/]+/sitemap_products_\d+\.xml", r"/products/[^/?#]+$"),
    "prefixed": (r"/product-sitemap\d*\.xml$", None),
    "paged": (None, r"/\d+-[^/]+\.html$"),
}


def listings(spark: SparkSession, root: str, domain: str | None = None, date: dt.date | str | None = None) -> DataFrame:
    """Listings under ``root``; a site and date only read their partitions. Unreadable files are skipped, missing columns are null."""
    df = spark.read.schema(schemas.LISTING).option("ignoreCorruptFiles", "true").option("pathGlobFilter", "*.parquet").parquet(root)
    if domain is not None:
        df = df.where(F.col("domain") == domain)
    return df if date is None else df.where(F.col("fetched_date") == F.lit(str(date)).cast("date"))


def with_columns_of(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a schema, those that are missing as nulls, in its order."""
    wanted = T.StructType.fromDDL(ddl)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])


def union(frames: list[DataFrame]) -> DataFrame:
    """All rows by column name; what a frame lacks is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def bronze(spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None, domain: str = "*", named: bool = False) -> DataFrame:
    """Fetch records in ``root/<site>/<date>/*.jsonl.gz``, with site and date from the path.

    With ``named`` folders are site=<site>/date=<date>, as ``write_bronze`` makes them.
    Only the folders of the dates are listed; by default yesterday's and today's. A gzip file is one task.
    """
    end = end or dt.date.today()
    start = start or end - dt.timedelta(days=1)
    days = ",".join(str(start + dt.timedelta(days=i)) for i in range((end - start).days + 1))
    where = f"site={domain}/date={{{days}}}/*.json.gz" if named else f"{domain}/{{{days}}}/*.jsonl.gz"
    return bronze_columns(spark.read.schema(schemas.BRONZE).json(f"{root}/{where}"))


def bronze_columns(rows: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return rows.select("*", F.regexp_extract(path, r"([^/=]+)/(?:date=)?\d{4}-\d{2}-\d{2}/[^/]+$", 1).alias("domain"), F.to_date(F.regexp_extract(path, r"[/=](\d{4}-\d{2}-\d{2})/[^/]+$", 1)).alias("fetched_date"), path.alias("bronze_source_key"))


def sitemap_urls(documents: DataFrame, xml_col: str = "xml", since: str | None = None) -> DataFrame:
    """(document's columns, loc, lastmod) of the pages in sitemaps; without a lastmod a page stays."""
    xml = text.without_controls(F.col(xml_col))
    entries = F.regexp_extract_all(xml, F.lit(r"(?is)<url>(.*?)</url>"), F.lit(1))
    keep = [c for c in documents.columns if c != xml_col]
    rows = documents.select(*keep, F.explode(F.coalesce(entries, F.array().cast("array<string>"))).alias("e"))
    value = lambda tag: text.text_or_null(F.trim(F.regexp_extract("e", rf"(?is)<{tag}>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</{tag}>", 1)))
    rows = rows.select(*keep, F.replace(value("loc"), F.lit("&amp;"), F.lit("&")).alias("loc"), value("lastmod").alias("lastmod")).where("loc is not null")
    return rows if since is None else rows.where(F.col("lastmod").isNull() | (F.col("lastmod") >= since))


def sitemap_children(documents: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Distinct ``loc``s of the sitemaps that sitemap indexes name."""
    entries = F.expr(f"xpath({xml_col}, '/sitemapindex/sitemap/loc/text()')")
    indexes = documents.where(F.col(xml_col).contains("<sitemapindex")).withColumn(xml_col, text.without_controls(F.col(xml_col)))
    return indexes.select(F.explode(entries).alias("loc")).select(F.trim("loc").alias("loc")).distinct()


def sitemap_pages(documents: DataFrame, roots: list[str], url_col: str = "url", xml_col: str = "xml", kind: str | None = None, since: str | None = None) -> DataFrame:
    """Pages of the captured sitemaps that can be reached from the roots; ``kind`` picks child sitemaps and pages by name.

    One join a level of indexes, until a level brings no sitemap that wasn't seen (so cycles end); captured documents are never collected.
    """
    child, page = SITEMAP_KINDS.get(kind, (None, None))
    seen = level = documents.sparkSession.createDataFrame([(r,) for r in roots], "loc string").distinct()
    while not level.isEmpty():
        children = sitemap_children(documents.join(level, F.col(url_col) == F.col("loc"), "left_semi"), xml_col)
        if child:
            children = children.where(F.col("loc").rlike(child))
        level = written(children.join(seen, "loc", "left_anti"), "sitemaps")
        seen = seen.unionByName(level)
    urls = sitemap_urls(documents.join(seen, F.col(url_col) == F.col("loc"), "left_semi"), xml_col, since).select(F.col("loc").alias("url"))
    return (urls.where(F.col("url").rlike(page)) if page else urls).distinct()


def numbered_sitemaps(documents: DataFrame, template: str, most: int = 50, url_col: str = "url", xml_col: str = "xml") -> DataFrame:
    """The captured sitemaps ``template.format(1)``, 2, …, up to the first that is missing or has no entry."""
    numbers = documents.sparkSession.createDataFrame([(n, template.format(n)) for n in range(1, most + 1)], "number int, at string")
    filled = documents.where(F.col(xml_col).rlike("(?i)<url[ >]")).select(F.col(url_col).alias("at")).distinct()
    stop = numbers.join(filled, "at", "left_anti").agg(F.coalesce(F.min("number"), F.lit(most + 1))).first()[0]
    return documents.join(numbers.where(F.col("number") < stop).select(F.col("at").alias(url_col)), url_col, "left_semi")


def listings_path(spark: SparkSession, root: str) -> None:
    """Name the root of the listings for SQL: ``listings_path`` is a variable of the session, and a query reads
    ``IDENTIFIER('parquet.`' || listings_path || '`')``. Another root is another call; no query changes."""
    spark.sql("DECLARE OR REPLACE VARIABLE listings_path STRING")
    spark.sql("SET VAR listings_path = :root", args={"root": root})


def hybrid(sitemap: DataFrame, category: DataFrame) -> DataFrame:
    """Pages of the sitemap, and those of category pages that it lacks."""
    return sitemap.select("url").unionByName(category.select("url").distinct().join(sitemap.select("url"), "url", "left_anti"))


def matching(urls: DataFrame, patterns: list[str]) -> DataFrame:
    """URLs in which one of the patterns is found; all without patterns."""
    return urls.where(F.lit(not patterns) | F.array_max(F.array(F.lit(False), *[F.col("url").rlike(p) for p in patterns])))


CATALOGUE = "array<struct<CODE_PRODU:string,NOM_PRODUI:string,PRIX_PHAR:string,PPM:string,FORME_PROD:string,PA:string>>"


def catalogue_items(bodies: Column) -> Column:
    """Items of ``var products = [...];`` or of a JSON array; an error for anything else."""
    script = text.text_or_null(F.regexp_extract(bodies, r"(?s)var\s+products\s*=\s*(\[.*?\])\s*;", 1))
    plain = F.when(F.trim(bodies).startswith("["), F.trim(bodies))
    items = F.from_json(F.coalesce(script, plain), CATALOGUE, {"mode": "FAILFAST"})
    return F.coalesce(items, F.raise_error(F.lit("no product list in the catalogue")).cast(CATALOGUE))


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Items of catalogue files, one row each."""
    return spark.read.text(path, wholetext=True).select(F.inline(catalogue_items(F.col("value"))))


def api_items(documents: DataFrame, body_col: str = "body", keep: list[str] | None = None) -> DataFrame:
    """``item`` (VARIANT) of captured API documents, beside the columns ``keep``: a list, or the first list under one of ITEM_KEYS."""
    v = F.try_parse_json(F.col(body_col))
    lists = [F.try_variant_get(v, "$", "array<variant>"), *[F.try_variant_get(v, f"$.{k}", "array<variant>") for k in ITEM_KEYS]]
    return documents.select(*(keep or []), F.explode(F.coalesce(*lists)).alias("item"))


def field(item: Column, path: str) -> Column:
    """A field by its path with dots; null if empty."""
    return text.text_or_null(F.try_variant_get(item, "$" + "".join(f'["{p}"]' for p in path.split(".")), "string"))


def api_urls(documents: DataFrame, url_field: str = "url", body_col: str = "body") -> DataFrame:
    return api_items(documents, body_col).select(field(F.col("item"), url_field).alias("url")).where("url is not null").distinct()


def paged(documents: DataFrame, chain: str = "chain", page: str = "page", body_col: str = "body") -> DataFrame:
    """The captured pages of each chain from page 1 up to the first that is missing or has no items."""
    filled = documents.join(api_items(documents, body_col, [chain, page]).select(chain, page).distinct(), [chain, page], "left_semi")
    steps = filled.select(chain, (F.col(page) + 1).alias(page)).unionByName(documents.select(chain, F.lit(1).cast(documents.schema[page].dataType).alias(page))).distinct()
    stops = steps.join(filled.select(chain, page), [chain, page], "left_anti").groupBy(chain).agg(F.min(page).alias("_stop"))
    return filled.join(stops, chain).where(F.col(page) < F.col("_stop")).drop("_stop")


def supplier_list(documents: DataFrame, fields: dict[str, str], chain: str = "supplier", page: str = "page", body_col: str = "body") -> DataFrame:
    """Products of suppliers' paged lists: (supplier, code, name, prix_pharmacien, in_stock, vendor_product_id), by the items' ``fields``; items without a code are left out."""
    items = api_items(paged(documents, chain, page, body_col), body_col, [chain])
    value = lambda n: field(F.col("item"), fields[n]) if n in fields else F.lit(None).cast("string")
    rows = items.select(F.col(chain).cast("string").alias("supplier"), value("code").alias("code"), value("name").alias("name"), prices.positive_decimal(value("price")).cast("decimal(12,3)").alias("prix_pharmacien"), F.when(value("in_stock").isNotNull(), prices.availability(value("in_stock"))).alias("in_stock"), value("id").try_cast("bigint").alias("vendor_product_id"))
    return rows.where("code is not null")


def table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


@F.pandas_udf(T.StringType())
def _unpacked(content: pd.Series) -> pd.Series:
    def one(b: bytes) -> str | None:
        try:
            return (gzip.decompress(b) if b[:2] == b"\x1f\x8b" else b).decode("utf-8", "replace")
        except (OSError, EOFError):
            return None  # a broken file doesn't fail the job

    return content.map(one)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(url, xml) of captured files; those that begin like gzip are unpacked, whatever their name."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("url"), _unpacked("content").alias("xml"))


def with_site(rows: DataFrame, sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the id of their domain's site, and the number of rows of each domain that has none."""
    known = sites.select("domain", F.col("site_id").alias("_site"))
    out = rows.join(known, "domain", "left").withColumn("site_id", F.coalesce("_site", "site_id") if "site_id" in rows.columns else F.col("_site"))
    missing = out.where("_site is null").groupBy("domain").agg(F.count("*").alias("errors"))
    return out.where("_site is not null").drop("_site"), missing
