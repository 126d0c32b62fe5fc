"""The nightly run: captured pages to listings, listings to the catalogue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa import schemas
from tarifa.functions.extract import listing_fields
from tarifa.operators import gold, matching
from tarifa.operators.upsert import SnapshotSet, insert_missing
from tarifa.sources.readers import with_columns_of
from tarifa.session import written


@dataclass
class Catalogue:
    masters: DataFrame
    offers: DataFrame
    log: DataFrame
    new_log: DataFrame | None = None  # what a run adds to the log


def listings_from(records: DataFrame, default_currency: str = "MAD") -> DataFrame:
    """Listings of stored fetch records (with domain and fetched_date)."""
    rows = listing_fields(records.where("status = 'success'"), "html", default_currency)
    as_text = {"raw_images": F.coalesce(F.to_json("raw_images"), F.lit("[]")), "raw_attributes": F.coalesce(F.to_json("raw_attributes"), F.lit("{}")), "raw_tags": F.lit("[]"), "raw_ean": F.coalesce("raw_ean", F.lit("")), "raw_brand": F.coalesce("raw_brand", F.lit(""))}
    return with_columns_of(rows.withColumns(as_text), schemas.LISTING)


def checked(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listings that a run can take, and the others with an ``error``: one bad row never fails a run."""
    price = F.col("raw_price")
    error = F.when(F.coalesce(F.col("url"), F.lit("")) == "", "no url").when(F.coalesce(F.col("domain"), F.lit("")) == "", "no domain")
    error = error.when(F.isnan(price) | (F.abs(price) == float("inf")), "price is no number")
    rows = listings.withColumn("error", error)
    return rows.where("error is null").drop("error"), rows.where("error is not null")


def known_by_url(listings: DataFrame, offers: DataFrame, row_id: str = "scraped_url_id") -> DataFrame:
    """Matches (tier 0) of listings whose page is an offer already: it is the product that it was."""
    own = offers.groupBy(F.col("product_url").alias("url")).agg(F.max(F.struct("match_confidence", "master_id")).alias("o")).select("url", "o.*")
    found = listings.select(F.col(row_id).cast("string").alias("row_id"), "url").join(own, "url")
    return found.select("row_id", "master_id", F.lit(0).alias("tier"), F.col("match_confidence").alias("confidence"), F.lit(False).alias("needs_review"), F.lit(False).alias("is_new"))


def resolve(listings: DataFrame, known: Catalogue, now: Column, priorities: dict[str, int] | None = None, thresholds: matching.Thresholds = matching.Thresholds()) -> tuple[Catalogue, DataFrame]:
    """The catalogue after a run over the listings, and the matches of the run.

    Pages that are offers already keep their product; the cascade, which never gives a site a
    product that it carries, sees the others. Each listing takes part, also where ids repeat.
    """
    listings = matching.with_own_keys(listings, "scraped_url_id", "listings")
    links = known.offers.select("domain", "master_id")
    seen_before = written(known_by_url(listings, known.offers), "known-pages")
    fresh = listings.join(seen_before.select(F.col("row_id").alias("scraped_url_id")), "scraped_url_id", "left_anti")
    found = written(matching.match(fresh, known.masters, links, thresholds=thresholds).unionByName(seen_before), "matches")
    ids = written(matching.new_products(fresh, found), "new-products")
    made = gold.new_masters(fresh, found, ids, now)
    whole = found.join(ids.withColumnRenamed("master_id", "new_id"), "row_id", "left").withColumn("master_id", F.coalesce("master_id", "new_id")).drop("new_id")
    masters = gold.enriched(known.masters, listings, found, now, priorities or {}).unionByName(made, allowMissingColumns=True)
    offers = gold.offers_after(known.offers, listings, whole, now)
    seen = listings.select(F.col("url").alias("product_url")).distinct()
    rows = gold.price_log_rows(offers.join(seen, "product_url", "left_semi"), now)
    return Catalogue(masters, offers, gold.appended(known.log, rows), insert_missing(known.log, rows, ["site_product_id", "logged_at"])), matching.with_ids(whole, "row_id")


SCHEMAS = {"masters": schemas.MASTER, "offers": schemas.SITE_PRODUCT, "log": schemas.PRICE_LOG}


def catalogue(spark: SparkSession, tables: dict[str, DataFrame]) -> Catalogue:
    """Stored tables, empty ones before the first run."""
    return Catalogue(**{n: tables[n] if n in tables else spark.createDataFrame([], s) for n, s in SCHEMAS.items()})


def stored_run(stored: SnapshotSet, listings: DataFrame, now: Column) -> DataFrame:
    """A run over the stored catalogue, committed as a whole; on top of another run's commit if that came first. Returns the matches.

    The log is append-only: a run adds its rows and can't take any away.
    """
    matches = []

    def run(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        after, found = resolve(listings, catalogue(listings.sparkSession, tables), now)
        matches[:] = [found]
        return {"masters": after.masters, "offers": after.offers, "log": after.new_log}

    stored.change(run)
    return matches[0]
