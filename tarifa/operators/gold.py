"""The catalogue: canonical products, offers of sites and the price log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarifa.functions import text
from tarifa.operators.upsert import insert_missing, last_of, upsert

UNKNOWN_SOURCE = 99


def source_priority(domain: Column, priorities: dict[str, int]) -> Column:
    out = F.lit(UNKNOWN_SOURCE)
    for name, priority in priorities.items():
        out = F.when(domain == name, priority).otherwise(out)
    return out


def best_images(existing: Column, incoming: Column, domain: Column, priorities: dict[str, int]) -> Column:
    """The list from the better source: lower priority wins, then the longer list, then what is there.

    The source of existing images is the first site whose name, without its last
    part, is in the first URL.
    """
    first = F.lower(F.try_element_at(existing, F.lit(1)))
    theirs = F.lit(UNKNOWN_SOURCE)
    for name, priority in reversed(list(priorities.items())):
        theirs = F.when(first.contains(name.rpartition(".")[0] or name), priority).otherwise(theirs)
    ours = source_priority(domain, priorities)
    better = (ours < theirs) | ((ours == theirs) & (F.size(incoming) > F.size(existing)))
    empty = lambda c: c.isNull() | (F.size(c) == 0)
    return F.when(empty(incoming), existing).when(empty(existing), incoming).when(better, incoming).otherwise(existing)


def tag_union(a: Column, b: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(a, none), F.coalesce(b, none)))


def filled(old: Column, new: Column) -> Column:
    """The old value unless it is null or empty."""
    return F.coalesce(text.text_or_null(old), text.text_or_null(new), old)


def _row(listings: DataFrame, matches: DataFrame, row_id: str) -> DataFrame:
    return listings.join(matches.withColumnRenamed("row_id", row_id), row_id)


def new_masters(listings: DataFrame, matches: DataFrame, ids: DataFrame, now: Column, row_id: str = "scraped_url_id") -> DataFrame:
    """Products of unmatched listings; ids: (row_id, master_id). The first listing of a product in row order gives its fields."""
    cut = lambda c, n: F.substring(F.coalesce(c, F.lit("")), 1, n)
    rows = listings.join(ids.withColumnRenamed("row_id", row_id), row_id)
    made = rows.select(
        F.col("master_id").alias("id"), cut("raw_name", 512).alias("name"), cut("raw_brand", 255).alias("brand"), cut("raw_ean", 14).alias("ean"), cut("raw_mpn", 128).alias("mpn"),
        cut("raw_category", 255).alias("category"), F.coalesce("raw_description", F.lit("")).alias("description"), text.json_list(F.col("raw_images"), scalar=True).alias("image_urls"), text.json_list(F.col("raw_tags")).alias("tags"),
        F.lit("active").alias("status"), F.lit(1.0).alias("match_confidence"), F.lit(False).alias("manually_verified"), now.alias("last_matched_at"), F.col(row_id).alias("_row"),
    )
    return made.groupBy(F.col("id").alias("_id")).agg(F.min_by(F.struct(*[c for c in made.columns if c != "_row"]), "_row").alias("r")).select("r.*")


def enriched(masters: DataFrame, listings: DataFrame, matches: DataFrame, now: Column, priorities: dict[str, int], row_id: str = "scraped_url_id") -> DataFrame:
    """Products with empty fields filled from the listings linked to them, tags united and the best images."""
    rows = _row(listings, matches.where("master_id is not null"), row_id)
    order = F.struct(-F.col("confidence"), F.col(row_id))
    best = lambda c: F.min_by(text.text_or_null(F.col(c)), F.when(text.present(F.col(c)), order))
    images, own = text.json_list(F.col("raw_images"), scalar=True), source_priority(F.col("domain"), priorities)
    news = rows.groupBy(F.col("master_id").alias("id")).agg(
        *[best(c).alias(f"n_{c[4:]}") for c in ("raw_ean", "raw_mpn", "raw_brand", "raw_category", "raw_description")],
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(text.json_list(F.col("raw_tags")))))).alias("n_tags"),
        F.min_by(F.struct(images.alias("images"), F.col("domain")), F.when(F.size(images) > 0, F.struct(own, -F.size(images), F.col(row_id)))).alias("n_images"),
        F.max("confidence").alias("n_confidence"), F.bool_or("needs_review").alias("n_review"),
    )
    joined = masters.join(news, "id", "left")
    told = F.col("n_confidence").isNotNull()
    change = {c: filled(F.col(c), F.col(f"n_{c}")) for c in ("ean", "mpn", "brand", "category", "description") if c in masters.columns}
    if "tags" in masters.columns:
        change["tags"] = F.when(told, tag_union(F.col("tags"), F.col("n_tags"))).otherwise(F.col("tags"))
    if "image_urls" in masters.columns:
        change["image_urls"] = best_images(F.col("image_urls"), F.col("n_images.images"), F.col("n_images.domain"), priorities)
    change["match_confidence"] = F.coalesce("n_confidence", "match_confidence")
    change["last_matched_at"] = F.when(told, now).otherwise(F.col("last_matched_at") if "last_matched_at" in masters.columns else F.lit(None))
    change["status"] = F.when(F.col("n_review"), "under_review").otherwise(F.col("status"))
    return joined.withColumns(change).select(*dict.fromkeys([*masters.columns, "last_matched_at"]))


OFFER = ("id master_id site_id domain product_url external_id current_price currency in_stock match_confidence last_scraped_at").split()
BY_URL = ("current_price", "currency", "in_stock", "match_confidence", "last_scraped_at")
BY_PAIR = ("product_url", "current_price", "in_stock", "match_confidence", "last_scraped_at")


def offers_after(offers: DataFrame, listings: DataFrame, matches: DataFrame, now: Column, row_id: str = "scraped_url_id") -> DataFrame:
    """Offers after a run. By URL first: price, stock and time change. Else by (product, site): only a surer match changes it. Else it is new.

    Of several listings of one offer the latest counts; a (product, site) has one offer. Offers and listings meet by URL in one join; what
    comes out of it, offers and listings of no known URL, is dealt by (product, site) once.
    """
    rows = _row(listings, matches.where("master_id is not null"), row_id)
    made = rows.select(
        "master_id", "site_id", "domain", F.col("url").alias("product_url"), F.substring(F.coalesce("raw_sku", F.lit("")), 1, 128).alias("external_id"),
        F.col("raw_price").cast("decimal(10,2)").alias("current_price"), F.substring(F.coalesce("raw_currency", F.lit("MAD")), 1, 3).alias("currency"), "in_stock",
        F.col("confidence").alias("match_confidence"), F.struct(F.col("fetched_at_utc"), F.col(row_id)).alias("_at"),
    )
    made = last_of(made, ["product_url"], [F.col("_at")]).withColumns({"id": F.lit(None).cast("string"), "last_scraped_at": now})
    met = offers.select(*OFFER, F.lit(True).alias("_known")).alias("old").join(made.alias("new"), "product_url", "full_outer")
    known, old, new = F.col("_known").isNotNull(), lambda c: F.col(f"old.{c}"), lambda c: F.col(f"new.{c}")
    each = {c: F.coalesce(new(c), old(c)) if c in BY_URL else F.when(known, old(c)).otherwise(new(c)) for c in OFFER if c != "product_url"}
    step = met.select("product_url", *[c.alias(name) for name, c in each.items()], "_known", F.when(~known, F.struct(new("match_confidence"), "_at")).alias("_order"))
    pair = Window.partitionBy("master_id", "site_id")
    step = step.withColumns({"_best": F.max_by(F.struct(*BY_PAIR), "_order").over(pair), "_held": F.max("_known").over(pair) & F.col("master_id").isNotNull() & F.col("site_id").isNotNull()})
    surer = known & F.coalesce(F.col("_held") & (F.col("_best.match_confidence") > F.col("match_confidence")), F.lit(False))
    fresh = ~known & F.coalesce(~F.col("_held"), F.lit(True)) & F.col("product_url").eqNullSafe(F.col("_best.product_url"))
    change = {c: F.when(surer, F.coalesce(F.col(f"_best.{c}"), F.col(c))).otherwise(F.col(c)) for c in BY_PAIR}
    change["id"] = F.when(known, F.col("id")).otherwise(F.md5(F.concat_ws("|", "master_id", "site_id")))
    return step.where(known | fresh).withColumns(change).select(*OFFER)


def price_log_rows(offers: DataFrame, now: Column) -> DataFrame:
    """What a run adds to the price log: priced offers only."""
    return offers.where("current_price is not null").select(F.col("id").alias("site_product_id"), "master_id", "site_id", F.col("current_price").alias("price"), "currency", "in_stock", now.alias("logged_at"))


def appended(log: DataFrame, rows: DataFrame) -> DataFrame:
    """The log with the rows that it lacks, by offer and time."""
    return log.unionByName(insert_missing(log, rows, ["site_product_id", "logged_at"]), allowMissingColumns=True)


def upsert_masters(masters: DataFrame, changes: DataFrame) -> DataFrame:
    """By identifier, else by name and brand, case left aside."""
    key = lambda frame: frame.withColumn("_key", F.coalesce(F.concat(F.lit("ean:"), text.text_or_null(F.col("ean"))), F.concat_ws("|", F.lower("name"), F.lower("brand"))))
    news = key(changes)
    news = last_of(news, ["_key"], [F.col("name")])
    return upsert(key(masters), news.drop("id") if "id" in news.columns else news, ["_key"]).withColumn("id", F.coalesce("id", F.md5("_key"))).drop("_key")


def upsert_offers(offers: DataFrame, changes: DataFrame) -> DataFrame:
    """By URL; of several changes the latest counts, then the greatest."""
    order = [F.col(c) for c in sorted(changes.columns, key=lambda c: c != "last_scraped_at")]
    return upsert(offers, last_of(changes, ["product_url"], order), ["product_url"])


def without_orphans(masters: DataFrame, offers: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products that have an offer; the log keeps all rows, without the ids of the products that went."""
    kept = masters.join(offers.select(F.col("master_id").alias("id")), "id", "left_semi")
    known = kept.select(F.col("id").alias("_id"))
    held = log.join(known, F.col("master_id") == F.col("_id"), "left").withColumn("master_id", F.col("_id")).drop("_id")
    return kept, held


def flagged(rows: DataFrame, where: Column, **values) -> DataFrame:
    """Bulk action: set columns on the rows that the condition selects."""
    return rows.withColumns({c: F.when(where, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})


def verify(masters: DataFrame, where: Column) -> DataFrame:
    return flagged(masters, where, manually_verified=True)


def flag_for_review(masters: DataFrame, where: Column) -> DataFrame:
    return flagged(masters, where, status="under_review", manually_verified=False)


def embeddings_text(vector: Column) -> Column:
    """A vector as '[a,b,...]' with six places, halves to the even digit.

    Java rounds halves up. Exact halves at six places are the odd multiples of 1/128; these move to the even side first.
    """

    def six(x: Column) -> Column:
        even = F.when(F.floor(x * 1e6) % 2 == 0, -2.5e-7).otherwise(2.5e-7)
        return F.format_string("%.6f", F.when(F.abs(x * 128 % 2) == 1, x + even).otherwise(x))

    return F.concat(F.lit("["), F.array_join(F.transform(vector, lambda x: six(x.cast("double"))), ","), F.lit("]"))
