"""The wholesale side: catalogue, availability, vendor ids and orders as projections.

Calls to a supplier are not made here; bodies and responses are columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.functions import prices, text
from tarifa.operators.upsert import last_of, upsert


def catalogue_rows(items: DataFrame, supplier: str) -> DataFrame:
    """Supplier products of catalogue items; those without a code are dropped, a code's last item counts."""
    get = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    rows = items.select(
        F.lit(supplier).alias("supplier"), get("CODE_PRODU").alias("code"), get("NOM_PRODUI").alias("name"),
        prices.positive_decimal(F.col("PRIX_PHAR")).cast("decimal(12,3)").alias("prix_pharmacien"), prices.positive_decimal(F.col("PPM")).cast("decimal(12,2)").alias("ppm"),
        get("FORME_PROD").alias("forme"), text.form_display(get("FORME_PROD")).alias("forme_display"), F.monotonically_increasing_id().alias("_n"),
    )
    return last_of(rows.where("code != ''"), ["supplier", "code"], [F.col("_n")]).drop("_n")


def upsert_catalogue(products: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(products, rows, ["supplier", "code"])


def with_availability(products: DataFrame, bodies: DataFrame) -> DataFrame:
    """bodies: (supplier, code, body). Products without an answer stay as they are, unknown ones unknown."""
    answers = bodies.select("supplier", "code", prices.availability(F.col("body")).alias("in_stock")).groupBy("supplier", "code").agg(F.bool_or("in_stock").alias("in_stock"))  # one yes is enough
    return upsert(products, answers, ["supplier", "code"], only_if=F.col("old.code").isNotNull()).where("name is not null")


def with_vendor_ids(products: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ids: (supplier, code, reference, vendor_product_id). The products, and counts of updated and not_found."""
    wanted = ids.select("supplier", F.coalesce(text.text_or_null(F.col("code")), F.col("reference")).alias("code"), F.col("vendor_product_id").alias("_id")).groupBy("supplier", "code").agg(F.max("_id").alias("_id"))
    out = products.join(wanted, ["supplier", "code"], "left").withColumn("vendor_product_id", F.coalesce("_id", "vendor_product_id")).drop("_id").select(*products.columns)
    hit = wanted.join(products.select("supplier", "code", F.lit(True).alias("hit")), ["supplier", "code"], "left")
    return out, hit.agg(F.count_if("hit").alias("updated"), F.count_if(F.col("hit").isNull()).alias("not_found"))


def order_payload(today: Column, supplier_id: str = "supplier_id", product_id: str = "product_id", quantity: str = "quantity", unit_price: str = "unit_price", sale_price: str = "sale_price", tax_id: Column | None = None, owner_id: Column | None = None, notes: str = "notes") -> Column:
    """The JSON of an order; a price of null or 0 is written as none."""
    price, sale = F.col(unit_price).cast("double"), F.col(sale_price).cast("double")
    given = price.isNotNull() & (price != 0)
    # The names and constants that the receiving side expects.
    product = F.struct(
        F.col(product_id).alias("ID"), F.col(quantity).alias("quantity"), F.when(given, price.cast("string")).otherwise("0.00").alias("unit_price"), F.coalesce(price, F.lit(0.0)).alias("unit_original_price"),
        F.coalesce(price, F.lit(0.0)).alias("purchase_price"), F.coalesce(sale, F.lit(0.0)).alias("sale_price"), (tax_id if tax_id is not None else F.lit(35)).alias("tax_id"),
        F.lit("percentage").alias("discount_type"), F.lit("0.00").alias("discount"), F.lit(-1).alias("available"), F.lit("").alias("product_price_id"),
    )
    body = F.struct(
        F.array(product).alias("products"), F.array().cast("array<string>").alias("products_details"), today.cast("string").alias("purchase_order_date"),
        F.lit("each_product").alias("global_discount_application_type"), F.lit("percentage").alias("global_discount_type"), F.col(supplier_id).cast("string").alias("supplier_id"), F.lit("").alias("contact_id"),
        F.lit("false").alias("orderOnline"), (owner_id if owner_id is not None else F.lit("")).alias("owner_id"), F.lit("approve").alias("status_action"), text.text_or_null(F.col(notes)).alias("comment"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def order_response(body: Column) -> Column:
    """struct(vendor_order_id, transaction_number, vendor_status) of a response; what is missing is ''."""
    v = F.try_parse_json(body)
    get = lambda p: F.coalesce(F.try_variant_get(v, f"$.data.{p}", "string"), F.try_variant_get(v, f"$.{p}", "string"))
    status = F.coalesce(get("status.ID"), get("status"))
    return F.struct(F.coalesce(get("ID"), F.lit("")).alias("vendor_order_id"), F.coalesce(get("transaction_number"), F.lit("")).alias("transaction_number"), F.coalesce(status, F.lit("")).alias("vendor_status"))


def draft_orders(products: DataFrame, requests: DataFrame) -> DataFrame:
    """requests: (order_id, supplier, code, quantity, unit_price). A price of null or 0 is the catalogue's."""
    rows = requests.join(products.select("supplier", "code", "prix_pharmacien"), ["supplier", "code"], "left")
    price = F.coalesce(F.when(F.col("unit_price") != 0, F.col("unit_price")), F.col("prix_pharmacien")).cast("decimal(12,3)")
    return rows.select("order_id", "supplier", "code", "quantity", price.alias("unit_price"), F.lit("draft").alias("status")).withColumn("total_price", prices.total(F.col("unit_price"), F.col("quantity")))


def submitted(orders: DataFrame, responses: DataFrame) -> DataFrame:
    """responses: (order_id, body, error). An answer makes a draft submitted, an error failed."""
    joined = orders.join(responses, "order_id", "left").withColumn("_r", order_response(F.col("body")))
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("body").isNotNull(), "submitted").otherwise(F.col("status"))
    return joined.withColumns({"status": status, "vendor_order_id": F.col("_r.vendor_order_id"), "transaction_number": F.col("_r.transaction_number")}).drop("_r", "body", "error")
