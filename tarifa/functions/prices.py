"""Prices, margins and stock as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a currency is written, the bands of a price, the keys and words of an availability.
DIRHAM = r"(?iu)MAD|\bDHS?\b|د\.?م\.?"
EURO = r"(?iu)€|\bEUR\b"
DOLLAR = r"(?iu)\$|\bUSD\b"
BANDS = ((50, "1. < 50 MAD"), (100, "2. 50-100 MAD"), (200, "3. 100-200 MAD"), (500, "4. 200-500 MAD"), (1000, "5. 500-1000 MAD"))
ABOVE = "6. > 1000 MAD"
STOCK_KEYS = ("isAvailable", "inStock", "in_stock", "disponible", "available", "stock")
STOCK_WORDS = ("true", "1", "yes", "oui", "disponible")
OUT_OF_STOCK = ("outofstock", "out_of_stock", "unavailable", "soldout", "discontinued")


def price(raw: Column, default_currency: str = "EUR") -> Column:
    """struct(price double, currency string, errors array<string>) of a written price.

    A comma is a decimal point unless there is a point too; then it groups thousands.
    """
    currency = F.when(raw.rlike(DIRHAM), "MAD").when(raw.rlike(EURO), "EUR").when(raw.rlike(DOLLAR), "USD").otherwise(default_currency)
    digits = F.regexp_replace(F.regexp_replace(raw, DIRHAM, ""), r"[^\d.,-]", "")
    digits = F.regexp_replace(digits, r"[.,]+$", "")
    plain = F.when(digits.contains(",") & digits.contains("."), F.replace(digits, F.lit(","), F.lit(""))).otherwise(F.replace(digits, F.lit(","), F.lit(".")))
    value = plain.try_cast("double")
    empty = F.trim(F.coalesce(raw, F.lit(""))) == ""
    errors = F.when(~empty & value.isNull(), F.array(F.concat(F.lit("price: "), raw))).otherwise(F.array().cast("array<string>"))
    return F.struct(value.alias("price"), currency.alias("currency"), errors.alias("errors"))


def positive_decimal(raw: Column) -> Column:
    """A decimal with comma or point; null if it is none or not above zero."""
    value = F.replace(F.trim(raw.cast("string")), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(value > 0, value)


def in_stock(availability: Column) -> Column:
    """Of a schema.org or Open Graph availability; null stays null."""
    word = F.lower(F.regexp_extract(availability, r"([^/]*)$", 1))
    return F.when(availability.isNotNull() & (word != ""), ~word.isin(*OUT_OF_STOCK))


def availability(body: Column) -> Column:
    """Whether an availability response says yes: a JSON flag, number or record, or a word; else false."""
    text = F.trim(body)
    v = F.try_parse_json(text)
    record = F.lit(None).cast("boolean")
    for key in reversed(STOCK_KEYS):
        value = F.try_variant_get(v, f"$.{key}", "string")
        kind = F.schema_of_variant(F.try_variant_get(v, f"$.{key}", "variant"))
        said = F.when(kind == "STRING", F.lower(value) == "true").when(kind == "BOOLEAN", value == "true").when(kind == "VOID", F.lit(False)).otherwise(F.coalesce(value.try_cast("double") != 0, F.lit(True)))
        record = F.when(F.try_variant_get(v, f"$.{key}", "variant").isNotNull(), said).otherwise(record)
    whole = F.when(text.startswith("{"), record).when(text.rlike(r"^-?\d+$"), text.try_cast("double") > 0)
    return F.coalesce(whole, F.lower(text).isin(*STOCK_WORDS), F.lit(False))


def band(value: Column) -> Column:
    out = F.lit(ABOVE)
    for top, label in reversed(BANDS):
        out = F.when(value < top, label).otherwise(out)
    return out


def saving_pct(low: Column, high: Column) -> Column:
    """Whole per cent, halves to even."""
    return F.bround((1 - low.cast("double") / F.nullif(high.cast("double"), F.lit(0.0))) * 100, 0).cast("int")


def margin_pct(retail: Column, wholesale: Column) -> Column:
    return F.bround((retail.cast("double") - wholesale.cast("double")) / F.nullif(wholesale.cast("double"), F.lit(0.0)) * 100, 0).cast("int")


def margin_band(pct: Column) -> Column:
    return F.when(pct >= 30, "good").when(pct >= 10, "fair").when(pct.isNotNull(), "poor")


def confidence_band(confidence: Column) -> Column:
    return F.when(confidence >= 0.95, "high").when(confidence >= 0.85, "medium").when(confidence.isNotNull(), "low")


def site_band(sites: Column) -> Column:
    return F.when(sites >= 2, "multi").when(sites == 1, "single").otherwise("none")


def total(unit_price: Column, quantity: Column) -> Column:
    return (unit_price * quantity).cast("decimal(14,3)")


def two_places(mean: Column) -> Column:
    """A mean rounded to cents from six places, so that engines agree on ties."""
    return F.round(mean.cast("decimal(18,6)"), 2).cast("double")


def per_cent(part: Column, whole: Column, places: int = 1) -> Column:
    return F.round((F.lit(100.0) * part / F.nullif(whole, F.lit(0))).cast("decimal(18,6)"), places).cast("double")
