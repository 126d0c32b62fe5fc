"""Schemas of the stored relations, as DDL. Ids are strings; times are UTC."""

from __future__ import annotations

#: One line for each fetch of a page.
BRONZE = (
    "url string, status string, html string, http_status_code int, final_url string, content_type string, "
    "content_length_bytes bigint, proxy_used string, attempt_count int, elapsed_seconds double, fetched_at_utc double, "
    "scraped_url_id string, site_id string, arq_job_id string, error_message string"
)

#: The extracted product listing of a page; ``domain`` and ``fetched_date`` are its partitions.
LISTING = (
    "scraped_url_id string, site_id string, url string, raw_name string, raw_brand string, raw_price double, "
    "raw_currency string, raw_description string, raw_ean string, raw_sku string, raw_mpn string, raw_images string, "
    "in_stock boolean, raw_stock_qty int, raw_rating double, raw_review_count int, raw_category string, raw_tags string, "
    "raw_attributes string, extraction_method string, parse_errors string, fetched_at_utc double, "
    "bronze_source_key string, domain string, fetched_date date"
)

#: The canonical product.
MASTER = (
    "id string, name string, brand string, ean string, mpn string, category string, description string, "
    "image_urls array<string>, tags array<string>, status string, match_confidence double, manually_verified boolean, "
    "last_matched_at timestamp, name_embedding array<float>"
)

#: What a site asks for a canonical product.
SITE_PRODUCT = (
    "id string, master_id string, site_id string, domain string, product_url string, external_id string, "
    "current_price decimal(10,2), currency string, in_stock boolean, match_confidence double, last_scraped_at timestamp"
)

PRICE_LOG = ("site_product_id string, master_id string, site_id string, price decimal(10,2), currency string, in_stock boolean, logged_at timestamp")

FETCH_LOG = ("url_id string, site_id string, url string, status string, http_status_code int, elapsed_seconds double, worker string, fetched_at timestamp")

URL_QUEUE = ("id string, site_id string, url string, url_type string, status string, priority int, discovered_at timestamp, next_scrape_after timestamp, job_id string, error_message string")

SITE = ("site_id string, domain string, name string, status string, discovery string, product_patterns array<string>")

PROXY = ("proxy_id string, dsn string, is_active boolean, failures int, domains array<string>")

SUPPLIER_PRODUCT = (
    "supplier string, code string, reference string, name string, prix_pharmacien decimal(12,3), ppm decimal(12,2), forme string, "
    "in_stock boolean, master_id string, match_confidence double, manually_verified boolean, vendor_product_id bigint"
)

ORDER = ("order_id string, supplier string, code string, quantity int, unit_price decimal(12,3), status string, transaction_number string, vendor_order_id string, response string")

#: Allowed values, checked by filters and not by types.
MASTER_STATUSES = ("active", "discontinued", "under_review")
URL_STATUSES = ("pending", "in_progress", "done", "failed", "blocked", "not_found", "excluded")
FETCH_STATUSES = ("success", "blocked", "not_found", "rate_limited", "timeout", "network_error", "http_error", "unknown_error")
ORDER_STATUSES = ("draft", "submitted", "confirmed", "failed")
