"""The HTML report of the listing views: seven small results in one page."""

from __future__ import annotations

import datetime as dt
import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.plans import analytics

ROWS = 100
DASH = "—"


def sections(listings: DataFrame, rows: int = ROWS, sample: int = 50, seed: int = 42) -> list[tuple[str, DataFrame]]:
    """(title, bounded result) of each section."""
    sampled = listings.where("raw_price is not null").orderBy(F.xxhash64("url", "scraped_url_id", F.lit(seed))).limit(sample)
    return [
        ("Overview", analytics.overview(listings)),
        ("Sites", analytics.by_site(listings)),
        ("Brands", analytics.by_brand(listings).limit(rows)),
        ("Products on several sites", analytics.cross_site_eans(listings).limit(rows)),
        ("Extraction quality", analytics.extraction_quality(listings)),
        ("Price bands", analytics.price_bands(listings)),
        ("Sample", sampled.select(*analytics.SAMPLED).orderBy("domain", "raw_brand", "raw_name")),
    ]


def cell(value) -> str:
    if value is None or value != value:
        return DASH
    if isinstance(value, float):
        return f"{value:,.2f}"
    return html.escape(", ".join(map(str, value)) if isinstance(value, list) else str(value))


def html_table(frame: DataFrame) -> str:
    rows = frame.collect()  # bounded by its section
    if not rows:
        return "<p>No data.</p>"
    head = "".join(f"<th>{html.escape(c)}</th>" for c in frame.columns)
    body = "".join("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in r) + "</tr>" for r in rows)
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"


def build(listings: DataFrame, title: str = "Listing report", at: dt.datetime | None = None) -> str:
    at = at or dt.datetime.now(dt.UTC)
    parts = [f"<h2>{html.escape(name)}</h2>{html_table(frame)}" for name, frame in sections(listings)]
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1><p>{at:%Y-%m-%d %H:%M} UTC</p>{''.join(parts)}</body></html>"
