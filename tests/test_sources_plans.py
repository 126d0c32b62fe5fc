import datetime as dt
import gzip
import json
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tarifa import schemas, testkit
from tarifa.operators.upsert import SnapshotTable
from tarifa.plans import analytics, nightly, report, serve
from tarifa.sources import readers, writers
from tarifa.streaming import rollup


def listings(spark, *rows):
    """rows: domain, date, url, name, price, method."""
    made = spark.createDataFrame(list(rows), "domain string, fetched_date string, url string, raw_name string, raw_price double, extraction_method string")
    return readers.with_columns_of(made.withColumn("fetched_date", F.col("fetched_date").cast("date")), schemas.LISTING)


def test_listings_round_trip_and_pruning(spark, tmp_path):
    root = f"{tmp_path}/listings"
    rows = listings(spark, ("a", "2024-01-01", "u1", "n", 1.0, "json_ld"), ("a", "2024-01-02", "u2", "n", 2.0, "og_meta"), ("b", "2024-01-01", "u3", "n", 3.0, "json_ld"), ("b", "2024-01-01", "u4", "", 3.0, "json_ld"), ("b", "2024-01-01", "u5", "n", 3.0, "failed"))
    writers.write_listings(rows, root)
    assert readers.listings(spark, root).count() == 3
    one = readers.listings(spark, root, "a", dt.date(2024, 1, 2))
    assert [r.url for r in one.collect()] == ["u2"]
    assert "PartitionFilters: [isnotnull(domain" in one._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")).replace("`", "")
    writers.write_listings(rows.where("domain = 'a'").withColumn("raw_price", F.lit(9.0)), root, replace_partitions=True)
    assert sorted((r.domain, r.raw_price) for r in readers.listings(spark, root).collect()) == [("a", 9.0), ("a", 9.0), ("b", 3.0)]
    writers.write_listings(rows, root)
    assert readers.listings(spark, root).count() == 6
    (tmp_path / "listings/domain=a/fetched_date=2024-01-01/broken.parquet").write_bytes(b"not parquet")
    assert readers.listings(spark, root).count() >= 6


def test_bronze(spark, tmp_path):
    day = tmp_path / "bronze/a.ma/2024-01-01"
    day.mkdir(parents=True)
    with gzip.open(day / "x.jsonl.gz", "wt") as f:
        f.write(json.dumps({"url": "http://a.ma/1", "status": "success", "html": "<h1>T</h1>", "http_status_code": 200, "fetched_at_utc": 5.5}) + "\n")
    row = readers.bronze(spark, f"{tmp_path}/bronze", dt.date(2023, 12, 31), dt.date(2024, 1, 1)).first()
    assert (row.domain, row.fetched_date, row.http_status_code) == ("a.ma", dt.date(2024, 1, 1), 200)
    made = nightly.listings_from(readers.bronze(spark, f"{tmp_path}/bronze", dt.date(2024, 1, 1), dt.date(2024, 1, 1))).first()
    assert (made.raw_name, made.extraction_method, made.raw_images) == ("T", "css_selectors", "[]")
    writers.write_bronze(readers.with_columns_of(spark.createDataFrame([("http://b.ma/1", "a\x00b", 0.0), (None, "c", 86400.0)], "url string, html string, fetched_at_utc double"), schemas.BRONZE), f"{tmp_path}/out")
    back = spark.read.json(f"{tmp_path}/out")
    assert {(r.site, r.html) for r in back.collect()} == {("b.ma", "ab"), ("unknown", "c")}


def test_sitemaps(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    docs = spark.createDataFrame(
        [
            ("http://s/i.xml", f"<sitemapindex {ns}><sitemap><loc>https://s/sitemap_products_1.xml</loc></sitemap><sitemap><loc>https://s/fr/sitemap_products_1.xml</loc></sitemap></sitemapindex>"),
            ("https://s/sitemap_products_1.xml", f"<urlset {ns}><url><loc> https://s/products/a </loc><lastmod>2024-02-01</lastmod></url><url><loc>https://s/products/b?x=1&amp;y</loc></url><url><loc>https://s/products/c</loc><lastmod>2023-01-01</lastmod>\x01</url></urlset>"),
            ("https://s/fr/sitemap_products_1.xml", f"<urlset {ns}><url><loc>https://s/fr/products/a</loc></url></urlset>"),
        ],
        "url string, xml string",
    )
    assert sorted(r.loc for r in readers.sitemap_urls(docs, since="2024-01-01").collect()) == ["https://s/fr/products/a", "https://s/products/a", "https://s/products/b?x=1&y"]
    assert [r.url for r in readers.sitemap_pages(docs, ["http://s/i.xml"], kind="numbered", since="2024-01-01").collect()] == ["https://s/products/a"]
    assert readers.sitemap_pages(docs, ["http://s/i.xml"]).count() == 4
    urls = spark.createDataFrame([("/1-x.html",), ("/x",)], "url string")
    assert readers.matching(urls, [r"/\d+-[^/]+\.html$"]).count() == 1 and readers.matching(urls, []).count() == 2


def test_catalogue(spark, tmp_path):
    from tarifa.operators import wholesale

    items = [{"CODE_PRODU": "A", "NOM_PRODUI": "x", "PRIX_PHAR": "12,5", "PPM": "0", "FORME_PROD": "CR"}, {"CODE_PRODU": "", "NOM_PRODUI": "none", "PRIX_PHAR": "1"}, {"CODE_PRODU": "B", "PRIX_PHAR": "0"}]
    (tmp_path / "c.js").write_text(f"var x = 1;\nvar products = {json.dumps(items)};\n")
    got = {r.code: (r.prix_pharmacien, r.ppm, r.forme_display) for r in wholesale.catalogue_rows(readers.catalogue(spark, str(tmp_path / "c.js")), "s").collect()}
    assert got == {"A": (Decimal("12.500"), None, "Crème"), "B": (None, None, "")}
    (tmp_path / "c.json").write_text(json.dumps(items * 5000))
    assert readers.catalogue(spark, str(tmp_path / "c.json")).count() == 15_000
    (tmp_path / "bad").write_text("nothing")
    with pytest.raises(PySparkException):
        readers.catalogue(spark, str(tmp_path / "bad")).collect()


def test_api(spark):
    docs = spark.createDataFrame([('{"data": [{"links": {"canonical": "u1"}}, {"links": 3}]}',), ('[{"links": {"canonical": "u2"}}]',), ("{}",), ("bad",)], "body string")
    assert sorted(r.url for r in readers.api_urls(docs, "links.canonical").collect()) == ["u1", "u2"]


def test_pool_rule(spark):
    columns = "id string, master_id string, site_id string, domain string, product_url string, current_price decimal(10,2), currency string, in_stock boolean, last_scraped date"
    at = lambda m, *prices: [(f"{m}{i}", m, str(i), f"d{i}", f"u{i}", None if p is None else Decimal(p), "MAD", s, None) for i, (p, s) in enumerate(prices)]
    offers = spark.createDataFrame([*at("a", ("326.70", True), ("270.00", True), ("310.00", True)), *at("b", ("150.00", False), ("270.00", True), ("310.00", True)), *at("c", ("150.00", False), ("270.00", False)), *at("d", (None, True))], columns)
    got = {r.master_id: r for r in serve.price_pools(offers).collect()}
    a, b, c, d = (got[k] for k in "abcd")
    assert (a.price_min, a.price_max, a.price_avg, a.cheapest_site) == (Decimal("270.00"), Decimal("326.70"), 302.23, "d1")
    assert (b.price_min, b.in_stock_count, c.price_min, c.price_max) == (Decimal("270.00"), 2, Decimal("150.00"), Decimal("270.00"))
    assert (d.price_min, d.price_avg, d.price_currency, d.sites_count, d.cheapest_site) == (None, None, "MAD", 1, None)
    assert [s.price for s in a.sites] == [Decimal("270.00"), Decimal("310.00"), Decimal("326.70")]
    master = spark.createDataFrame([("z", "n", "b", "", "", "active")], "id string, name string, brand string, ean string, category string, status string")
    empty = serve.price_comparison(master, offers, "z").first()
    assert (empty.sites_count, empty.price_currency, empty.sites, empty.price_min) == (0, "MAD", [], None)


def test_proxies(spark):
    proxies = spark.createDataFrame([("1", "p1", True, 0, ["a"]), ("2", "p2", True, 0, []), ("3", "p3", False, 0, ["b"])], schemas.PROXY)
    sites = spark.createDataFrame([("a",), ("b",)], "domain string")
    assert sorted((r.domain, r.dsn) for r in serve.proxies_for(proxies, sites).collect()) == [("a", "p1"), ("b", "p2")]
    assert {r.domain: r.dsns for r in serve.proxy_pools(proxies).collect()} == {"a": ["p1"], "global": ["p2"]}


def test_paging_is_whole(spark):
    rows = spark.range(23)
    pages = [r.id for n in (1, 2, 3) for r in serve.page(rows, F.desc("id"), number=n, size=10).collect()]
    assert pages == list(range(22, -1, -1))


def test_views_and_report(spark, sf_dir):
    rows = testkit.listings(spark, sf_dir)
    assert analytics.register_views(rows) == sorted(analytics.VIEWS)
    assert spark.sql("SELECT count(*) FROM listing_by_site").first()[0] > 0
    page = report.build(rows, at=dt.datetime(2024, 1, 1))
    assert page.count("<h2>") == 7 and "2024-01-01" in page
    assert "No data." in report.build(rows.limit(0)) and report.cell(None) == "—" and report.cell(1234.5) == "1,234.50"


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    log = testkit.price_log(spark, sf_dir)
    log.repartition(3).write.parquet(f"{tmp_path}/log")
    stream = rollup.daily_stream(spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log"), late="4000 days")
    table = SnapshotTable(spark, f"file://{tmp_path}/table")
    rollup.start(stream, rollup.into_snapshot(table, ["day", "master_id", "site_id"]), f"{tmp_path}/checkpoint").awaitTermination()
    batch = rollup.daily(log)
    assert table.read().exceptAll(batch).count() == 0 and table.read().count() == batch.count()
    done = rollup.settled(batch, F.lit("1997-01-01 00:30:00").cast("timestamp"))
    assert done.agg(F.max("day")).first()[0] == dt.datetime(1996, 12, 30) or done.where("day >= '1996-12-31'").count() == 0


def test_store_then_mark():
    class Batch:
        def persist(self):
            done.append("persist")

        def unpersist(self):
            done.append("unpersist")

    done = []
    rollup.store_then_mark(lambda b, n: done.append("write"), lambda b, n: done.append("mark"))(Batch(), 0)
    assert done == ["persist", "write", "mark", "unpersist"]


def test_logs(spark, tmp_path):
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (2, dt.datetime(2024, 2, 5))], "k int, t timestamp")
    writers.append_log(rows, f"{tmp_path}/log", "t")
    writers.append_log(rows, f"{tmp_path}/log", "t")
    back = spark.read.parquet(f"{tmp_path}/log")
    assert back.count() == 4 and back.select("period").distinct().count() == 2
    assert writers.compacted(back, ["k"], "t").count() == 4
