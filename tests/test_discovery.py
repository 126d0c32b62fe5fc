import datetime as dt
import gzip

from pyspark.sql import functions as F

from tarifa import __main__ as cli
from tarifa import schemas
from tarifa.sources import discovery, readers, writers


def captured(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    rows = [
        ("1", "http://a/s.xml", f"<urlset {ns}><url><loc>http://a/p/1</loc></url><url><loc>http://a/about</loc></url></urlset>", None, None),
        ("1", "http://a/cat/x", None, '<a href="/p/1">1</a><a href="/p/2">2</a>', None),
        ("2", "http://b/api", None, None, '{"items": [{"url": "http://b/p/9"}]}'),
        ("3", "http://c/p", None, '<script type="application/ld+json">{"@type": "Product", "url": "http://c/p"}</script>', None),
    ]
    return spark.createDataFrame(rows, "site_id string, url string, xml string, html string, body string")


def test_strategies_and_isolation(spark):
    sites = [
        discovery.Site("1", "a", "hybrid", options={"roots": ["http://a/s.xml"], "categories": ["/cat/"]}, patterns=["/p/"]),
        discovery.Site("2", "b", "api"),
        discovery.Site("3", "c", "json_ld"),
        discovery.Site("4", "d", "no such strategy"),
        discovery.Site("5", "e", "api", status="paused"),
    ]
    queue = spark.createDataFrame([], schemas.URL_QUEUE)
    after, errors = discovery.run(sites, captured(spark), queue, F.lit("2024-01-01").cast("timestamp"))
    got = {r.url: (r.change, r.status) for r in after.collect()}
    assert got == {u: ("created", "in_progress") for u in ("http://a/p/1", "http://a/p/2", "http://b/p/9", "http://c/p")}
    assert set(errors) == {"d"}


def test_category_walk(spark):
    rows = [
        ("http://a/c", '<div class="list"><a class="p" href="/p/1">x</a></div><a href="/about">y</a><a class="next btn" href="/c?page=2">'),
        ("http://a/c?page=2", '<div class="list"><p><a class="p" href="http://z/p/2">x</a><a class="p" href="/p/1"></p></div><a class="next" href="/c?page=3">'),
        ("http://a/c?page=3", '<div class="list"><a class="p" href="/p/3"></div><a class="next" href="/c">'),
        ("http://a/other", '<div class="list"><a class="p" href="/p/9"></div>'),
        ("http://a/none", None),
    ]
    pages = spark.createDataFrame(rows, "url string, html string")
    walk = lambda **o: sorted(r.url for r in discovery.category(pages, {"category_urls": ["http://a/c"], "product_selector": ".list a.p"} | o).collect())
    assert walk() == ["http://a/p/1", "http://a/p/3", "http://z/p/2"]
    assert walk(max_pages=2) == ["http://a/p/1", "http://z/p/2"] and walk(max_pages=1) == ["http://a/p/1"]
    assert walk(max_pages=1, url_prefix="http://k/") == ["http://k/p/1"]
    assert walk(category_urls=["http://a/gone"]) == []


def test_numbered_sitemaps(spark):
    one = "<urlset><url><loc>http://a/%d</loc></url></urlset>"
    docs = spark.createDataFrame([("http://a/1.xml", one % 1), ("http://a/2.xml", one % 2), ("http://a/3.xml", "<urlset></urlset>"), ("http://a/4.xml", one % 4), ("http://b/1.xml", one % 9)], "url string, xml string")
    urls = lambda **o: sorted(r.url for r in readers.numbered_sitemaps(docs, "http://a/{}.xml", **o).collect())
    assert urls() == ["http://a/1.xml", "http://a/2.xml"] and urls(most=1) == ["http://a/1.xml"]
    assert readers.numbered_sitemaps(docs, "http://c/{}.xml").count() == 0


def test_path_of_the_listings(spark, tmp_path):
    for n in (2, 3):
        spark.range(n).write.parquet(f"{tmp_path}/{n}")
        readers.listings_path(spark, f"{tmp_path}/{n}")
        assert spark.sql("SELECT count(*) AS n FROM IDENTIFIER('parquet.`' || listings_path || '`')").first().n == n


def test_gzip_by_content(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes(gzip.compress(b"<x/>"))
    (tmp_path / "b.gz.xml").write_bytes(b"<y/>")
    (tmp_path / "c.xml").write_bytes(b"\x1f\x8bbroken")
    assert sorted(map(str, (r.xml for r in readers.documents(spark, str(tmp_path)).collect()))) == ["<x/>", "<y/>", "None"]


def test_rows_without_a_site_are_counted(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "domain string, k int")
    sites = spark.createDataFrame([("7", "a")], "site_id string, domain string")
    out, missing = readers.with_site(rows, sites)
    assert [(r.site_id, r.k) for r in out.collect()] == [("7", 1)] and [(r.domain, r.errors) for r in missing.collect()] == [("b", 2)]


def test_command_line(spark, tmp_path, capsys):
    made = spark.createDataFrame([("a", "2024-01-01", "http://a/1", "Gel Doux 200ml", 5.0, "json_ld", "1", "r1")], "domain string, fetched_date string, url string, raw_name string, raw_price double, extraction_method string, site_id string, scraped_url_id string")
    rows = readers.with_columns_of(made.withColumn("fetched_date", F.col("fetched_date").cast("date")), schemas.LISTING)
    writers.write_listings(rows, f"{tmp_path}/l")
    for _ in range(2):
        cli.main(["resolve", f"{tmp_path}/l", f"file://{tmp_path}/c"])
    from tarifa.operators.upsert import SnapshotSet

    assert {n: t.count() for n, t in SnapshotSet(spark, f"file://{tmp_path}/c").read().items()} == {"masters": 1, "offers": 1, "log": 2}
    cli.main(["report", f"{tmp_path}/l", f"{tmp_path}/r.html"])
    assert "Gel Doux" in (tmp_path / "r.html").read_text() and dt.date.today()
