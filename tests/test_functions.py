import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarifa.functions import extract, prices, selectors, similarity, text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("native", [True, False])
@pytest.mark.parametrize(
    "name,want",
    [("Velin Baume", "baume velin"), ("Savon Orage Nacre 75 ml", "75ml nacre orage savon"), ("Nacre Savon Orage 75ml", "75ml nacre orage savon"), ("", ""), (None, ""), ("Forêt d'hiver pour l'âtre", "atre foret hiver"), ("200 gel", "200gel"), ("a b", "")],
)
def test_normalise_name(spark, name, want, native):
    assert one(spark, text.normalise_name(F.col("n"), native), n=name) == want


def test_normalise_name_is_idempotent(spark):
    names = [("Gel 200 ml X",), ("Élixir N°5 100ML",), ("a-b_c d",)]
    df = spark.createDataFrame(names, "n string").select(text.normalise_name(F.col("n")).alias("a"))
    assert df.where(text.normalise_name(F.col("a")) != F.col("a")).count() == 0


@pytest.mark.parametrize("name,want", [("x 200ml", "200ml"), ("500 mg y", "500mg"), ("50gel", "50g"), ("1.5L", "1.5l"), ("1,5 l", "1.5l"), ("20 UI", "20ui"), ("none", None), (None, None)])
def test_extract_volume(spark, name, want):
    assert one(spark, text.extract_volume(F.col("n")), n=name) == want


def test_fingerprint(spark):
    fp = lambda b, n: one(spark, text.fingerprint(F.col("b"), F.col("n")), b=b, n=n)
    assert fp("VELIN", "VELIN Crépuscule 75 ml") == "velin_75ml_crepuscule"
    assert fp("VELIN", "VELIN Baume 75ml") != fp("VELIN", "VELIN Crépuscule 75ml")
    assert fp("", "Baume 75ml") is None and fp("VELIN", "Baume") is None and fp("VELIN", "VELIN 75ml") is None


@pytest.mark.parametrize("raw,default,price,currency", [("270.00", "MAD", 270.0, "MAD"), ("189", "EUR", 189.0, "EUR"), ("270,00", "MAD", 270.0, "MAD"), ("270 MAD", "EUR", 270.0, "MAD"), ("270 د.م.", "EUR", 270.0, "MAD"), ("189 DH", "EUR", 189.0, "MAD"), ("1,299.00", "EUR", 1299.0, "EUR"), ("€99", "MAD", 99.0, "EUR"), ("", "MAD", None, "MAD"), ("N/A", "EUR", None, "EUR"), (None, "EUR", None, "EUR")])
def test_price(spark, raw, default, price, currency):
    got = one(spark, prices.price(F.col("r"), default), r=raw)
    assert (got.price, got.currency) == (price, currency)


@pytest.mark.parametrize("body,want", [('{"supplierId": 363, "isAvailable": true}', True), ('{"isAvailable": false}', False), ("true", True), ("false", False), ("1", True), ("0", False), ("disponible", True), ("indisponible", False), ("UNKNOWN_STATUS", False), ('{"stock": "TRUE"}', True), ('{"stock": "yes"}', False), ('{"stock": 0}', False), ('{"other": 1}', False), ("", False), (None, False)])
def test_availability(spark, body, want):
    assert one(spark, prices.availability(F.col("b")), b=body) is want


def test_descriptions(spark):
    clean = lambda t: one(spark, text.clean_description(F.col("t")), t=t)
    assert clean("Commandez Baume Velin 12 à seulement 41,50 MAD chez Boutique-x.ma. Livraison en deux jours. Produit 100 % original.") == ""
    assert clean("Commandez ceci\nà seulement 9 DH chez Y") == ""
    assert clean("Sent la mousse. LIVRAISON le mardi seulement.") == "Sent la mousse."
    assert clean("Un voile léger, sans savon.") == "Un voile léger, sans savon."
    assert clean("") == "" and len(clean("x" * 3000)) == 2000


def test_bands_and_margins(spark):
    assert one(spark, prices.saving_pct(F.lit(270), F.lit(326.70))) == 17
    assert one(spark, prices.margin_pct(F.lit(130), F.lit(100))) == 30
    assert one(spark, prices.band(F.lit(50))) == "2. 50-100 MAD" and one(spark, prices.band(F.lit(1000))) == "6. > 1000 MAD"
    assert [one(spark, prices.confidence_band(F.lit(x))) for x in (0.95, 0.85, 0.84)] == ["high", "medium", "low"]
    assert [one(spark, prices.site_band(F.lit(x))) for x in (2, 1, 0)] == ["multi", "single", "none"]
    assert one(spark, prices.positive_decimal(F.lit("12,5"))) == 12.5 and one(spark, prices.positive_decimal(F.lit("0"))) is None


def test_small_texts(spark):
    assert one(spark, text.hide_password(F.lit("http://user:secret@host:1"))) == "http://user:***@host:1"
    assert one(spark, text.url_host(F.lit("https://u:p@WWW.Shop.ma:80/x"))) == "www.shop.ma"
    assert one(spark, text.absolute_url(F.lit("/p/1"), F.lit("https://a.b/c/d"))) == "https://a.b/p/1"
    assert one(spark, text.without_controls(F.lit("a\x00b\x1fc\nd"))) == "abc\nd"
    assert one(spark, text.form_display(F.lit("CR"))) == "Crème" and one(spark, text.form_display(F.lit("ZZ"))) == "ZZ"
    assert one(spark, text.valid_ean(F.lit("ABC123"))) is None and one(spark, text.ean_in_text(F.lit("x 4006000099422 y"))) == "4006000099422"
    assert one(spark, text.json_list(F.lit('["a"]'))) == ["a"] and one(spark, text.json_list(F.lit("x"))) == [] and one(spark, text.json_list(F.lit("x"), True)) == ["x"]
    assert one(spark, text.vector(F.lit("[1,2.5]"))) == [1.0, 2.5]
    assert one(spark, text.normalise_wholesale(F.lit(" crème-gel 50 "))) == "CREME GEL 50"
    assert one(spark, text.matches_any(F.lit("/p/1"), F.array(F.lit("/p/")))) and one(spark, text.matches_any(F.lit("x"), F.array().cast("array<string>")))


@given(st.text("abc ", max_size=30), st.text("abc ", max_size=30))
@settings(max_examples=200, deadline=None)
def test_ratio(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            d[i + 1][j + 1] = d[i][j] + 1 if a[i] == b[j] else max(d[i][j + 1], d[i + 1][j])
    assert similarity.common_subsequence(a, b) == d[-1][-1]
    assert similarity.ratio(a, b) == similarity.ratio(b, a) and 0 <= similarity.ratio(a, b) <= 100
    assert similarity.token_sort_ratio(a, " ".join(reversed(a.split()))) == pytest.approx(100.0)


def ld(data):
    return f'<script type="application/ld+json">{data if isinstance(data, str) else json.dumps(data)}</script>'


def fields(spark, html):
    return spark.createDataFrame([(html,)], "html string").transform(extract.listing_fields).first()


def test_json_ld(spark):
    r = fields(spark, ld({"@type": "Product", "name": "N", "brand": [{"name": "B"}], "offers": [{"priceSpecification": [{"price": "264.00", "priceCurrency": "MAD"}, {"price": "412.50", "priceType": "https://schema.org/ListPrice"}]}]}))
    assert (r.raw_name, r.raw_brand, r.raw_price_str, r.raw_currency, r.extraction_method) == ("N", "B", "264.00", "MAD", "json_ld")
    r = fields(spark, ld({"@graph": [{"@type": "WebSite"}, {"@type": "Product", "name": "G", "sku": "1", "gtin13": "4006000099422", "image": [{"url": "a"}, {"url": "b"}], "aggregateRating": {"ratingValue": "4.5", "reviewCount": "23"}, "category": "A > é", "additionalProperty": [{"name": "x", "value": "y"}], "offers": {"availability": "https://schema.org/OutOfStock"}}]}))
    assert (r.raw_ean, r.raw_sku, r.raw_images, r.raw_rating, r.raw_review_count, r.raw_category, r.raw_attributes, r.in_stock) == ("4006000099422", "1", ["a", "b"], 4.5, 23, "A > é", {"x": "y"}, False)
    assert fields(spark, ld({"@type": "WebSite"})).extraction_method == "failed"
    r = fields(spark, ld("{invalid json}"))
    assert r.extraction_method == "failed" and len(json.loads(r.parse_errors)) == 1


def test_open_graph(spark):
    head = "".join(f'<meta property="{k}" content="{v}">' for k, v in {"og:title": "VELIN Baume 75ml - Une boutique", "product:brand": "VELIN", "product:price:amount": "61", "product:price:currency": "MAD", "product:availability": "instock", "product:retailer_item_id": "4006000099422", "og:image": "https://i/x.png", "og:description": "Baume."}.items())
    r = fields(spark, head + '<meta content="37 en stock" name="twitter:data2">')
    assert (r.raw_name, r.raw_brand, r.raw_price, r.raw_currency, r.in_stock, r.raw_ean, r.raw_images, r.raw_description, r.raw_stock_qty) == ("VELIN Baume 75ml", "VELIN", 61.0, "MAD", True, "4006000099422", ["https://i/x.png"], "Baume.", 37)
    for word in ("outofstock", "out_of_stock", "unavailable"):
        assert fields(spark, f'<meta property="product:availability" content="{word}">').in_stock is False
    assert fields(spark, '<meta property="product:retailer_item_id" content="ABC123">').raw_ean is None


def test_selectors():
    page = '<div class="related"><b class=price>1</b></div><div class="product-prices x"><p><br><i>Was</i><span class="a price">\n 7,5 <u>DH</u></span></p></div><span class=price>3</span><meta property="m:p" content="9">'
    first = lambda s: next(iter(selectors.values(page, [s])[0]), None)
    assert first(".price") == "1" and first(extract.PRICE_SELECTOR) == "7,5 DH" and first(".current-price .price") is None
    assert first("meta[property='m:p']@content") == "9" and first("div.related.price") is None and first("*[property]@content") == "9"
    assert selectors.values(page, [".price", "u"], every=True) == [["1", "7,5 DH", "3"], ["DH"]]
    assert selectors.values(None, ["a"]) == selectors.values("", ["a"]) == [[]]
    assert selectors.values("<i>a</q> b</i>c", ["i"], every=True) == [["a b"]] and selectors.values("<p>open", ["p"]) == [["open"]]
    assert len(selectors.values("<b>" * 20000 + "</q>" * 20000, ["i b"])) == 1
    for bad in ("a > b", "a:first-child", ".price div["):
        with pytest.raises(ValueError):
            selectors.parsed(bad)


def test_selectors_of_a_site(spark):
    html = '<h1>Page</h1><h2 id="t">Own name</h2><div class="promo"><span class="price">5 DH</span></div><em data-p="12,50 DH"></em>'
    pages = spark.createDataFrame([("a", html), ("b", html), (None, html), ("a", None)], "domain string, html string")
    sites = {"a": {"raw_name": "#t", "raw_price_str": "em[data-p]@data-p", "raw_review_count": ".none"}}
    got = [(r.raw_name, r.raw_price, r.extraction_method) for r in extract.listing_fields(pages, sites=sites).collect()]
    assert got == [("Own name", 12.5, "css_selectors"), ("Page", 5.0, "css_selectors"), ("Page", 5.0, "css_selectors"), ("", None, "failed")]


def test_css_and_links(spark):
    r = fields(spark, '<h1>A &amp; <b>b</b></h1><span class="big price">99,00 DH</span>')
    assert (r.raw_name, r.raw_price, r.extraction_method) == ("A & b", 99.0, "css_selectors")
    pages = spark.createDataFrame([("http://a.b/c", '<a href="/p/1">x</a><a class=k href="http://z/q">y</a><a href="/p/1">')], "url string, html string")
    assert sorted(r.url for r in extract.links(pages).collect()) == ["http://a.b/p/1", "http://z/q"]
    pages = spark.createDataFrame([(ld([{"@type": "Product", "url": "u"}, {"@type": "ItemList", "@id": "i"}, {"@type": "X", "url": "n"}]),)], "html string")
    assert sorted(r.url for r in extract.entity_urls(pages).collect()) == ["i", "u"]
