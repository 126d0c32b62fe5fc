import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarifa import schemas, testkit
from tarifa.functions import similarity
from tarifa.operators import gold, matching, urlqueue, wholesale
from tarifa.operators.upsert import SnapshotSet, SnapshotTable, insert_missing, last_of, upsert
from tarifa.plans import nightly

def now():
    return F.lit("2024-01-02 00:00:00").cast("timestamp")


def listing(spark, *rows):
    columns = "scraped_url_id string, raw_name string, raw_brand string, raw_ean string, raw_sku string, site_id string, domain string"
    return spark.createDataFrame(list(rows), columns)


def masters(spark, *rows):
    return spark.createDataFrame([(*r, "active") for r in rows], "id string, name string, brand string, ean string, status string")


def tiers(spark, rows, known, links=None, **kw):
    got = matching.match(listing(spark, *rows), masters(spark, *known), links and spark.createDataFrame(links, "domain string, master_id string"), **kw)
    return {r.row_id: (r.tier, r.master_id, r.confidence, r.needs_review, r.is_new) for r in got.collect()}


def test_tiers(spark):
    known = [("m1", "ISDIN Fotoprotector SPF50 200ml", "ISDIN", "4006000099422"), ("m2", "Cleanance Gel Nettoyant", "AVENE", ""), ("m3", "Bioderma Sensibio Solution Micellaire Douce Extra", "", "")]
    rows = [
        ("ean", "x", "", "4006000099422", "", "1", "a.ma"),
        ("bad", "nothing like it", "", "ABC123", "", "1", "a.ma"),
        ("name", "Gel nettoyant Cleanance", "Avène", "", "", "1", "a.ma"),
        ("gate", "Gel nettoyant Cleanance", "ISDIN", "", "", "1", "a.ma"),
        ("site", "Gel nettoyant Cleanance", "AVENE", "", "", "1", "b.ma"),
        ("fuzzy", "Bioderma Sensibio Solutions Micellaire Douce Extra", "Bioderma", "", "", "1", "a.ma"),
        ("print", "Fotoprotector fluide invisible ISDIN 200 ml", "ISDIN", "", "", "1", "a.ma"),
    ]
    got = tiers(spark, rows, known, [("b.ma", "m2")])
    assert got["ean"] == (1, "m1", 1.0, False, False)
    assert got["bad"][0] == 6 and got["bad"][1] is None and got["bad"][4]
    assert got["name"][:2] == (3, "m2")
    assert got["gate"][0] == 6 and got["site"][0] == 6
    assert got["fuzzy"][:2] == (3, "m3") and 0.95 <= got["fuzzy"][2] < 1
    assert got["print"] == (6, None, 0.0, False, True) or got["print"][:2] == (4, "m1")


def test_fingerprint_tier(spark):
    got = tiers(spark, [("r", "Fluide ISDIN 200 ml creme", "ISDIN", "", "", "1", "a.ma")], [("m", "Creme riche ISDIN visage 200ml", "ISDIN", "")])
    assert got["r"] == (4, "m", 0.92, False, False)


def test_every_listing_of_a_repeated_id_is_matched(spark):
    known = [("m1", "Serum eclat visage", "", "4006000099422"), ("m2", "Cleanance Gel Nettoyant", "AVENE", "")]
    kinds = {("x", "", "4006000099422"): (1, "m1"), ("Gel nettoyant Cleanance", "Avène", ""): (3, "m2"), ("Gel nettoyant Cleanances", "", ""): (3, "m2"), ("nothing like it", "", ""): (6, None)}
    rows = [(i, name, brand, ean, "", "1", "a.ma") for i in ("one", "two", "a:b", None) for name, brand, ean in kinds] + [("one", "nothing like it", "", "", "", "1", "a.ma")]
    got = matching.match(listing(spark, *rows), masters(spark, *known)).collect()
    want = [(r[0], *kinds[r[1:4]]) for r in rows]
    assert sorted(((r.row_id, r.tier, r.master_id) for r in got), key=str) == sorted(want, key=str)


def test_fuzzy_query_keeps_repeated_ids(spark, sf_dir):
    """Against each row alone: a row's match does not hang on others of its id."""
    from tarifa.queries import QUERIES, _rows

    index = matching.indexed(testkit.masters(spark, sf_dir))
    rows = _rows(spark, sf_dir).withColumn("id", F.col("row_id")).withColumn("row_id", F.to_json(F.struct("row_id", "norm", "brand_norm", "domain")))
    alone = matching.by_similarity(rows.dropDuplicates(["row_id"]), index, None, 90.0)
    want = rows.groupBy("row_id", "id").count().join(alone, "row_id").groupBy("id", "master_id").agg(F.sum("count").alias("n"))
    got = QUERIES["match_fuzzy_topk"](spark, sf_dir).groupBy(F.col("row_id").alias("id"), "master_id").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_no_masters(spark):
    got = tiers(spark, [("r", "x y z", "", "", "", "1", "a")], [])
    assert got["r"] == (6, None, 0.0, False, True)


def test_sku_tier_is_optional(spark):
    skus = spark.createDataFrame([("1", "S9", "m")], "site_id string, sku string, master_id string")
    row, known = [("r", "qq ww", "", "", "S9", "1", "a")], [("m", "other thing", "", "")]
    assert tiers(spark, row, known)["r"][0] == 6
    assert tiers(spark, row, known, skus=skus, thresholds=matching.Thresholds(sku_tier=True))["r"][:2] == (2, "m")


def test_vector_tier(spark):
    rows = listing(spark, ("a", "qq", "", "", "", "1", "d1"), ("b", "ww", "", "", "", "1", "d1"), ("c", "ee", "", "", "", "1", "d2")).join(spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.7, 0.71]), ("c", [1.0, 0.01])], "scraped_url_id string, name_embedding array<float>"), "scraped_url_id")
    known = masters(spark, ("m", "zz yy", "", ""), ("n", "xx vv", "", "")).join(spark.createDataFrame([("m", [1.0, 0.0]), ("n", [0.0, -1.0])], "id string, name_embedding array<float>"), "id")
    links = spark.createDataFrame([("d2", "m")], "domain string, master_id string")
    got = {r.row_id: r for r in matching.match(rows, known, links).collect()}
    assert (got["a"].tier, got["a"].master_id, got["a"].confidence) == (4, "m", 1.0)
    assert (got["b"].tier, got["b"].needs_review) == (5, True)
    assert got["c"].tier == 6


@pytest.mark.parametrize("least", [95.0, 90.0, 75.0])
def test_similar_names_miss_none(spark, least):
    import random

    rng = random.Random(int(least))

    def changed(x):
        x = list(x)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(x) + 1)
            if rng.random() < 0.5:
                x.insert(i, rng.choice("ab "))
            elif i < len(x):
                x.pop(i)
        return " ".join("".join(x).split())

    base = ["".join(rng.choice("abcde ") for _ in range(rng.randint(1, 40))) for _ in range(40)]
    a, b = ({changed(x) for x in base for _ in (0, 1)} - {""} for _ in (0, 1))
    got = {(r.norm, r.m_norm) for r in matching.similar_names(spark.createDataFrame([(x,) for x in a], "norm string"), spark.createDataFrame([(x,) for x in b], "m_norm string"), least).collect()}
    assert {(x, y) for x in a for y in b if similarity.ratio(x, y) >= least} <= got


def test_new_products_are_joined(spark):
    rows = listing(spark, ("1", "Gel Doux", "", "12345678", "", "1", "a"), ("2", "Autre", "", "12345678", "", "2", "b"), ("3", "Gel Frais", "Xa", "", "", "1", "a"), ("4", "frais gel", "", "", "", "2", "b"), ("5", "Gel Frais", "Ya", "", "", "3", "c"))
    ids = {r.row_id: r.master_id for r in matching.new_products(rows, matching.match(rows, masters(spark))).collect()}
    assert ids["1"] == ids["2"] and len({ids["3"], ids["5"], ids["1"]}) == 3


def test_wholesale_match(spark):
    products = spark.createDataFrame([("s", "c1", "GEL 4006000099422", None), ("s", "c2", "Crème hydratante visage", None), ("s", "c3", "zzz", None), ("s", "c4", "x", "m")], "supplier string, code string, name string, master_id string")
    known = masters(spark, ("m1", "a", "", "4006000099422"), ("m2", "Creme Hydratante Visages", "", ""))
    got = {r.code: (r.master_id, r.confidence, r.manually_verified) for r in matching.match_wholesale(products, known).collect()}
    assert got["c1"] == ("m1", 1.0, True) and got["c2"][0] == "m2" and got["c2"][1] >= 0.95 and set(got) == {"c1", "c2"}


def test_vectors_as_text_round_halves_to_even(spark):
    values = [[k / 128 for k in range(-9, 10)], [0.1234565, -2.0000004, 1e-9, -1e-9, 3.0, 1 / 3], [12345.0078125, -77.9921875, 0.00390625]]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v array<float>")
    got = {r.i: (r.v, r.t) for r in rows.withColumn("t", gold.embeddings_text(F.col("v"))).collect()}
    assert all(t == "[" + ",".join(f"{x:.6f}" for x in v) + "]" for v, t in got.values()) and "0.007812," in got[0][1]


def test_best_images(spark):
    sites = {"one.ma": 1, "two.ma": 2}
    pick = lambda old, new, d: spark.createDataFrame([(old, new, d)], "o array<string>, n array<string>, d string").select(gold.best_images(F.col("o"), F.col("n"), F.col("d"), sites).alias("x")).first().x
    assert pick(["https://two/a"], ["b"], "one.ma") == ["b"]
    assert pick(["https://one/a"], ["b"], "two.ma") == ["https://one/a"]
    assert pick(["https://one/a"], ["b", "c"], "one.ma") == ["b", "c"]
    assert pick([], ["b"], "x") == ["b"] and pick(["a"], [], "one.ma") == ["a"] and pick(["https://zzz/a"], ["b"], "two.ma") == ["b"]


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "B", "n"), (3, "c", "z"), (1, None, "x")], "k int, v string, w string")
    once = upsert(old, new, ["k"], fill_only=("w",))
    want = [(1, "a", "x"), (2, "B", "y"), (3, "c", "z")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, upsert(once, new, ["k"], fill_only=("w",)).collect())) == want
    kept = upsert(old, new, ["k"], only_if=F.col("new.v") > F.col("old.v"))
    assert sorted(map(tuple, kept.collect())) == [(1, "a", None), (2, "b", "y"), (3, "c", "z")]
    assert insert_missing(old, new, ["k"]).count() == 1
    assert sorted(map(tuple, last_of(new.unionByName(old), ["k"], [F.col("v")]).collect()), key=str) == [(1, "a", None), (2, "b", "y"), (3, "c", "z")]


def test_snapshots(spark, tmp_path):
    t = SnapshotTable(spark, f"file://{tmp_path}/t")
    assert t.current() is None
    t.write(spark.range(3))
    first = t.read()
    t.write(spark.range(5))
    assert t.read().count() == 5 and first.count() == 3


def test_tables_that_change_together(spark, tmp_path):
    stored = SnapshotSet(spark, f"file://{tmp_path}/c")
    assert stored.read() == {}
    stored.write({"a": spark.range(1), "b": spark.range(2)})
    bad = spark.range(1).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        stored.write({"a": spark.range(5), "b": bad})
    assert {n: t.count() for n, t in stored.read().items()} == {"a": 1, "b": 2}


def test_faulty_rows_are_counted(spark):
    rows = spark.createDataFrame([("1", "u", "d", 1.0), (None, "u2", "d", None), ("2", None, "d", 1.0), ("3", "u", "", 1.0), ("4", "u", "d", float("nan"))], "scraped_url_id string, url string, domain string, raw_price double")
    good, faulty = nightly.checked(rows)
    assert sorted(str(r.scraped_url_id) for r in good.collect()) == ["1", "None"]
    assert sorted(r.error for r in faulty.collect()) == ["no domain", "no url", "price is no number"]
    found = spark.createDataFrame([("1", 1, False, False), ("2", 6, True, False)], "row_id string, tier int, is_new boolean, needs_review boolean")
    assert [tuple(r) for r in matching.run_stats(found, faulty).collect()] == [(None, 0, 0, 0, 3), (1, 1, 0, 0, 0), (6, 1, 1, 0, 0)]


def test_waiting_for_the_queue(spark):
    states = [["pending", "done"], ["in_progress", "done"], ["failed", "done"]]
    at, left = [0.0], list(states)
    read = lambda: spark.createDataFrame([(s,) for s in (left.pop(0) if len(left) > 1 else left[0])], "status string")
    sleep = lambda s: at.__setitem__(0, at[0] + s)
    assert urlqueue.wait(read, 600, 60, lambda: at[0], sleep) == {"failed": 1, "done": 1} and at[0] == 120
    assert urlqueue.wait(lambda: spark.createDataFrame([("pending",)], "status string"), 100, 60, lambda: at[0], sleep) is None


def test_an_injected_encoder_feeds_the_vector_tiers(spark):
    def load():
        words = {"mer": 0, "ocean": 0, "lune": 1}
        return lambda texts: [[2.0 * sum(words.get(w) == i for w in t.lower().split()) + 0.001 for i in range(2)] for t in texts]

    rows = spark.createDataFrame([("1", "s", "d", "Baume Ocean"), ("2", "s", "d", "Baume Lune"), ("3", "s", "d", "")], "scraped_url_id string, site_id string, domain string, raw_name string")
    rows = matching.with_vectors(rows.selectExpr("*", "'' as raw_brand", "'' as raw_ean", "'' as raw_sku"), load, F.col("raw_name"))
    vectors = [r.name_embedding for r in rows.collect()]
    assert vectors[2] is None and all(abs(sum(x * x for x in v) - 1) < 1e-6 for v in vectors[:2])
    known = spark.createDataFrame([("m", "Creme Mer", "", None, "active")], "id string, name string, brand string, ean string, status string")
    got = {r.row_id: (r.tier, r.master_id) for r in matching.match(rows, matching.with_vectors(known, load, F.col("name"))).collect()}
    assert got == {"1": (4, "m"), "2": (6, None), "3": (6, None)}


def test_a_run_with_repeated_ids(spark):
    from tarifa.sources.readers import with_columns_of

    def run(ids):
        pages = [(i, "1", f"http://a.ma/{n}", name, "a.ma", 10.0 + n, float(n)) for n, (i, name) in enumerate(zip(ids, ["Gel Doux", "Shampooing Frais", "Creme Riche"], strict=True))]
        rows = with_columns_of(spark.createDataFrame(pages, "scraped_url_id string, site_id string, url string, raw_name string, domain string, raw_price double, fetched_at_utc double"), schemas.LISTING)
        none = nightly.Catalogue(*[spark.createDataFrame([], s) for s in (schemas.MASTER, schemas.SITE_PRODUCT, schemas.PRICE_LOG)])
        after, found = nightly.resolve(rows, none, now())
        return sorted((r.product_url, r.master_id, r.current_price) for r in after.offers.collect()), sorted(str(r.row_id) for r in found.collect())

    same, ids = run(["u", "u", None])
    assert (same, ids) == (run(["u", "v", "w"])[0], ["None", "u", "u"]) and len(same) == 3


def offers(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SITE_PRODUCT)


def test_a_run_of_the_catalogue(spark, tmp_path):
    pages = [("u1", "1", "http://a.ma/1", "ISDIN Gel 200ml", 10.0, 1.0), ("u2", "2", "http://b.ma/1", "Gel ISDIN 200 ml", 9.0, 1.0), ("u3", "1", "http://a.ma/2", "Shampooing doux", None, 1.0)]
    rows = spark.createDataFrame([(*p, "ISDIN" if "ISDIN" in p[3] else "", f"{'a' if p[1] == '1' else 'b'}.ma") for p in pages], "scraped_url_id string, site_id string, url string, raw_name string, raw_price double, fetched_at_utc double, raw_brand string, domain string")
    from tarifa.sources.readers import with_columns_of

    rows = with_columns_of(rows, schemas.LISTING)
    empty = lambda s: spark.createDataFrame([], s)
    first, found = nightly.resolve(rows, nightly.Catalogue(empty(schemas.MASTER), empty(schemas.SITE_PRODUCT), empty(schemas.PRICE_LOG)), now())
    assert first.masters.count() == 2 and first.offers.count() == 3 and first.log.count() == 2
    assert found.where("is_new").count() == 3
    store = {}
    for name in ("masters", "offers", "log"):
        t = SnapshotTable(spark, f"file://{tmp_path}/{name}")
        t.write(getattr(first, name))
        store[name] = t.read()
    later = F.lit("2024-01-03 00:00:00").cast("timestamp")
    cheaper = rows.withColumn("raw_price", F.col("raw_price") - 1)
    second, found = nightly.resolve(cheaper, nightly.Catalogue(**store), later)
    assert second.offers.count() == 3
    assert {r.current_price for r in second.offers.collect()} == {Decimal("9.00"), Decimal("8.00"), None}
    assert second.log.count() == 4


def test_offer_of_a_surer_match_only(spark):
    then = dt.datetime(2024, 1, 1)
    held = offers(spark, ("o", "m", "1", "a.ma", "http://a/1", "", Decimal("5.00"), "MAD", True, 0.9, then))
    rows = spark.createDataFrame([("r", "1", "http://a/2", "a.ma", 4.0, 1.0)], "scraped_url_id string, site_id string, url string, domain string, raw_price double, fetched_at_utc double")
    from tarifa.sources.readers import with_columns_of

    rows = with_columns_of(rows, schemas.LISTING)
    for confidence, price in ((0.8, Decimal("5.00")), (0.95, Decimal("4.00"))):
        found = spark.createDataFrame([("r", "m", 3, confidence, False, False)], "row_id string, master_id string, tier int, confidence double, needs_review boolean, is_new boolean")
        got = gold.offers_after(held, rows, found, now()).collect()
        assert [r.current_price for r in got] == [price]


def test_offers_after_a_run_are_those_of_row_by_row_rules(spark, capsys):
    """Known and unknown URLs, none, sites without an id, offers that share a URL or a (product, site); dealt by row, by URL and by (product, site) once."""
    import random

    rng = random.Random(8)
    then, urls, masters_, sites = dt.datetime(2024, 1, 1), [None, *"abcdefghij"], [None, "m", "n", "o"], [None, "1", "2"]
    held = [(f"o{i}", rng.choice(masters_), rng.choice(sites), "a.ma", rng.choice(urls[:6]), "", rng.choice([None, Decimal("5.00")]), "MAD", True, rng.choice([0.5, 0.9]), then) for i in range(12)]
    rows = [(f"r{i}", rng.choice(sites), rng.choice(urls), "a.ma", rng.choice([None, Decimal(i)]), rng.choice([None, "EUR"]), rng.choice([None, False]), float(rng.randint(1, 3))) for i in range(30)]
    found = [(r[0], rng.choice(masters_), rng.choice([0.4, 0.7, 0.95])) for r in rows]
    product, sure = {f[0]: f[1] for f in found}, {f[0]: f[2] for f in found}
    made, best, want = {}, {}, {o[0]: list(o) for o in held}
    for r in sorted((r for r in rows if product[r[0]]), key=lambda r: (r[7], r[0])):
        made[r[2]] = r
    for o in want.values():
        if (r := made.get(o[4])) and o[4] is not None:
            o[6:11] = [r[4] if r[4] is not None else o[6], r[5] or "MAD", o[8] if r[6] is None else r[6], sure[r[0]], "now"]
    for r in sorted((r for u, r in made.items() if u is None or u not in {o[4] for o in held}), key=lambda r: (sure[r[0]], r[7], r[0])):
        best[product[r[0]], r[1]] = r
    for (m, s), r in best.items():
        same = [o for o in want.values() if o[1] == m and o[2] == s and s is not None]
        for o in same:
            if sure[r[0]] > o[9]:
                o[4], o[6], o[8:11] = r[2] or o[4], r[4] if r[4] is not None else o[6], [o[8] if r[6] is None else r[6], sure[r[0]], "now"]
        if not same:
            want[m, s] = [None, m, s, "a.ma", r[2], "", r[4], r[5] or "MAD", r[6], sure[r[0]], "now"]
    listed = spark.createDataFrame(rows, "scraped_url_id string, site_id string, url string, domain string, raw_price decimal(10,2), raw_currency string, in_stock boolean, fetched_at_utc double").withColumn("raw_sku", F.lit(""))
    matches = spark.createDataFrame(found, "row_id string, master_id string, confidence double")
    known, threshold = offers(spark, *held), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = gold.offers_after(known, listed, matches, now())
        capsys.readouterr()
        out.explain()
        assert 0 < capsys.readouterr().out.count("Exchange hashpartitioning") <= 5
        got = [[None if not r.id.startswith("o") else r.id, *r[1:10], "now" if r.last_scraped_at != then else then] for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(got, key=str) == sorted(want.values(), key=str)
    assert any(isinstance(k, tuple) for k in want) and any(o[10] == "now" for o in want.values() if o[0])


def test_orphans_and_log(spark):
    m = masters(spark, ("1", "a", "", ""), ("2", "b", "", ""))
    o = spark.createDataFrame([("1",)], "master_id string")
    log = spark.createDataFrame([("1", 3), ("2", 4)], "master_id string, price int")
    kept, held = gold.without_orphans(m, o, log)
    assert [r.id for r in kept.collect()] == ["1"] and sorted(map(tuple, held.select("price", "master_id").collect())) == [(3, "1"), (4, None)]


def test_queue(spark):
    queue = spark.createDataFrame([("1", "s", "u1", "product", "done", 1, None, None), ("2", "s", "u2", "product", "done", 1, None, dt.datetime(2030, 1, 1)), ("3", "s", "u3", "product", "pending", 1, None, None)], "id string, site_id string, url string, url_type string, status string, priority int, discovered_at timestamp, next_scrape_after timestamp")
    found = spark.createDataFrame([("s", "u1"), ("s", "u2"), ("s", "u3"), ("s", "u4"), ("s", "u4")], "site_id string, url string")
    got = {r.url: (r.change, r.status) for r in urlqueue.discovered(queue, found, now()).collect()}
    assert got == {"u1": ("reset", "pending"), "u2": ("kept", "done"), "u3": ("kept", "pending"), "u4": ("created", "pending")}
    assert {r.url: r.change for r in urlqueue.discovered(queue, found, now(), rescrape=True).collect()}["u2"] == "reset"
    going = urlqueue.enqueued(queue)
    assert {r.url: r.status for r in going.collect()} == {"u1": "done", "u2": "done", "u3": "in_progress"}
    results = spark.createDataFrame([("3", 503, dt.datetime(2024, 1, 1), None), ("3", 404, dt.datetime(2024, 1, 2), None)], "id string, http_status_code int, fetched_at timestamp, error_message string")
    assert urlqueue.fetched(going, results).where("id = '3'").first().status == "not_found"
    assert urlqueue.unfinished(going) == 1


@pytest.mark.parametrize("code,want", [(200, "success"), (403, "blocked"), (404, "not_found"), (451, "not_found"), (429, "rate_limited"), (503, "http_error"), (418, "http_error"), (None, "timeout")])
def test_outcomes(spark, code, want):
    df = spark.createDataFrame([(code, "read timeout")], "c int, e string")
    assert df.select(urlqueue.outcome(F.col("c"), F.col("e")).alias("x")).first().x == want


def test_orders(spark):
    import json

    request = spark.createDataFrame([("o", "s", "c", 2, None, 7, 9, None, "")], "order_id string, supplier string, code string, quantity int, unit_price double, supplier_id int, product_id int, sale_price double, notes string")
    body = json.loads(request.select(wholesale.order_payload(F.lit("2024-01-01")).alias("x")).first().x)
    assert body["supplier_id"] == "7" and body["comment"] is None and body["products"][0]["unit_price"] == "0.00" and body["products"][0]["tax_id"] == 35
    products = spark.createDataFrame([("s", "c", Decimal("4.500"))], "supplier string, code string, prix_pharmacien decimal(12,3)")
    draft = wholesale.draft_orders(products, request.select("order_id", "supplier", "code", "quantity", "unit_price"))
    assert draft.first().total_price == Decimal("9.000")
    answers = spark.createDataFrame([("o", '{"data": {"ID": 5, "transaction_number": "T1", "status": {"ID": "approved"}}}', None)], "order_id string, body string, error string")
    done = wholesale.submitted(draft, answers).first()
    assert (done.status, done.vendor_order_id, done.transaction_number) == ("submitted", "5", "T1")
    plain = spark.createDataFrame([("{}",)], "b string").select(wholesale.order_response(F.col("b")).alias("r")).first().r
    assert tuple(plain) == ("", "", "")


def test_vendor_ids_and_availability(spark):
    products = spark.createDataFrame([("s", "c1", "n", None, None), ("s", "c2", "n", None, True)], "supplier string, code string, name string, vendor_product_id long, in_stock boolean")
    ids = spark.createDataFrame([("s", "", "c1", 8), ("s", "zz", "", 9)], "supplier string, code string, reference string, vendor_product_id long")
    out, counts = wholesale.with_vendor_ids(products, ids)
    assert {r.code: r.vendor_product_id for r in out.collect()} == {"c1": 8, "c2": None} and tuple(counts.first()) == (1, 1)
    bodies = spark.createDataFrame([("s", "c2", "false"), ("s", "none", "true")], "supplier string, code string, body string")
    assert {r.code: r.in_stock for r in wholesale.with_availability(products, bodies).collect()} == {"c1": None, "c2": False}


def test_cascade_covers_all_rows(spark, sf_dir):
    rows = testkit.listings(spark, sf_dir)
    got = matching.match(rows, testkit.masters(spark, sf_dir))
    assert got.select("row_id").distinct().count() == rows.select("scraped_url_id").distinct().count()
