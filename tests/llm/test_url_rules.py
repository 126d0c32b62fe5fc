from tarifa.llm import url_rules
from tarifa.llm.queries import URL_LIST, op4_url_rules

SCHEMA = "page_id long, url string, html string, row int, verdict int, tokens int"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "", 1, 1, 1) for i, u in enumerate(urls)], SCHEMA)


def by_hand(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest
        for c in "/?#":
            host = host.split(c)[0]
        path = rest[len(host) :]
        for c in "?#":
            path = path.split(c)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in URL_LIST:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, best


def test_list_and_parts_on_the_tables(spark, sf_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = op4_url_rules(spark, sf_dir).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, best = by_hand(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best and best[0])
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.Net/en/x?y#z", "http://a.net", "http://xnet/", "ftp://Ä.org/fr/1", "http://a.com?x=/y", "http://a.com#b", "http://b.example.com/de/", "//net/"]
    rows = sorted(url_rules.judged(pages(spark, urls), URL_LIST).collect(), key=lambda r: r.page_id)
    for r, u in zip(rows, urls, strict=True):
        host, path, best = by_hand(u)
        assert (r.host, r.path, r.rule) == (host, path, best and best[0]), u
        assert r.verdict == (best[1] if best else "allow"), u


def mined_by_hand(urls, support, confidence, least):
    """Verdict of unlisted URLs from counting all token sets."""
    from collections import Counter
    from itertools import combinations

    def tokens(u):
        import re

        host, path, _ = by_hand(u)
        query = u.split("?", 1)[1].split("#")[0] if "?" in u.split("#")[0] else ""
        found = ["h:" + x for x in host.split(".")] + ["p:" + x for x in re.split("[/._-]", path.lower())] + ["q:" + x.split("=")[0] for x in query.split("&")]
        return tuple(sorted({t for t in found if len(t) > 2 and not t[2:].isdigit()}))

    listed = [(tokens(u), by_hand(u)[2][1]) for u in urls if by_hand(u)[2]]
    n, whole, said = len(listed), Counter(), Counter()
    for t, v in listed:
        for k in range(1, len(t) + 1):
            for c in combinations(t, k):
                whole[c] += 1
                said[c, v] += 1
    floor = max(support * n, least)
    rules = {(c, v): (m / whole[c], m / n) for (c, v), m in said.items() if m >= floor - 1e-9 and m / whole[c] >= confidence}
    pruned = {(c, v): r for (c, v), r in rules.items() if not any((d, v) in rules and rules[d, v][0] >= r[0] for k in range(1, len(c)) for d in combinations(c, k))}
    out = {}
    for i, u in enumerate(urls):
        t = set(tokens(u))
        fit = [(-r[0], -r[1], -len(c), list(c), v) for (c, v), r in pruned.items() if set(c) <= t]
        out[i] = by_hand(u)[2][1] if by_hand(u)[2] else (min(fit)[4] if fit else "allow")
    return out


def test_mined_rules_against_counting(spark, sf_dir):
    urls = [r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").collect()]
    urls = [u for u in urls for _ in (0, 1)][:400]
    want = mined_by_hand(urls, 0.005, 0.8, 5)
    for held in (20_000, 0):  # in memory, and by a join
        rows = url_rules.judged(pages(spark, urls), URL_LIST, held=held).collect()
        assert {r.page_id: r.verdict for r in rows} == want


def test_rules_of_tokens_that_go_together(spark):
    """Words that both labels have and that always occur together: every combination of variants counts as its rule."""
    urls = [f"http://a{i}.net/alpha/beta?x" for i in range(9)] + [f"http://b{i}.org/fr/alpha/beta" for i in range(2)]
    urls += [f"http://c{i}.net/gamma/delta" for i in range(8)] + [f"http://d{i}.org/fr/gamma/delta" for i in range(2)]
    urls += ["http://e.com/beta", "http://e.com/alpha/y", "http://e.com/gamma", "http://e.com/delta", "http://e.com/none"]
    want = mined_by_hand(urls, 0.005, 0.8, 5)
    assert want[21] == want[22] == "block" and want[25] == "allow"
    for held in (20_000, 0):
        rows = url_rules.judged(pages(spark, urls), URL_LIST, held=held).collect()
        assert {r.page_id: r.verdict for r in rows} == want


def test_long_and_repeated_urls_are_no_burden(spark):
    """Copies of URLs of 30 words, with one label and with both: 2^30 subsets would never end."""
    words = "/".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30))
    urls = [f"http://a.net/{words}"] * 20 + [f"http://b.org/fr/{words}"] * 3 + ["http://c.net/q/r"] * 20 + ["http://d.com/" + words.split("/")[4]]
    rows = {r.page_id: r for r in url_rules.judged(pages(spark, urls), URL_LIST).collect()}
    assert rows[43].verdict == "block" and rows[43].why == ["p:" + words.split("/")[4]]  # 20 of 23 with this word
    assert all(r.verdict == ("allow" if ".org" in u else "block") for r, u in ((rows[i], u) for i, u in enumerate(urls)))


def test_nothing_to_learn_from_and_empty(spark):
    rows = url_rules.judged(pages(spark, ["http://a.com/x", "http://b.com/y"]), URL_LIST).collect()
    assert {r.verdict for r in rows} == {"allow"}
    assert url_rules.judged(pages(spark, ["x"]).limit(0), URL_LIST).collect() == []


def test_repeated_pages(spark):
    df = pages(spark, ["http://a.net/x"] * 30)
    assert url_rules.judged(df.unionByName(df), URL_LIST).where("verdict = 'block'").count() == 60
