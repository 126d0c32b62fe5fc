import html
import itertools
import random
import re

from tarifa.llm import html_text
from tarifa.llm.queries import op1_html_text

SCHEMA = "page_id long, url string, html string, key int, host int, shared int, text int, lines int"


def main(page, shared=()):
    return html_text.main_text(html_text.lines_of(page), set(shared))


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(0)
    for _ in range(400):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 20))] for _ in (0, 1))
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in reversed(range(len(a))):
            for j in reversed(range(len(b))):
                d[i][j] = d[i + 1][j + 1] + 1 if a[i] == b[j] else max(d[i + 1][j], d[i][j + 1])
        got = html_text.common_lines(a, b)
        it = iter(b)
        assert got == sorted(set(got)) and len(got) == d[0][0] and all(any(x == y for y in it) for x in (a[i] for i in got))


def test_articles_of_the_tables(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in op1_html_text(spark, sf_dir).collect():
        inside = re.search("<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>|<br>", " " if "<br>" in z else "", z)).split()) for z in re.split("</?(?:p|h1)>", inside)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_markup():
    cases = {
        "<body><div class='ad'>buy<p>x<nav>menu</nav></div><article><h1>T&amp;t</h1><p>a <b>b</b><br>c<section class='comments'><p>me too</section></article>": "T&t\n\na b c",
        "<nav><ul><li>menu</li></ul></nav><main><p>x&nbsp; y</p><form>send</form><aside>see</aside></main><footer>f</footer>": "x y",
        "<article><header><h1>H</h1></header><p>x</p><footer>by</footer></article>": "H\n\nx",
        "<div id=content><div class='cookie-notice'>We use</div><p>Body</p></div><p>off</p>": "Body",
        "<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>": "yes",
        "<article><p>one<p>two<ul><li>three<li>four</ul></article>": "one\n\ntwo\n\nthree\n\nfour",
        "<article>a<div hidden>no</div><div style='display: none'>no</div>b</article>": "a\n\nb",
        "<article><p>1 &lt; 2 &#233; &unknown; &copy</p></article>": "1 < 2 é &unknown; ©",
        "<article><p>x</p><div class='comment-list'><article><p>reader</p></article></div></article>": "x",
        "": "", "<!-- never closed": "", "<p>plain": "plain", "<ul><li><a href=x>only a link</a></ul>": "",
    }
    for page, text in cases.items():
        assert main(page) == text, page


def test_an_element_that_nothing_closes():
    assert main("<div class='ad'>buy<article><p>text</p></article>") == "text"


def test_shared_lines_go_where_no_article_is_declared(spark):
    menu, foot = "<p>Our shop</p><p>Call us now</p>", "<p>All rights reserved</p>"
    pages = [(i, f"http://h.com/a/{i}", f"<body>{menu}<p>Story {i} is told here.</p>{foot}</body>", *[1] * 5) for i in range(6)]
    pages += [(10, "http://alone.com/x", f"<body>{menu}<p>Alone.</p></body>", *[1] * 5)]
    for crowd in (256, 2):
        got = {r.page_id: r.text for r in html_text.extracted(spark.createDataFrame(pages, SCHEMA), crowd=crowd).collect()}
        assert sum(got[i] == f"Story {i} is told here." for i in range(6)) >= (6 if crowd > 2 else 0)
        assert all(f"Story {i} is told here." in got[i] for i in range(6))
        assert got[10] == "Our shop\n\nCall us now\n\nAlone."


def test_each_page_meets_its_nearest_url_at_any_number_of_ranges(spark):
    """A hot host: lines of a section are shared within it only, and many pages have one path."""
    page = lambda section, i: f"<body><p>Shop</p><p>Menu of section {section}</p><p>Own story {i} of {section}, told here at some length.</p></body>"
    rows = [(1000 * s + i, f"http://hot.com/{s:02}/{i}", page(s, i), *[1] * 5) for s in range(12) for i in range(4)]
    rows += [(50_000 + i, f"http://hot.com/index.php?id={i}", page("index", i), *[1] * 5) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    results = [{r.page_id: r.text for r in html_text.extracted(df, crowd=crowd).collect()} for crowd in (10_000, 20, 5, 1)]
    assert all(r == results[0] for r in results)
    assert len(results[0]) == len(rows) and all(re.fullmatch(r"Own story .* length\.", text) for text in results[0].values())


def nearest_by_hand(rows):
    """All pages of a host in order of URL; a run of copies meets the page before or after it; plain dynamic programming aligns them."""
    read = {i: [line.text for line in html_text.lines_of(h)] for i, _, h in rows}
    out = {}
    order = sorted(rows, key=lambda r: (r[1].split("?")[0].split("://")[1].split("/")[0], r[1].split("?")[0].split("://")[1].partition("/")[2]))
    host = lambda r: r[1].split("://")[1].split("/")[0]
    for at, row in enumerate(order):
        beside = []
        for step in (-1, 1):
            if 0 <= at + step < len(order) and host(order[at + step]) == host(row):
                beside.append(order[at + step])
        same = [sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(row[1], b[1], strict=False))) for b in beside]
        if not beside:
            out[row[0]] = "\n\n".join(read[row[0]])
            continue
        a, b = read[row[0]], read[beside[same.index(max(same))][0]]
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in reversed(range(len(a))):
            for j in reversed(range(len(b))):
                d[i][j] = d[i + 1][j + 1] + 1 if a[i] == b[j] else max(d[i + 1][j], d[i][j + 1])
        kept, j = [], 0
        for i, line in enumerate(a):
            while j < len(b) and line != b[j] and d[i][j] == d[i][j + 1]:
                j += 1
            if j < len(b) and line == b[j]:
                j += 1
            else:
                kept.append(line)
        out[row[0]] = "\n\n".join(kept)
    return out


def test_a_host_of_2000_pages_against_pairing_by_hand(spark):
    """No markup helps: what the nearest URL has too goes, at any number of ranges."""
    rng = random.Random(3)
    rows = []
    for i in range(2000):
        section = i // 40
        lines = ["Shop", f"Menu of {section}", *[f"Own {i} line {k} {rng.random()} with some more text to read." for k in range(rng.randint(2, 5))], f"Foot of {section % 7}", "Rights"]
        rows.append((i, f"http://hot.com/s{section:03}/{i:05}", "".join(f"<p>{x}</p>" for x in lines)))
    want = nearest_by_hand(rows)
    df = spark.createDataFrame([(*r, *[1] * 5) for r in rows], SCHEMA).repartition(5)
    for crowd in (10_000, 300, 37):
        assert {r.page_id: r.text for r in html_text.extracted(df, crowd=crowd).collect()} == want
    assert all("Shop" not in t and "Menu" not in t and "Rights" not in t for t in want.values())


def test_copies_and_near_copies_meet_the_next_other_page(spark, monkeypatch):
    """Also where the run of copies fills many ranges, and groups of ranges."""
    monkeypatch.setattr(html_text, "GROUP", 2)
    menu, foot = "<p>Our shop</p>", "<p>All rights reserved</p>"
    story = lambda what: f"<p>A long story of {what}, told here from its start.</p><p>And how {what} went on until it ended well.</p>"
    text = lambda what: f"A long story of {what}, told here from its start.\n\nAnd how {what} went on until it ended well."
    rows = [(i, f"http://h.com/a?{i}", menu + story("copies") + foot) for i in range(9)]
    rows += [(100 + i, f"http://h.com/b/{i}", menu + f"<p>Day {i}</p>" + story("days") + foot) for i in range(9)]
    rows += [(200 + i, f"http://h.com/c/{i}", menu + story(f"page {i} {'xyz'[i] * 40}") + foot) for i in range(3)]
    df = spark.createDataFrame([(*r, *[1] * 5) for r in rows], SCHEMA)
    for crowd in (1000, 4, 1):
        got = {r.page_id: r.text for r in html_text.extracted(df, crowd=crowd).collect()}
        assert {got[i] for i in range(9)} == {text("copies")}
        assert all(got[100 + i] == f"Day {i}\n\n" + text("days") for i in range(9))
        assert all(got[200 + i].startswith("A long story of page") and got[200 + i].endswith("well.") for i in range(3))


def test_copies_of_an_article_stay(spark):
    page = "<nav>m</nav><article><h1>T</h1><p>Same text.</p></article>"
    rows = [(i, f"http://h.com/{i}", page.replace(">m<", f">m{i}<"), *[1] * 5) for i in range(5)]
    assert {r.text for r in html_text.extracted(spark.createDataFrame(rows, SCHEMA)).collect()} == {"T\n\nSame text."}


def test_odd_rows(spark):
    page = "<article><p>x</p></article>"
    rows = [(1, None, page), (1, None, page), (None, "http://a.com", page), (2, "no scheme", None), (3, "http://a.com/" + "p" * 5000, "<p>" + "word " * 100_000), (4, "", "")]
    got = sorted((str(r.page_id), r.n_chars) for r in html_text.extracted(spark.createDataFrame([(*r, *[1] * 5) for r in rows], SCHEMA)).collect())
    assert got == sorted([("1", 1), ("1", 1), ("None", 1), ("2", 0), ("3", 499_999), ("4", 0)])
    assert html_text.extracted(spark.createDataFrame([], SCHEMA)).collect() == []


def test_broken_tags_take_linear_time():
    import time

    k = 20_000
    odd = ["<b>" * k + "</q>" * k, "<section><article>" + "<b>" * k + "</section>" * k, "<article>" * k + "</article>" * k, "<div>" * k + "</p><p>" * k, "<p><b>" * k + "</p>" * k, "<a><div>" * k + "<a>" * k, "<li><i>" * k + "<li>" * k]
    for page in odd:
        began = time.time()
        html_text.lines_of(page)
        assert time.time() - began < 5, page[:30]  # minutes, if each end walked through the open elements


def test_many_broken_tags_take_linear_time():
    assert main("<p>" + "<div class=\"x" * 3000 + "end") is not None
    assert len(main("<div>" * 5000 + "deep")) == 4
