"""Main text of web pages by nearest-URL page differencing.

Each page is read into text lines, one a block. Pages of a host are ordered by
URL path, and each is paired with the neighbour with which its path has the
longer common prefix (the one before, if equal). Pages of a host with equal lines
are one page here, and all get its result. Consecutive pages that have ``COPY`` of each other's
letters in common are copies of each other: they are paired with the page before or after
all of them, as an alignment of two copies would delete the article. A page without a
neighbour that is no copy loses no line. The lines of both are aligned by their longest common
subsequence; lines in it are shared and deleted. Two kinds of evidence from the
markup go along: lines of a declared article (``article``, ``main``, the usual
roles and names) are not deleted for being shared, as copies of an article would
vanish; and what is marked as menu, header, footer, sidebar, notice, advert,
form, comment and so on goes even if its text is the page's own. Where a page
declares an article, only that is left; where not, what differencing left, without
blocks that consist of links.

Alignment moves hashes of lines only. Pages are dealt into ranges of (host, path, key)
of about ``crowd`` pages, so that a host (or a path) that holds a third of all pages is
many tasks' work. A range gets the page that comes before it and the one after it (beyond copies), so
every page meets its nearest URL, whatever the number of ranges.
The alignment works on the lines that both pages have and is bit-parallel.

Defined cases: a null html is empty, and has no text; a null URL has an empty
host and path; rows alike in page, URL and html are aligned once and all get the
result; markup that is not closed, or closed wrongly, ends with the element
around it (an unwanted element that nothing closes ends at its first block); an empty table gives an empty
table; further columns never matter.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarifa.llm.common import by_bytes, running, type_of
from tarifa.session import written

CROWD = 2048
COPY = 0.8
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# Fixed values of HTML: elements without an end, with raw text, and block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul caption".split())
SILENT = frozenset("head script style title textarea iframe noembed noframes xmp template noscript svg math object canvas audio video select datalist".split())
# Elements, roles and names that are not the article.
UNWANTED = frozenset("nav footer aside form menu dialog button search".split()) | SILENT
UNWANTED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
UNWANTED_NAMES = frozenset("ad ads nav navbar menu menubar footer aside banner notice alert modal consent gdpr overlay widget toolbar pager masthead login signin signup search tags copyright legal skip hidden reply replies respond outbrain taboola".split())
UNWANTED_STARTS = ("comment", "advert", "sponsor", "cookie", "newsletter", "subscri", "sidebar", "breadcrumb", "promo", "navig", "popup", "share", "sharing", "social", "related", "recommend", "disqus", "paginat")
ARTICLE_NAMES = frozenset("article post entry story content articlebody main".split())

ROOTS = frozenset("article main body html".split())

TOKEN = re.compile(r"<!--(?:.*?-->|.*)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass(slots=True)
class Line:
    text: str
    wanted: bool  # not marked as anything but article
    inside: int  # 2 in an article element, 1 in what is named as one, 0 elsewhere
    linked: int  # characters in links


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _kind(tag: str, rest: str, inside: int) -> tuple[bool, int]:
    """(unwanted, declares an article)."""
    declares = 2 if tag in ("article", "main") else 0
    if tag in UNWANTED or (tag == "header" and inside < 2):
        return True, 0
    if "=" not in rest and "hidden" not in rest:
        return False, declares
    if tag in ("html", "body"):
        return False, 0
    a = _attributes(rest)
    role = a.get("role", "").lower()
    if role in UNWANTED_ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style", ""), re.I):
        return True, 0
    names = {n.lower() for n in NAME.findall(f"{a.get('class', '')} {a.get('id', '')}")}
    if any(n in UNWANTED_NAMES or n.startswith(UNWANTED_STARTS) for n in names) or (inside < 2 and not declares and "header" in names):
        return True, 0
    if not declares and (role in ("main", "article") or "articlebody" in a.get("itemprop", "").lower()):
        declares = 2
    if not declares and tag in ("div", "section", "td") and names & ARTICLE_NAMES:
        declares = 1
    return False, declares


@cache
def _kinds(tag: str) -> tuple[str, ...]:
    """A tag, and what else it counts as where an end or a start looks for an open element."""
    kinds = [tag]
    if tag in BLOCKS:
        kinds += ["block"] if tag == "p" else ["block", "other block"]
    if tag in ROOTS and tag != "html":
        kinds.append("root")
    return tuple(kinds)


def lines_of(page: str) -> list[Line]:
    """The page's blocks of text, marked by what the markup says of them."""
    open_ended: set[int] = set()
    while True:
        lines, unclosed = _read(page, open_ended)
        if unclosed <= open_ended:
            return lines
        open_ended |= unclosed


def _read(page: str, open_ended: set[int]) -> tuple[list[Line], set[int]]:
    lines: list[Line] = []
    stack: list[tuple[str, bool, int, int]] = []  # tag, unwanted, inside before it, place of its start
    opened: defaultdict[str, list[int]] = defaultdict(list)  # where in the stack: by tag, and by kind
    parts: list[str] = []
    unwanted = inside = silent = links = linked = brief = 0
    unclosed: set[int] = set()

    def last(kind: str) -> int:
        return opened[kind][-1] if opened[kind] else -1

    def block():
        nonlocal parts, linked, brief
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                lines.append(Line(text, not unwanted and not brief, inside, linked))
                brief = 0
            parts, linked = [], 0

    def say(raw: str):
        nonlocal linked
        if raw and not silent:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked += len(text.strip())

    def leave(n: int, by_name: bool):
        nonlocal unwanted, inside, silent, links
        while len(stack) > n:
            tag, bad, inside, place = stack.pop()
            for kind in _kinds(tag):
                opened[kind].pop()
            if bad:
                unwanted -= 1
                if not (by_name and len(stack) == n):
                    unclosed.add(place)
            silent -= tag in SILENT
            links -= tag == "a"

    at, find = 0, TOKEN.search
    while m := find(page, at):
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            block()
        elif tag == "br":
            parts.append(" ")
        if m[1]:
            if opened[tag] and (tag in ROOTS or opened[tag][-1] > last("root")):  # else an end without a start inside the article
                leave(opened[tag][-1], True)
            continue
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or tag == "a":  # these end the one before
            if opened[tag] and opened[tag][-1] >= last("other block" if tag == "a" else "block"):
                leave(opened[tag][-1], True)
        elif tag in BLOCKS and stack and stack[-1][0] == "p":
            leave(len(stack) - 1, True)
        bad, declares = _kind(tag, m[3], inside)
        if bad and m.start() in open_ended:
            bad, brief = False, int(tag not in ("head", "noscript"))
        if bad or declares or tag in BLOCKS or tag in SILENT or tag in ("a", "span", "b", "i", "em", "strong"):
            if bad and tag not in BLOCKS:
                block()
            for kind in _kinds(tag):
                opened[kind].append(len(stack))
            stack.append((tag, bad, inside, m.start()))
            unwanted += bad
            silent += tag in SILENT
            links += tag == "a"
            inside = max(inside, declares)
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = stop.start() if stop else len(page)
    say(page[at:])
    block()
    leave(0, False)
    return lines, {p for p in unclosed if p not in open_ended}


# alignment


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of one longest common subsequence with ``b``."""
    both = set(a) & set(b)
    x = [i for i, v in enumerate(a) if v in both]
    y = [v for v in b if v in both]
    found, head = [], 0
    while head < min(len(x), len(y)) and a[x[head]] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and a[x[-1 - tail]] == y[-1 - tail]:
        tail += 1
    found += x[:head]
    middle, other = x[head : len(x) - tail], y[head : len(y) - tail]
    if middle and other:
        found += [middle[i] for i in _subsequence([a[i] for i in middle], other)]
    return found + x[len(x) - tail :] if tail else found


def _row(a: list[int], b: list[int]) -> int:
    """Bit-parallel row of the length table of a whole against b: bit j is 0 where the length grows at b[j]."""
    of: dict[int, int] = {}
    for j, v in enumerate(b):
        of[v] = of.get(v, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & of.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return v


def _subsequence(a: list[int], b: list[int]) -> list[int]:
    """Hirschberg's halving on bit-parallel rows: memory grows with the lines, not with their product."""
    if not a or not b:
        return []
    if len(a) == 1:
        return [0] if a[0] in b else []
    half = len(a) // 2
    front, back = _row(a[:half], b), _row(a[half:][::-1], b[::-1])
    n = len(b)
    f = np.concatenate([[0], np.cumsum(~np.unpackbits(np.frombuffer(front.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n] & 1)])
    g = np.concatenate([[0], np.cumsum(~np.unpackbits(np.frombuffer(back.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n] & 1)])
    k = int(np.argmax(f.astype(int) + g[::-1].astype(int)))
    return _subsequence(a[:half], b[:k]) + [half + i for i in _subsequence(a[half:], b[k:])]


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def main_text(lines: list[Line], shared: set[int]) -> str:
    """The article's blocks, joined by blank lines."""
    kept = [line for i, line in enumerate(lines) if line.wanted and (line.inside or i not in shared)]
    level = max((line.inside for line in kept), default=0)
    if level:
        kept = [line for line in kept if line.inside == level]
    else:
        kept = [line for line in kept if line.linked * 2 < len(line.text)]
    return "\n\n".join(line.text for line in kept)


# on Spark


def _pages(batch: pa.RecordBatch) -> list[list[Line]]:
    return [lines_of(page) for page in pc.fill_null(batch.column("html"), "").to_pylist()]


PAGE = "host string, path string, lines array<bigint>, sizes array<int>"


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the lines, their letters (none in what the markup rules out) and a mark of both."""
    for batch in by_bytes(batches, "html", 4 << 20):
        pages = _pages(batch)
        lines = [[xxhash.xxh3_64_intdigest(line.text) - (1 << 63) for line in page] for page in pages]
        sizes = [[len(line.text) if line.wanted else 0 for line in page] for page in pages]
        marks = [xxhash.xxh3_128_hexdigest(repr((x, y))) for x, y in zip(lines, sizes, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("host"), batch.column("path"), pa.array(marks, pa.string()), pa.array(lines, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))], names=["key", "host", "path", "mark", "lines", "sizes"])


def _repeats(a: dict, b: dict) -> bool:
    """Whether ``COPY`` of a's letters are in lines that b has too."""
    left, same = Counter(b["lines"]), 0
    for line, n in zip(a["lines"], a["sizes"], strict=True):
        if left[line] > 0:
            left[line] -= 1
            same += n
    return same >= COPY * sum(a["sizes"])


def _copies(a: dict, b: dict) -> bool:
    return a["host"] == b["host"] and _repeats(a, b) and _repeats(b, a)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each part; they are in order of part."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, group in groupby(rows, key=lambda r: r["part"]):
        yield list(group)


def _page(row: dict | None) -> dict | None:
    return row and {c: row[c] for c in ("host", "path", "lines", "sizes")}


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: its ends, and the first and last page inside that is no copy of the page before it."""
    for rows in _ranges(batches):
        starts = [i for i in range(1, len(rows)) if not _copies(rows[i - 1], rows[i])]
        ends = {"first": rows[0], "last": rows[-1], "start": rows[starts[0]] if starts else None, "before": rows[starts[-1] - 1] if starts else None}
        out = {"part": [rows[0]["part"]]} | {k: pa.array([_page(v)], EDGE) for k, v in ends.items()}
        yield pa.RecordBatch.from_pydict(out | {"part": pa.array(out["part"], pa.int32())})


EDGE = pa.struct([("host", pa.string()), ("path", pa.string()), ("lines", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))])


def _same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, same): whether a range's first page is a copy of the last one before it."""
    for batch in batches:
        rows = batch.to_pylist()
        yield pa.RecordBatch.from_pydict({"i": pa.array([r["i"] for r in rows], pa.int64()), "same": pa.array([_copies(r["previous"], r["first"]) for r in rows], pa.bool_())})


GROUP = 1024


def _beside(edges: DataFrame) -> DataFrame:
    """(part, at, page): the page before each range (0) and after it (2), beyond copies of its first and last page.

    Ranges are numbered, and pages are named by numbers that grow with their place: that of the last page that is no copy of its
    successor is the largest before a range. So a running maximum finds it, and one from behind the page after it: over groups
    of ranges, then over the groups. Only numbers, never pages, meet in one task.
    """
    i = F.col("i")
    ranges = written(edges.join(running(edges.select("part"), [F.col("part")], {"i": F.lit(1).cast("long")}), "part"), "html-numbered")
    pairs = ranges.select("i", "first").join(ranges.select((i + 1).alias("i"), F.col("last").alias("previous")), "i").mapInArrow(_same, "i bigint, same boolean")
    flags = ranges.select("i", "part", F.col("before").isNotNull().alias("inner"), F.col("start").isNotNull().alias("opens")).join(pairs, "i", "left")
    own = flags.withColumn("apart", F.coalesce(~F.col("same"), F.lit(False))).withColumn("group", F.floor(i / GROUP))
    own = written(own.select("i", "part", "group", F.when(F.col("apart"), 2 * i - 1).alias("low"), F.greatest(F.when(F.col("inner"), 2 * i), F.when(F.col("apart"), 2 * i - 1)).alias("v"), F.least(F.when(F.col("apart"), 2 * i), F.when(F.col("opens"), 2 * i + 1)).alias("u")), "html-places")
    groups = own.groupBy("group").agg(F.max("v").alias("v"), F.min("u").alias("u"))
    before, after = (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)
    far = groups.select("group", F.max("v").over(Window.orderBy("group").rowsBetween(*before)).alias("far_v"), F.min("u").over(Window.orderBy("group").rowsBetween(*after)).alias("far_u"))
    inside = Window.partitionBy("group").orderBy("i")
    found = own.join(far, "group").select("part", F.greatest("low", F.max("v").over(inside.rowsBetween(*before)), "far_v").alias("low"), F.least(F.min("u").over(inside.rowsBetween(*after)), "far_u").alias("high"))
    asked = found.select("part", F.explode(F.array(F.struct(F.lit(0).alias("at"), F.col("low").alias("place")), F.struct(F.lit(2).alias("at"), F.col("high").alias("place")))).alias("x")).select("part", "x.*").where("place is not null")
    named = [(0, 2 * i + 1, "last"), (0, 2 * i, "before"), (2, 2 * i, "first"), (2, 2 * i + 1, "start")]
    pages = ranges.select(F.explode(F.array(*[F.struct(F.lit(at).alias("at"), place.alias("place"), F.col(page).alias("page")) for at, place, page in named])).alias("x")).select("x.*").where("page is not null")
    return asked.join(pages, ["at", "place"]).select("part", "at", "page.*")


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _ranges(batches):
        own = [r for r in rows if r["at"] == 1]
        before, after = (next((r for r in rows if r["at"] == at), None) for at in (0, 2))
        starts = [0, *[i for i in range(1, len(own)) if not _copies(own[i - 1], own[i])], len(own)]
        out = []
        for a, b in zip(starts, starts[1:], strict=False):  # a run of copies
            beside = (own[a - 1] if a else before), (own[b] if b < len(own) else after)
            for row in own[a:b]:
                near = [(-_prefix(row["path"], x["path"]), n, x["lines"]) for n, x in enumerate(beside) if x and x["host"] == row["host"] and not _repeats(row, x)]
                out.append(common_lines(row["lines"], min(near)[2]) if near else [])
        yield pa.RecordBatch.from_arrays([pa.array([r["host"] for r in own], pa.string()), pa.array([r["mark"] for r in own], pa.string()), pa.array(out, pa.list_(pa.int32()))], names=["host", "mark", "shared"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, "html", 4 << 20):
        shared = batch.column("shared").to_pylist()
        texts = [main_text(lines, set(s or ())) for lines, s in zip(_pages(batch), shared, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])


def shared_lines(pages: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(key, shared): places of the lines that a page shares with its nearest neighbour; ``pages``: key, host, path, html."""
    read = written(pages.mapInArrow(_hashes, f"key {type_of(pages, 'key')}, host string, path string, mark string, lines array<bigint>, sizes array<int>").dropDuplicates(["key"]), "html-lines")
    place = F.struct("path", "key")
    one = read.groupBy("host", "mark").agg(F.min_by(F.struct("path", "key", "lines", "sizes"), place).alias("p")).select("host", "mark", "p.*")
    parts = max(1, -(-read.count() // crowd))
    dealt = written(one.repartitionByRange(parts, "host", "path", "key").withColumn("part", F.spark_partition_id()), "html-ranges")
    parts = (dealt.agg(F.max("part")).first()[0] or 0) + 1
    ordered = lambda rows: rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", *[c for c in ("at",) if c in rows.columns], "host", "path", "key")
    page = f"struct<{PAGE.replace(' ', ':')}>".replace(",:", ",")
    edges = written(ordered(dealt).mapInArrow(_edges, f"part int, first {page}, last {page}, start {page}, before {page}"), "html-edges")  # one row a range
    rows = dealt.withColumn("at", F.lit(1)).unionByName(_beside(edges), allowMissingColumns=True)
    shared = written(ordered(rows).mapInArrow(_align, "host string, mark string, shared array<int>"), "html-shared")
    return read.select("key", "host", "mark").join(shared, ["host", "mark"]).select("key", "shared")


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", crowd: int = CROWD) -> DataFrame:
    """(id, url, text, n_chars) of each page."""
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), F.col(html_col).alias("html"), F.struct(F.col(id_col).cast("string").alias("id"), F.xxhash64(url, html_col).alias("mark")).alias("key"))
    part = lambda i: F.coalesce(F.regexp_extract("url", PARTS, i), F.lit(""))
    shared = shared_lines(rows.select("key", F.lower(part(1)).alias("host"), part(2).alias("path"), "html"), crowd).withColumnRenamed("key", "k")
    joined = rows.join(shared, F.col("key.id").eqNullSafe(F.col("k.id")) & (F.col("key.mark") == F.col("k.mark")), "left")
    texts = joined.select("id", "url", "html", "shared").mapInArrow(_texts, f"id {type_of(pages, id_col)}, url string, text string")
    return texts.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
