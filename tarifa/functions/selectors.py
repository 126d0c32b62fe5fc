"""CSS selectors over stored pages, where containers matter and a pattern can't count nesting.

A selector is a group of alternatives with commas; each is a line of descendants,
each of these a tag, ``.class``, ``#id``, ``[attr]`` or ``[attr='value']`` or several of them.
``selector@attr`` asks for an attribute in place of the text. The first match in
document order counts. A page is read once for all its selectors, in linear time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PART = re.compile(r"""([\w-]+|\*)|\.([\w-]+)|\#([\w-]+)|\[([\w:-]+)(?:=(?:"([^"]*)"|'([^']*)'|([^\]"']*)))?\]""")


@lru_cache(maxsize=4096)
def parsed(selector: str) -> tuple[tuple[tuple, ...], str | None]:
    """Alternatives of the selector, and the attribute that it asks for; what isn't understood is an error."""
    selector, _, attribute = selector.partition("@")
    return tuple(tuple(_compound(p) for p in one.split()) for one in selector.split(",") if one.strip()), attribute or None


def _compound(part: str) -> tuple:
    tag, wanted, at = None, [], 0
    while at < len(part):
        m = PART.match(part, at)
        if not m or (m[1] and at):
            raise ValueError(f"not a selector: {part!r}")
        if m[1]:
            tag = None if m[1] == "*" else m[1].lower()
        elif m[2]:
            wanted.append(("class", m[2]))
        elif m[3]:
            wanted.append(("id", m[3]))
        else:
            wanted.append((m[4].lower(), next((v for v in m.groups()[4:] if v is not None), None)))
        at = m.end()
    return tag, tuple(wanted)


def _fits(compound: tuple, tag: str, attributes: dict[str, str]) -> bool:
    if compound[0] not in (None, tag):
        return False
    for name, value in compound[1]:
        own = attributes.get(name)
        if own is None or (value is not None and (value not in own.split() if name == "class" else own != value)):
            return False
    return True


class _Page(HTMLParser):
    """Finds values of selectors. For each open element it keeps how many leading parts of each alternative its line has met."""

    def __init__(self, selectors: list[str], every: bool):
        super().__init__(convert_charrefs=True)
        self.every = every
        self.lines = [(i, line, attribute) for i, s in enumerate(selectors) for lines, attribute in [parsed(s)] for line in lines]
        self.found: list[list[str]] = [[] for _ in selectors]
        self.open: list[tuple[str, tuple[int, ...]]] = []
        self.names: Counter[str] = Counter()
        self.reading: dict[int, tuple[int, list[str]]] = {}  # selector: depth of its element, pieces of text

    def handle_starttag(self, tag: str, attrs: list) -> None:
        attributes = {k: v or "" for k, v in reversed(attrs)}
        before = self.open[-1][1] if self.open else (0,) * len(self.lines)
        met = list(before)
        for n, (i, line, attribute) in enumerate(self.lines):
            done = before[n]
            if done < len(line) - 1:
                met[n] += _fits(line[done], tag, attributes)
            elif (self.every or not self.found[i]) and i not in self.reading and _fits(line[-1], tag, attributes):
                if attribute:
                    if attributes.get(attribute):
                        self.found[i].append(attributes[attribute])
                elif tag not in VOID:
                    self.reading[i] = (len(self.open), [])
        if tag not in VOID:
            self.open.append((tag, tuple(met)))
            self.names[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        for _, pieces in self.reading.values():
            pieces.append(data)

    def handle_endtag(self, tag: str) -> None:
        while self.names[tag]:
            name, _ = self.open.pop()
            self.names[name] -= 1
            self._closed()
            if name == tag:
                break

    def _closed(self) -> None:
        for i in [i for i, (depth, _) in self.reading.items() if depth == len(self.open)]:
            text = " ".join("".join(self.reading.pop(i)[1]).split())
            if text:
                self.found[i].append(text)

    def finish(self) -> list[list[str]]:
        self.close()
        while self.open:
            self.open.pop()
            self._closed()
        return self.found


def values(html: str | None, selectors: list[str], every: bool = False) -> list[list[str]]:
    """For each selector the first value that isn't empty, or all, in document order."""
    if not html:
        return [[] for _ in selectors]
    page = _Page(selectors, every)
    page.feed(html)
    return page.finish()


def first(html: Column, site: Column, defaults: dict[str, str], sites: dict[str, dict[str, str]] | None = None) -> Column:
    """Struct of the first value of each field's selector; ``sites`` has selectors of its own for some sites (configuration)."""
    names = [*dict.fromkeys([*defaults, *(n for own in (sites or {}).values() for n in own)])]

    @F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    def found(pages: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for htmls, of in pages:
            rows = []
            for h, s in zip(htmls, of, strict=True):
                asked = defaults | (sites or {}).get(s, {})
                got = dict(zip(asked, values(h, [*asked.values()]), strict=True))
                rows.append([got[n][0] if got.get(n) else None for n in names])
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return found(html, site)


def every(html: Column, selector: str) -> Column:
    """All values of a selector, as an array."""
    parsed(selector)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def found(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: values(h, [selector], every=True)[0])

    return found(html)
