"""Names, volumes, descriptions, URLs and other texts as Column functions.

Everything here stays in the JVM but ``strip_marks``, which needs Unicode
decomposition; ``fold`` has a table of all letters that are one letter and marks, of any script, and is used where
plans must stay native.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words without weight in a product name, units of volume and dose, forms of a wholesale product.
STOP_WORDS = (
    "le la les de du des un une pour avec sans et en au aux "
    "the for with without and to of "
    "ml mg g kg l cl "
    "x"
).split()
JOINED_UNITS = "ml|cl|l|mg|g|kg|ui|iu|mcg"
VOLUME_UNITS = "ml|cl|l|mg|g|kg|ui|iu|mcg|µg"
FORMS = {
    "CO": "Comprimé", "CP": "Comprimé", "GE": "Gélule", "GO": "Gouttes", "SI": "Sirop", "SP": "Spray", "PO": "Poudre",
    "CR": "Crème", "TU": "Tube", "AM": "Ampoule", "LI": "Liquide", "SO": "Solution", "EM": "Émulsion", "SU": "Suppositoire",
}


def _marked() -> tuple[str, str]:
    """Letters that are one letter and marks, and that letter."""
    pairs = []
    for c in (x for x in range(0xC0, 0x2FA20) if not (0xAC00 <= x < 0xD7A4 or 0xD800 <= x < 0xF900)):
        bare = "".join(x for x in unicodedata.normalize("NFD", chr(c)) if unicodedata.category(x) != "Mn")
        if len(bare) == 1 and bare != chr(c):
            pairs.append((chr(c), bare))
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


_FROM, _TO = _marked()


def fold(c: Column) -> Column:
    """Letters without their marks, and without combining marks; native."""
    return F.regexp_replace(F.translate(c, _FROM, _TO), r"\p{Mn}", "")


@F.pandas_udf(T.StringType())
def strip_marks(s: pd.Series) -> pd.Series:
    """Any text without its combining marks (NFD, category Mn)."""
    bare = lambda x: x if x is None or x.isascii() else "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn")
    return s.map(bare)


def text_or_null(c: Column) -> Column:
    return F.when(c != "", c)


def present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def normalised_tokens(name: Column, native: bool = True) -> Column:
    bare = (fold if native else strip_marks)(F.lower(name))
    joined = F.regexp_replace(bare, rf"(\d+)\s+({JOINED_UNITS})", "$1$2")
    words = F.split(F.trim(F.regexp_replace(joined, r"(?U)[^\w]+", " ")), " ")
    return F.array_sort(F.filter(words, lambda w: ~w.isin(STOP_WORDS) & (F.length(w) > 1)))


def normalise_name(name: Column, native: bool = True) -> Column:
    """Sorted words without marks, punctuation, stop words and single letters; an empty or null name is ''."""
    return F.coalesce(F.array_join(normalised_tokens(name, native), " "), F.lit(""))


def extract_volume(name: Column) -> Column:
    """The first amount with a unit, like 200ml or 1.5l, else null."""
    pattern = rf"(?iu)(\d+(?:[.,]\d+)?)\s*({VOLUME_UNITS})"
    amount, unit = F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)
    return text_or_null(F.concat(F.replace(amount, F.lit(","), F.lit(".")), F.lower(unit)))


def fingerprint(brand: Column, name: Column, native: bool = True) -> Column:
    """brand_volume_word: the word is the first of the sorted name that is neither the brand nor an amount."""
    return fingerprint_of(normalise_name(brand, native), normalised_tokens(name, native), extract_volume(name))


def fingerprint_of(brand_norm: Column, tokens: Column, volume: Column) -> Column:
    """The same from columns that are there already."""
    own = F.replace(brand_norm, F.lit(" "), F.lit(""))
    words = F.filter(tokens, lambda w: (w != own) & ~w.rlike("^[0-9]+[a-z]+$"))
    whole = F.concat(own, F.lit("_"), volume, F.lit("_"), F.try_element_at(words, F.lit(1)))
    return F.when((own != "") & (F.size(words) > 0), whole)


def normalise_wholesale(name: Column, native: bool = True) -> Column:
    """Upper case without marks and punctuation; order is kept."""
    bare = (fold if native else strip_marks)(F.trim(F.upper(name)))
    return F.coalesce(F.trim(F.regexp_replace(bare, r"(?U)[^\w]+", " ")), F.lit(""))


def clean_description(text: Column) -> Column:
    """Without sentences about orders at a price, delivery and originality; 2000 characters at most."""
    out = F.regexp_replace(text, r"(?isu)Commandez\b.*?à seulement.*?(?:د\.م\.|MAD|DH)\s*chez\s+[^\s.]+(?:\.[a-z]{2,3})?\.?", "")
    out = F.regexp_replace(out, r"(?iu)Livraison\b[^.]*\.?", "")
    out = F.regexp_replace(out, r"(?iu)Produits?\s+100\s*%\s*origina(?:ux|l)\.?", "")
    return F.substring(F.trim(out), 1, 2000)


def title_without_site(title: Column) -> Column:
    return F.regexp_replace(title, r"\s+-\s+.*$", "")


def valid_ean(c: Column) -> Column:
    """The value if it has 8 to 14 digits and nothing else, else null."""
    return F.when(c.rlike("^[0-9]{8,14}$"), c)


def ean_in_text(c: Column) -> Column:
    return text_or_null(F.regexp_extract(c, r"\b(\d{8,14})\b", 1))


def first_number(c: Column) -> Column:
    return F.try_to_number(text_or_null(F.regexp_extract(c, r"(\d+)", 1)), F.lit("999999999")).cast("int")


def form_display(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in FORMS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code), code)


def url_host(url: Column) -> Column:
    """Host without user and port, lower case; null if there is none."""
    return text_or_null(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)))


def absolute_url(href: Column, base: Column) -> Column:
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    return F.when(href.startswith("http"), href).otherwise(F.concat(origin, F.when(href.startswith("/"), href).otherwise(F.concat(F.lit("/"), href))))


def matches_any(url: Column, patterns: Column) -> Column:
    """True where one of the patterns is found, or where there is none."""
    return (F.size(patterns) == 0) | F.exists(patterns, lambda p: F.regexp_like(url, p))


def without_controls(xml: Column) -> Column:
    return F.regexp_replace(xml, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def without_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\x00"), F.lit(""))


def hide_password(dsn: Column) -> Column:
    return F.regexp_replace(dsn, r"(://[^:/@]*:)[^@]*@", "$1***@")


def clipped(c: Column, n: int, mark: str = "") -> Column:
    """The first ``n`` characters; ``mark`` shows that there were more."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(mark))).otherwise(c) if mark else F.substring(c, 1, n)


def json_list(c: Column, scalar: bool = False) -> Column:
    """A JSON list of strings; anything else is an empty list, or a list of it with ``scalar``."""
    listed = F.from_json(c, "array<string>")
    one = F.when(F.trim(c).startswith('"'), F.array(F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>")[0])).when(present(F.trim(c)) & ~F.trim(c).rlike(r"^[\[{]"), F.array(c))
    return F.coalesce(F.when(F.trim(c).startswith("["), listed), one if scalar else F.lit(None), F.array().cast("array<string>"))


def vector(c: Column) -> Column:
    """A vector written as '[a,b,...]'."""
    return F.from_json(c, "array<float>")


def backoff(attempt: Column, base: float = 2.0, seed: int = 0) -> Column:
    """Full jitter: uniform between 0 and base * 2^(attempt - 1) seconds."""
    return F.rand(seed) * base * F.pow(F.lit(2.0), attempt - 1)
