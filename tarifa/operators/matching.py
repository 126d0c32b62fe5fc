"""Entity resolution: a cascade of tiers that links listings to canonical products.

Each tier is a join of the rows that no earlier tier has linked. Products are
keys of joins, never an index in a driver's memory.

tier 1  identifier (8-14 digits), whatever the site
tier 2  (site, sku), off by default
tier 3  equal normalised names, then token-sort similarity of 95 or more
tier 4  brand_volume_word fingerprint (0.92), then cosine of 0.90 or more
tier 5  cosine of 0.65 or more, flagged for review
tier 6  a new product

From tier 3 on, products that the listing's site already carries are left out,
and two known brands must be equal. Ties go to the product that comes first by
(brand, name, id); of products with equal keys the last counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tarifa.functions import similarity, text
from tarifa.operators import name_join, vector_index
from tarifa.session import written


@dataclass(frozen=True)
class Thresholds:
    fuzzy: float = 95.0
    fingerprint: float = 0.92
    vector: float = 0.90
    review: float = 0.65
    sku_tier: bool = False


MATCH = ["row_id", "master_id", "tier", "confidence", "needs_review"]


def _keyed(rows: DataFrame, name: Column, brand: Column, keep: list[Column], norm: str, brand_norm: str, fingerprint: str) -> DataFrame:
    """Name keys in two projections, so that a name's words are made once a row."""
    first = rows.select(*keep, text.normalised_tokens(F.coalesce(name, F.lit(""))).alias("_words"), text.normalise_name(brand).alias(brand_norm), text.extract_volume(name).alias("_volume"))
    keys = [F.array_join("_words", " ").alias(norm), F.col(brand_norm), text.fingerprint_of(F.col(brand_norm), F.col("_words"), F.col("_volume")).alias(fingerprint)]
    return first.select(*[c for c in first.columns if c not in ("_words", "_volume", brand_norm)], *keys)


def prepared(listings: DataFrame, row_id: str = "scraped_url_id") -> DataFrame:
    """The listings' keys of all tiers."""
    vector = [F.col(c) for c in ("name_embedding",) if c in listings.columns]
    keep = [F.col(row_id).cast("string").alias("row_id"), F.col("domain"), F.col("site_id"), text.valid_ean(F.trim("raw_ean")).alias("ean"), F.col("raw_sku").alias("sku"), *vector]
    return _keyed(listings, F.col("raw_name"), F.col("raw_brand"), keep, "norm", "brand_norm", "fingerprint")


def with_own_keys(rows: DataFrame, column: str, what: str) -> DataFrame:
    """The rows, written, each with a key of its own for its id in ``column``, as ids repeat (a page scraped on several days). Keys are in order of id."""
    own = F.concat_ws(".", F.hex(F.xxhash64(*rows.columns)), F.monotonically_increasing_id().cast("string"))
    return written(rows.withColumn(column, F.concat_ws("\x1f", F.col(column).cast("string"), own)), what)


def with_ids(rows: DataFrame, column: str) -> DataFrame:
    """Keys of ``with_own_keys`` back to ids."""
    return rows.withColumn(column, F.when(F.contains(F.col(column), F.lit("\x1f")), F.regexp_replace(column, "\x1f[^\x1f]*$", "")))


def indexed(masters: DataFrame) -> DataFrame:
    """Active products with the same keys and their place in (brand, name, id)."""
    name, brand = F.coalesce("name", F.lit("")), F.coalesce("brand", F.lit(""))
    vector = [F.col(c).alias("m_embedding") for c in ("name_embedding",) if c in masters.columns]
    keep = [F.col("id").alias("master_id"), F.struct(brand.alias("b"), name.alias("n"), "id").alias("place"), text.text_or_null(F.trim("ean")).alias("m_ean"), *vector]
    return _keyed(masters.where(F.col("status").isin("active", "under_review")), name, brand, keep, "m_norm", "m_brand", "m_fingerprint")


def _last(index: DataFrame, key: str) -> DataFrame:
    """The last product of each key."""
    last = index.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.max(F.struct("place", "master_id", "m_brand")).alias("p"))
    return last.select(key, F.col("p.master_id").alias("master_id"), F.col("p.m_brand").alias("m_brand"))


def _same_brand(a: str = "brand_norm", b: str = "m_brand") -> Column:
    return (F.col(a) == "") | (F.col(b) == "") | (F.col(a) == F.col(b))


def _off_site(candidates: DataFrame, links: DataFrame | None) -> DataFrame:
    """Without products that the row's site already carries; links: (domain, master_id)."""
    if links is None:
        return candidates
    return candidates.join(links.select("domain", "master_id").distinct(), ["domain", "master_id"], "left_anti")


def _result(found: DataFrame, tier: int | Column, confidence: Column, review: Column | bool = False) -> DataFrame:
    return found.select("row_id", "master_id", F.lit(tier).alias("tier") if isinstance(tier, int) else tier.alias("tier"), confidence.cast("double").alias("confidence"), (F.lit(review) if isinstance(review, bool) else review).alias("needs_review"))


def by_ean(rows: DataFrame, index: DataFrame) -> DataFrame:
    found = rows.join(_last(index, "m_ean"), F.col("ean") == F.col("m_ean"))
    return _result(found, 1, F.lit(1.0))


def by_sku(rows: DataFrame, skus: DataFrame) -> DataFrame:
    """skus: (site_id, sku, master_id)."""
    last = skus.where("sku != ''").groupBy("site_id", "sku").agg(F.max("master_id").alias("master_id"))
    return _result(rows.join(last, ["site_id", "sku"]), 2, F.lit(1.0))


def by_name(rows: DataFrame, index: DataFrame, links: DataFrame | None) -> DataFrame:
    found = rows.where("norm != ''").join(_last(index, "m_norm"), (F.col("norm") == F.col("m_norm")) & _same_brand())
    return _result(_off_site(found, links), 3, F.lit(1.0))


def by_fingerprint(rows: DataFrame, index: DataFrame, links: DataFrame | None, confidence: float) -> DataFrame:
    found = rows.join(_last(index, "m_fingerprint"), F.col("fingerprint") == F.col("m_fingerprint"))
    return _result(_off_site(found, links), 4, F.lit(confidence))


SEGMENTS = """explode(array_distinct(flatten(transform(sequence(0, d), i -> array(xxhash64(l, i,
    substring(n, cast(floor(i * l / (d + 1)) as int) + 1, cast(floor((i + 1) * l / (d + 1)) - floor(i * l / (d + 1)) as int))))))))"""
SUBSTRINGS = """explode(array_distinct(flatten(transform(sequence(0, d), i -> transform(
    filter(sequence(cast(floor(i * len / (d + 1)) - floor((d - (l - len)) / 2) as int), cast(floor(i * len / (d + 1)) + floor((d + (l - len)) / 2) as int)),
           q -> q >= 0 and q + floor((i + 1) * len / (d + 1)) - floor(i * len / (d + 1)) <= l),
    q -> xxhash64(len, i, substring(n, q + 1, cast(floor((i + 1) * len / (d + 1)) - floor(i * len / (d + 1)) as int))))))))"""
#: A bit for each letter that a name has an odd number of times. An insertion or deletion changes one.
ODD = "aggregate(split(n, ''), 0L, (m, c) -> m ^ shiftleft(1L, pmod(37 * if(ascii(c) < 64, ascii(c) - 48, ascii(c)), 64)))"
#: A frequent segment's keys: of d + 1 parts of ``odd`` one is equal, as d edits change d bits at most; what lies behind 64 bits is always equal.
PARTS = """transform(sequence(0, d), i -> xxhash64(k, i, if(i * ceil(64 / (d + 1)) >= 64, 0L,
    shiftrightunsigned(odd, cast(i * ceil(64 / (d + 1)) as int)) & (shiftleft(1L, cast(ceil(64 / (d + 1)) as int)) - 1))))"""
FREQUENT = 64
DELETIONS = "explode(array_distinct(transform(sequence(1, length(n)), i -> xxhash64(concat(substring(n, 1, i - 1), substring(n, i + 1))))))"


def similar_names(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """Distinct pairs (norm, m_norm) of names that can reach ``least``; below 95 those that do.

    With a + b letters, at most d = (a + b) * (1 - least / 100) of them are inserted or
    deleted. A name cut into d + 1 segments then has one that is found whole in the
    other name, moved by no more than the edits allow: an equi-join on (length, number
    of segment, segment). At a frequent segment names meet by parts of their letters' counts too, and those
    go in the join whose letters occur too differently often. For a low ``least`` segments would be single
    letters; then names meet in cells (``name_join``).
    """
    if least < 95:
        return name_join.scored(left, right, least).select("norm", "m_norm")
    room = 1 - least / 100
    ratio = (1 - room) / (1 + room)  # of the lengths of two names that can reach it
    x = written(left.select(F.col("norm").alias("n")).distinct().withColumns({"l": F.length("n"), "odd": F.expr(ODD)}), "names-left")
    y = written(right.select(F.col("m_norm").alias("n")).distinct().withColumns({"l": F.length("n"), "odd": F.expr(ODD)}), "names-right")
    x = x.withColumn("len", F.explode(F.sequence(F.ceil(F.col("l") * ratio - 1e-9).cast("int"), F.floor(F.col("l") / ratio + 1e-9).cast("int"))))
    edits = lambda l: F.floor((l + F.floor(l / ratio + 1e-9)) * room + 1e-9).cast("int")  # noqa: E731, E741
    x = x.withColumn("d", F.least(edits(F.col("len")), F.col("len") - 1)).where("abs(l - len) <= d or l = len")
    y = y.withColumn("d", F.least(edits(F.col("l")), F.col("l") - 1))
    keys = written(y.select(F.expr(SEGMENTS).alias("k"), "n", "l", "odd", "d"), "names-keys")
    hot = written(keys.groupBy("k").agg(F.count("*").alias("number")).where(F.col("number") > FREQUENT).select("k", F.lit(True).alias("hot")), "names-hot")
    dealt = lambda rows: rows.join(hot, "k", "left").withColumn("k", F.explode(F.when(F.col("hot"), F.expr(PARTS)).otherwise(F.array("k"))))
    both = F.col("l") + F.col("m_l")
    near = (F.bit_count(F.col("odd").bitwiseXOR(F.col("m_odd"))) <= both * room + 1e-9) & (2 * F.least("l", "m_l") >= both * (1 - room) - 1e-9)
    right_keys = dealt(keys).select(F.col("k").alias("m_k"), F.col("n").alias("m_norm"), F.col("l").alias("m_l"), F.col("odd").alias("m_odd"))
    share = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a small table is one file, but has many keys
    pairs = dealt(x.repartition(share, "n").select(F.expr(SUBSTRINGS).alias("k"), "n", "l", "odd", "d")).withColumnRenamed("n", "norm").join(right_keys, (F.col("k") == F.col("m_k")) & near)
    return pairs.select("norm", "m_norm").distinct().repartition(share, "norm", "m_norm")


def close_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """(norm, m_norm, score) of the distinct pairs of equal names and of names of which one has a letter more.

    The shorter name is one of the longer's deletions: a join on hashes, 16 bytes a deletion, whose size grows
    with the names however alike they are. The names then tell whether it was not the hash alone.
    """
    named = lambda rows, name: written(rows.select(F.col(name).alias("n")).where("n != ''").distinct().select("n", F.xxhash64("n").alias("own")), "names-close")
    x, y = named(left, "norm"), named(right, "m_norm")
    cut = lambda rows, name: rows.select(F.expr(DELETIONS).alias("key"), F.col("own").alias(name))
    a, b = x.select(F.col("own").alias("a")), y.select(F.col("own").alias("b"))
    met = a.join(b, F.col("a") == F.col("b"))
    met = met.unionByName(a.join(cut(y, "b"), F.col("a") == F.col("key")).select("a", "b")).unionByName(cut(x, "a").join(b, F.col("b") == F.col("key")).select("a", "b")).distinct()
    pairs = met.join(x.select(F.col("own").alias("a"), F.col("n").alias("norm")), "a").join(y.select(F.col("own").alias("b"), F.col("n").alias("m_norm")), "b")
    short, both = F.least(F.length("norm"), F.length("m_norm")), F.length("norm") + F.length("m_norm")
    same = (F.col("norm") == F.col("m_norm")) | ((both == 2 * short + 1) & (F.levenshtein("norm", "m_norm") == 1))
    return pairs.where(same).select("norm", "m_norm", (F.lit(200.0) * short / both).alias("score"))


def scored_names(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(norm, m_norm, score) of the distinct pairs of names that reach ``least``."""
    if least < 95:
        return name_join.scored(left, right, least)
    score = similarity.scorer(similarity.ratio)(F.col("norm"), F.col("m_norm"))
    return similar_names(left, right, least).withColumn("score", score).where(F.col("score") >= least)


def fuzzy_candidates(left: DataFrame, right: DataFrame, least: float, same_brand: bool = True, close: bool = False) -> DataFrame:
    """Rows with the products whose names reach ``least``, or those of them that are ``close``; names are scored once each."""
    a = left.select("row_id", "domain", "norm", "brand_norm").where("norm != ''")
    b = right.select("master_id", "place", "m_norm", "m_brand").where("m_norm != ''")
    names = close_names(a, b).where(F.col("score") >= least) if close else scored_names(a, b, least)
    found = a.join(names, "norm").join(b, "m_norm")
    return found.where(_same_brand()) if same_brand else found


def most_similar(asked: DataFrame, index: DataFrame, links: DataFrame | None, least: float, same_brand: bool = True) -> DataFrame:
    """(row_id, master_id, score): of each row (row_id, norm, brand_norm, domain) the most similar product that fits and reaches ``least``.

    Names that are equal or differ by one letter come first. With l letters, a name at two insertions and deletions or more
    scores 100 * l / (l + 1) at most; a row with a better one is settled, and only the others meet all names.
    """

    def best(rows: DataFrame, close: bool) -> DataFrame:
        found = _off_site(fuzzy_candidates(rows, index, least, same_brand, close), links)
        first = found.groupBy("row_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "place", "master_id")).alias("b"), F.first(F.length("norm")).alias("l"))
        return first.select("row_id", F.col("b.master_id").alias("master_id"), (-F.col("b.s")).alias("score"), "l")

    asked = written(asked.where("norm != ''").select("row_id", "norm", "brand_norm", "domain"), "similar-asked")
    settled = written(best(asked, True).where("score > 100.0 * l / (l + 1) + 1e-6").drop("l"), "similar-settled")
    rest = written(asked.join(settled.select("row_id"), "row_id", "left_anti"), "similar-rest")
    return settled if rest.isEmpty() else settled.unionByName(best(rest, False).drop("l"))


def by_similarity(rows: DataFrame, index: DataFrame, links: DataFrame | None, least: float) -> DataFrame:
    """Rows that share name, brand and site have the same answer, so it is looked for once."""
    key = F.to_json(F.struct("norm", "brand_norm", "domain"))
    asked = rows.where("norm != ''").select("norm", "brand_norm", "domain").distinct().withColumn("row_id", key)
    best = most_similar(asked, index, links, least).withColumnRenamed("row_id", "key")
    own = rows.select("row_id", key.alias("key")).join(best, "key")
    return _result(own, 3, F.round(F.col("score") / 100, 4))


def nearest(rows: DataFrame, index: DataFrame, links: DataFrame | None, least: float) -> DataFrame:
    """(row_id, master_id, score) of the nearest product by cosine that the site lacks and whose brand fits, if it reaches ``least``.

    Products go to an inverted file; a row visits the lists that can hold a product of that score.
    """
    products = index.where("m_embedding is not null").select("master_id", "place", "m_brand", "m_embedding")
    sites = F.array().cast("array<string>")
    if links is not None:
        carried = links.groupBy("master_id").agg(F.collect_set("domain").alias("_sites"))
        products, sites = products.join(carried, "master_id", "left"), F.col("_sites")
    found = vector_index.build(products, None, "master_id", "m_embedding", F.col("place"), F.col("m_brand"), sites)
    asked = vector_index.asked_of(rows, "row_id", "name_embedding", F.col("brand_norm"), F.col("domain"), least)
    return vector_index.within(found, asked).select(F.col("query").alias("row_id"), F.col("id").alias("master_id"), "score")


def by_vector(rows: DataFrame, index: DataFrame, links: DataFrame | None, t: Thresholds) -> DataFrame:
    found = nearest(rows, index, links, t.review)
    sure = F.col("score") >= t.vector
    return _result(found, F.when(sure, 4).otherwise(5), F.round("score", 4), ~sure)


def match(listings: DataFrame, masters: DataFrame, links: DataFrame | None = None, skus: DataFrame | None = None, thresholds: Thresholds = Thresholds(), row_id: str = "scraped_url_id") -> DataFrame:
    """One row a listing, also where ids repeat: MATCH and ``is_new``. links: (domain, master_id) that exist already.

    Identifiers are joined to the listings. The name tiers see each (name, brand, site) once, and their answers are joined back once.
    """
    rows, index = with_own_keys(prepared(listings, row_id), "row_id", "match-rows"), written(indexed(masters), "match-index")
    by_key = rows.join(_last(index, "m_ean").select(F.col("m_ean").alias("ean"), F.col("master_id").alias("_ean")), "ean", "left")
    sku = F.lit(None).cast("string")
    if thresholds.sku_tier and skus is not None:
        last = skus.where("sku != ''").groupBy("site_id", "sku").agg(F.max("master_id").alias("_sku"))
        by_key, sku = by_key.join(last, ["site_id", "sku"], "left"), F.col("_sku")
    asked = F.struct("norm", "brand_norm", "domain", "fingerprint")
    keyed = by_key.withColumn("_master", F.coalesce("_ean", sku)).withColumn("_tier", F.when(F.col("_ean").isNotNull(), 1).when(sku.isNotNull(), 2))
    keyed = written(keyed.withColumn("_key", F.when(F.col("_tier").isNull(), F.to_json(asked))).drop("_ean", "_sku"), "match-keyed")
    names = written(keyed.where("_tier is null").select(F.col("_key").alias("row_id"), "norm", "brand_norm", "domain", "fingerprint").distinct(), "match-names")
    tiers = [lambda r: by_name(r, index, links), lambda r: by_similarity(r, index, links, thresholds.fuzzy), lambda r: by_fingerprint(r, index, links, thresholds.fingerprint)]
    found, left = None, names
    for tier in tiers:
        own = written(tier(left), "match-tier")
        found = own if found is None else found.unionByName(own)
        left = left.join(own.select("row_id"), "row_id", "left_anti")
    named = found.select(F.col("row_id").alias("_key"), F.col("master_id").alias("_named"), "tier", "confidence")
    whole = keyed.join(named, "_key", "left")
    decided = whole.select("row_id", F.coalesce("_master", "_named").alias("master_id"), F.coalesce("_tier", "tier").alias("tier"), F.when(F.col("_tier").isNotNull(), 1.0).otherwise(F.col("confidence")).alias("confidence"), F.lit(False).alias("needs_review"))
    none = [F.lit(None).cast("string").alias("master_id"), F.lit(6).alias("tier"), F.lit(0.0).alias("confidence"), F.lit(False).alias("needs_review")]
    if "name_embedding" in rows.columns and "m_embedding" in index.columns:
        decided = written(decided, "match-decided")
        rest = rows.join(decided.where("tier is null").select("row_id"), "row_id", "left_semi")
        near = written(by_vector(rest, index, links, thresholds), "match-vectors")
        decided = decided.where("tier is not null").unionByName(near).unionByName(rest.join(near.select("row_id"), "row_id", "left_anti").select("row_id", *none))
    else:
        decided = decided.withColumns({"confidence": F.coalesce("confidence", F.lit(0.0)), "tier": F.coalesce("tier", F.lit(6))})
    return with_ids(decided.select(*MATCH), "row_id").withColumn("is_new", F.col("tier") == 6)


def _two_sites(rows: DataFrame) -> DataFrame:
    """(m_norm, m_brand, m_known, firsts): the first rows (row_id, domain) of a name and brand from two sites; so there is one from another site than any."""
    each = rows.where("norm != ''").groupBy("norm", "brand_norm", F.col("ean").isNotNull().alias("m_known"), "domain").agg(F.min("row_id").alias("row_id"))
    both = each.groupBy(F.col("norm").alias("m_norm"), F.col("brand_norm").alias("m_brand"), "m_known").agg(F.array_sort(F.collect_list(F.struct("row_id", "domain"))).alias("firsts"))
    return both.withColumn("firsts", F.slice("firsts", 1, 2))


def _linked(asked: DataFrame, similar: DataFrame, others: DataFrame) -> DataFrame:
    """(norm, brand_norm, domain, known, score, other): for each name, brand and site, with an identifier or without, the first row of each similar name that fits and is from another site."""
    met = asked.select("norm", "brand_norm", "domain", F.col("ean").isNotNull().alias("known")).distinct().join(similar, "norm").join(_two_sites(others), "m_norm")
    met = met.where(_same_brand() & ~(F.col("known") & F.col("m_known")))
    apart = F.try_element_at(F.filter("firsts", lambda x: ~x["domain"].eqNullSafe(F.col("domain"))), F.lit(1))
    return met.select("norm", "brand_norm", "domain", "known", "score", apart["row_id"].alias("other")).where("other is not null")


KEYS = ["norm", "brand_norm", "domain", "known"]


def _leading(rows: DataFrame, least: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(leaders, linked, similar) of written rows: those that lead, the (norm, brand_norm, domain) by which a row with an identifier meets names of rows without one, scores of names.

    Where no name links a row with an identifier, only the first row of the identifier can lead: the later ones have a leader by then. So only these
    firsts, linked rows and rows without an identifier are settled in rounds.
    """
    rows = rows.select("row_id", "ean", *KEYS[:3], F.col("ean").isNotNull().alias("known"))
    names = written(rows.where("norm != ''").select("norm").distinct(), "run-norms")
    similar = written(scored_names(names, names.select(F.col("norm").alias("m_norm")), least), "run-names")
    known, free = rows.where("known"), rows.where("not known")
    linked = written(_linked(known, similar, free).select(*KEYS[:3]).distinct(), "run-linked")
    firsts = known.join(linked, KEYS[:3], "left_anti").groupBy("ean").agg(F.min(F.struct("row_id", *KEYS)).alias("r")).select("r.row_id", "ean", *[F.col("r")[c].alias(c) for c in KEYS])
    left = written(firsts.unionByName(known.join(linked, KEYS[:3], "left_semi")).unionByName(free), "run-left")
    leaders = None
    while not left.isEmpty():
        def first(others: DataFrame, left: DataFrame = left) -> DataFrame:
            """left with ``_first``: the first of the others that a row is linked to."""
            same = others.where("ean is not null").groupBy("ean").agg(F.min("row_id").alias("_same"))
            near = _linked(left, similar, others).groupBy(*KEYS).agg(F.min("other").alias("_near"))
            return left.join(same, "ean", "left").join(near, KEYS, "left").select(*left.columns, F.least("_same", "_near").alias("_first"))

        if leaders is not None:
            left = written(left.join(first(leaders).where("_first < row_id").select("row_id"), "row_id", "left_anti"), "run-left")
        fresh = written(first(left, left).where("_first is null or _first >= row_id").drop("_first"), "run-leaders")
        leaders = fresh if leaders is None else leaders.unionByName(fresh)
        left = written(left.join(fresh.select("row_id"), "row_id", "left_anti"), "run-left")
    return left if leaders is None else leaders, linked, similar


def _followed(rows: DataFrame, leaders: DataFrame, linked: DataFrame, similar: DataFrame) -> DataFrame:
    """The rows with ``lead`` of their leader. Rows with an identifier get it in one join; rows that names may lead are few or are looked at apart."""
    rows = rows.withColumn("known", F.col("ean").isNotNull())
    own = leaders.where("ean is not null").groupBy("ean").agg(F.min(F.struct("row_id", "lead")).alias("_own"))
    known = rows.where("known")
    by_ean = known.join(own, "ean").where("_own.row_id <= row_id").select(*rows.columns, F.col("_own.lead").alias("lead"))
    free = rows.where("not known").join(leaders.where("ean is null").select("row_id", "lead"), "row_id", "left").select(*rows.columns, "lead")
    later = known.join(linked, KEYS[:3], "left_semi").join(own, "ean", "left").where("_own.row_id is null or _own.row_id > row_id").select(*rows.columns)
    rest = written(later.unionByName(free.where("lead is null").drop("lead")), "run-rest")
    near = rest.select("row_id", *KEYS).join(_linked(rest, similar, leaders), KEYS).where("other < row_id")
    near = near.groupBy("row_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "other"))["other"].alias("other")).join(leaders.select(F.col("row_id").alias("other"), "lead"), "other")
    return by_ean.unionByName(free.where("lead is not null")).unionByName(rest.join(near.drop("other"), "row_id").select(*rows.columns, "lead"))


def leaders_of(rows: DataFrame, least: float = 95.0) -> DataFrame:
    """(row_id, leader) of rows (row_id, ean, norm, brand_norm, domain) that come one by one in order of row_id.

    A row joins the leader with its identifier, else the one of the most similar name (of equal ones the first) that reaches
    ``least``, is from another site, has a brand that fits and not another identifier; a row that finds none leads from then on.

    Who leads is settled in rounds of joins: a row that has a leader before it follows, one that has no undecided row before it
    leads. Links between rows are never listed: of each name and brand the first rows of two sites stand for all.
    """
    rows = written(rows.select("row_id", "ean", *KEYS[:3]), "run-rows")
    leaders, linked, similar = _leading(rows, least)
    return _followed(rows, leaders.withColumn("lead", F.col("row_id")), linked, similar).select("row_id", F.col("lead").alias("leader"))


def new_products(listings: DataFrame, matches: DataFrame | None = None, row_id: str = "scraped_url_id", least: float = 95.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """(row_id, master_id): unmatched listings of one run (without ``matches`` all of them) that are the same product share an id (``leaders_of``).

    The id is a hash of the leader's keys, so reruns agree. Ids of listings must not repeat here. Columns of the listings to ``keep`` come along.
    """
    kept = [F.col(c).alias(f"_keep_{c}") for c in keep]
    rows = _keyed(listings, F.col("raw_name"), F.col("raw_brand"), [F.col(row_id).cast("string").alias("row_id"), "domain", text.valid_ean(F.trim("raw_ean")).alias("ean"), *kept], "norm", "brand_norm", "fingerprint").drop("fingerprint")
    if matches is not None:
        rows = rows.join(matches.where("is_new").select("row_id"), "row_id", "left_semi")
    rows = written(rows, "run-new")
    leaders, linked, similar = _leading(rows, least)
    key = [F.coalesce(c, F.lit("")) for c in ("ean", "norm", "brand_norm", "domain")]
    place = F.row_number().over(Window.partitionBy(*key).orderBy("row_id"))  # leaders that are alike in all of it are different pages of a site
    leaders = written(leaders.withColumn("lead", F.md5(F.to_json(F.struct(*key, place)))), "run-products")
    return _followed(rows, leaders, linked, similar).select("row_id", F.col("lead").alias("master_id"), *[F.col(f"_keep_{c}").alias(c) for c in keep])


def run_stats(matches: DataFrame, faulty: DataFrame | None = None) -> DataFrame:
    """Listings by tier, and how many are new or to be reviewed; with ``faulty`` rows also ``errors``, in a row without a tier."""
    stats = matches.groupBy("tier").agg(F.count("*").alias("listings"), F.count_if("is_new").alias("new"), F.count_if("needs_review").alias("review"))
    if faulty is not None:
        zero = F.lit(0).cast("long")
        errors = faulty.agg(F.count("*").alias("errors")).where("errors > 0").select(F.lit(None).cast("int").alias("tier"), *[zero.alias(c) for c in ("listings", "new", "review")], "errors")
        stats = stats.withColumn("errors", zero).unionByName(errors)
    return stats.orderBy("tier")


def with_vectors(rows: DataFrame, encoder: Callable[[], Callable[[list[str]], np.ndarray]], text_column: Column, column: str = "name_embedding", batch: int = 256) -> DataFrame:
    """The rows with unit vectors of a text in ``column``, for the vector tiers; null for a text that is null or empty.

    ``encoder`` loads the model, once for each Python worker's task, and gives a function from texts to
    a matrix. It must be importable on executors or picklable.
    """

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encoded(pieces: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder()
        for s in pieces:
            out = pd.Series([None] * len(s), index=s.index, dtype=object)
            known = [i for i, t in zip(s.index, s, strict=True) if t]
            for k in range(0, len(known), batch):
                some = known[k : k + batch]
                matrix = np.asarray(encode(s.loc[some].tolist()), np.float32)
                matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), np.float32(1e-12))
                for i, v in zip(some, matrix, strict=True):
                    out.at[i] = v
            yield out

    return rows.withColumn(column, encoded(text_column))


def wholesale_by_ean(open_: DataFrame, active: DataFrame) -> DataFrame:
    """(supplier, code, master_id, confidence) of products whose name has a product's identifier in it."""
    last = active.where("m_ean is not null").groupBy("m_ean").agg(F.max(F.struct("place", "master_id")).alias("p")).select("m_ean", F.col("p.master_id").alias("master_id"))
    return open_.join(last, F.col("ean") == F.col("m_ean")).select("supplier", "code", "master_id", F.lit(1.0).alias("confidence"))


def wholesale_keys(supplier_products: DataFrame, masters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(open products, active ones) with the keys by which they meet."""
    tokens = F.array_join(F.array_sort(F.split(text.normalise_wholesale(F.col("name")), " ")), " ")
    active = masters.where("status = 'active'").select(F.col("id").alias("master_id"), F.struct(F.coalesce("brand", F.lit("")).alias("b"), F.coalesce("name", F.lit("")).alias("n"), "id").alias("place"), text.valid_ean(F.col("ean")).alias("m_ean"), F.lit("").alias("m_brand"), tokens.alias("m_norm"))
    return supplier_products.where("master_id is null").select("supplier", "code", text.ean_in_text(F.col("name")).alias("ean"), tokens.alias("norm")), active


def match_wholesale(supplier_products: DataFrame, masters: DataFrame, least: float = 75.0, sure: float = 0.95) -> DataFrame:
    """(supplier, code, master_id, confidence, manually_verified) of products without a link.

    An identifier inside the name decides; else the most similar active name. Each different name is looked at once.
    """
    open_ = supplier_products.where("master_id is null")
    names = open_.select("name").where("name is not null").distinct()
    keyed, active = wholesale_keys(names.select(F.lit("").alias("supplier"), F.col("name").alias("code"), "name", F.lit(None).cast("string").alias("master_id")), masters)
    keyed, active = written(keyed, "wholesale-names"), written(active, "wholesale-active")
    by_ean = wholesale_by_ean(keyed, active).select(F.col("code").alias("name"), "master_id", "confidence")
    rest = keyed.join(by_ean.select(F.col("name").alias("code")), "code", "left_anti").select(F.col("norm").alias("row_id"), F.lit("").alias("domain"), "norm", F.lit("").alias("brand_norm"), "code")
    best = most_similar(rest.drop("code").distinct(), active, None, least, same_brand=False)
    near = rest.join(best, "row_id").select(F.col("code").alias("name"), "master_id", F.round(F.col("score") / 100, 4).alias("confidence"))
    found = written(by_ean.unionByName(near), "wholesale-found")
    return open_.select("supplier", "code", "name").join(found, "name").select("supplier", "code", "master_id", "confidence", (F.col("confidence") >= sure).alias("manually_verified"))
