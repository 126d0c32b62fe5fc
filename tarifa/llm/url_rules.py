"""URL filtering by association rules.

URLs with a label (block or allow) are turned into sets of tokens: the labels of
the host, the words of the path's segments and the keys of the query. Spark's FP-growth
mines the token combinations that occur with a label; a combination becomes a
rule for that label if it has the least support and confidence, and if no part
of it is a rule for the same label with at least its confidence.

Two things keep long and repeated URLs from giving all subsets of their words, and change no
rule. A token that occurs with one label only is a rule by itself and no part of a longer one that is not pruned,
so it is taken out before FP-growth. Tokens that occur in exactly the
same labelled URLs (equal counts and 128 bits of hashes) are one item, with all of them as
its *variants*; a rule then stands for those with any one variant of each of its items. What is left to FP-growth are
tokens that both labels have and that do not go together.

Rules match by an inverted index: from a token to the items of rules that have it. A rule
fires on a URL that has a variant of each of its items; the most confident rule decides, then
the better supported, then the longer, then the first in token order. No rule: the default.
Up to ``held`` variants (the bound is checked) go to the executors as an index in
memory and the URLs are not shuffled; beyond that the index is a table that is
joined by token, and Spark splits hot tokens.

A list of (host, path, verdict) rules overrules what is mined, and gives the
labels to mine from: the URLs on which it decides.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no
tokens and the default; rows that repeat a page are rows of their own; without
labelled URLs nothing is mined; an empty table gives an empty table; further
columns never matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarifa.llm.common import type_of
from tarifa.session import written

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HELD = 20_000
ListRule = tuple[str, str, str]  # host, path, verdict


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def tokens(url: Column) -> Column:
    """Sorted, each once: ``h:`` host labels, ``p:`` words of the path without bare numbers, ``q:`` keys of the query."""
    words = lambda mark, array: F.transform(F.filter(array, lambda x: (x != "") & ~x.rlike("^[0-9]+$")), lambda x: F.concat(F.lit(mark), x))
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    found = F.concat(words("h:", F.split(host(url), r"\.")), words("p:", F.split(F.lower(path(url)), r"[/._-]")), words("q:", keys))
    return F.array_sort(F.array_distinct(F.coalesce(found, F.array().cast("array<string>"))))


def listed(h: Column, p: Column, rules: list[ListRule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((h == rule_host) | h.endswith("." + rule_host)) & p.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


RULES = "antecedent array<array<string>>, verdict string, confidence double, support double"


def mine(labelled: DataFrame, support: float = 0.005, confidence: float = 0.8, least: int = 5) -> DataFrame:
    """(antecedent, verdict, confidence, support), pruned, from rows of (tokens, verdict); an antecedent is items, an item its variants."""
    spark = labelled.sparkSession
    rows = written(labelled.select("tokens", "verdict").withColumn("n", F.monotonically_increasing_id()), "url-labelled")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], RULES)
    floor = max(support * n, least)
    seen = rows.select("n", "verdict", F.explode("tokens").alias("token"))
    most = F.expr("max_by(verdict, struct(k, verdict))")
    said = seen.groupBy("token", "verdict").agg(F.count("*").alias("k"), F.bit_xor(F.xxhash64("n")).alias("x"), F.bit_xor(F.xxhash64("n", F.lit(7))).alias("y"))
    singles = said.groupBy("token").agg(F.sum("k").alias("n"), F.max("k").alias("k"), most.alias("verdict"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    singles = written(singles.where(F.col("n") >= floor - 1e-9), "url-tokens")
    sure = singles.where("k = n").select(F.array(F.array("token")).alias("antecedent"), "verdict", F.lit(1.0).alias("confidence"), (F.col("k") / n).alias("support"))
    items = written(singles.where("k < n").groupBy("n", "x", "y").agg(F.array_sort(F.collect_list("token")).alias("variants")).select(F.col("variants")[0].alias("item"), "variants"), "url-items")
    rest = seen.join(items, F.col("token") == F.col("item")).groupBy("n", "verdict").agg(F.collect_list("item").alias("items"))
    baskets = written(rest.select(F.concat("items", F.array(F.concat(F.lit("="), F.col("verdict")))).alias("items")), "url-transactions")
    number = baskets.count()
    if not number:
        return written(sure, "url-rules")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, floor * (1 - 1e-9) / number), minConfidence=confidence).fit(baskets)
    found = model.associationRules.where(F.col("consequent")[0].startswith("="))
    found = found.where(~F.exists("antecedent", lambda x: x.startswith("=")))
    found = written(found.select(F.array_sort("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], 2, 99).alias("verdict"), "confidence", (F.col("support") * number / n).alias("support")), "url-mined")
    # a longer rule is pruned if one of its parts says the same as surely: the parts of a rule of k tokens are 2^k - 2
    parts = F.aggregate("antecedent", F.array(F.array().cast("array<string>")), lambda acc, x: F.concat(acc, F.transform(acc, lambda y: F.concat(y, F.array(x)))))
    short = found.select(F.col("antecedent").alias("part"), "verdict", F.col("confidence").alias("c"))
    longer = found.select("antecedent", "verdict", "confidence", F.explode(parts).alias("part")).where("part != antecedent")
    pruned = longer.join(short, ["part", "verdict"]).where("c >= confidence").select("antecedent", "verdict").distinct()
    left = found.join(pruned, ["antecedent", "verdict"], "left_anti").withColumn("rule", F.xxhash64("antecedent", "verdict"))
    wide = left.select("*", F.posexplode("antecedent").alias("at", "item")).join(items, "item")
    wide = wide.groupBy("rule", "antecedent", "verdict", "confidence", "support").agg(F.array_sort(F.collect_list(F.struct("at", "variants"))).alias("own"))
    return written(wide.select(F.col("own.variants").alias("antecedent"), "verdict", "confidence", "support").unionByName(sure), "url-rules")


def _match(batches: Iterator[pa.RecordBatch], rules: list[tuple[list[list[str]], str]], default: str) -> Iterator[pa.RecordBatch]:
    """``rules`` in the order in which they decide."""
    index = defaultdict(list)
    for k, (antecedent, _) in enumerate(rules):
        for at, variants in enumerate(antecedent):
            for token in variants:
                index[token].append((k, 1 << at))
    whole = [(1 << len(a)) - 1 for a, _ in rules]
    for batch in batches:
        verdicts, why = [], []
        for own in batch.column("tokens").to_pylist():
            hits, best = defaultdict(int), None
            for token in own:
                for k, item in index.get(token, ()):
                    hits[k] |= item
                    if hits[k] == whole[k] and (best is None or k < best):
                        best = k
            verdicts.append(default if best is None else rules[best][1])
            why.append(None if best is None else [t for t in own if any(t in variants for variants in rules[best][0])])
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(verdicts, pa.string()), pa.array(why, pa.list_(pa.string()))], names=["row", "verdict", "why"])


def matched(rows: DataFrame, rules: DataFrame, default: str = "allow", held: int = HELD) -> DataFrame:
    """(row, verdict, why) of rows (row: struct, tokens); why: the tokens that made the deciding rule fire."""
    order = [F.col("confidence").desc(), F.col("support").desc(), F.size("antecedent").desc(), F.transform("antecedent", lambda x: x[0]), F.col("verdict")]
    variants = rules.agg(F.sum(F.size(F.flatten("antecedent")))).first()[0] or 0
    if variants <= held:
        found = [(r["antecedent"], r["verdict"]) for r in rules.orderBy(*order).collect()]
        return rows.select("row", "tokens").mapInArrow(partial(_match, rules=found, default=default), f"row {type_of(rows, 'row')}, verdict string, why array<string>")
    index = rules.select(F.struct("antecedent", "verdict", "confidence", "support").alias("rule"), F.posexplode("antecedent").alias("at", "item")).select("rule", "at", F.explode("item").alias("token"))
    own = rows.select("tokens").distinct()
    hits = own.select("tokens", F.explode("tokens").alias("token")).join(index, "token").groupBy("tokens", "rule").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("items"))
    hits = hits.where(F.bit_count("items") == F.size("rule.antecedent"))
    first = Window.partitionBy("tokens").orderBy(*order)
    best = hits.select("tokens", "rule.*").withColumn("k", F.row_number().over(first)).where("k = 1")
    best = best.select("tokens", F.col("verdict").alias("v"), F.array_intersect("tokens", F.flatten("antecedent")).alias("why"))
    return rows.join(best, "tokens", "left").select("row", F.coalesce("v", F.lit(default)).alias("verdict"), "why")


def judged(pages: DataFrame, rules: list[ListRule], id_col: str = "page_id", url_col: str = "url", default: str = "allow", support: float = 0.005, confidence: float = 0.8, held: int = HELD) -> DataFrame:
    """(id, host, path, rule, verdict, why) of each page."""
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"), tokens(url).alias("tokens"))
    name, verdict = listed(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("listed", verdict)
    mined = mine(rows.where("listed is not null").select("tokens", F.col("listed").alias("verdict")), support, confidence)
    out = matched(rows.select(F.struct("id", "host", "path", "rule", "listed").alias("row"), "tokens"), mined, default, held)
    return out.select(F.col("row.id").alias(id_col), "row.host", "row.path", "row.rule", F.coalesce("row.listed", "verdict").alias("verdict"), F.when(F.col("row.listed").isNull(), F.col("why")).alias("why"))
