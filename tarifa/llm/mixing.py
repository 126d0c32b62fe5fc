"""Mixing sources to target weights by pivotal dependent rounding.

A document is to appear ``rate`` times, where a source's rate is its target
over its size. The fractions are rounded so that the words are kept: a document
with an open fraction meets others, and at random either gets words from them or
passes words on, until one side has no fraction left. The odds are such that each
document keeps its expected number of copies.

All documents, of any size, go the same way. A chunk is gone through from its largest
document on; the document meets the *bundle* of all smaller ones in the chunk, which
take or give the words in proportion to their sizes, so that their common rate
moves a little. So large documents are settled while there are many words left to
make up for them, and what is left open at the end is a small one. The first chunk of a source
has its ``FAN`` * 4 largest documents at most (those with over 1/256 of its words), and its
bundle is the rest of the source; the others are dealt into chunks of about ``FAN``, a hot source
just has more of them. Each chunk ends with one document at most whose fraction
is open. These residuals meet pair by pair in chunks of ``FAN`` again, and so
on up to one for each source: a reduction tree of log_64(n) levels, each of
which shuffles a 64th of the one below. Random numbers are hashes of the
documents, so reruns agree, whatever the partitioning.

Only DataFrame functions are used.

Defined cases: a null text has no words; rows alike in id, source and size share
their copies evenly (they differ by one at most); a null source is a source of its own, ranked
last; a source without words has target 0; an empty table gives an empty table;
further columns never matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tarifa.llm.common import running
from tarifa.session import written

FAN = 64
MOST = 3
HEAD = 4 * FAN  # documents with over 1/HEAD of their source's words, HEAD of them at most, are its first chunk
WORD = r"[^\x20\x09-\x0D]+"
TINY = 1e-9


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: int = 3, most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size) with weight, target and rate.

    Weights 1..``weights`` repeat in code-point order of the source, null last.
    A share above ``most`` times the source's size stops there and its excess is
    reshared by weight until none is above: with the sources in order of the
    share at which they are full, that is one running sum.
    """
    by_name = F.col("source").asc_nulls_last()
    ranked = running(sources, [by_name], {"place": F.lit(1)}).withColumn("w", F.col("place") % weights + 1).drop("place")
    ranked = ranked.withColumn("full", F.col("source_size") * float(most)).withColumn("at", F.col("full") / F.col("w"))
    summed = running(ranked, [F.col("at"), by_name], {"full_before": F.col("full"), "w_before": F.col("w")})
    total = summed.agg(F.sum(F.col("source_size").cast("double")).alias("size"), F.sum("w").alias("w")).first()
    level = (F.lit(total["size"] or 0.0) - F.col("full_before")) / (F.lit(total["w"] or 0) - F.col("w_before"))
    filled = written(summed.withColumn("level", level).withColumn("is_full", F.col("at") <= F.col("level")), "mix-filled")
    line = filled.agg(F.max(F.when(~F.col("is_full"), F.col("level")))).first()[0]  # the first that isn't full; it sinks from there on
    target = F.when(F.col("is_full"), F.col("full")).otherwise(F.lit(line).cast("double") * F.col("w"))
    return filled.select("source", "source_size", "w", target.alias("target"), F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"))


def _uniform(*columns) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") * F.lit(2.0**-53)


def _fold(units: Column, unit: str) -> Column:
    """Pivotal rounding along an array in its order: (open, done)."""
    none = F.array().cast(f"array<{unit}>")
    start = F.struct(F.lit(None).cast(unit).alias("open"), none.alias("done"))

    def meet(acc: Column, b: Column) -> Column:
        a = acc["open"]
        up = F.least(a["size"] * (1 - a["p"]), b["size"] * b["p"])  # words that a can get from b
        down = F.least(a["size"] * a["p"], b["size"] * (1 - b["p"]))
        moved = F.when(b["z"] < down / (up + down), up).otherwise(-down)
        pa, pb = a["p"] + moved / a["size"], b["p"] - moved / b["size"]
        a_done, b_done = (pa < TINY) | (pa > 1 - TINY), (pb < TINY) | (pb > 1 - TINY)
        set_a, set_b = a.withField("p", F.round(pa)), b.withField("p", F.round(pb))
        done = F.concat(acc["done"], F.when(a_done, F.array(set_a)).otherwise(none), F.when(b_done, F.array(set_b)).otherwise(none))
        rest = F.when(~a_done, a.withField("p", pa)).when(~b_done, b.withField("p", pb))
        return F.when(a.isNull(), F.struct(b.alias("open"), acc["done"].alias("done"))).otherwise(F.struct(rest.alias("open"), done.alias("done")))

    return F.aggregate(units, start, meet)


def _descend(units: Column, unit: str, rate: Column, words: Column) -> Column:
    """Pivotal rounding along an array from its largest unit on: (rate, rest, open, done).

    A unit meets the bundle of all words after it (``words``: of the whole chunk, and of
    what follows it), whose common ``rate`` takes or gives what the unit moves. The bundle has no fraction
    left at a rate of 0 or ``MOST``; the unit that takes it there, or has none after it, stays open.
    """
    none = F.array().cast(f"array<{unit}>")
    start = F.struct(rate.alias("rate"), words.cast("double").alias("rest"), F.lit(None).cast(unit).alias("open"), none.alias("done"))

    def met(acc: Column, u: Column) -> Column:  # named step by step, so that each is computed once
        want = u["m"] * acc["rate"]
        near = F.when(F.abs(want - F.round(want)) < TINY, F.round(want)).otherwise(want)
        return F.struct(near.alias("want"), F.floor(near).alias("whole"), (acc["rest"] - u["size"] * u["m"]).alias("rest"))

    def odds(acc: Column, u: Column, x: Column) -> Column:
        f = x["want"] - x["whole"]
        up = F.least(u["size"] * (1 - f), x["rest"] * acc["rate"])  # words that the unit can get from the bundle
        down = F.least(u["size"] * f, x["rest"] * (MOST - acc["rate"]))
        moved = F.when((f <= 0) | (up + down <= 0), 0.0).when(u["z"] * (up + down) < down, up).otherwise(-down)
        return F.struct(x["whole"].alias("whole"), f.alias("f"), x["rest"].alias("rest"), moved.alias("moved"))

    def close(acc: Column, u: Column, x: Column) -> Column:
        p = x["f"] + x["moved"] / u["size"]
        shifted = F.when(x["rest"] > 0, acc["rate"] - x["moved"] / x["rest"]).otherwise(acc["rate"])
        now = F.when(shifted < TINY, 0.0).when(shifted > MOST - TINY, float(MOST)).otherwise(shifted)
        own = u.withField("whole", x["whole"].cast("long"))
        settled = (p < TINY) | (p > 1 - TINY)
        done = F.when(settled, F.concat(acc["done"], F.array(own.withField("p", F.round(p))))).otherwise(acc["done"])
        return F.struct(now.alias("rate"), x["rest"].alias("rest"), F.when(settled, acc["open"]).otherwise(own.withField("p", p)).alias("open"), done.alias("done"))

    def let(value: Column, use) -> Column:
        return F.transform(F.array(value), use)[0]

    return F.aggregate(units, start, lambda acc, u: let(met(acc, u), lambda x: let(odds(acc, u, x), lambda y: close(acc, u, y))))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """(id, source, size, m, source_size, target, copies): what ``m`` rows alike get together."""
    id_type = docs.schema[id_col].dataType.simpleString()
    unit_type = f"struct<size:bigint,order:bigint,id:{id_type},m:bigint,whole:bigint,p:double,z:double>"
    keys = ["source", "source_size", "target"]
    same = lambda frame, c="source": F.col(c).eqNullSafe(F.col("s"))
    source = F.col(source_col).cast("string").alias("source")
    units = written(docs.select(F.col(id_col).alias("id"), source, words(F.col(text_col)).alias("size")).groupBy("id", "source", "size").agg(F.count("*").alias("m")), "mix-units")
    order, z = F.xxhash64("id", "source", "size", F.lit(seed)), _uniform("id", "source", "size", F.lit(seed + 1))
    unit = F.struct("size", order.alias("order"), "id", "m", F.lit(0).cast("long").alias("whole"), F.lit(0.0).alias("p"), z.alias("z"))

    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    sources = written(targets(sizes).withColumnRenamed("source", "s").drop("w"), "mix-sources")
    placed = units.join(sources, same(units)).drop("s").withColumn("u", unit)
    is_head, in_unit = F.col("size") * F.col("m") * HEAD > F.col("source_size"), F.col("size") * F.col("m")
    sorted_units = F.sort_array(F.collect_list("u"), asc=False)
    head = placed.where(is_head).groupBy(*keys, "rate").agg(sorted_units.alias("us"))  # HEAD of a source at most
    head = written(head.select(*keys, _descend(F.col("us"), unit_type, F.col("rate"), F.col("source_size")).alias("f")).select(*keys, "f.*"), "mix-head")

    rest = placed.where(~is_head)
    plan = rest.groupBy("source").agg(F.ceil(F.count("*") / FAN).alias("chunks"))
    plan = plan.join(head.select(F.col("source").alias("s"), F.col("rate").alias("left")), same(plan), "left").drop("s")
    plan = written(plan.select(F.col("source").alias("s"), "chunks", "left"), "mix-plan")
    most = (plan.agg(F.max("chunks")).first()[0] or 0) + 1  # and the head's

    small = rest.join(plan, same(rest)).withColumn("rate", F.coalesce("left", "rate"))
    wordless = F.col("m") * F.col("rate")  # no words to keep: rounded alone
    whole = F.floor(wordless).cast("long")
    alone = small.where("size = 0").select(*keys, F.col("u").withField("whole", whole).withField("p", F.when(F.col("u.z") < wordless - whole, 1.0).otherwise(0.0)).alias("u"))
    chunk = F.pmod(F.xxhash64("id", "size", F.lit(seed + 2)), "chunks")
    chunks = small.where("size > 0").groupBy(*keys, "rate", chunk.alias("chunk")).agg(sorted_units.alias("us"), F.sum(in_unit).alias("words"))
    chunks = chunks.select(*keys, _descend(F.col("us"), unit_type, F.col("rate"), F.col("words")).alias("f")).select(*keys, "f.open", "f.done")
    folded = written(chunks.unionByName(head.select(*keys, "open", "done")), "mix-level")
    parts = [alone]
    while True:
        parts.append(folded.select(*keys, F.explode("done").alias("u")))
        opened = folded.where("open is not null").select(*keys, F.col("open").withField("z", _uniform("open.z", "open.order", F.lit(seed))).alias("u"))
        if most <= 1:
            break
        most = -(-most // FAN)
        level = opened.withColumn("chunk", F.pmod(F.xxhash64("u.order", F.lit(most)), F.lit(most))).groupBy(*keys, "chunk").agg(_fold(F.sort_array(F.collect_list("u")), unit_type).alias("f"))
        folded = written(level.select(*keys, "f.open", "f.done"), "mix-level")
    parts.append(opened.select(*keys, F.col("u").withField("p", F.when(F.col("u.z") < F.col("u.p"), 1.0).otherwise(0.0)).alias("u")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("u.id").alias("id"), "source", F.col("u.size").alias("size"), F.col("u.m").alias("m"), "source_size", "target", (F.col("u.whole") + F.col("u.p").cast("long")).alias("copies"))


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """One row a document: id, size, source_size, target, taken."""
    each = copies(docs, id_col, text_col, source_col, seed).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    own = F.floor(F.col("copies") / F.col("m")) + F.when(F.col("k") < F.col("copies") % F.col("m"), 1).otherwise(0)
    return each.select(F.col("id").alias(id_col), "size", "source_size", "target", (own * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """The mix itself: each row as often as it is taken, all columns kept."""
    key = lambda *columns: F.to_json(F.struct(*[c.alias(n) for c, n in zip(columns, ("id", "source", "size"), strict=True)]))  # noqa: E731  never null: the join and the window are dealt alike
    plan = copies(docs, id_col, text_col, source_col, seed).select(key(F.col("id"), F.col("source"), F.col("size")).alias("key"), "m", "copies")
    own = key(F.col(id_col), F.col(source_col).cast("string"), words(F.col(text_col)))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("key"))
    place = F.when(F.col("m") == 1, F.lit(1)).otherwise(F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row"))))
    times = F.floor(F.col("copies") / F.col("m")) + F.when(place - 1 < F.col("copies") % F.col("m"), 1).otherwise(0)
    joined = rows.join(plan, "key")
    return joined.select("row", times.cast("int").alias("times")).where("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("i")).select("row.*")
