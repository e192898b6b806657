"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be copied target / source_size times. The
whole part is given to all; the fractions are rounded against each other: two
fractional documents meet, and as many words as one of them can give or take
move between them, in a random direction that keeps both expectations, so
that one becomes integral and the source's words stay what they were. The
other goes on. Documents meet in blocks of documents of like size; each block
ends with at most one fractional document, and those meet in the next round,
a reduction tree whose fan-in is ``BLOCK``. What is left in the end is one
document a source. So that it is a small one, documents of over 1/``LARGE`` of
the target meet first, in a tree for each size class. The one that a class
leaves over, at most some 250 a source, is settled against the pool of all
smaller ones, largest first (the pool's rate takes the difference). Only DataFrame functions
are used; every random draw is a hash of the documents that meet, so that
reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise, packed, unpacked

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that meet in one block, about.
BLOCK = 256
#: Copies of a document at most, and so a source's largest growth.
MOST = 3
WEIGHTS = (1, 2, 3)
SEED = 17
#: Documents of more than this part of their source's target meet first, among their like.
LARGE = 256
_NEAR = 1e-9
_UNIT = ["doc_id", "source", "text_key"]


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) with ``target`` added.

    Sources in code-point order, null last, weigh 1, 2, 3 and again. What a
    source would get above ``MOST`` times its size is shared by weight among
    the others until none is above: there is a level at which each source has
    min(cap, level * weight), and sorted by cap / weight it is the first that
    the next source's cap does not undercut. The windows run over one row a
    source.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size").cast("double"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    up = W.orderBy("ratio", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(up.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(up.rowsBetween(0, W.unboundedFollowing))
    whole = F.sum("source_size").over(W.partitionBy())
    rows = rows.withColumn("level", (whole - before) / rest).withColumn("nth", F.row_number().over(up))
    holds = F.when(F.col("ratio") >= F.col("level"), F.col("nth"))
    rows = rows.withColumn("level", F.min_by("level", holds).over(W.partitionBy()))
    return rows.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _draw(*keys: Column) -> Column:
    """Uniform in [0, 1), from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(SEED)), 11) * F.lit(2.0**-53)


def _meet(rows: Column) -> Column:
    """Sequential pivotal rounding of an array of (mass, …unit, p): struct(left, done)."""
    one = "struct<mass:bigint,doc_id:bigint,source:string,text_key:bigint,p:double>"
    done = "array<struct<doc_id:bigint,source:string,text_key:bigint,up:int>>"
    start = F.struct(F.lit(None).cast(one).alias("left"), F.array().cast(done).alias("done"))

    def settled(x, up):
        return F.struct(*[x[c].alias(c) for c in _UNIT], F.lit(up).cast("int").alias("up"))

    def with_p(x, p):
        return F.struct(*[x[c].alias(c) for c in ("mass", *_UNIT)], p.alias("p"))

    def meet(a, b, done_):
        """Words move from b to a: a is full, b is empty, or both."""
        take, give = (1.0 - a["p"]) * a["mass"], b["p"] * b["mass"]
        none = F.lit(None).cast(one)
        full = F.struct(with_p(b, b["p"] - take / b["mass"]).alias("left"), F.concat(done_, F.array(settled(a, 1))).alias("done"))
        empty = F.struct(with_p(a, a["p"] + give / a["mass"]).alias("left"), F.concat(done_, F.array(settled(b, 0))).alias("done"))
        even = F.struct(none.alias("left"), F.concat(done_, F.array(settled(a, 1), settled(b, 0))).alias("done"))
        return F.when(F.abs(take - give) <= _NEAR * (a["mass"] + b["mass"]), even).when(take < give, full).otherwise(empty)

    def step(acc, x):
        a = acc["left"]
        to_a = F.least((1.0 - a["p"]) * a["mass"], x["p"] * x["mass"])
        to_x = F.least(a["p"] * a["mass"], (1.0 - x["p"]) * x["mass"])
        u = _draw(a["text_key"], a["doc_id"], x["text_key"], x["doc_id"])
        met = F.when(u * (to_a + to_x) < to_x, meet(a, x, acc["done"])).otherwise(meet(x, a, acc["done"]))
        return F.when(a.isNull(), F.struct(x.alias("left"), acc["done"].alias("done"))).otherwise(met)

    return F.aggregate(rows, start, step)


def _pooled(rows: Column, base: Column, pool: Column) -> Column:
    """Left-over documents in turn, one a size class: struct(owed words and mass of the others, done)."""
    done = "array<struct<doc_id:bigint,source:string,text_key:bigint,up:int>>"
    start = F.struct(F.lit(0.0).alias("owed"), pool.cast("double").alias("mass"), F.array().cast(done).alias("done"))

    def step(acc, x):
        fair = base + x["p"]
        rate = F.least(F.greatest(fair + acc["owed"] / acc["mass"], F.lit(0.0)), F.lit(float(MOST)))
        copies = F.least(F.floor(rate + _draw(x["text_key"], x["doc_id"])), F.lit(MOST)).cast("long")
        made = F.struct(*[x[c].alias(c) for c in _UNIT], (copies - base).cast("int").alias("up"))
        left = F.greatest(acc["mass"] - x["mass"], F.lit(1e-6))
        return F.struct((acc["owed"] + (fair - copies) * x["mass"]).alias("owed"), left.alias("mass"), F.concat(acc["done"], F.array(made)).alias("done"))

    return F.aggregate(rows, start, step)


def _round(rows: DataFrame, klass: Column, name: str) -> DataFrame:
    """One level of the tree: blocks of about ``BLOCK`` rows of one source and size class."""
    rows = rows.withColumn("klass", klass)
    counts = rows.groupBy("source", "klass").agg(F.count("*").alias("n"))
    counts = counts.select(F.col("source").alias("s"), F.col("klass").alias("k"), F.ceil(F.col("n") / BLOCK).alias("blocks"))
    rows = rows.join(counts, rows["source"].eqNullSafe(F.col("s")) & (F.col("klass") == F.col("k")))
    block = F.pmod(F.xxhash64("text_key", "doc_id", F.lit(name)), F.col("blocks"))
    one = F.struct("mass", *_UNIT, "p")
    met = rows.groupBy("source", "klass", block.alias("block")).agg(F.sort_array(F.collect_list(one)).alias("rows"))
    return materialise(met.select("source", "klass", _meet(F.col("rows")).alias("met")), name)


def _most(rows: DataFrame, *by: str) -> int:
    return rows.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def _large(large: DataFrame, klass: Column) -> tuple[list[DataFrame], DataFrame]:
    """The tree of each size class of each source: what is settled, and at most one document a class."""
    done, level = [], 0
    while True:
        met = _round(large, klass, f"large{level}")
        done.append(met.select(F.explode("met.done").alias("u")).select("u.*"))
        large = met.where("met.left is not null").select("met.left.*")
        if _most(met, "source", "klass") <= 1:
            return done, large
        level += 1


def plan(docs: DataFrame) -> DataFrame:
    """Copies of every document: doc_id, source, text_key, size, rows, source_size, target, copies.

    ``docs`` has doc_id, source and text. Rows that are equal in all three are
    one unit (``rows`` counts them) and get the same number of copies each.
    Null text has size 0; a null source is a source of its own, weighed last;
    null doc_ids are ordinary. Documents of a source without any words are
    taken once. An empty table gives no rows.
    """
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    unit = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), key.alias("text_key"), words(F.col("text")).alias("size"))
    unit = materialise(unit.groupBy(*_UNIT, "size").agg(F.count("*").alias("rows")), "units")
    sizes = unit.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    aim = materialise(targets(sizes), "targets").withColumnRenamed("source", "s")
    unit = unit.join(aim, unit["source"].eqNullSafe(F.col("s"))).drop("s").withColumn("mass", F.col("size") * F.col("rows"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    unit = unit.withColumn("rate", F.least(F.greatest(rate, F.lit(0.0)), F.lit(float(MOST))))
    klass = F.floor(4 * F.log2(F.col("mass") + 1.0)).cast("int")
    share = [F.floor(F.col("rate") + _NEAR).alias("base"), F.greatest(F.col("rate") - F.floor(F.col("rate") + _NEAR), F.lit(0.0)).alias("p")]
    large = (F.col("mass") * LARGE > F.col("target")) & (F.col("target") > 0)
    big = materialise(unit.where(large).select(*_UNIT, "mass", *share), "large")
    met, left = _large(big.where(F.col("p") > _NEAR).select("mass", *_UNIT, "p"), klass)
    # A row a source: the words of its smaller documents, and its left-over ones, at most one a class.
    small = unit.groupBy(F.col("source").alias("s")).agg(F.sum(F.when(large, 0).otherwise(F.col("mass"))).alias("small"), F.max(share[0]).alias("base"))
    left = left.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("mass", *_UNIT, "p")), asc=False).alias("rows"), F.sum("mass").alias("mass"))
    left = left.join(small, left["source"].eqNullSafe(F.col("s")))
    left = materialise(left.select("source", _pooled(F.col("rows"), F.col("base"), F.col("mass") + F.col("small")).alias("met")), "pooled")
    pool = left.select(F.col("source").alias("s"), (F.col("met.owed") / F.col("met.mass")).alias("more"))
    met.append(left.select(F.explode("met.done").alias("u")).select("u.*"))
    rest = unit.where(~large)
    rest = rest.join(pool, rest["source"].eqNullSafe(F.col("s")), "left").drop("s")
    rate = F.col("rate") + F.when(F.col("source_size") > 0, F.coalesce("more", F.lit(0.0))).otherwise(0.0)
    rest = rest.withColumn("rate", F.least(F.greatest(rate, F.lit(0.0)), F.lit(float(MOST))))
    rest = materialise(rest.select(*_UNIT, "mass", *share), "rest")

    open_ = rest.where((F.col("p") > _NEAR) & (F.col("mass") > 0)).select("mass", *_UNIT, "p")
    # Without words there is nothing to balance: a draw of its own decides.
    done = [rest.where((F.col("p") > _NEAR) & (F.col("mass") == 0)).select(*_UNIT, (_draw(F.col("text_key"), F.col("doc_id")) < F.col("p")).cast("int").alias("up"))]
    level = 0
    while True:
        round_ = _round(open_, klass, f"round{level}")
        done.append(round_.select(F.explode("met.done").alias("u")).select("u.*"))
        open_ = round_.where("met.left is not null").select("met.left.*")
        if level and _most(round_, "source") <= 1:
            break
        klass, level = F.lit(0), level + 1
    last = open_.select(*_UNIT, (_draw(F.col("text_key"), F.col("doc_id")) < F.col("p")).cast("int").alias("up"))
    for part in done + met:
        last = last.union(part.select(*_UNIT, "up"))
    def on(c: str) -> str:
        return f"_{c}"

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(*[F.col(c).alias(on(c)) for c in _UNIT], *[c for c in right.columns if c not in _UNIT])
        same = left["doc_id"].eqNullSafe(right["_doc_id"]) & left["source"].eqNullSafe(right["_source"]) & (left["text_key"] == right["_text_key"])
        return left.join(right, same, how).drop(*map(on, _UNIT))

    copies = (F.col("base") + F.coalesce("up", F.lit(0))).cast("long")
    settled = joined(rest.union(big).select(*_UNIT, "base"), last, "left").select(*_UNIT, copies.alias("copies"))
    return joined(unit.select(*_UNIT, "size", "rows", "source_size", "target"), settled, "inner")


def mixture(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted).

    A null source is a source, the last. Null and empty texts have size 0 and
    are not taken. Equal rows are taken alike; an empty table gives no rows.
    """
    rows = plan(docs).withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say, with all its columns.

    Rows of size 0 (null and empty texts) go; other columns may hold anything,
    nulls included. An empty table stays empty.
    """
    aim = plan(docs).where("copies > 0").select(*[F.col(c).alias(f"_{c}") for c in _UNIT], F.col("copies").alias("_copies"))
    rows = packed(docs, "doc_id", "source", "text").withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc_id")) & F.col("source").cast("string").eqNullSafe(F.col("_source")) & (F.col("_key") == F.col("_text_key"))
    rows = rows.join(aim, same).withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
    return unpacked(rows, docs.columns)
