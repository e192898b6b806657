"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is a bag of lower-cased words with their counts as weights. For
each slot k and term t, hashes of (t, k) give r, c ~ Gamma(2, 1) and b ~ U(0, 1);
a term of weight w has

    y = exp(r * (floor(ln w / r + b) - b)),   a = c / (y * exp(r))

and the slot keeps the smallest a. Two bags agree in a slot with probability
equal to their generalised Jaccard similarity, sum(min) / sum(max). The value
a is itself a function of term, slot and quantised weight, so that equal minima
mean the same sample; a slot of the fingerprint is 16 bits of a hash of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD_GAP, lower_ascii

SLOTS = 64
#: Slots evaluated in one row: a term's row is repeated for each such group. More columns at once would make
#: methods that the JVM does not compile (measured: 64 in one row cost 23 us a term, in groups of 4 they cost 7).
GROUP = 4
DIGITS = 4
#: Ranges of doc_id per shuffle partition; each is ordered on its own.
RANGES = 4
_NULL = "-" * DIGITS


def in_order(docs: DataFrame) -> DataFrame:
    """(range, nth, halo, doc_id, text, next_text): every document beside the next one, by falling doc_id.

    Ids are cut into ranges at approximate quantiles, and each range is sorted
    on its own. The one neighbour that a range lacks, the first document of the
    range after it, comes as a copy (``halo``), so that no range is looked at
    twice. After the last document comes the first. Null ids are last, equal
    ids stand by a hash of the text.
    """
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 100 * ranges).alias("c")).first()["c"]
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts or []), reverse=True)]).cast("array<bigint>")
    # Null ids pass every cut.
    own = F.size(F.filter(cuts, lambda c: F.coalesce(F.col("doc_id") < c, F.lit(True))))
    docs = docs.withColumn("range", own)
    head = docs.select("range", "doc_id", "text_key").groupBy("range").agg(F.max(F.struct("doc_id", "text_key")).alias("head"))
    # One row a range: the range before each gets a copy of its first document.
    before = F.coalesce(F.lag("range").over(W.orderBy("range")), F.max("range").over(W.partitionBy()))
    head = head.select(F.col("range").alias("r"), F.col("head.doc_id").alias("d"), F.col("head.text_key").alias("k"), before.alias("before"))
    docs = docs.join(F.broadcast(head), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")) & (F.col("range") == F.col("r")), "left")
    place = F.struct(F.col("range"), F.lit(False).alias("halo"))
    copy = F.struct(F.col("before").alias("range"), F.lit(True).alias("halo"))
    docs = docs.withColumn("place", F.explode(F.when(F.col("before").isNull(), F.array(place)).otherwise(F.array(place, copy))))
    docs = docs.select("place.range", "place.halo", "doc_id", "text_key", "text")
    order = W.partitionBy("range").orderBy("halo", F.col("doc_id").desc_nulls_last(), F.col("text_key").desc())
    docs = docs.withColumn("nth", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))
    return docs.select("range", "nth", "halo", "doc_id", "text", "next_text")


def edited() -> Column:
    """The text with its last third replaced by the start of the next document."""
    third = F.floor(F.length("text") / 3).cast("int")
    return F.concat(F.left("text", F.length("text") - third), F.left(F.coalesce("next_text", F.lit("")), third))


def _uniform(bits: Column, width: int) -> Column:
    return (bits + F.lit(0.5)) * F.lit(2.0**-width)


def _gammas(term: Column, k: int) -> list[Column]:
    """ln c, r and b of slot k of the row's group."""
    slot = F.col("group") * GROUP + k
    h, g = F.xxhash64(term, 2 * slot), F.xxhash64(term, 2 * slot + 1)
    low = lambda c, n: c.bitwiseAND(F.lit((1 << n) - 1))
    c = -F.log(_uniform(F.shiftrightunsigned(h, 32), 32) * _uniform(low(h, 32), 32))
    r = -F.log(_uniform(F.shiftrightunsigned(g, 43), 21) * _uniform(low(F.shiftrightunsigned(g, 22), 21), 21))
    return [F.log(c).alias(f"c{k}"), r.alias(f"r{k}"), (low(g, 22) * F.lit(2.0**-22)).alias(f"b{k}")]


def _smallest(weight: str, k: int) -> Column:
    """ln a, smallest over the terms that the bag has (``weight``: ln of the count, null: none)."""
    r, b = F.col(f"r{k}"), F.col(f"b{k}")
    return F.min(F.col(f"c{k}") - r * (F.floor(F.col(weight) / r + b) - b + 1.0))


def _digits(value: Column) -> Column:
    """The slot's hexadecimal digits."""
    bits = F.shiftrightunsigned(F.xxhash64(value), 64 - 4 * DIGITS)
    return F.when(value.isNull(), F.lit(_NULL)).otherwise(F.lpad(F.lower(F.hex(bits)), DIGITS, "0"))


def sampled(pairs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Signatures of two texts a row: (range, nth, one, two), arrays of ``slots`` (a multiple of GROUP) slots.

    ``pairs`` has range, nth (unique together) and the texts one and two. If it
    is already partitioned by range, nothing is shuffled.
    """
    split = lambda c: F.split(lower_ascii(F.col(c)), WORD_GAP)
    sides = F.array(F.struct(F.lit(0).alias("side"), split("one").alias("words")), F.struct(F.lit(1).alias("side"), split("two").alias("words")))
    rows = pairs.select("range", "nth", F.explode(sides).alias("s")).select("range", "nth", "s.side", F.explode("s.words").alias("word"))
    term = F.xxhash64("word").alias("term")
    # The empty word (a blank start or end, an empty text) keeps the row, without weight.
    there = F.when(F.col("word") != "", 1).otherwise(0)
    rows = rows.select("range", "nth", term, (there * (1 - F.col("side"))).cast("long").alias("n1"), (there * F.col("side")).cast("long").alias("n2"))
    rows = rows.groupBy("range", "nth", "term").agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2"))
    weights = [F.when(F.col(n) > 0, F.log(n)).alias(w) for n, w in (("n1", "w1"), ("n2", "w2"))]
    groups = F.explode(F.array(*[F.lit(g) for g in range(slots // GROUP)])).alias("group")
    rows = rows.select("range", "nth", "term", *weights, groups)
    rows = rows.select("range", "nth", "group", "w1", "w2", *[c for k in range(GROUP) for c in _gammas(F.col("term"), k)])
    rows = rows.groupBy("range", "nth", "group").agg(*[_smallest(w, k).alias(f"{w}_{k}") for w in ("w1", "w2") for k in range(GROUP)])
    sides = [F.array(*[_digits(F.col(f"{w}_{k}")) for k in range(GROUP)]).alias(n) for w, n in (("w1", "one"), ("w2", "two"))]
    rows = rows.select("range", "nth", F.struct("group", *sides).alias("g"))
    rows = rows.groupBy("range", "nth").agg(F.sort_array(F.collect_list("g")).alias("g"))
    return rows.select("range", "nth", *[F.flatten(f"g.{n}").alias(n) for n in ("one", "two")])


def likeness(a: Column, b: Column, slots: int = SLOTS) -> Column:
    """Share of slots in which two signatures agree."""
    same = F.filter(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p: p["x"] == p["y"])
    return F.size(same) / F.lit(float(slots))


def fingerprints(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """One row per document: its fingerprint, and how like it is to its edited text's and to the next document's.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. Null text is empty. Texts without words share one
    fingerprint (all slots blank) and are wholly like each other. Repeated rows
    are documents of their own. A single document is its own next one. An
    empty table gives no rows.
    """
    rows = in_order(docs)
    text = edited()
    signed = sampled(rows.select("range", "nth", F.col("text").alias("one"), text.alias("two")), slots)
    signed = signed.withColumn("next", F.lead("one").over(W.partitionBy("range").orderBy("nth")))
    facts = rows.where(~F.col("halo")).select("range", "nth", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(text, 256).alias("edited_sha256"))
    return facts.join(signed, ["range", "nth"]).select(
        "doc_id", "n_chars", "edited_sha256",
        F.array_join("one", "").alias("fingerprint"), F.array_join("two", "").alias("edited_fingerprint"),
        likeness(F.col("one"), F.col("two"), slots).alias("near_edited"), likeness(F.col("one"), F.col("next"), slots).alias("near_next"),
    )
