"""Surrogate keys that last: dense numbers, kept in a table from load to load.

A dimension row is known by its natural key and, where that repeats, by its
place among the copies. Keys seen before keep their number, whatever else of
the row has changed; new ones go on from the largest number given so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import checkpoint_dir
from ledgerlake.sources.stored import TableStore


def dense_numbers(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with ``out``: 1, 2, 3, ... in ``order``, without one sort of all rows.

    Rows are range-partitioned and sorted within ranges, and kept by a
    checkpoint; a row's number is its place in its range plus the sizes of the
    ranges before it, of which there is one small row each.
    """
    checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_seq", F.monotonically_increasing_id()).checkpoint()
    ranged = ranged.withColumn("_range", F.shiftright("_seq", 33))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = sizes.select("_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return ranged.join(F.broadcast(sizes), "_range").withColumn(out, F.col("_seq") + F.col("_shift")).drop("_seq", "_range", "_shift")


def _key_schema(df: DataFrame, natural: str) -> T.StructType:
    return T.StructType([T.StructField("natural_key", df.schema[natural].dataType), T.StructField("copy", T.LongType()), T.StructField("number", T.LongType())])


def with_identities(store: TableStore, name: str, df: DataFrame, natural: str, key: str) -> DataFrame:
    """``df`` with numbers of table ``name`` in place of column ``key``.

    ``natural`` is the natural key, not null. The table of numbers is replaced
    as a whole once all new ones are given: a load that is killed before gives
    none, and a load that is repeated gives the same.
    """
    schema = _key_schema(df, natural)
    content = F.xxhash64(*[F.col(c) for c in df.columns if c != key])
    rows = dense_numbers(df.withColumn("_content", content), [natural, "_content"], "_place")
    first = rows.groupBy(natural).agg(F.min("_place").alias("_first"))
    rows = rows.join(first, natural).withColumn("copy", F.col("_place") - F.col("_first"))

    known = None
    if store.version(name):
        known = store.read(name, schema)
    wanted = rows.select(F.col(natural).alias("natural_key"), "copy")
    new = wanted if known is None else wanted.join(known, ["natural_key", "copy"], "left_anti")
    last = 0 if known is None else known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    new = dense_numbers(new, ["natural_key", "copy"], "number").withColumn("number", F.col("number") + last)
    numbers = new if known is None else known.unionByName(new)
    version = store.replace(name, numbers.select(*schema.names))

    numbers = store.read(name, schema, version).withColumnRenamed("natural_key", natural)
    out = rows.join(numbers, [natural, "copy"]).withColumn(key, F.col("number"))
    return out.select(*df.columns)
