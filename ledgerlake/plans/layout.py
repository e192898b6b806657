"""Silver headers, lines and returns laid out together by their header key.

``lay_out`` writes the tables of a family (POS: headers, lines, returns by
transaction id; e-commerce: headers and lines by order id) into the same number
of buckets of that key. One shuffle a table, at the write, then serves
duplicate marking of headers and POS lines, the line-header joins and the join
of returns with their headers: none of them shuffles by the key again.

A bucket is one task, so a key must not fill one. Keys with more rows than a
mean bucket (at most ``buckets`` of them a table), and rows without a key, stay
out of the buckets: they are written beside them and go through the ordinary
joins, which Spark may split. The two parts share no key, so every table and
fact is the union of both.
"""

from __future__ import annotations

import os
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators import gold, silver
from ledgerlake.plans.warehouse import Warehouse, run_all

# The header key of each family, and the tables that carry it.
FAMILIES = {
    "transaction_id": ["pos_transactions", "pos_items", "returns"],
    "order_id": ["ecom_orders", "ecom_items"],
}
FACTS = ["fact_pos_transactions", "fact_ecom_orders", "fact_sales_items", "fact_returns"]
# A key with fewer rows than this is never kept out of its bucket.
LEAST_HOT = 10_000


def _marked_by(table: str, key: str) -> bool:
    """Whether rows that are copies of each other have the same header key."""
    return key in silver.DEDUP_KEYS[table]


def mark_in_place(df: DataFrame, keys: list[str]) -> DataFrame:
    """``dedup_flag`` by a window, for rows that lie together by one of ``keys`` already.

    The rows of a key must be bounded, as they are in the buckets.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn("is_duplicate", F.when(whole & (n > 1), 1).otherwise(0))


def hot_keys(frames: list[DataFrame], key: str, buckets: int, least: int = LEAST_HOT) -> DataFrame:
    """Keys with more rows in one of the frames than a mean bucket of it: at most ``buckets`` a frame."""
    found = []
    for df in frames:
        rows = df.select(key).filter(F.col(key).isNotNull())
        most = max(rows.count() // buckets, least)
        found.append(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select(key))
    return reduce(DataFrame.unionByName, found).distinct()


class LaidOut:
    """Two warehouses without a key in common: ``bucketed`` and ``spread``."""

    def __init__(self, bucketed: Warehouse, spread: Warehouse):
        self.bucketed, self.spread = bucketed, spread

    def silver(self, table: str) -> DataFrame:
        return self.bucketed.silver(table).unionByName(self.spread.silver(table))

    def gold(self, name: str) -> DataFrame:
        return self.bucketed_fact(name).unionByName(self.spread.gold(name))

    def bucketed_fact(self, name: str) -> DataFrame:
        w = self.bucketed
        if name == "fact_sales_items":
            return gold.fact_sales_items(
                w.silver("pos_items"), w.silver("pos_transactions"), w.silver("ecom_items"), w.silver("ecom_orders"),
                w.dim_product(), w.dim_store(), w.dim_date(), lines_first=True,
            )
        if name == "fact_returns":
            return gold.fact_returns(
                w.silver("returns"), w.silver("pos_transactions"), w.dim_product(), w.dim_store(), w.dim_date(),
                header_first=True,
            )
        return w.gold(name)


def lay_out(w: Warehouse, path: str, database: str, buckets: int, least_hot: int = LEAST_HOT) -> LaidOut:
    """Write the families of ``w`` below ``path`` in ``buckets`` buckets, named in ``database``; return them as read.

    Copies of headers and POS lines are marked when they are read. Returns and
    e-commerce lines repeat by an id of their own, so theirs are marked before.
    Tables that are there are replaced. ``buckets`` follows from the largest
    table: about its bytes over 128 MB.
    """
    spark = w.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{path}'")
    key_of = {t: key for key, tables in FAMILIES.items() for t in tables}
    typed = {t: silver.accepted(w.silver_typed(t), t) for t in key_of}
    rows = {t: typed[t] if _marked_by(t, key) else w.silver(t) for t, key in key_of.items()}

    def write_hot(key: str) -> None:
        found = hot_keys([typed[t] for t in FAMILIES[key]], key, buckets, least_hot)
        found.write.mode("overwrite").parquet(os.path.join(path, "hot_keys", key))

    def split(t: str) -> tuple[DataFrame, Column]:
        key = key_of[t]
        hot = spark.read.schema(typed[t].select(key).schema).parquet(os.path.join(path, "hot_keys", key))
        hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))  # at most ``buckets`` keys for each table of the family
        return rows[t].join(hot, key, "left"), F.col("_hot").isNotNull() | F.col(key).isNull()

    def write_spread(t: str) -> None:
        both, apart = split(t)
        both.filter(apart).select(rows[t].columns).write.mode("overwrite").parquet(os.path.join(path, "spread", t))

    def write_bucketed(t: str) -> None:
        # Spark deals rows to partitions and to buckets by the same hash: one file a bucket.
        both, apart = split(t)
        out = both.filter(~apart).select(rows[t].columns).repartition(buckets, key_of[t]).write.mode("overwrite")
        out = out.format("parquet").option("path", os.path.join(path, "bucketed", t))
        out.bucketBy(buckets, key_of[t]).sortBy(key_of[t]).saveAsTable(f"`{database}`.`{t}`")

    run_all([partial(write_hot, key) for key in FAMILIES])
    run_all([partial(write, t) for t in key_of for write in (write_bucketed, write_spread)])
    bucketed, spread = {}, {}
    for t, key in key_of.items():
        together, aside = spark.table(f"`{database}`.`{t}`"), spark.read.schema(rows[t].schema).parquet(os.path.join(path, "spread", t))
        if _marked_by(t, key):
            keys = silver.DEDUP_KEYS[t]
            together = silver.lineage_last(mark_in_place(together, keys))
            aside = silver.lineage_last(silver.dedup_flag(aside, keys))
        bucketed[f"silver_{t}"], spread[f"silver_{t}"] = together, aside
    dims = {n: w.gold(n) for n in ("dim_product", "dim_store", "dim_date")}
    return LaidOut(*[Warehouse(spark, None, w.date_range, {**dims, **part}) for part in (bucketed, spread)])
