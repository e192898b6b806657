"""Distributed ranking over the whole frame (no single-partition window).

``global_rank`` gives SQL ``RANK() OVER (ORDER BY value DESC)``:

1. count the rows of each distinct value: a value that very many rows share
   (NULL, or a common price) shrinks to one row before any shuffle;
2. put the distinct values into buckets by approximate quantiles. The bucket
   is an expression on the value, so that a value is always in one bucket;
3. a value's rank is one plus the rows of earlier buckets plus the rows of
   earlier values in its bucket; both are running sums over small windows;
4. join the ranks back to the rows on the value (null-safe). The planner
   broadcasts them if they are few, else AQE splits a hot value's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def global_rank(df: DataFrame, value: str, out_col: str = "rank", descending: bool = True,
                partitions: int | None = None) -> DataFrame:
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = F.col("_value")
    counts = df.groupBy(F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    cuts = counts.agg(F.percentile_approx("_value", [k / n for k in range(1, n)] or [0.5], 100 * n)).scalar()
    counts = counts.withColumn("_cuts", cuts)  # one array of n values, the same for all
    before = F.size(F.filter("_cuts", (lambda c: c > v) if descending else (lambda c: c < v)))
    # NULL values come last; without any value there are no cuts.
    bucket = F.when(v.isNull(), F.lit(n + 1)).otherwise(F.greatest(F.coalesce(before, F.lit(0)), F.lit(0)))
    counts = counts.withColumn("_bucket", bucket).drop("_cuts")
    order = v.desc_nulls_last() if descending else v.asc_nulls_last()
    earlier = (Window.unboundedPreceding, -1)
    inside = F.sum("_n").over(Window.partitionBy("_bucket").orderBy(order).rowsBetween(*earlier))
    # One row per bucket, so a bounded window; a handful of longs to broadcast.
    totals = counts.groupBy("_bucket").agg(F.sum("_n").alias("_total"))
    offsets = totals.select("_bucket", F.sum("_total").over(Window.orderBy("_bucket").rowsBetween(*earlier)).alias("_off"))
    zero = F.lit(0)
    ranks = counts.withColumn("_inside", inside).join(F.broadcast(offsets), "_bucket").select(
        "_value", (F.coalesce("_off", zero) + F.coalesce("_inside", zero) + 1).cast("bigint").alias("_rank"))
    ranked = df.join(ranks, df[value].eqNullSafe(ranks["_value"]))
    return ranked.select(*[df[c] for c in df.columns if c != out_col], F.col("_rank").alias(out_col))


def percent_rank(df: DataFrame, value: str, out_col: str = "pct_rank", descending: bool = False) -> DataFrame:
    """PERCENT_RANK() OVER (ORDER BY value): (rank - 1) / (rows - 1), exact to
    4 decimals, 0 for a single row."""
    from ledgerlake.functions.ratios import ratio

    ranked = global_rank(df, value, "_rk", descending=descending)
    total = df.agg(F.count(F.lit(1))).scalar()
    pr = F.when(total > 1, ratio(F.col("_rk") - 1, total - 1, 4)).otherwise(F.lit(0.0))
    return ranked.withColumn(out_col, pr).drop("_rk")
