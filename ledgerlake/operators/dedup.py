"""Duplicate marking and latest-version selection.

``dedup_flag`` reproduces the reference as written: *every* row of a key
that occurs more than once is flagged (not only the older copies), and
rows with a NULL key part are never flagged.

Plan shape (skew-safe): counts per key are pre-aggregated (map-side partial
aggregation collapses a hot key to one row per task), only keys seen more
than once are kept, and that small key set is left-joined back. AQE picks
broadcast or sort-merge for the join from the measured size of the key set
and splits a hot key's partition on the big side; no single task ever holds
a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DUP_COL = "is_duplicate"
#: Types whose text gives back the value exactly.
TEXT_IS_EXACT = (T.StringType, T.IntegerType, T.LongType, T.BooleanType, T.DateType, T.DecimalType, T.TimestampNTZType)


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys (all parts non-NULL) that occur more than once."""
    not_null = None
    for k in keys:
        c = F.col(k).isNotNull()
        not_null = c if not_null is None else (not_null & c)
    return (
        df.select(*keys)
        .filter(not_null)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .select(*keys, F.lit(1).alias("_dup"))
    )


def dedup_flag(df: DataFrame, keys: list[str], out_col: str = DUP_COL, seen: DataFrame | None = None) -> DataFrame:
    """Add ``out_col`` = 1 for all rows of a duplicated key, else 0. ``seen``,
    if given, holds the keys of the same rows and is cheaper to come by."""
    dups = duplicated_keys(df if seen is None else seen, keys)
    base = df.drop(out_col) if out_col in df.columns else df
    joined = base.join(dups, on=keys, how="left")
    return joined.withColumn(out_col, F.coalesce(F.col("_dup"), F.lit(0))).drop("_dup").select(
        *base.columns, out_col
    )


def dedup_once(df: DataFrame, keys: list[str], out_col: str = DUP_COL) -> DataFrame:
    """The rows that ``dedup_flag`` would mark 0, with that column, for keys without NULL.

    One aggregation instead of a count and a join back, so that ``df`` is built
    once: where a key has one row, the largest value of each column is that row.
    Hot keys are reduced map-side.
    """
    others = [c for c in df.columns if c not in keys and c != out_col]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in others])
    return groups.filter(F.col("_n") == 1).select(*[c for c in df.columns if c != out_col], F.lit(0).alias(out_col))


def dedup_keep_latest(
    df: DataFrame,
    keys: list[str],
    order_col: str = "load_timestamp",
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Keep one row per key: the newest by ``order_col``.

    A batch load gives every row the same load time, so a deterministic
    tie-break over the remaining columns is appended. Rows with a NULL key
    part are kept as they are (they never form a group).

    Plan shape: the winning row per key is chosen with ``max_by`` over a
    struct ordering key, a partial-aggregating reduction - a hot key is
    reduced map-side, so no task sorts a whole group. Where the ordering key
    holds every column, and the text of each gives the value back, it is the
    row: ``max`` of it alone is shuffled, and the values are cast from it.
    """
    tie = tie_break if tie_break is not None else [c for c in df.columns if c not in keys and c != order_col]
    key_null = None
    for k in keys:
        c = F.col(k).isNull()
        key_null = c if key_null is None else (key_null | c)
    others = [c for c in df.columns if c not in keys]
    order = F.struct(
        F.col(order_col).alias("_o"),
        *[F.col(c).cast("string").alias(f"_t{i}") for i, c in enumerate(tie)],
    )
    groups = df.filter(~key_null).groupBy(*keys)
    if set(others) == {order_col, *tie} and all(isinstance(df.schema[c].dataType, TEXT_IS_EXACT) for c in tie):
        winners = groups.agg(F.max(order).alias("_w")).select(*keys, F.col("_w._o").alias(order_col), *[
            F.col(f"_w._t{i}").cast(df.schema[c].dataType).alias(c) for i, c in enumerate(tie)
        ]).select(*df.columns)
    else:
        payload = F.struct(*[F.col(c) for c in others])
        winners = groups.agg(F.max_by(payload, order).alias("_w")).select(*keys, "_w.*").select(*df.columns)
    return winners.unionByName(df.filter(key_null))

