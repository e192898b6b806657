"""Dense positions of rows in an order, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise


def numbered(rows: DataFrame, group: list[str], order: list, name: str) -> DataFrame:
    """``rows`` with ``pos`` (long, from 0): the place of a row among those of its group, in ``order``; and ``n``, how many those are.

    Rows are range-partitioned by group and order, so that a large group is
    split between tasks; a row's place is its place in its range plus the
    sizes of the group's earlier ranges (one small row for each group and
    range). Null group values are a group. Rows that tie in ``order`` are told
    apart by where they stand in the written input, so a great number of equal
    rows is split as well. ``_at``, ``_seq``, ``_part``, ``pos`` and ``n`` must not
    be columns of ``rows``.
    """
    # Written first: the range sample reads it too, and ties must not move if a task is repeated.
    rows = materialise(rows.withColumn("_at", F.monotonically_increasing_id()), f"{name}-rows")
    keys = [*group, *order, "_at"]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_seq", F.monotonically_increasing_id())
    ranged = materialise(ranged.withColumn("_part", F.shiftright("_seq", 33)).drop("_at"), f"{name}-ranges")
    parts = ranged.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    # One row for each range of a group here: its ranges are few, its rows are not.
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    size = F.sum("_n").over(Window.partitionBy(*group))
    parts = parts.select(*[F.col(c).alias(f"_{c}") for c in group], F.col("_part").alias("_range"), shift.alias("_shift"), size.alias("n"))
    same = ranged["_part"] == parts["_range"]
    for c in group:
        same = same & ranged[c].eqNullSafe(parts[f"_{c}"])
    out = ranged.join(parts, same)
    return out.withColumn("pos", F.col("_seq") + F.col("_shift")).drop("_seq", "_part", "_range", "_shift", *[f"_{c}" for c in group])
