"""Equal neighbours in a sorted order: which rows share their key with another row."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import materialise


def _marked(rows: pa.RecordBatch, before: np.ndarray, after: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
    columns = [*rows.columns, pa.array(before | after), pa.array(~before), pa.array(edge)]
    return pa.RecordBatch.from_arrays(columns, [*rows.schema.names, "repeated", "first", "edge"])


def _mark_batches(batches, keys):
    """Rows of one range in order, each with what its neighbours say; the last row waits for the next batch."""
    held, held_same, held_edge = None, False, True
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        same = np.zeros(rows.num_rows, bool)  # as the row before
        if rows.num_rows > 1:
            equal = np.ones(rows.num_rows - 1, bool)
            for k in keys:
                v = rows.column(k).to_numpy()
                equal &= v[1:] == v[:-1]
            same[1:] = equal
        same[0] = held_same
        edge = np.zeros(rows.num_rows, bool)
        edge[0] = held_edge
        n = rows.num_rows - 1
        if n:
            yield _marked(rows.slice(0, n), same[:-1], same[1:], edge[:-1])
            held_edge = False
        held, held_same = rows.slice(n, 1), bool(same[n])
    if held is not None:
        yield _marked(held, np.array([held_same]), np.array([False]), np.array([True]))


def repeated(rows: DataFrame, keys: list[str], rest: list[str], name: str, wanted: str = "true", keep: dict | None = None) -> DataFrame:
    """``rows`` with ``repeated`` (another row has its key) and ``first`` (a first of its key; at least one each).

    ``keys`` are long columns without nulls, ``rest`` columns that spread the
    rows of one key over ranges. Rows are sorted by both in ranges, where equal
    keys are neighbours, so that a key of any number of rows is many tasks'
    work. The first and last key of each range are settled afterwards.

    ``wanted`` is a condition on the two flags: only such rows are returned. A
    key column comes back as null except where its condition in ``keep`` holds
    or the row is at the edge of a range, so that what is written stays small.
    The range sample computes ``rows`` once more; they must come out alike.
    """
    order = [*keys, *rest]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, T.BooleanType()) for c in ("repeated", "first", "edge")]])
    marked = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(partial(_mark_batches, keys=keys), schema)
    slim = [F.when(F.expr(f"edge or ({(keep or {}).get(c, 'false')})"), F.col(c)).alias(c) if c in keys else F.col(c) for c in marked.columns]
    marked = materialise(marked.where(f"edge or ({wanted})").select(*slim), name)
    # Two rows for each range at most, at any size of the input.
    cut = marked.where("edge").groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n").withColumn("_cut", F.lit(True))
    marked = marked.join(F.broadcast(cut), keys, "left")
    return marked.withColumn("repeated", F.col("repeated") | F.coalesce("_cut", F.lit(False))).drop("_cut", "edge").where(wanted)
