"""Keyed merge of a stored table with a new extract: the latest version of each key stays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import dedup_keep_latest
from ledgerlake.operators.silver import DEDUP_KEYS
from ledgerlake.sources.stored import TableStore


def merge_latest(stored: DataFrame | None, extract: DataFrame, keys: list[str], order_col: str = "load_timestamp") -> DataFrame:
    """One row per key of ``stored`` and ``extract`` together (same columns):
    the newest by ``order_col``. A row that arrives late with an older load
    time loses to what is stored; rows of one load time go by their other
    columns, as text, the largest first, so the result does not depend on the
    order of extracts. Rows with a NULL key part stay, all of them.
    """
    rows = extract if stored is None else stored.unionByName(extract)
    return dedup_keep_latest(rows, keys, order_col)


def merge_into(store: TableStore, table: str, extract: DataFrame) -> DataFrame:
    """Merge an extract of typed Silver rows into the stored ``table`` and
    return its new version. The version is replaced as a whole, so a merge
    that is killed leaves the old one, and repeating a merge changes nothing.
    Readers see the rows that they opened."""
    stored = store.read(table, extract.schema) if store.version(table) else None
    version = store.replace(table, merge_latest(stored, extract, DEDUP_KEYS[table] or ["product_id"]))
    return store.read(table, extract.schema, version)


def replaced_keys(stored: DataFrame, merged: DataFrame, keys: list[str], order_col: str = "load_timestamp") -> DataFrame:
    """Keys whose row in ``merged`` is of another load time than any in ``stored``."""
    before = stored.groupBy(*keys).agg(F.max(order_col).alias("_before"))
    return merged.join(before, keys).filter(F.col(order_col) != F.col("_before")).select(*keys)
