"""Helpers that the operators share: tables, shared scratch tables, hashing."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words in every contract.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD_GAP = r"[\x20\x09-\x0D]+"

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would fold all of Unicode)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: The folder of a local session that names none, by application.
_OWN_FOLDER: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: there
    the driver and the executor are one process and see the same disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        context = spark.sparkContext
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _OWN_FOLDER:
            _OWN_FOLDER[context.applicationId] = tempfile.mkdtemp(prefix="ledgerlake-llm-")
        path = _OWN_FOLDER[context.applicationId]
    return path.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recompute.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, *used: str) -> DataFrame:
    """The ``used`` columns, and all others in one struct ``rest``: their names can clash with nothing."""
    others = [c for c in docs.columns if c not in used]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    return docs.select(*used, rest.alias("rest"))


def unpacked(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Undoes ``packed``: the given columns in their order."""
    return docs.select(*[F.col(c) if c in docs.columns and c != "rest" else F.col("rest")[c].alias(c) for c in columns])


_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element (wraps at 64 bits)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def utf8_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (starting at 0) of an Arrow string column; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def in_slices(batches, rows: int = 256):
    """The batches in slices of so many rows: what is made of a slice is small, whatever a batch holds.

    At the end, memory that Arrow keeps for later goes back to the system:
    Python workers outlive their tasks and share the executor's memory.
    """
    import pyarrow as pa

    try:
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                yield batch.slice(first, rows)
    finally:
        pa.default_memory_pool().release_unused()


def row_blocks(at: np.ndarray, most: int):
    """Ranges of rows of at most ``most`` bytes together (a longer row stands alone)."""
    first = 0
    while first < len(at) - 1:
        last = int(np.searchsorted(at, at[first] + most, side="right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of the first word of each row (and the end)."""
    inside = ~IS_SPACE[raw]
    joined = np.zeros(len(raw), dtype=bool)
    joined[1:] = inside[:-1]
    cut = at[:-1][at[:-1] < len(raw)]
    joined[cut] = False
    starts = np.flatnonzero(inside & ~joined)
    stops = np.zeros(len(raw), dtype=bool)
    stops[:-1] = inside[1:]
    cut = at[1:-1]
    stops[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(inside & ~stops) + 1
    return starts, ends, np.searchsorted(starts, at)


_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of a fixed odd number, modulo 2**64; at least ``n``."""
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.full(max(n, 1024), 0x9E3779B97F4A7C55, np.uint64))
    return _POWERS


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of every word: mixed bytes weighted by powers, summed per word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    first = np.concatenate(([0], np.cumsum(length)[:-1]))
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    code = raw[place + np.repeat(starts, length)]
    if lower:
        code = LOWER[code]
    value = mix64(np.arange(256, dtype=np.uint64) + GOLDEN)[code] * powers(int(length.max()))[place]
    return mix64(np.add.reduceat(value, first) + length.astype(np.uint64) * GOLDEN)
