"""Line dedup: range-partitioned line hashes, streamed in order, giving bitmaps.

Every line key of a document becomes one small row (128-bit hash, document,
position). The rows are range-partitioned and sorted by hash, then document
(largest first), then position. A hot line's range is simply split between
tasks, since the document is part of the range key. Each task streams its
rows once, holding the rows of at most ``min_docs - 1`` documents. Only runs
that touch the edge of a task need more: they are settled by counting over
those edge keys, two per task at most. Texts do not travel through the sort;
the result is one compressed keep bitmap per document that loses lines.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import LOWER, SPACES, in_slices, materialise, packed, unpacked

MIN_CHARS = 40
MIN_DOCS = 5

_GAP = bytes(SPACES)
_LOWER = LOWER.tobytes()
_LINES = "h1 long, h2 long, doc_id long, text_key long, pos int, n_lines int"
_RUNS = "kind int, " + _LINES
_DROP, _OPEN, _SEEN = 0, 1, 2


def line_key(line: bytes) -> bytes:
    return line.strip(_GAP).translate(_LOWER)


def _text_key(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("text", text).withColumn("text_key", F.xxhash64(text))


def _arrow(rows: list, schema: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema)


_ROW_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
_ROW_NAMES = ["h1", "h2", "doc_id", "text_key", "pos", "n_lines"]


def _line_batches(batches, min_chars: int):
    for batch in in_slices(batches):
        rows = []
        for doc, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))):
            lines = text.encode().split(b"\n")
            for pos, line in enumerate(lines):
                if len(line) >= min_chars and len(k := line_key(line)) >= min_chars and len(k.decode()) >= min_chars:
                    h = hashlib.blake2b(k, digest_size=16).digest()
                    rows.append((int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), doc, key, pos, len(lines)))
            if len(rows) >= 20_000:
                yield _arrow(rows, _ROW_NAMES, _ROW_TYPES)
                rows = []
        yield _arrow(rows, _ROW_NAMES, _ROW_TYPES)


def _stream_runs(batches, min_docs: int):
    """Rows of one range in order -> settled drops, and what the range's edges leave open."""
    out, names, types = [], ["kind", *_ROW_NAMES], [pa.int32(), *_ROW_TYPES]
    key, first_run = None, True
    held: list = []  # rows of the run's documents while they are fewer than min_docs
    docs = 0
    last = ()
    seen: list = []  # one row for each of the first min_docs documents

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in _ROW_NAMES)):
            if row[:2] != key:
                first_run = key is None
                key, held, docs, last, seen = row[:2], [], 0, (), []
            if last != (row[2],):
                last, docs = (row[2],), docs + 1
                if docs <= min_docs:
                    seen.append(row)
            if first_run:
                out.append((_OPEN, *row))
            elif docs < min_docs:
                held.append(row)
            else:
                if held:
                    out += [(_DROP, *r) for r in held if r[2] != seen[0][2]]
                    held = []
                out.append((_DROP, *row))
            if len(out) >= 20_000:
                yield _arrow(out, names, types)
                out = []
    if key is not None and not first_run:  # the last run may go on in the next range
        out += [(_OPEN, *r) for r in held] if docs < min_docs else [(_SEEN, *r) for r in seen]
    yield _arrow(out, names, types)


def _pack(batches):
    for batch in batches:
        maps, dropped = [], []
        for n, drop in zip(batch.column("n_lines").to_pylist(), batch.column("drop").to_pylist()):
            keep = np.ones(n, bool)
            keep[drop] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
            dropped.append(len(drop))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(batch.column("n_lines").to_pylist(), pa.int64()), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())],
            ["doc_id", "text_key", "n_lines", "n_dropped", "keep"],
        )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_key, n_lines, n_dropped, keep) of every document that loses lines.

    ``keep`` is a zlib-compressed bitmap, one bit a line (1: stays), first line
    in the highest bit; ``text_key`` is xxhash64 of the text, which tells rows
    that share a doc_id apart.

    * A line's key is the line without outer white space, A-Z lower-cased.
      Keys of ``min_chars`` code points in ``min_docs`` documents or more lose
      all lines except those of the largest doc_id that holds the key.
    * Null text is one empty line. Rows that share a doc_id are one document
      when documents are counted; null doc_ids together are one document, the
      smallest. Equal rows have equal bitmaps. An empty table gives no rows.
    """
    docs = _text_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    lines = materialise(docs.mapInArrow(partial(_line_batches, min_chars=min_chars), _LINES), "lines")
    order = ["h1", "h2", F.col("doc_id").desc_nulls_last(), "text_key", "pos"]
    runs = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = materialise(runs.mapInArrow(partial(_stream_runs, min_docs=min_docs), _RUNS), "runs")
    edge = runs.where(F.col("kind") != _DROP).groupBy("h1", "h2", "doc_id").agg(F.count("*").alias("n"))
    edge = edge.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("largest")).where(F.col("docs") >= min_docs)
    # At most two keys per range partition: small at any size of the input.
    late = runs.where(F.col("kind") == _OPEN).join(F.broadcast(edge), ["h1", "h2"])
    late = late.where(~F.col("doc_id").eqNullSafe(F.col("largest")))
    what = ["doc_id", "text_key", "n_lines", "pos"]
    drops = runs.where(F.col("kind") == _DROP).select(what).union(late.select(what))
    drops = drops.groupBy("doc_id", "text_key", "n_lines").agg(F.collect_set("pos").alias("drop"))
    return drops.mapInArrow(_pack, "doc_id long, text_key long, n_lines long, n_dropped long, keep binary")


def kept_text(text: str, keep: bytes | None) -> str:
    if keep is None:
        return text
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines)).tolist()
    return "\n".join(line for line, bit in zip(lines, bits) if bit)


def with_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (doc_id, text and ``rest``; null text as empty) with ``n_dropped`` and ``keep`` (null: every line stays)."""
    maps = keep_bitmaps(docs, min_chars, min_docs)
    maps = maps.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "n_dropped", "keep")
    docs = _text_key(docs)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key"))
    return docs.join(maps, same, "left").drop("_doc", "_key", "text_key")


def _digests(batches):
    for batch in in_slices(batches):
        total, dropped, sha = [], [], []
        for text, n, keep in zip(*(batch.column(c).to_pylist() for c in ("text", "n_dropped", "keep"))):
            total.append(text.count("\n") + 1)
            dropped.append(n or 0)
            sha.append(hashlib.sha256(kept_text(text, keep).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(sha, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )


def line_digests(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_sha256.

    Null text is one empty line; repeated rows lose the same lines (see
    ``keep_bitmaps``); an empty table gives no rows.
    """
    out = with_bitmaps(docs.select("doc_id", "text"))
    return out.mapInArrow(_digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def _rewrite(batches):
    for batch in in_slices(batches):
        texts = [kept_text(t, k) for t, k in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), batch.column("rest")], ["doc_id", "text", "rest"])


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``; all columns and rows stay (null text becomes empty)."""
    rows = packed(docs, "doc_id", "text")
    return unpacked(with_bitmaps(rows, min_chars, min_docs).mapInArrow(_rewrite, rows.schema), docs.columns)
