"""Removal of long repeats by prefix-free parsing.

Every run of ``window`` neighbouring positions has a trigger: the position
where the rolling hash of the next few bytes is smallest. Triggers depend on
the bytes near them alone, so equal strings are parsed alike wherever they
are. A phrase belongs to a trigger: it holds all strings of ``length`` bytes
whose first trigger this is, so phrases overlap by that length, and two equal
strings of ``length`` bytes always start at the same distance before a trigger
of an equal phrase part. Order to ``length`` bytes, all that the question
needs, is therefore the order of the dictionary's suffixes together with how
often the parse has each phrase.

1. Parse: each phrase as (text, trigger, extent, hash of the bytes that every
   string of the phrase has in common). Phrases for which these are found
   nowhere else hold no repeat and go no further.
2. Dictionary: the phrases left, in the order of their digests. A phrase that
   the parse has twice or more is repeated as a whole, suffixes and all.
3. Suffixes of the dictionary: where phrases share the common bytes but are
   not all alike, their suffixes, cut to ``length`` bytes, are brought in the
   order of digests; equal neighbours are repeats that cover a phrase in part.
4. The covered bytes of each text are the union of what 2 and 3 found.

Texts are compressed and bucketed once; all joins with them move only phrases.
A phrase is known by 64 bits of its common bytes and 64 bits of the whole.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import GOLDEN, mix64, row_blocks, shared_folder, utf8_parts
from ledgerlake.llm.neighbours import repeated

LENGTH = 200

_BLOCK = 1 << 19
#: A phrase is one number: place of the trigger, then its distance from the first and the last start, in so many bits each.
_BITS = 12
_LOW = np.uint64((1 << 21) - 1)  # block and length fit into so many positions
_BASE = 0x9E3779B97F4A7C55
_BYTE = mix64(np.arange(256, dtype=np.uint64) + GOLDEN)


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(_LOW), base, np.uint64))))


_POWER: list[np.ndarray] = []


def shape(length: int) -> tuple[int, int]:
    """(bytes that a trigger hashes, positions of which one is a trigger): both within any string of ``length`` bytes."""
    width = max(1, min(16, length // 3))
    window = 1
    while 2 * window + width - 1 <= length and window < 1 << _BITS:
        window *= 2
    return width, window


def triggers(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First trigger of each string of ``length`` bytes, and the hash of the bytes behind it that all strings with that distance or less hold."""
    width, window = shape(length)
    if not _POWER:  # made once for each worker
        _POWER.extend((_powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))))
    power, inverse = _POWER
    n = len(raw)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[:n], out=total[1:])
    value = mix64((total[width:] - total[:-width]) * inverse[: n - width + 1])
    # The smaller position loses a tie: the last of equal hashes is the trigger.
    least = (value & ~_LOW) | (_LOW - np.arange(len(value), dtype=np.uint64))
    step = 1
    while step < window:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    at = (_LOW - (least[: n - length + 1] & _LOW)).astype(np.int64)
    common = length - window + 1
    shared = mix64((total[at + common] - total[at]) * inverse[at])
    return at, shared.view(np.int64)


def _blocks(at: np.ndarray, length: int):
    """(rows, first and last byte, starts of the strings to look at, from the first byte) by blocks; a long text is several."""
    for a, b in row_blocks(at, _BLOCK):
        lo = int(at[a])
        while lo < at[b]:
            hi = int(at[b]) if b - a > 1 else min(int(at[b]), lo + _BLOCK + length - 1)
            inside = np.zeros(hi - lo, bool)
            for row in range(a, b):
                inside[max(int(at[row]) - lo, 0) : max(min(int(at[row + 1]), hi) - length + 1 - lo, 0)] = True
            if hi - lo >= length:
                yield (a, b), lo, hi, np.flatnonzero(inside)
            lo = hi if hi == at[b] else hi - length + 1


def _packed(at, most, least) -> np.ndarray:
    return (np.asarray(at, np.int64) << (2 * _BITS)) | (np.asarray(most, np.int64) << _BITS) | np.asarray(least, np.int64)


def _unpacked(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mask = (1 << _BITS) - 1
    return part >> (2 * _BITS), (part >> _BITS) & mask, part & mask


_PARSE = "row long, part long, common long"


def _parse_batches(batches, length):
    for batch in batches:
        raw, at = utf8_parts(_texts(batch))
        ids = batch.column("row").to_numpy()
        for _, lo, hi, starts in _blocks(at, length):
            if not len(starts):
                continue
            trigger, common = triggers(raw[lo:hi], length)
            trigger, common = trigger[starts], common[starts]
            new = np.ones(len(starts), bool)
            new[1:] = (trigger[1:] != trigger[:-1]) | (starts[1:] != starts[:-1] + 1)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(starts)) - 1
            row = np.searchsorted(at, starts[first] + lo, side="right") - 1
            part = _packed(trigger[first] + lo - at[row], trigger[first] - starts[first], trigger[first] - starts[last])
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(part), pa.array(common[first])], ["row", "part", "common"])


def _texts(batch) -> pa.Array:
    """The texts of a batch of the bucketed table."""
    read = zstandard.ZstdDecompressor()
    return pa.array([read.decompress(t) for t in batch.column("packed").to_pylist()], pa.binary()).cast(pa.string())


def _digests(strings: list[bytes]) -> np.ndarray:
    joined = b"".join(hashlib.blake2b(s, digest_size=8).digest() for s in strings)
    return np.frombuffer(joined, np.int64)


def _lists(batch) -> tuple[np.ndarray, np.ndarray]:
    """Index of the batch's row for each entry of its lists of parts, and the entries."""
    column = batch.column("parts")
    return np.repeat(np.arange(len(column)), pc.fill_null(pc.list_value_length(column), 0).to_numpy()), column.flatten().to_numpy()


def _phrases(batch):
    """(bytes of the text, row, place of the trigger, most, least) of each phrase."""
    row, part = _lists(batch)
    ids = batch.column("row").to_pylist()
    read, owner, text = zstandard.ZstdDecompressor(), -1, b""
    packed = batch.column("packed")
    for r, at, most, least in zip(row.tolist(), *(x.tolist() for x in _unpacked(part))):
        if r != owner:
            owner, text = r, read.decompress(packed[r].as_py())
        yield text, ids[r], at, most, least


_KEYED = "row long, part long, common long, h long"


def _keyed(rows, parts, commons, strings) -> pa.RecordBatch:
    columns = [pa.array(rows, pa.int64()), pa.array(parts, pa.int64()), pa.array(commons, pa.int64()), pa.array(_digests(strings))]
    return pa.RecordBatch.from_arrays(columns, ["row", "part", "common", "h"])


def _phrase_batches(batches, length):
    """Key of each phrase: digests of the bytes all its strings hold, and of the whole."""
    _, window = shape(length)
    for batch in batches:
        rows, strings, commons = [], [], []
        for text, row, at, most, least in _phrases(batch):
            rows.append(row)
            strings.append(text[at - most : at - least + length])
            commons.append(text[at : at + length - window + 1])
        yield _keyed(rows, _lists(batch)[1], _digests(commons), strings)


def _suffix_batches(batches, length):
    """Key of each suffix, cut to ``length``; its part is the start, and 1 in the lowest bit if its phrase is open."""
    _, window = shape(length)
    for batch in batches:
        rows, parts, commons, strings = [], [], [], []
        for text, row, at, most, least in _phrases(batch):
            at, is_open = at >> 1, at & 1
            common = int(_digests([text[at : at + length - window + 1]])[0])
            for start in range(at - most, at - least + 1):
                parts.append(2 * start + is_open)
                strings.append(text[start : start + length])
            rows += [row] * (most - least + 1)
            commons += [common] * (most - least + 1)
            if len(rows) > 50_000:
                yield _keyed(rows, parts, commons, strings)
                rows, parts, commons, strings = [], [], [], []
        yield _keyed(rows, parts, commons, strings)


def _union(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs that the intervals cover together."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    cut = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    return list(zip(start[cut].tolist(), end[np.append(cut[1:], len(start)) - 1].tolist())) if len(start) else []


_KEPT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _kept_batches(batches):
    for batch in batches:
        row, part = _lists(batch)
        bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
        read = zstandard.ZstdDecompressor()
        sizes, spans, kept = [], [], []
        for k, packed in enumerate(batch.column("packed").to_pylist()):
            raw = read.decompress(packed)
            own = part[bounds[k] : bounds[k + 1]]
            runs = _union(own >> 32, own & 0xFFFFFFFF)
            inner = [0, *[x for run in runs for x in run], len(raw)]
            sizes.append(len(raw))
            spans.append([{"start": a, "end": b} for a, b in runs])
            kept.append(b"".join(raw[a:b] for a, b in zip(inner[::2], inner[1::2])))
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])


def _pack_batches(batches):
    write = zstandard.ZstdCompressor(3)
    for batch in batches:
        packed = [write.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(packed, pa.binary())], ["row", "doc_id", "packed"])


def _bucketed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, packed) as a table bucketed by ``row``, a number of its own for each row of ``docs``; texts are compressed."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"prefix_free_{uuid.uuid4().hex}"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(_pack_batches, "row long, doc_id long, packed binary").repartition(buckets, "row")
    rows.write.bucketBy(buckets, "row").option("path", f"{shared_folder(spark)}/llm/{name}").saveAsTable(name)
    return spark.table(name)


def _with_text(texts: DataFrame, parts: DataFrame, how: str = "inner") -> DataFrame:
    """``texts`` with the list of their ``parts`` (row, part). Only the parts are shuffled, to the buckets of the texts."""
    return texts.join(parts.groupBy("row").agg(F.collect_list("part").alias("parts")).hint("merge"), "row", how)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (removed runs of bytes), kept (the bytes that stay).

    Each byte goes that a string of ``length`` bytes covers which also starts
    anywhere else in ``docs``, in the same text included; overlaps count.

    * Null texts are empty; texts shorter than ``length`` lose nothing.
    * Every row is a text of its own, whatever its doc_id (null, or one that
      other rows have): rows with equal texts lose them, all of them.
    * An empty table gives no rows. Columns beyond doc_id and text play no part.
    """
    texts = _bucketed(docs)
    parse = texts.mapInArrow(partial(_parse_batches, length=length), _PARSE)
    parse = repeated(parse, ["common"], ["row", "part"], "parse", "repeated")

    phrases = _with_text(texts, parse).mapInArrow(partial(_phrase_batches, length=length), _KEYED)
    phrases = repeated(phrases, ["common", "h"], ["row", "part"], "dictionary", keep={"common": "first or not repeated"})

    # Phrases that are alone in their whole extent, and one of each other phrase with the same common bytes.
    unsettled = phrases.where("not repeated").select("common").distinct()
    parts = phrases.where("first or not repeated").join(unsettled, "common", "left_semi")
    place, rest = F.shiftright("part", 2 * _BITS), F.col("part") % (1 << 2 * _BITS)
    is_open = F.when(F.col("repeated"), 0).otherwise(1)
    parts = parts.select("row", (F.shiftleft(place * 2 + is_open, 2 * _BITS) + rest).alias("part"))
    suffixes = _with_text(texts, parts).mapInArrow(partial(_suffix_batches, length=length), _KEYED)
    suffixes = repeated(suffixes, ["common", "h"], ["row", "part"], "suffixes", "repeated and part % 2 = 1")

    most, least = F.shiftright("part", _BITS) % (1 << _BITS), F.col("part") % (1 << _BITS)
    covered = phrases.where("repeated").select("row", (place - most).alias("start"), (place - least + length).alias("end"))
    start = F.shiftright("part", 1)
    covered = covered.union(suffixes.select("row", start.alias("start"), (start + length).alias("end")))
    covered = covered.select("row", (F.shiftleft("start", 32) + F.col("end")).alias("part"))
    return _with_text(texts, covered, "left").mapInArrow(_kept_batches, _KEPT)


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (see ``remove_repeats``)."""
    out = remove_repeats(docs, length)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
