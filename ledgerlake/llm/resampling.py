"""Importance resampling towards a target: hashed n-grams of joined batches.

A block of texts is joined with a separator that no word holds, and one regex
pass over the joined bytes finds all words. Searching the documents' offsets
for the words' starts says whose each word is, which masks the runs of two or
three words that would cross from one document into the next; what is left is
counted by bucket with ``bincount``. A run's bucket is the crc32 of its bytes,
combined from the crc32 of its words: appending n bytes to a text acts on its
crc32 as a linear map that depends on n alone.

Two passes over the texts: one adds up the buckets of corpus and target, one
weighs each document with the 10,000 gains that follow.
"""

from __future__ import annotations

import re
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise, row_blocks, utf8_parts
from ledgerlake.llm.positions import numbered

BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42

#: Bytes of words (after A-Z are lower-cased), and crc32's polynomial, bits reversed.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
POLYNOMIAL = 0xEDB88320

#: Joined bytes that are worked on at a time; a longer text is cut between words.
_BLOCK = 1 << 19
_SEPARATOR = b"\n"


def _byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(POLYNOMIAL) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


def _append_zeros(c: np.ndarray) -> np.ndarray:
    return _TABLE[c & np.uint32(255)] ^ (c >> np.uint32(8))


def _apply(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The linear map that has ``tables`` (4, 256) for the four bytes of ``c``."""
    out = np.zeros(len(c), np.uint32)
    for k in range(4):
        out ^= tables[k][(c >> np.uint32(8 * k)) & np.uint32(255)]
    return out


_TABLE = _byte_table()
_SHORT = 64


def _shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """The maps for 0 to ``_SHORT`` appended bytes, and for the powers of two above."""
    unit = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]).astype(np.uint32)
    few = [unit]
    for _ in range(_SHORT):
        few.append(_append_zeros(few[-1]))
    many = [few[-1]]  # 64 bytes, 128 bytes, ...
    for _ in range(32):
        many.append(_apply(many[-1], many[-1].ravel()).reshape(4, 256))
    return np.stack(few), np.stack(many)


_FEW, _MANY = _shift_tables()


def append(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 after ``length`` more bytes, less the crc32 of those bytes (to be added with xor)."""
    rest = (length % _SHORT).astype(np.intp)
    out = np.zeros(len(crc), np.uint32)
    for k in range(4):
        out ^= _FEW[rest, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    large = np.flatnonzero(length >= _SHORT)
    times = length[large] // _SHORT
    bit = 0
    while len(large):
        odd = (times & 1).astype(bool)
        out[large[odd]] = _apply(_MANY[bit], out[large[odd]])
        times, bit = times >> 1, bit + 1
        large, times = large[times > 0], times[times > 0]
    return out


def word_crcs(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of each word: byte by byte for all words at once, longer words on their own."""
    raw = np.frombuffer(text, np.uint8)
    length = ends - starts
    order = np.argsort(-np.minimum(length, _SHORT + 1), kind="stable")
    out = np.empty(len(starts), np.uint32)
    long = int((length > _SHORT).sum())
    for k in order[:long]:
        out[k] = zlib.crc32(text[starts[k] : ends[k]])
    order = order[long:]
    first, size = starts[order], length[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for at in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -at))  # the words that have this byte
        crc[:n] = _TABLE[(crc[:n] ^ raw[first[:n] + at]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def _joined(raw: np.ndarray, at: np.ndarray):
    """(rows, joined texts, offset of each text, words of each that were counted before) by blocks.

    A text over the block size comes in pieces cut between words; each piece
    begins with the last two words of the one before, which count only as the
    start of longer runs.
    """
    for a, b in row_blocks(at, _BLOCK):
        if b - a > 1 or at[b] - at[a] <= _BLOCK:
            texts = [raw[at[k] : at[k + 1]].tobytes() for k in range(a, b)]
            offsets = at[a:b] - at[a] + np.arange(b - a)
            yield np.arange(a, b), _SEPARATOR.join(texts).lower(), offsets, np.zeros(b - a, np.int64)
            continue
        text = raw[at[a] : at[b]].tobytes().lower()
        lo, held, size = 0, 0, _BLOCK
        while lo < len(text):
            hi = min(lo + size, len(text))
            while hi < len(text) and WORD.match(text, hi, hi + 1):
                hi += 1
            last = [m.start() for m in WORD.finditer(text, lo, hi)][-(LONGEST_RUN - 1) :] if hi < len(text) else []
            if last and last[0] == lo and hi < len(text):  # a few huge words: take more at a time
                size *= 2
                continue
            yield np.array([a]), text[lo:hi], np.zeros(1, np.int64), np.array([held])
            lo, held, size = (last[0], len(last), _BLOCK) if last else (hi, 0, _BLOCK)


def _features(raw: np.ndarray, at: np.ndarray):
    """(rows, index into rows of each feature, bucket of each feature, words of each row) by blocks."""
    for rows, text, offsets, held in _joined(raw, at):
        spans = np.fromiter((x for m in WORD.finditer(text) for x in m.span()), np.int64)
        starts, ends = spans[::2], spans[1::2]
        owner = np.searchsorted(offsets, starts, side="right") - 1
        length = ends - starts
        word = word_crcs(text, starts, ends)
        # crc32 of a space and the word, to be added behind another one.
        behind = append(np.full(len(word), zlib.crc32(b" "), np.uint32), length) ^ word
        place = np.arange(len(word)) - np.searchsorted(starts, offsets)[owner] if len(word) else np.zeros(0, np.int64)
        who, which, run = [], [], word
        for more in range(LONGEST_RUN):
            if more:
                run = append(run[: len(run) - 1], length[more:] + 1) ^ behind[more:]
            first, last = owner[: len(run)], owner[more:]
            fits = (first == last) & (place[: len(run)] + more >= held[first])
            who.append(first[fits])
            which.append(run[fits] % np.uint32(BUCKETS))
        yield rows, np.concatenate(who), np.concatenate(which), np.bincount(owner[place >= held[owner]], minlength=len(rows))


def _count_batches(batches, column):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, bucket, _ in _features(*utf8_parts(batch.column("text"))):
            total += np.bincount(bucket, minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", column])


def bucket_counts(texts: DataFrame, column: str) -> DataFrame:
    """(bucket, ``column``): how often each bucket's features are in ``texts``; at most ``BUCKETS`` rows."""
    counts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(partial(_count_batches, column=column), f"bucket int, {column} long")
    return counts.groupBy("bucket").agg(F.sum(column).alias(column))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log likelihood ratio of each bucket, rounded down."""
    s, t = corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def _weigh_batches(batches, gain):
    for batch in batches:
        raw, at = utf8_parts(batch.column("text"))
        n, words, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for rows, who, bucket, count in _features(raw, at):
            n[rows] += np.bincount(who, minlength=len(rows))
            words[rows] += count
            weight[rows] += np.bincount(who, gain.value[bucket], len(rows)).astype(np.int64)  # exact: far below 2^53
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(words), pa.array(weight)], ["doc_id", "n_features", "n_words", "weight"])


def _dense(counts: DataFrame, column: str) -> np.ndarray:
    out = np.zeros(BUCKETS, np.int64)
    rows = counts.toPandas()  # a row a bucket
    out[rows["bucket"].to_numpy(np.int64)] = rows[column].to_numpy(np.int64)
    return out


def weights(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_features, n_words, weight) of each row of ``docs``, towards the texts of ``target``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gain = gains(_dense(bucket_counts(docs, "n"), "n"), _dense(bucket_counts(target, "n"), "n"))
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    return docs.mapInArrow(partial(_weigh_batches, gain=shared), "doc_id long, n_features long, n_words long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null: not drawn).

    ``docs`` has doc_id and text, ``target`` text; other columns play no part.

    * Null or empty texts have no features and weight 0. They count as documents
      of no words, which are never drawn.
    * Scores that tie go by smaller doc_id (null last), then by larger weight;
      equal rows draw the same number and take neighbouring ranks.
    * A null doc_id draws the number of the text ``<seed>:``.
    * An empty target leaves the corpus' own counts to weigh; no documents give no rows.
    """
    rows = weights(docs, target)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform)))
    rows = rows.select("doc_id", "n_features", "weight", score.alias("score"), (F.col("n_words") < min_words).alias("short"))
    order = ["short", F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight")]
    rows = materialise(numbered(rows.withColumn("g", F.lit(0)), ["g"], order, "resampling"), "resampling")
    able = rows.where(~F.col("short")).count()
    rank = F.when(F.col("pos") < percent * able // 100, F.col("pos") + 1)
    return rows.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
