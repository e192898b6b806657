"""Toxicity: character n-gram linear classifier on naive Bayes log-count ratios.

Features are hashed n-grams of the lower-cased bytes (white space as one
space), present or not. For each feature f, over all labelled training rows,

    r_f = log( (docs_toxic(f) + a) / (toxic + 2a) ) - log( (docs_clean(f) + a) / (clean + 2a) )

A logistic model is then fitted on the inputs r_f * present(f), on a bounded
sample of the training rows. Its weights times r_f are one vector of fixed
size that goes to every executor; scoring reads each whole text once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import GOLDEN, IS_SPACE, LOWER, in_slices, materialise, mix64, row_blocks, utf8_parts

ORDERS = (4, 5)
BITS = 20
SMOOTHING = 1.0
#: Features of the linear model: those with the largest likelihood ratio.
FEATURES = 1 << 12
#: Rows the linear model is fitted on, at most (smallest hash of the id first), half of them toxic if there are so many.
SAMPLE_ROWS = 4_000
#: Label rows up to which the labels are sent to the scan instead of shuffling the texts.
BROADCAST_LABELS = 1_000_000
#: Bytes of text that are worked on at a time (a longer text stands alone).
_BLOCK = 1 << 18
_FOLD = LOWER.copy()
_FOLD[IS_SPACE] = 0x20


@dataclass
class Model:
    weights: np.ndarray  # by feature: r_f times the linear weight
    bias: float
    orders: tuple = ORDERS
    bits: int = BITS


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts`` (null id: as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def ngrams(raw: np.ndarray, orders=ORDERS, bits: int = BITS) -> list[np.ndarray]:
    """The feature at each byte, for each order (shorter by order - 1)."""
    code = mix64(np.arange(256, dtype=np.uint64) + GOLDEN)[_FOLD[raw]]
    out, value, size = [], np.zeros(len(raw), np.uint64), 0
    for order in orders:
        while size < order:
            size += 1
            n = max(len(raw) - size + 1, 0)
            value = value[:n] * np.uint64(0x9E3779B97F4A7C55) + code[size - 1 : size - 1 + n]
        out.append(((mix64(value + np.uint64(order))) >> np.uint64(64 - bits)).astype(np.int32))
    return out


def _each_doc(texts, orders, bits):
    """(row, features with repeats) of each of an Arrow column of texts."""
    raw, at = utf8_parts(texts)
    for a, b in row_blocks(at, _BLOCK):
        grams = ngrams(raw[at[a] : at[b]], orders, bits)
        for row in range(a, b):
            lo, hi = at[row] - at[a], at[row + 1] - at[a]
            yield row, np.concatenate([g[lo : max(hi - n + 1, lo)] for g, n in zip(grams, orders)])


def _distinct(values: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    order = np.arange(len(values), dtype=np.int32)
    scratch[values] = order
    return values[scratch[values] == order]


def _count_batches(batches, orders, bits):
    count = np.zeros((2, 1 << bits), np.int32)
    scratch = np.zeros(1 << bits, np.int32)
    docs = [0, 0]
    for batch in in_slices(batches, 1024):
        label = batch.column("label").to_pylist()
        for row, features in _each_doc(batch.column("text"), orders, bits):
            count[label[row]][_distinct(features, scratch)] += 1
            docs[label[row]] += 1
    some = np.flatnonzero(count.any(axis=0))
    for a in range(0, len(some), 1 << 16):
        part = some[a : a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *(pa.array(c[part], pa.int64()) for c in count)], ["feature", "clean", "toxic"])
    yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), *(pa.array([n], pa.int64()) for n in docs)], ["feature", "clean", "toxic"])


def _sample_batches(batches, orders, bits, chosen):
    used = chosen.value
    scratch = np.zeros(1 << bits, np.int32)
    for batch in batches:
        rows = [f[used[f]] for _, f in _each_doc(batch.column("text"), orders, bits)]
        rows = [_distinct(f, scratch) for f in rows]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.int32()))], ["label", "features"])


def _fit(rows: list[np.ndarray], label: np.ndarray, value: np.ndarray, penalty: float = 1e-3, rounds: int = 300):
    """Logistic regression on sparse rows with inputs ``value[f]``: weights by feature, and a bias."""
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    used, column = np.unique(flat, return_inverse=True)
    x = value[flat]
    w, bias = np.zeros(len(used)), 0.0
    # Adagrad on the full sample: no step size to tune, the same result on every run.
    g_w, g_b = np.full(len(used), 1e-8), 1e-8
    for _ in range(rounds):
        z = np.bincount(row, x * w[column], len(rows)) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label
        d_w = np.bincount(column, x * error[row], len(used)) / len(rows) + penalty * w
        d_b = error.mean()
        g_w += d_w * d_w
        g_b += d_b * d_b
        w -= 0.1 * d_w / np.sqrt(g_w)
        bias -= 0.1 * d_b / np.sqrt(g_b)
    out = np.zeros(len(value))
    out[used] = w
    return out, float(bias)


def train(docs: DataFrame, labels: DataFrame, features: int = FEATURES, sample_rows: int = SAMPLE_ROWS, orders=ORDERS, bits: int = BITS) -> Model:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, label 0/1; both may hold more).

    Labels that are null or neither 0 nor 1, and labels without a document, are
    left out; of several labels of one document the larger counts. Without
    rows of both labels every text scores the share of toxic rows (0.5 if none).
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    labels = labels.where("label in (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    labels = materialise(labels, "labels")
    few = labels.count() <= BROADCAST_LABELS
    rows = docs.join(F.broadcast(labels) if few else labels, "doc_id")
    counts = rows.select("label", "text").mapInArrow(partial(_count_batches, orders=orders, bits=bits), "feature int, clean long, toxic long")
    counts = materialise(counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "ngram-counts")
    total = counts.where("feature = -1").first()
    if total is None or not total["clean"] or not total["toxic"]:
        share = 0.5 if total is None or not total["clean"] + total["toxic"] else total["toxic"] / (total["clean"] + total["toxic"])
        return Model(np.zeros(1 << bits, np.float32), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), orders, bits)
    a, clean, toxic = SMOOTHING, total["clean"], total["toxic"]
    r = F.log((F.col("toxic") + a) / (toxic + 2 * a)) - F.log((F.col("clean") + a) / (clean + 2 * a))
    there = F.col("toxic") + F.col("clean")
    gain = F.col("toxic") * F.log((F.col("toxic") + a) / (there + 2 * a) / (toxic / (clean + toxic))) + F.col("clean") * F.log((F.col("clean") + a) / (there + 2 * a) / (clean / (clean + toxic)))
    best = counts.where("feature >= 0").select("feature", r.alias("r"), gain.alias("gain")).orderBy(F.desc("gain"), "feature").limit(features).toPandas()
    ratio = np.zeros(1 << bits)
    ratio[best["feature"].to_numpy()] = best["r"].to_numpy()

    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    pick = labels.join(docs.select("doc_id").distinct(), "doc_id")
    half = pick.where("label = 1").orderBy(*order).limit(sample_rows // 2).union(pick.where("label = 0").orderBy(*order).limit(sample_rows // 2))
    chosen = spark.sparkContext.broadcast(ratio != 0)
    sample = docs.join(F.broadcast(half), "doc_id").select("label", "text")  # at most sample_rows ids
    sample = sample.mapInArrow(partial(_sample_batches, orders=orders, bits=bits, chosen=chosen), "label int, features array<int>").toPandas()
    label = sample["label"].to_numpy(float)
    w, bias = _fit([np.asarray(f, np.int64) for f in sample["features"]], label, ratio)
    # The sample's share of toxic rows is not that of the corpus.
    bias += float(np.log(toxic / clean) - np.log(max(label.sum(), 1) / max((1 - label).sum(), 1)))
    return Model((w * ratio).astype(np.float32), bias, orders, bits)


def _scores(texts, m: Model, scratch: np.ndarray) -> np.ndarray:
    z = np.full(len(texts), m.bias)
    for row, features in _each_doc(texts, m.orders, m.bits):
        hit = features[m.weights[features] != 0]
        z[row] += float(m.weights[_distinct(hit, scratch)].sum(dtype=np.float64))
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _score_batches(batches, model):
    scratch = np.zeros(1 << model.value.bits, np.int32)
    for batch in in_slices(batches, 1024):
        yield batch.drop_columns(["text"]).append_column("score", pa.array(_scores(batch.column("text"), model.value, scratch)))


def clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``limit`` or more; all columns stay.

    Only texts go to Python, and only scores come back. Null text scores as
    empty; equal texts share their score, so repeated rows stay or go
    together. Where nothing could be learnt (labels of one kind, or none), no
    row goes. An empty table stays empty.
    """
    if not model.weights.any():
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        m = shared.value
        return pa.array(_scores(texts, m, np.zeros(1 << m.bits, np.int32)))

    return docs.where(scored(F.col("text").cast("string")) < limit)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic likelier) in place of ``text``. Null text scores as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in ("text", "score")]
    schema = T.StructType([*docs.select(rest).schema.fields, T.StructField("score", T.DoubleType())])
    return docs.select(*rest, "text").mapInArrow(partial(_score_batches, model=shared), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    ``labels`` has doc_id and toxic. Rows with crc32(doc_id) mod 5 = 0 are held
    out: their labels are never read. Null or empty texts are scored too, and
    repeated rows each get their row. Without labels of both kinds all texts
    score the share of toxic ones (0.5 without any); an empty table gives no rows.
    """
    out = held_out(F.col("doc_id"), 5, 0)
    seen = labels.where(~out).select("doc_id", F.col("toxic").alias("label"))
    model = train(docs.where(~out), seen)
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), "text"), model)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
