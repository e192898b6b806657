"""Language-model scoring by logistic context mixing over hashed-context bit predictors.

A text is its lower-cased words and an end. Each word is coded in bits: a
frequent word by its path in a Huffman tree over the ``VOCAB`` commonest words
of the training texts, any other by an escape and then its bytes, each by its
path in a second tree, up to a terminator. So every text has a probability,
and bits are few: about as many as the text's information.

Each bit is predicted by a static predictor (the tree node) and by hashed
contexts: for words the last very common word (at the ``TOP_BITS`` nodes next
to the root), the last word and the last two words; for bytes the last two of
the word and the word so far. Their logits are mixed by weights chosen by a
gate (how sure each context is), learnt online by gradient steps; the mixed
prediction is refined by an adaptive table (by gate and quantised prediction),
and the two are averaged.

Counts stay where they are made, and the symbols travel to them. A block of
texts sends each distinct (contexts, symbol) once, with the texts that have
it, to the bucket of its last word: there lie all symbols that follow that
word, so the zeros and ones of every context at every tree node are sums over
neighbours in sorted order, exact and as many as the training texts give. The
bucket learns weights and refinement from all of its training symbols, each
one's own count taken out, then prices its symbols and sends every text one
sum. Very common words have one bucket for each group of the words before them,
so that no bucket holds more than a small share, and their group is part of the
context. Buckets follow from the counted words alone: scores depend neither on
the number of partitions nor on the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import GOLDEN, IS_SPACE, LOWER, in_slices, materialise, mix64, powers, row_blocks, utf8_parts, word_bounds, word_hashes

#: Words that have a code of their own, at most (the commonest; ties to the smaller hash).
VOCAB = 1 << 18
#: Occurrences from which a word has a code. Words seen once teach the escape and the bytes of new words: as many
#: tokens are such words as will be new (Good and Turing).
MIN_COUNT = 2
#: Words common enough to tell the language or style: the context "last very common word".
COMMON = 256
#: Bits next to the root that the last very common word predicts.
TOP_BITS = 12
CONTEXTS = 3
#: Training tokens a bucket, about; the buckets' number follows the training texts.
BUCKET_TOKENS = 1 << 18
#: Buckets that a very common word's followers are spread over, for each bucket's worth of them.
SPREAD = 4
#: Step size of the mixer, and bits a step.
RATE = 0.02
_STEP = 1 << 13
#: Symbols of a bucket worked on at once, about: their arrays stay in a core's cache.
_SYMBOLS = 1 << 15
#: Bytes of texts worked on at once; longer texts are worked on in pieces.
_BLOCK = 1 << 19
#: Bytes of texts that send their symbols together, and symbols from which they are sent in parts.
_TEXTS = 1 << 22
_SEND = 1 << 20
#: Rows of a slice of an Arrow batch, at most.
_ROWS = 1 << 14
#: Scores are added up in whole steps of 1/4096 natural log, so that the order of adding is no matter.
_UNIT = 4096
_LOGIT = 8.0
_SURE = np.array([1, 3, 16])


def training(doc_id: Column) -> Column:
    """Whether the model may learn from a document: crc32 of the id as text mod 7 is not 2 (null id: empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 != 2


# ------------------------------------------------------------------ word counts


def _count_batches(batches):
    """(word, n) for the words of a task; kind 1: n per byte value, and texts under 256."""
    total: dict = {"h": np.zeros(0, np.uint64), "n": np.zeros(0, np.int64)}
    pending, size = [], 0
    byte_n, texts = np.zeros(257, np.int64), 0

    def fold():
        some, n = np.unique(np.concatenate([total["h"][:0], *pending]), return_counts=True)
        pending.clear()
        h, n = np.concatenate((total["h"], some)), np.concatenate((total["n"], n))
        order = np.argsort(h, kind="stable")  # two sorted runs
        h = h[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else order
        total["h"], total["n"] = h[first], np.add.reduceat(n[order], first) if len(h) else n

    for batch in in_slices(batches, _ROWS):
        raw, at = utf8_parts(batch.column("text"))
        texts += len(at) - 1
        for a, b in row_blocks(at, _BLOCK):
            part, off = raw[at[a] : at[b]], at[a : b + 1] - at[a]
            starts, ends, _ = word_bounds(part, off)
            byte_n += np.bincount(LOWER[part], minlength=257)
            pending.append(word_hashes(part, starts, ends))
            size += len(starts)
            if size > _SEND:
                fold()
                size = 0
    fold()
    for a in range(0, len(total["h"]), 1 << 16):
        h, n = total["h"][a : a + (1 << 16)], total["n"][a : a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(h), np.int32)), pa.array(h.view(np.int64)), pa.array(n)], ["kind", "word", "n"])
    byte_n[256] = texts
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(257, np.int32)), pa.array(np.arange(257)), pa.array(byte_n)], ["kind", "word", "n"])


# ------------------------------------------------------------------ codes


def tree(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A Huffman code: (offsets, node and bit of each step from leaf to root, logit of a 1 at each inner node)."""
    n = len(weights)
    order = np.argsort(weights, kind="stable")
    weight = np.zeros(2 * n - 1)
    weight[:n] = weights[order]
    parent = np.zeros(2 * n - 1, np.int64)
    side = np.zeros(2 * n - 1, np.int8)
    leaf, inner = 0, n
    w = weight.tolist()
    for new in range(n, 2 * n - 1):  # two queues: leaves and inner nodes are both in rising order
        pair = []
        for _ in range(2):
            if leaf < n and (inner >= new or w[leaf] <= w[inner]):
                pair.append(leaf)
                leaf += 1
            else:
                pair.append(inner)
                inner += 1
        w[new] = w[pair[0]] + w[pair[1]]
        parent[pair[0]] = parent[pair[1]] = new
        side[pair[1]] = 1
    weight = np.array(w)
    one = np.zeros(2 * n - 1)
    is_one = np.flatnonzero(side == 1)
    one[parent[is_one]] = weight[is_one]
    share = one[n:] / weight[n:]
    logit = np.clip(np.log(np.maximum(share, 1e-9)) - np.log(np.maximum(1 - share, 1e-9)), -_LOGIT, _LOGIT)
    at, root = np.empty(n, np.int64), 2 * n - 2
    at[order] = np.arange(n)
    steps = []
    alive = np.arange(n)
    node = at
    while n > 1 and len(alive):
        steps.append((alive, parent[node] - n, side[node]))
        keep = parent[node] != root
        alive, node = alive[keep], parent[node][keep]
    depth = np.zeros(n, np.int64)
    for who, _, _ in steps:
        depth[who] += 1
    offsets = np.concatenate(([0], np.cumsum(depth)))
    nodes, bits = np.zeros(offsets[-1], np.int32), np.zeros(offsets[-1], np.int8)
    for k, (who, nd, bit) in enumerate(steps):
        nodes[offsets[who] + k] = nd
        bits[offsets[who] + k] = bit
    return offsets, nodes, bits, logit.astype(np.float32)


class _Sent:
    """Arrays travel compressed: a broadcast lies on the disk of the driver and of every executor."""

    def __getstate__(self):
        own = {k: v for k, v in vars(self).items() if k in self.__dataclass_fields__}  # what is derived is not sent
        return {k: (v.dtype.str, v.shape, pa.compress(v.tobytes(), codec="zstd", asbytes=True)) if isinstance(v, np.ndarray) else v for k, v in own.items()}

    def __setstate__(self, state):
        for k, v in state.items():
            if isinstance(v, tuple):
                kind, shape, data = v
                size = int(np.prod(shape)) * np.dtype(kind).itemsize
                v = np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True), kind).reshape(shape) if size else np.zeros(shape, kind)
            setattr(self, k, v)


@dataclass
class Coder(_Sent):
    """The vocabulary (sorted hashes with their rank and count) and the two trees as one set of paths.

    Symbols: words by rank, the end, the escape, then 257 bytes (256: end of the word).
    """

    words: np.ndarray
    rank: np.ndarray
    count: np.ndarray
    offsets: np.ndarray  # of each symbol's path, leaf to root
    nodes: np.ndarray
    bits: np.ndarray
    logits: np.ndarray  # static, of each node: those of words, then those of bytes
    word_nodes: int
    leaf: np.ndarray  # of each symbol, its place from left to right: a node's symbols are neighbours
    kind: np.ndarray  # of each symbol, the subtree at TOP_BITS that it is in

    @classmethod
    def of(cls, words: np.ndarray, rank: np.ndarray, count: np.ndarray, word_tree: tuple, byte_tree: tuple) -> Coder:
        (w_at, w_node, w_bit, w_logit), (b_at, b_node, b_bit, b_logit) = word_tree, byte_tree
        offsets = np.concatenate((w_at, b_at[1:] + w_at[-1]))
        nodes, bits = np.concatenate((w_node, b_node + len(w_logit))).astype(np.int32), np.concatenate((w_bit, b_bit))
        place = (np.arange(len(offsets) - 1) >= len(w_at) - 1).astype(np.int64)
        depth = np.diff(offsets)
        kind = place
        for level in range(int(depth.max())):
            on = depth > level
            side = np.zeros(len(place), np.int64)
            side[on] = bits[offsets[1:][on] - 1 - level]
            place = np.unique(place * 2 + side, return_inverse=True)[1]
            if level < TOP_BITS:
                kind = place
        return cls(words, rank, count, offsets, nodes, bits, np.concatenate((w_logit, b_logit)), len(w_logit), place, kind)

    @property
    def end(self) -> int:
        return len(self.words)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among ``words``, -1 if it has none."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        first, shift = self._starts
        at, last = np.take(first, (hashes >> shift).astype(np.intp)), len(self.words) - 1
        found = np.take(self.words, np.minimum(at, last))
        on = np.flatnonzero((found < hashes) & (at < last))
        while len(on):  # a few steps: words are spread evenly
            at[on] += 1
            found[on] = self.words[at[on]]
            on = on[(found[on] < hashes[on]) & (at[on] < last)]
        return np.where(found == hashes, at, -1)

    @cached_property
    def _starts(self) -> tuple[np.ndarray, np.uint64]:
        """By the high bits of a hash: the first word from there on."""
        bits = min(max(len(self.words).bit_length() + 1, 1), 22)
        shift = np.uint64(64 - bits)
        return np.searchsorted(self.words, np.arange(1 << bits, dtype=np.uint64) << shift), shift


@dataclass
class Words:
    """The words of a block of texts; one end follows the words of each text."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray  # text of each token, ends included
    hashes: np.ndarray  # of each token (0 for ends)
    place: np.ndarray  # among the coder's words; -1 unknown, -2 end


def words_of(coder: Coder, raw: np.ndarray, at: np.ndarray) -> Words:
    starts, ends, first = word_bounds(raw, at)
    hashes = word_hashes(raw, starts, ends)
    place = coder.find(hashes)
    texts = len(at) - 1
    # An end after the words of each text.
    row = np.repeat(np.arange(texts), np.diff(first) + 1)
    is_end = np.zeros(len(row), bool)
    is_end[first[1:] + np.arange(texts)] = True
    out = [np.zeros(len(row), x.dtype) for x in (starts, ends, hashes, place)]
    for o, x in zip(out, (starts, ends, hashes, place)):
        o[~is_end] = x
    out[3][is_end] = -2
    return Words(raw, out[0], out[1], row, out[2], out[3])


@dataclass
class Symbols:
    """What a block codes: of each symbol its token, itself and its contexts."""

    token: np.ndarray
    symbol: np.ndarray
    style: np.ndarray  # 0: no very common word yet, else its rank + 1
    last: np.ndarray  # the last word, or the last two bytes
    two: np.ndarray  # the word before that, or the byte before those in the low bits and the word so far above


_STYLES = COMMON + 1


def symbols_of(coder: Coder, w: Words, before: tuple = (), spelt: bool = True) -> Symbols:
    """Words and ends, then (if ``spelt``) the bytes of words without a code. ``before``: (two, last, style) that a piece goes on from."""
    n, end = len(w.row), coder.end
    vocab = n and end
    symbol = np.where(w.place >= 0, coder.rank[np.maximum(w.place, 0)] if vocab else 0, np.where(w.place == -2, end, end + 1))
    start = end + 2
    same = np.zeros(n, bool)
    same[1:] = w.row[1:] == w.row[:-1]
    last, two = np.full(n, start), np.full(n, start)
    last[1:] = np.where(same[1:], symbol[:-1], start)
    two[1:] = np.where(same[1:], last[:-1], start)
    # The last very common word before each token, within its text.
    here = np.where((symbol < COMMON) & (symbol < end), np.arange(n), -1)
    seen = np.maximum.accumulate(np.concatenate(([-1], here[:-1]))) if n else here
    first = np.maximum.accumulate(np.where(same, 0, np.arange(n))) if n else here
    style = np.where(seen >= first, symbol[np.maximum(seen, 0)] + 1, 0) if n else here
    if before and n:
        two[0], last[0] = before[:2]
        two[1:2] = before[1]
        style[seen < 0] = before[2]
    far = np.flatnonzero((symbol == end + 1) & spelt)
    token = np.arange(n)
    if not len(far):
        return Symbols(token, symbol, style, last, two)
    owner, byte, pair, more = _spelt(w, far)
    return Symbols(
        np.concatenate((token, owner)), np.concatenate((symbol, byte + end + 2)), np.concatenate((style, style[owner])),
        np.concatenate((last, start + 1 + pair)), np.concatenate((two, more)),
    )


def _spelt(w: Words, tokens: np.ndarray):
    """The bytes of words without a code, each word with its terminator: token, byte, last two bytes, the one before and the word so far."""
    n = w.ends[tokens] - w.starts[tokens] + 1
    start = np.cumsum(n) - n
    owner = np.repeat(tokens, n)
    inside = np.arange(int(n.sum())) - np.repeat(start, n)
    is_last = inside == np.repeat(n - 1, n)
    symbol = np.where(is_last, 256, LOWER[w.raw[np.minimum(np.repeat(w.starts[tokens], n) + inside, len(w.raw) - 1)]]).astype(np.int64)
    back = np.full((3, len(symbol)), 511, np.int64)  # the bytes before, 511 before the word
    for k in range(1, 4):
        back[k - 1][k:] = np.where(inside[k:] >= k, symbol[:-k], 511)
    # All bytes of the word so far.
    value = mix64(symbol.astype(np.uint64) + GOLDEN) * powers(int(inside.max()) + 1)[inside]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))[:-1]
    whole = mix64(total - np.repeat(total[start], n) + inside.astype(np.uint64))
    return owner, symbol, back[0] << 9 | back[1], (whole >> np.uint64(42)).astype(np.int64) << 9 | back[2]


def _pieces(raw: np.ndarray, at: np.ndarray, most: int):
    """(bytes, row offsets, whether it ends its text): a single longer text in pieces that end at white space."""
    if len(at) != 2 or len(raw) <= most:
        yield raw, at, True
        return
    a = 0
    while a < len(raw):
        b = a + most
        while b < len(raw):  # the next gap, looked for in steps
            gap = np.flatnonzero(IS_SPACE[raw[b : b + 4096]])
            if len(gap):
                b += int(gap[0]) + 1
                break
            b += 4096
        b = min(b, len(raw))
        yield raw[a:b], np.array([0, b - a]), b == len(raw)
        a = b


def coded(coder: Coder, raw: np.ndarray, at: np.ndarray, most: int = _BLOCK, spelt: bool = True):
    """(words, symbols) of a block of texts, or of each piece of a long one: contexts go on from piece to piece."""
    before: tuple = ()
    for part, off, whole in _pieces(raw, at, most):
        w = words_of(coder, part, off)
        if not whole:
            w = Words(w.raw, w.starts[:-1], w.ends[:-1], w.row[:-1], w.hashes[:-1], w.place[:-1])
        s = symbols_of(coder, w, before, spelt)
        yield w, s
        n = len(w.row)
        if not whole and n:
            last = int(s.symbol[n - 1])
            common = last + 1 if last < min(COMMON, coder.end) else int(s.style[n - 1])
            before = int(s.last[n - 1]), last, common


# ------------------------------------------------------------------ model


@dataclass
class Model(_Sent):
    coder: Coder
    style: np.ndarray  # zeros and ones by (style, node of the top)
    top: np.ndarray  # node -> its place among those of the top, -1: none
    buckets: int
    groups: np.ndarray  # by ``last``: groups of ``two`` that are contexts of their own
    spelt_groups: int
    train_tokens: int
    types: int
    end_count: int

    @cached_property
    def packed_style(self) -> tuple[np.ndarray, np.ndarray]:
        """Packed logits by (style, node of the top): of all counts, and without a zero or a one of them."""
        zeros, ones = self.style[..., 0].reshape(-1), self.style[..., 1].reshape(-1)
        return _packed_logits(zeros, ones), _packed_less(zeros, ones).reshape(-1)


def _contexts(model: Model, style, last, two) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group: what stays together, hashes of the three contexts, each within a group).

    Words: none here (the last very common word has a table), the last word
    with its group of words before, the last two. Bytes: the last two with the
    last very common word, the last three, the word so far.
    """
    group, own, before = _group(model, last, two)
    middle = np.where(last >= len(model.groups), mix64(own + before + GOLDEN), group)
    return group, mix64(group + style.astype(np.uint64)), middle, mix64(own + two.astype(np.uint64) + GOLDEN)


def _group(model: Model, last, two) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the group, last in the high bits, what of ``two`` the group goes by)."""
    words = len(model.groups)
    byte = last >= words
    before = np.where(byte, two & 511, two).astype(np.uint64)
    groups = np.where(byte, model.spelt_groups, model.groups[np.minimum(last, words - 1)]).astype(np.uint64)
    own = last.astype(np.uint64) << np.uint64(32)
    many = np.flatnonzero(groups > 1)
    share = np.zeros(len(last), np.uint64)
    share[many] = mix64(before[many] + GOLDEN) % groups[many]
    return mix64(own + share + GOLDEN), own, before


def _style_batches(batches, coder):
    """(key, n): how often a symbol of each kind follows each style in training texts."""
    c: Coder = coder.value
    kinds = int(c.kind.max()) + 1
    n = np.zeros(_STYLES * kinds, np.int64)
    for batch in in_slices(batches, _ROWS):
        raw, at = utf8_parts(batch.column("text"))
        for a, b in row_blocks(at, _BLOCK):
            for _, s in coded(c, raw[at[a] : at[b]], at[a : b + 1] - at[a], spelt=False):
                np.add.at(n, s.style * kinds + c.kind[s.symbol], 1)
    at = np.flatnonzero(n)
    for a in range(0, len(at), 1 << 16):
        part = at[a : a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(n[part])], ["key", "n"])


def _style_counts(coder: Coder, key: np.ndarray, n: np.ndarray):
    """(zeros and ones by style and node of the top, place of each node there)."""
    kinds = int(coder.kind.max()) + 1
    count = np.zeros(_STYLES * kinds, np.float64)
    count[key] = n
    count = count.reshape(_STYLES, kinds).T
    one_of = np.zeros(kinds, np.int64)
    one_of[coder.kind] = np.arange(len(coder.kind))
    depth = np.diff(coder.offsets)[one_of]
    place, sums = np.full(len(coder.logits), -1), []
    for level in range(TOP_BITS):
        on = np.flatnonzero((depth > level) & (one_of < coder.end + 2))
        at = coder.offsets[one_of[on] + 1] - 1 - level
        node = coder.nodes[at]
        u, inverse = np.unique(node, return_inverse=True)
        place[u] = sum(len(x) for x in sums) + np.arange(len(u))
        both = np.zeros((len(u), 2, _STYLES))
        np.add.at(both, (inverse, coder.bits[at]), count[on])
        sums.append(both)
    return np.concatenate(sums).transpose(2, 0, 1).astype(np.float32), place


def train(docs: DataFrame, vocab: int = VOCAB, bucket_tokens: int = BUCKET_TOKENS) -> tuple[Model, DataFrame]:
    """Model and word counts (word: 64-bit hash, n) learnt from the texts of ``docs`` (doc_id, text) that ``training`` allows."""
    spark = docs.sparkSession
    known = docs.where(training(F.col("doc_id")))
    counts = known.select("text").mapInArrow(_count_batches, "kind int, word long, n long")
    counts = materialise(counts.groupBy("kind", "word").agg(F.sum("n").alias("n")), "words")
    words = counts.where("kind = 0").select("word", "n")
    byte_n = np.zeros(257)
    for row in counts.where("kind = 1").collect():  # 257 rows
        byte_n[row["word"]] = row["n"]
    texts = int(byte_n[256])
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("types")).first()
    top = words.where(F.col("n") >= MIN_COUNT).orderBy(F.desc("n"), "word").limit(vocab).toArrow()  # at most ``vocab`` rows of 16 bytes
    hashes = top.column("word").to_numpy().view(np.uint64)
    n = top.column("n").to_numpy()
    order = np.argsort(hashes)
    far = max(total["n"] - int(n.sum()), 0)
    weights = np.concatenate((n, [max(texts, 1), max(far, 1)])).astype(float)
    byte_n[256] = max(total["n"], 1)
    coder = Coder.of(hashes[order], np.arange(len(hashes))[order], n[order], tree(weights), tree(byte_n + 1))
    shared = spark.sparkContext.broadcast(coder)
    styles = known.select("text").mapInArrow(partial(_style_batches, coder=shared), "key long, n long")
    styles = styles.groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # at most 257 styles by 2**TOP_BITS kinds, and as many nodes
    shared.destroy()
    style, place = _style_counts(coder, styles.column("key").to_numpy(), styles.column("n").to_numpy())
    share = bucket_tokens / SPREAD
    groups = np.maximum(np.ceil(np.concatenate((n, [1, far, texts])) / share), 1).astype(np.int64)
    tokens = int(total["n"]) + texts
    buckets = max(1, -(-tokens // bucket_tokens))
    return Model(coder, style, place, buckets, groups, max(1, int(far / share)), tokens, int(total["types"]) + (texts > 0), texts), words


# ------------------------------------------------------------------ symbols to their buckets


def _planes(*columns: np.ndarray) -> bytes:
    """Whole numbers of equal length, their bytes in planes (the high ones are mostly zeros), compressed."""
    x = np.stack(columns)
    kind = np.int32 if not x.size or (x.min() >= -(1 << 31) and x.max() < 1 << 31) else np.int64
    size = np.dtype(kind).itemsize
    body = x.astype(kind, copy=False).view(np.uint8).reshape(len(columns), -1, size).transpose(0, 2, 1)
    return np.array([x.shape[1], size]).tobytes() + pa.compress(np.ascontiguousarray(body), codec="zstd", asbytes=True)


def _columns(data: bytes, columns: int) -> np.ndarray:
    n, size = np.frombuffer(data, np.int64, 2).tolist()
    body = pa.decompress(memoryview(data)[16:], decompressed_size=n * columns * size, codec="zstd", asbytes=True)
    planes = np.frombuffer(body, np.uint8).reshape(columns, size, n).transpose(0, 2, 1)
    return np.ascontiguousarray(planes).view(np.int32 if size == 4 else np.int64).reshape(columns, n)


_ASKED = "bucket long, block long, symbols binary, texts binary, info binary"
_FIELDS = ["bucket", "block", "symbols", "texts", "info"]


def _tuple_hash(style, last, two, symbol) -> np.ndarray:
    history = mix64((last.astype(np.uint64) << np.uint64(32)) + two.astype(np.uint64) + GOLDEN)
    return mix64(history + ((symbol.astype(np.uint64) << np.uint64(10)) | style.astype(np.uint64)))


def _sent(model: Model, parts: list[np.ndarray], learnt: np.ndarray):
    """(bucket, symbols, texts) of a block: each distinct symbol with its contexts once, and the texts that have it.

    ``parts``: rows style, last, two, symbol, text. Symbols are sorted by
    bucket, last, two and a few bits of a hash; were two that differ alike in
    those, they might be sent twice, and the bucket would add them up.
    """
    style, last, two, symbol, row = np.concatenate(parts, axis=1)
    parts.clear()
    if not len(row):
        return
    key = _group(model, last, two)[0] % np.uint64(model.buckets)
    left = np.uint64(64 - model.buckets.bit_length())
    key <<= left
    for x, at in ((last, 20), (two, 40)):
        key |= (x.astype(np.uint64) & np.uint64(0xFFFFF)) << left - np.uint64(at)
    key |= _tuple_hash(style, last, two, symbol) >> np.uint64(104) - left
    order = np.argsort(key)
    bucket = key[order] >> left
    del key
    columns = [x[order] for x in (style, last, two, symbol)]
    texts = row[order]
    new = np.zeros(len(order), bool)
    new[0] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    bucket = bucket[first].astype(np.int64)
    columns = [x[first] for x in columns]
    columns += [np.diff(np.append(first, len(texts))), np.add.reduceat(learnt[texts], first)]
    columns = [x.astype(np.int32, copy=False) for x in columns]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
    at = np.append(first, len(texts))
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(bucket[a]), _planes(*[c[a:b] for c in columns]), _planes(texts[at[a] : at[b]])


def _ask_batches(batches, model):
    """Rows for the buckets, and one row a block with what is known of its texts."""
    m: Model = model.value
    scale = np.log10(m.train_tokens + m.types + 1.0)
    known = np.log10(m.coder.count + 1.0) - scale
    end = np.log10(m.end_count + 1.0) - scale
    block = TaskContext.get().partitionId() << 33

    def sent(parts, learnt):
        rows = [(bucket, block, symbols, owners, None) for bucket, symbols, owners in _sent(m, parts, learnt)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _FIELDS)

    for batch in in_slices(batches, _ROWS):
        raw, at = utf8_parts(batch.column("text"))
        held_out = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for a, b in row_blocks(at, _TEXTS):
            texts = b - a
            learnt = (~held_out[a:b]).astype(np.int64)
            n_tokens, n_known, base, rare = np.zeros(texts, np.int64), np.zeros(texts, np.int64), np.zeros(texts), []
            parts, size = [], 0
            for i, j in row_blocks(at[a : b + 1], _BLOCK):  # small arrays, whatever a block holds
                for w, s in coded(m.coder, raw[at[a + i] : at[a + j]], at[a + i : a + j + 1] - at[a + i]):
                    there = w.place >= 0
                    price = np.where(there, known[np.maximum(w.place, 0)] if len(known) else 0, np.where(w.place == -2, end, 0))
                    n_tokens[i:j] += np.bincount(w.row, minlength=j - i)
                    n_known[i:j] += np.bincount(w.row, there | ((w.place == -2) & (m.end_count > 0)), j - i).astype(np.int64)
                    base[i:j] += np.bincount(w.row, price, j - i)
                    far = w.place == -1
                    rare.append((i, np.bincount(w.row[far], minlength=j - i), w.hashes[far].view(np.int64)))
                    parts.append(np.stack((s.style, s.last, s.two, s.symbol, w.row[s.token] + i)).astype(np.int32))
                    size += len(s.token)
                    if size > _SEND:
                        yield from sent(parts, learnt)
                        size = 0
            if size:
                yield from sent(parts, learnt)
            n_rare = np.zeros(texts, np.int64)
            for i, n, _ in rare:
                n_rare[i : i + len(n)] += n
            off = np.concatenate(([0], np.cumsum(n_rare)))
            lists = pa.LargeListArray.from_arrays(pa.array(off), pa.array(np.concatenate([r[2] for r in rare])))
            info = pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, texts), pa.array(held_out[a:b]), pa.array(np.diff(at[a : b + 1])), pa.array(n_tokens), pa.array(n_known), pa.array(base), lists],
                ["doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base_score", "rare"],
            )
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, info.schema) as out:
                out.write_batch(info)
            one = [[block % m.buckets], [block], [None], [None], [sink.getvalue().to_pybytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(one, _TYPES)], _FIELDS)
            block += 1


_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


# ------------------------------------------------------------------ mixing

_GATES = 4**CONTEXTS
_STEPS = 33


def _packed_logits(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logit in steps of 1/256, times 4, plus sureness 0 to 3."""
    ones, zeros = ones.astype(np.float32), zeros.astype(np.float32)
    logit = np.clip(np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4))), -_LOGIT, _LOGIT)
    n = ones + zeros
    sure = (n >= _SURE[0]).astype(np.int16) + (n >= _SURE[1]) + (n >= _SURE[2])
    return (np.rint(logit * 256).astype(np.int16) * 4 + sure).astype(np.int16)


def _packed_less(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Two values a count: without one of its zeros, without one of its ones."""
    return np.stack((_packed_logits(np.maximum(zeros - 1, 0), ones), _packed_logits(zeros, np.maximum(ones - 1, 0))), axis=1)


_FEW = 64
#: The same of counts below ``_FEW``, by zeros and ones; both values of a count in 32 bits.
_PACKED = _packed_logits(*np.divmod(np.arange(_FEW * _FEW), _FEW))
_LESS = _packed_less(*np.divmod(np.arange(_FEW * _FEW), _FEW)).view(np.int32).reshape(-1)


def _packed_counts(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(``_packed_logits``, ``_packed_less``) of whole numbers as float64, nearly all of them small."""
    many = np.flatnonzero(zeros + ones >= _FEW)
    key = zeros * _FEW
    key += ones
    key[many] = 0
    key = key.astype(np.intp)
    full, less = np.take(_PACKED, key), np.take(_LESS, key).view(np.int16).reshape(-1, 2)
    if len(many):
        full[many], less[many] = _packed_logits(zeros[many], ones[many]), _packed_less(zeros[many], ones[many])
    return full, less


@dataclass
class Bits:
    """Bits of symbols, with each context's packed logit: of all counts, and without the bit's own (for symbols that are learnt from).

    Level by level from the root; within a level, symbols with deeper leaves come first.
    """

    row: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    full: np.ndarray  # context; bit
    less: np.ndarray
    place: np.ndarray  # of each symbol, its place within a level
    alive: np.ndarray  # of each level, its bits
    ids: np.ndarray  # (row, node) of each bit side by side
    own: np.ndarray  # (less, bit) of each bit side by side

    def some(self, at: np.ndarray):
        """(row, node, less, bit) of some bits: two reads of 8 bytes each."""
        ids = np.take(self.ids.view(np.int64).reshape(-1), at).view(np.int32).reshape(-1, 2)
        own = np.take(self.own.view(np.int64).reshape(-1), at).view(np.int16).reshape(-1, CONTEXTS + 1).T
        return ids[:, 0], ids[:, 1], own[:CONTEXTS], own[CONTEXTS].astype(np.int8)

    def of(self, symbols: np.ndarray) -> np.ndarray:
        """The bits of these symbols, level by level in the order given."""
        at, first = self.place[symbols], np.cumsum(self.alive) - self.alive
        return np.concatenate([at[at < n] + a for a, n in zip(first, self.alive)] or [at[:0]])


class _Run:
    """Symbols in the order of (context, leaf): those under a node are neighbours, so that its zeros and ones are sums over a run.

    A symbol alone under its node stays alone, so it leaves: ``bits_of`` has given it its own count at every level.
    """

    def __init__(self, context: np.ndarray, leaf: np.ndarray, n: np.ndarray, among: np.ndarray):
        order = np.argsort(context)
        new = np.concatenate(([True], context[order][1:] != context[order][:-1]))[: len(order)]
        key = np.cumsum(new) << 20 | leaf[order]
        by = np.argsort(key)
        order, key = order[by], key[by] >> 20
        self.at, self.n = among[order], n[order].astype(np.float64)
        self.first = np.concatenate(([True], key[1:] != key[:-1]))[: len(order)]
        self._keep(len(n) and int(among.max()) + 1)

    def _keep(self, alive: int) -> None:
        alone = self.first & np.concatenate((self.first[1:], [True]))[: len(self.first)]
        keep = np.flatnonzero(~alone & (self.at < alive))
        if len(keep) < len(self.at):
            self.at, self.n, self.first = np.take(self.at, keep), np.take(self.n, keep), np.take(self.first, keep)

    def level(self, bit: np.ndarray, full: np.ndarray, less: np.ndarray, following: int) -> None:
        """Sets the values of a level's bits; ``following``: bits of the next level."""
        if not len(self.at):
            return
        side = np.take(bit, self.at)
        run = np.cumsum(self.first)
        run -= 1
        both = run * 2
        both += side
        n = np.bincount(both, self.n, 2 * int(run[-1]) + 2)
        packed, without = _packed_counts(n[0::2], n[1::2])
        full[self.at] = np.take(packed, run)
        less[self.at] = np.take(without, both)
        self.first[1:] |= side[1:] != side[:-1]
        self._keep(following)


def bits_of(model: Model, style, last, two, symbol, n) -> Bits:
    """All bits of distinct symbols with ``n`` training occurrences each."""
    c = model.coder
    depth = c.offsets[symbol + 1] - c.offsets[symbol]
    order = np.argsort(-depth.astype(np.int16), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    style, last, two, symbol, n = (x[order] for x in (style, last, two, symbol, n))
    levels = int(depth.max()) if len(depth) else 0
    alive = np.array([np.count_nonzero(depth > level) for level in range(levels)], np.int64)
    total = int(alive.sum())
    ids, bit = np.empty((total, 2), np.int32), np.empty(total, np.int8)
    row, node = ids.T
    full, own = np.empty((CONTEXTS, total), np.int16), np.empty((total, CONTEXTS + 1), np.int16)
    less = own.T[:CONTEXTS]
    out = Bits(row, node, bit, full, less, place, alive, ids, own)
    if not total:
        return out
    root, order = c.offsets[symbol + 1] - 1, order.astype(np.int32)
    is_byte = symbol > c.end + 1
    byte, every = np.flatnonzero(is_byte), np.arange(len(symbol))
    runs = []
    for k, h in enumerate(_contexts(model, style, last, two)[1:]):
        among = every if k else byte
        runs.append(_Run(h[among], c.leaf[symbol[among]], n[among], among))
    # A symbol alone in its context: its own count, on the side of the bit.
    times = n.astype(np.float64)
    (zero, zero_less), (one, one_less) = _packed_counts(times, 0 * times), _packed_counts(0 * times, times)
    zero_less, one_less = zero_less[:, 0].copy(), one_less[:, 1].copy()
    styles = style.astype(np.int64) * model.style.shape[1]
    some_words, some_bytes = len(byte) < len(symbol), len(byte) > 0
    a = 0
    for level, size in enumerate(alive.tolist()):
        b, following = a + size, int(alive[level + 1]) if level + 1 < levels else 0
        at = root[:size] - level
        row[a:b] = order[:size]
        node[a:b] = nodes = np.take(c.nodes, at)
        bit[a:b] = side = np.take(c.bits, at)
        is_one, here = side.view(bool), is_byte[:size]
        whole, without = np.where(is_one, one[:size], zero[:size]), np.where(is_one, one_less[:size], zero_less[:size])
        full[1:, a:b], less[1:, a:b] = whole, without
        if some_words and level < TOP_BITS:
            key = styles[:size] + np.take(model.top, nodes)
            of_style, own_style = np.take(model.packed_style[0], key), np.take(model.packed_style[1], key * 2 + side)
            if some_bytes:
                of_style, own_style = np.where(here, whole, of_style), np.where(here, without, own_style)
            full[0, a:b], less[0, a:b] = of_style, own_style
        else:
            full[0, a:b], less[0, a:b] = whole * here, without * here
        for run, of_run, own_of_run in zip(runs, full, less):
            run.level(side, of_run[a:b], own_of_run[a:b], following)
        a = b
    own[:, CONTEXTS] = bit
    return out


def _inputs(coder: Coder, node: np.ndarray, packed: np.ndarray):
    """(inputs of the mixer, its weight set) of each bit."""
    x = [np.take(coder.logits, node)]
    gate = (node >= coder.word_nodes).astype(np.int16)
    for p in packed:
        v = (p >> 2).astype(np.float32)
        v *= np.float32(1 / 256)
        x.append(v)
        gate *= 4
        gate += p & 3
    return x, gate.astype(np.intp)


def _mixed(weights: np.ndarray, x: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
    z = np.take(weights[0], gate)
    z *= x[0]
    for w, v in zip(weights[1:], x[1:]):
        t = np.take(w, gate)
        t *= v
        z += t
    return z


def _refined(z: np.ndarray, gate: np.ndarray):
    """Place in the refinement table: left column and distance to it."""
    y = np.clip(z, -_LOGIT, _LOGIT)
    y += np.float32(_LOGIT)
    y *= np.float32((_STEPS - 1) / (2 * _LOGIT))
    low = np.minimum(y.astype(np.int32), _STEPS - 2)
    return gate * _STEPS + low, y - low  # the distance in float64


def _error(z: np.ndarray, bit: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What was not foreseen of each bit, ``n`` times."""
    t = np.clip(z, -12, 12)
    np.negative(t, out=t)
    np.exp(t, out=t)
    t += 1
    np.divide(1, t, out=t)
    np.subtract(bit, t, out=t)
    t *= n
    return t


_FINE = 512
#: Natural log of the probability of what happened, by the logit of it in steps of 1/512 from -12 to 12.
_LOG_P = -np.log1p(np.exp(-np.arange(-12 * _FINE, 12 * _FINE + 1) / _FINE)).astype(np.float32)


class Mixer:
    """Weights by gate and the refinement table; both are learnt online."""

    def __init__(self, coder: Coder):
        gates = 2 * _GATES
        self.coder = coder
        self.weights = np.full((CONTEXTS + 1, gates), 0.3, np.float32)
        self.refine = np.tile(np.linspace(-_LOGIT, _LOGIT, _STEPS, dtype=np.float32), (gates, 1)).reshape(-1)

    def log_p(self, node: np.ndarray, packed: np.ndarray, bit: np.ndarray) -> np.ndarray:
        """Natural log of the probability given to each bit.

        The final logit is a whole number of steps for a one, and minus that for
        a zero, so that the two probabilities add up to one.
        """
        x, gate = _inputs(self.coder, node, packed)
        z = _mixed(self.weights, x, gate)
        at, share = _refined(z, gate)
        left = np.take(self.refine, at)
        at += 1
        right = np.take(self.refine, at)
        right -= left
        share *= right
        share += left
        z += share
        z *= np.float32(0.5 * _FINE)
        np.rint(z, out=z)
        np.clip(z, -12 * _FINE, 12 * _FINE, out=z)
        step = z.astype(np.int32)
        step *= 2 * bit.astype(np.int32) - 1
        step += 12 * _FINE
        return np.take(_LOG_P, step)

    def learn(self, node: np.ndarray, packed: np.ndarray, bit: np.ndarray, n: np.ndarray) -> None:
        """An online step over bits that occur ``n`` times: per gate the mean gradient, times the root of its bits."""
        x, gate = _inputs(self.coder, node, packed)
        z = _mixed(self.weights, x, gate)
        place, share = _refined(z, gate)
        size = len(self.refine)
        bits, times = np.bincount(place, minlength=size), np.bincount(place, n, size)
        error = _error(z, bit, n)
        scale = RATE * np.sqrt(bits.reshape(-1, _STEPS).sum(axis=1)) / np.maximum(times.reshape(-1, _STEPS).sum(axis=1), 1)
        for own, v in zip(self.weights, x):
            v *= error
            own += (scale * np.bincount(gate, v, 2 * _GATES)).astype(np.float32)
        far = 1 - share
        r = np.take(self.refine, place) * far
        r += np.take(self.refine, place + 1) * share
        error = _error(r, bit, n)
        far *= error
        error *= share
        # Each bit teaches its left column and the next one.
        for whole in (bits, times):
            whole[1:] += whole[:-1].copy()
        scale = RATE * np.sqrt(bits) / np.maximum(times, 1)
        self.refine += (scale * np.bincount(np.concatenate((place, place + 1)), np.concatenate((far, error)), size)).astype(np.float32)


def priced(model: Model, style, last, two, symbol, n) -> np.ndarray:
    """Price of each distinct symbol of a bucket in steps of 1/4096 natural log.

    Weights are learnt online from the symbols with training occurrences, part
    by part (whole groups); each part is priced once it has been learnt from,
    and the first one is gone through twice.
    """
    group = mix64(_contexts(model, style, last, two)[0] + GOLDEN) >> np.uint64(20)
    part = (group % np.uint64(len(symbol) // _SYMBOLS + 1)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    mixer = Mixer(model.coder)
    price = np.zeros(len(symbol))
    for k, on in enumerate(np.split(order, np.flatnonzero(np.diff(part[order])) + 1)):
        bits = bits_of(model, *[x[on] for x in (style, last, two, symbol, n)])
        known = bits.of(np.flatnonzero(n[on] > 0))
        known = np.random.default_rng(len(known)).permutation(known)
        weight = n[on].astype(np.float32)
        for _ in range(1 if k else 2):
            for a in range(0, len(known), _STEP):
                row, node, less, bit = bits.some(known[a : a + _STEP])
                mixer.learn(node, less, bit, np.take(weight, row))
        log_p = [mixer.log_p(bits.node[a : a + _STEP], bits.full[:, a : a + _STEP], bits.bit[a : a + _STEP]) for a in range(0, len(bits.row), _STEP)]
        price[on] = -np.bincount(bits.row, np.concatenate(log_p) if log_p else None, len(on))
    return np.rint(price * _UNIT).astype(np.int64)


def _price_batches(batches, model):
    """Rows sorted by bucket: for every row of a bucket, the texts that it names and the sum of their prices."""
    m: Model = model.value

    def settled(held):
        columns = [_columns(h[1], 6) for h in held]
        style, last, two, symbol, _, known = np.concatenate(columns, axis=1)
        # Distinct symbols in the order of their hashes.
        hashes = _tuple_hash(style, last, two, symbol)
        order = np.argsort(hashes)
        hashes = hashes[order]
        new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
        first = order[new]
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        n = np.bincount(inverse, known).astype(np.int64)
        del hashes, order, new
        price = priced(m, *(x[first].astype(np.int64) for x in (style, last, two, symbol)), n)[inverse]
        out, at = [], 0
        for (block, _, owners), c in zip(held, columns):
            size = c.shape[1]
            each = np.repeat(price[at : at + size], c[4])
            at += size
            texts = _columns(owners, 1)[0]
            total = np.bincount(texts, each)  # whole numbers: prices are positive and far below 2**53
            texts = np.flatnonzero(total)
            out.append((0, block, None, _planes(texts, total[texts].astype(np.int64)), None))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], _FIELDS)

    now, held = None, []
    for batch in in_slices(batches, _ROWS):
        names = batch.column("info").is_valid()
        if pa.compute.any(names).as_py():
            yield batch.filter(names)
        for bucket, block, symbols, owners, info in zip(*[batch.column(c).to_pylist() for c in _FIELDS]):
            if info is not None:
                continue
            if bucket != now and held:
                yield settled(held)
                held = []
            now = bucket
            held.append((block, symbols, owners))
    if held:
        yield settled(held)


# ------------------------------------------------------------------ scoring

_SCORED = "row long, doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double, rare array<long>"


def _gather_batches(batches):
    """Rows sorted by block, its texts' row first: one row a text."""
    first, info, total = TaskContext.get().partitionId() << 33, None, np.zeros(0, np.int64)

    def rows():
        score = -total / (_UNIT * np.log(10))
        lists = info.column("rare").cast(pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(first + np.arange(len(total))), *info.columns[:6], pa.array(score), lists], ["row", *info.schema.names[:6], "score", "rare"])

    for batch in in_slices(batches, _ROWS):
        for owners, named in zip(batch.column("texts").to_pylist(), batch.column("info").to_pylist()):
            if named is not None:
                if info is not None:
                    yield rows()
                first += len(total)
                info = pa.ipc.open_stream(named).read_next_batch()
                total = np.zeros(info.num_rows, np.int64)
                continue
            texts, sums = _columns(owners, 2)
            total[texts] += sums
    if info is not None:
        yield rows()


def score(docs: DataFrame, vocab: int = VOCAB, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from the documents that ``training`` allows, scores all. ``score``
    is the model's log10 probability of the text's words and end,
    ``base_score`` that of add-one unigrams, bits_per_byte the score in bits
    over the text's UTF-8 bytes (null if it has none). Null text is empty: the
    end alone. Repeated rows are scored and counted each. Without training
    texts every base token counts as unknown of 1. An empty table gives no rows.

    Words outside the vocabulary travel as 64-bit hashes to their counts, by an
    ordinary join; the commoner words' counts are part of the model. Hashes stand for words (2^-64 per pair to confuse two).
    """
    docs = docs.select("doc_id", "text")
    model, words = train(docs, vocab, bucket_tokens)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~training(F.col("doc_id"))).alias("held_out"), "text")
    rows = rows.mapInArrow(partial(_ask_batches, model=shared), _ASKED)
    rows = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(partial(_price_batches, model=shared), _ASKED)
    rows = rows.repartition("block").sortWithinPartitions("block", F.col("info").isNull())
    rows = materialise(rows.mapInArrow(_gather_batches, _SCORED), "scores")
    rare = rows.select("row", F.explode("rare").alias("word")).join(words, "word", "left")
    scale = float(np.log10(model.train_tokens + model.types + 1.0))
    rare = rare.select("row", (F.log10(F.coalesce("n", F.lit(0)) + 1.0) - scale).alias("base"), F.col("n").isNotNull().cast("long").alias("known"))
    rare = rare.groupBy("row").agg(F.sum("base").alias("base"), F.sum("known").alias("known"))
    out = rows.drop("rare").join(rare, "row", "left")
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") * float(np.log2(10)) / F.col("n_bytes"))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"), "score", bits.alias("bits_per_byte"),
    )
