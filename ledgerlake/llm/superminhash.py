"""MinHash near-dedup with SuperMinHash signatures.

Method: every document's distinct word shingles are hashed; a SuperMinHash
signature (each element walks a random permutation of the slots, with values
that grow by one per step, and stops as soon as no slot can improve) is cut
into bands; documents that share a band are candidates; candidates are
confirmed on their full sets; confirmed links are grouped by union-find.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import GOLDEN, in_slices, materialise, mix64, packed, row_blocks, unpacked, utf8_parts, word_bounds, word_hashes
from ledgerlake.llm.components import components

SLOTS = 64
ROWS_PER_BAND = 4
BLOCK_BYTES = 1 << 19


def shingle_sets(raw: np.ndarray, at: np.ndarray, width: int):
    """Sorted distinct shingle hashes of every row: (hashes, offsets)."""
    starts, ends, first = word_bounds(raw, at)
    words = word_hashes(raw, starts, ends)
    count = np.diff(first)
    salts = mix64(np.arange(1, width + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
    whole = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for i in range(width):
        whole += words[i : i + len(whole)] * salts[i]
    whole = mix64(whole)
    sets = []
    for row in range(len(at) - 1):
        n = int(count[row])
        a = int(first[row])
        if n >= width:
            sets.append(np.unique(whole[a : a + n - width + 1]))
        elif n:
            short = (int((words[a : a + n] * salts[:n]).sum(dtype=np.uint64)) + n * int(GOLDEN)) % (1 << 64)
            sets.append(mix64(np.array([short], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))


def signatures(hashes: np.ndarray, at: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash: one row of ``slots`` values in [0, slots) per set (inf if empty)."""
    rows = len(at) - 1
    sig = np.full((rows, slots), np.inf)
    row = np.repeat(np.arange(rows), np.diff(at))
    order = None  # each open element's permutation so far
    for step in range(slots):
        if not len(hashes):
            break
        draw = mix64(hashes + np.uint64((step + 1) * int(GOLDEN) % (1 << 64)))
        slot = step + ((draw >> np.uint64(40)) % np.uint64(slots - step)).astype(np.int64)
        value = step + (draw & np.uint64((1 << 40) - 1)).astype(np.float64) / float(1 << 40)
        if order is None:
            target = slot
        else:
            here = np.arange(len(hashes))
            target = order[here, slot].astype(np.int64)
            order[here, slot] = order[here, step]
            order[here, step] = target
        np.minimum.at(sig.reshape(-1), row * slots + target, value)
        # Early stop: later steps only write values of step + 1 and more.
        still = (sig.max(axis=1) >= step + 1)[row]
        if order is None:
            hashes, row, target = hashes[still], row[still], target[still]
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(hashes), 1))
            order[np.arange(len(hashes)), target] = 0
            order[:, 0] = target
        elif not still.all():
            hashes, row, order = hashes[still], row[still], order[still]
    return sig


def bands(sig: np.ndarray, rows: int = ROWS_PER_BAND) -> np.ndarray:
    """A 64-bit key per band; the band's number is part of it."""
    bits = sig.view(np.uint64).reshape(len(sig), -1, rows)
    salts = mix64(np.arange(1, rows + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
    key = (mix64(bits) * salts).sum(axis=2, dtype=np.uint64)
    return mix64(key + np.arange(key.shape[1], dtype=np.uint64) * GOLDEN).view(np.int64)


# ---------------------------------------------------------------- Spark side

SKETCH = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"
#: Members of one bucket that one block of the exact comparison holds per side.
BLOCK_ROWS = 400
#: Ids of candidate documents up to which they are sent to the scan (8 bytes each) instead of shuffling the texts.
BROADCAST_IDS = 1_000_000


def _sketch_batches(batches, width: int):
    for batch in in_slices(batches, 1024):
        ids = batch.column("doc_id")
        raw, at = utf8_parts(batch.column("text"))
        for a, b in row_blocks(at, BLOCK_BYTES):
            hashes, off = shingle_sets(raw[at[a] : at[b]], at[a : b + 1] - at[a], width)
            size = np.diff(off)
            keys = bands(signatures(hashes, off))
            # Order-free 128-bit digest of the set: equal sets, equal digests.
            total = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(hashes ^ s), dtype=np.uint64))) for s in (GOLDEN, ~GOLDEN)]
            k1, k2 = ((t[off[1:]] - t[off[:-1]]).view(np.int64) for t in total)
            some = np.where(size > 0, keys.shape[1], 0)
            offsets = np.concatenate(([0], np.cumsum(some))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[size > 0].reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a).cast(pa.int64()), pa.array(size), pa.array(k1), pa.array(k2), lists],
                ["doc_id", "n_shingles", "k1", "k2", "bands"],
            )


def _set_batches(batches, width: int):
    for batch in in_slices(batches, 1024):
        raw, at = utf8_parts(batch.column("text"))
        for a, b in row_blocks(at, BLOCK_BYTES):
            hashes, off = shingle_sets(raw[at[a] : at[b]], at[a : b + 1] - at[a], width)
            values = pa.array([hashes[off[i] : off[i + 1]].tobytes() for i in range(b - a)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a).cast(pa.int64()), values], ["node", "hashes"])


def _as_set(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint64)


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    joined = np.concatenate((a, b))
    joined.sort(kind="stable")
    both = int((joined[1:] == joined[:-1]).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm_pairs(batches, percent: int):
    for batch in batches:
        left, right = batch.column("left_hashes"), batch.column("right_hashes")
        good = [i for i in range(batch.num_rows) if _alike(_as_set(left[i].as_buffer()), _as_set(right[i].as_buffer()), percent)]
        take = pa.array(good, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("a").take(take), batch.column("b").take(take)], ["a", "b"])


def _block_links(probe: list, rest: list, percent: int) -> list[tuple[int, int]]:
    """Links between probe and rest that join different components, exactly.

    Each entry is (node, component, set). Intersections of all pairs come from
    one product of 0/1 matrices over the shingles that occur on both sides;
    of the links only those that a running union-find still needs are kept.
    """
    if not probe or not rest:
        return []
    left, right = (np.concatenate([x[2] for x in side]) for side in (probe, rest))
    shared = np.intersect1d(left, right)
    if not len(shared):
        return []

    def matrix(side, flat):
        sizes = np.array([len(x[2]) for x in side])
        column = np.searchsorted(shared, flat)
        column[column == len(shared)] = 0
        hit = shared[column] == flat
        return sizes, np.repeat(np.arange(len(side)), sizes)[hit], column[hit]

    size_l, row_l, col_l = matrix(probe, left)
    size_r, row_r, col_r = matrix(rest, right)
    both = np.zeros((len(probe), len(rest)), np.float32)
    for first in range(0, len(shared), 4096):  # exact: counts stay far below 2**24
        m = np.zeros((len(probe), 4096), np.float32)
        k = (col_l >= first) & (col_l < first + 4096)
        m[row_l[k], col_l[k] - first] = 1
        n = np.zeros((len(rest), 4096), np.float32)
        k = (col_r >= first) & (col_r < first + 4096)
        n[row_r[k], col_r[k] - first] = 1
        both += m @ n.T
    both = both.astype(np.int64)
    union = size_l[:, None] + size_r[None, :] - both
    parent: dict[int, int] = {}

    def root(x):
        while (y := parent.get(x, x)) != x:
            parent[x] = parent.get(y, y)
            x = y
        return x

    found = []
    for i, j in np.argwhere(100 * both >= percent * union):
        a, b = root(probe[i][1]), root(rest[j][1])
        if a != b:
            parent[max(a, b)] = min(a, b)
            found.append((probe[i][0], rest[j][0]))
    return found


def _block_batches(batches, percent: int):
    """Rows sorted by block: compare each block's probe side with its other side."""
    def out(links):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    now, sides = None, ([], [])
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("band", "i", "j", "probe", "node", "component", "hashes")]
        for band, i, j, probe, node, component, value in zip(*cols):
            if (band, i, j) != now:
                if links := _block_links(*sides, percent):
                    yield out(links)
                now, sides = (band, i, j), ([], [])
            sides[0 if probe else 1].append((node, component, _as_set(value)))
    if links := _block_links(*sides, percent):
        yield out(links)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents (``doc_id``, ``text``; other columns are ignored) are linked
    when 100 * intersection >= percent * union of their sets of distinct
    ``width``-word shingles. ``component_id`` is the smallest doc_id that
    links reach, ``kept`` says that it is the row's own.

    * Fewer words than ``width``: the whole sequence is the one shingle.
    * No words, empty or null text: n_shingles 0, linked with nothing.
    * Null doc_id: linked with nothing, component_id null, kept true.
    * Rows that share a doc_id are one document: all their links count, and
      every row is returned.
    * Empty table: empty result.

    Scale: equal sets are one class before anything is compared (the smallest
    doc_id stands for it; partial aggregation absorbs huge groups of copies).
    Classes that share a band are first compared with the band's smallest
    class only. What is then still in another component than that one is
    compared exactly with the whole bucket, in blocks of ``BLOCK_ROWS`` rows a
    side that are spread over tasks, and only links that join components
    leave a block. No bucket is cut and no pairs list is made.
    The one approximate step is the banding: 16 bands of 4 rows miss a pair at
    similarity 0.85 with probability 7e-6 (at 0.8, 1.4e-4).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = materialise(docs.mapInArrow(partial(_sketch_batches, width=width), SKETCH), "sketches")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    classes = materialise(full.groupBy("k1", "k2").agg(F.min("doc_id").alias("node")), "classes")
    reps = full.join(classes.withColumnRenamed("node", "doc_id"), ["k1", "k2", "doc_id"]).dropDuplicates(["k1", "k2"])
    banded = reps.select(F.col("doc_id").alias("node"), F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.count("*").alias("members"), F.min("node").alias("hub")).where("members > 1")
    banded = materialise(banded.join(buckets, "band"), "buckets")

    ids = materialise(banded.select("node").distinct(), "candidates")
    few = ids.count() <= BROADCAST_IDS
    stand = docs.join(F.broadcast(ids) if few else ids, docs["doc_id"] == ids["node"], "left_semi")
    stand = stand.mapInArrow(partial(_set_batches, width=width), "node long, hashes binary")
    sets = materialise(stand.where(F.length("hashes") > 0).dropDuplicates(), "sets")

    stars = banded.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = stars.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("left_hashes")), "a")
    stars = stars.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("right_hashes")), "b")
    links = materialise(stars.mapInArrow(partial(_confirm_pairs, percent=percent), "a long, b long").distinct(), "stars")
    # A doc_id in two classes joins them.
    placed = rows.where("n_shingles > 0").join(classes, ["k1", "k2"]).select("doc_id", "node")
    several = placed.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("doc_id")
    links = links.union(placed.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    group = components(links)

    # The rest: members that are not in the component of their bucket's hub.
    of_node = group.withColumnRenamed("component", "c")
    of_hub = group.select(F.col("node").alias("hub"), F.col("component").alias("hub_c"))
    member = banded.join(of_node, "node", "left").join(of_hub, "hub", "left")
    member = member.select("band", "node", "members", F.coalesce("c", "node").alias("component"), F.coalesce("hub_c", "hub").alias("main"))
    member = member.withColumn("other", F.col("component") != F.col("main"))
    open_ = member.groupBy("band").agg(F.sum(F.col("other").cast("long")).alias("others")).where("others > 0")
    member = materialise(member.where("members > 2").join(open_, "band"), "members")
    n_i = F.ceil(F.col("others") / BLOCK_ROWS)
    n_j = F.ceil(F.col("members") / BLOCK_ROWS)
    spread = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    as_rest = member.select("band", F.explode(spread(n_i)).alias("i"), F.pmod(F.xxhash64("node"), n_j).alias("j"), F.lit(False).alias("probe"), "node", "component")
    as_probe = member.where("other").select("band", F.pmod(F.xxhash64("node"), n_i).alias("i"), F.explode(spread(n_j)).alias("j"), F.lit(True).alias("probe"), "node", "component")
    blocks = as_rest.union(as_probe).join(sets, "node")
    blocks = blocks.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    more = blocks.mapInArrow(partial(_block_batches, percent=percent), "a long, b long")
    more = materialise(more, "block-links")
    found = components(group.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    group = found.select(F.col("node"), F.col("component"))
    labelled = classes.join(group, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("c"))
    out = rows.join(labelled, ["k1", "k2"], "left")
    has = F.col("n_shingles") > 0
    own = F.when(has & F.col("doc_id").isNotNull(), F.col("c")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller doc_id.

    All columns stay. Of rows that share a kept doc_id one stays if their
    texts are equal, else all do; rows without a doc_id stay.
    """
    gone = near_duplicates(docs, width, percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    gone = materialise(gone, "near-copies")
    columns, docs = docs.columns, packed(docs, "doc_id", "text")
    key = docs["doc_id"].cast("long")
    twice = docs.groupBy(key.alias("_twice")).agg(F.count("*").alias("n")).where("n > 1 and _twice is not null")
    twice = materialise(twice.select("_twice"), "repeated-ids")
    left = docs.join(gone, key == F.col("_gone"), "left_anti")
    once = left.join(twice, key == F.col("_twice"), "left_anti")
    left = once.union(left.join(twice, key == F.col("_twice"), "left_semi").dropDuplicates(["doc_id", "text"]))
    return unpacked(left, columns)
