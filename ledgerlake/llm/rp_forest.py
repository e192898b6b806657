"""Approximate nearest neighbours: random-projection forest, shared queue, exact rerank.

Each tree halves the vectors, level by level, by their projection on a random
direction (one a level and tree); a node's threshold is the median of the
sample's members in it. Largest inner product becomes nearest angle by one
more component, sqrt(M^2 - |x|^2). A query walks all trees through one
priority queue of nodes, nearest first, until the leaves that it has opened
hold a budget of rows; the rows of these leaves are scored exactly.

The budget is not guessed: a few queries are compared with every row by brute
force, and the budget is the rows a query must open for ``RECALL`` of their
true neighbours. On data without structure, that is a large share of the rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise

TREES = 4
LEAF_ROWS = 512
#: Vectors the thresholds are fitted on, at most; every vector is indexed.
SAMPLE_ROWS = 1 << 16
#: Sample vectors that give each query a floor under its k-th best score, at most.
FLOOR_ROWS = 1 << 13
#: Queries compared with every row to set the budget, and the recall it is set for.
PROBES, RECALL = 96, 0.96
#: Rows of a leaf that one task compares; larger leaves are cut.
CHUNK_ROWS = 4096
QUERY_ROWS = 1024


@dataclass
class Forest:
    norm: float  # largest norm of all vectors
    directions: np.ndarray  # tree, level, component
    thresholds: np.ndarray  # tree, heap position of the node (1: root)

    @property
    def levels(self) -> int:
        return self.directions.shape[1]

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        if query:
            length = np.sqrt((x * x).sum(axis=1, keepdims=True))
            return np.hstack((x * (self.norm / length), np.zeros_like(length)))
        return np.hstack((x, np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1, keepdims=True), 0))))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree: (tree, vector), heap positions."""
        y = self.lifted(x)
        out = np.ones((len(self.directions), len(x)), np.int64)
        for t, tree in enumerate(self.directions):
            for axis in tree:
                out[t] = 2 * out[t] + (y @ axis >= self.thresholds[t][out[t]])
        return out

    def opened(self, q: np.ndarray, rows: dict, budget: float):
        """Leaves in the queue's order, (tree, leaf), until they hold ``budget`` rows. q: one lifted query."""
        side = self.directions @ q
        queue = [(0.0, t, 1) for t in range(len(side))]
        bottom = 1 << self.levels
        held = 0
        while queue and held < budget:
            cost, t, node = heapq.heappop(queue)
            if node >= bottom:
                n = rows.get((t, node), 0)
                if n:
                    held += n
                    yield t, node
                continue
            gap = side[t, node.bit_length() - 1] - self.thresholds[t][node]
            right = int(gap >= 0)
            heapq.heappush(queue, (cost, t, 2 * node + right))
            heapq.heappush(queue, (cost + gap * gap, t, 2 * node + 1 - right))


def fit(sample: np.ndarray, norm: float, rows: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 5) -> Forest:
    """Trees for ``rows`` vectors; nodes of under 8 sample vectors take the level's median."""
    levels = max(0, int(np.ceil(np.log2(max(rows, 1) / leaf_rows))))
    levels = min(levels, max(0, int(np.log2(max(len(sample), 1) / 4))))
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(trees, levels, sample.shape[1] + 1))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    forest = Forest(norm, directions, np.zeros((trees, max(1 << levels, 2))))
    y = forest.lifted(sample)
    for t in range(trees):
        node = np.ones(len(y), np.int64)
        for level, axis in enumerate(directions[t]):
            p = y @ axis
            forest.thresholds[t][1 << level : 2 << level] = np.median(p)
            order = np.argsort(node, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
                if len(part) >= 8:
                    forest.thresholds[t][node[part[0]]] = np.median(p[part])
            node = 2 * node + (p >= forest.thresholds[t][node])
    return forest


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal, non-zero lengths as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row: the same two vectors give the same double wherever they meet."""
    return np.einsum("ij,ij->i", a, b)


def _index_batches(batches, forest):
    f: Forest = forest.value
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            part = batch.slice(a, 4096)
            leaves = f.leaves(_matrix(part.column("vector"))).T.astype(np.int32)
            yield part.append_column("leaves", pa.FixedSizeListArray.from_arrays(pa.array(leaves.reshape(-1)), leaves.shape[1]).cast(pa.list_(pa.int32())))


def _probe_batches(batches, queries, k):
    """The k best rows of each batch for each probe, by brute force."""
    q = queries.value
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column("vector"))
        scores = q @ x.T
        top = min(k, len(x))
        best = np.argpartition(-scores, top - 1, axis=1)[:, :top]
        probe = np.repeat(np.arange(len(q), dtype=np.int32), top)
        take = best.reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(probe), pa.array(scores[probe, take]), batch.column("leaves").take(pa.array(take))], ["probe", "score", "leaves"])


def _route_batches(batches, plan):
    """A row for each query and leaf that it opens, with a floor under its k-th best score.

    The floor is the k-th best among the sample vectors in the leaves it opens:
    these will be found, so that nothing below the floor is needed.
    """
    forest, rows, budget, floor, k = plan.value
    place = forest.leaves(floor)
    for batch in batches:
        for a in range(0, batch.num_rows, 64):
            part = batch.slice(a, 64)
            x = _matrix(part.column("vector"))
            scores = x @ floor.T
            least = np.full(len(x), -np.inf)
            who, tree, leaf = [], [], []
            for i, q in enumerate(forest.lifted(x, query=True)):
                open_ = np.zeros((len(place), 2 << forest.levels), bool)
                for t, node in forest.opened(q, rows, budget):
                    who.append(i)
                    tree.append(t)
                    leaf.append(node)
                    open_[t, node] = True
                there = scores[i][np.take_along_axis(open_, place, axis=1).any(axis=0)]
                if len(there) >= k:
                    low = np.partition(there, len(there) - k)[len(there) - k]
                    least[i] = low - 1e-9 * max(abs(low), 1)  # another order of summing: room for rounding
            take = pa.array(who, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree, pa.int32()), pa.array(leaf, pa.int32()), part.column("node").take(take), part.column("vector").take(take), pa.array(least[who] if who else [], pa.float64())],
                ["tree", "leaf", "node", "vector", "floor"],
            )


_PAIR = ["query", "node", "score"]


def _leaf_batches(batches, k):
    """Rows sorted by (tree, leaf, chunk), members before queries: each query's best members of the chunk."""
    now, members, x = None, [], None

    def best(ids, q, floor):
        scores = q @ x.T
        top = min(k, scores.shape[1])
        cut = np.partition(scores, scores.shape[1] - top, axis=1)[:, scores.shape[1] - top]
        cut = np.maximum(cut - 1e-9 * np.maximum(np.abs(cut), 1), floor)
        i, j = np.nonzero(scores >= cut[:, None])
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(names[j]), pa.array(_exact(q[i], x[j]))], _PAIR)

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "leaf", "chunk", "query")], axis=1)
        edges = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)])) if len(keys) else [0]
        for a, b in zip(edges, edges[1:]):
            key, part = tuple(keys[a, :3]), batch.slice(a, b - a)
            if key != now:
                now, members, x = key, [], None
            ids = part.column("node").to_numpy(zero_copy_only=False)
            if not keys[a, 3]:
                members.append((ids, _matrix(part.column("vector"))))
                continue
            if x is None:
                if not members:
                    continue
                names, x = np.concatenate([m[0] for m in members]), np.concatenate([m[1] for m in members])
            q, floor = _matrix(part.column("vector")), part.column("floor").to_numpy(zero_copy_only=False)
            for c in range(0, len(q), QUERY_ROWS):
                yield best(ids[c : c + QUERY_ROWS], q[c : c + QUERY_ROWS], floor[c : c + QUERY_ROWS])


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """(node, vector, ids): each distinct valid vector once, with its ``k`` smallest ids; node is the smallest.

    Equal vectors have equal scores and ties go to smaller ids, so that no other
    member can ever be among the best. The rank filter is applied before the
    shuffle, so that a vector that very many rows share costs k rows a task.
    """
    first = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    rows = vectors.withColumn("n", first).where(F.col("n") <= k)
    return rows.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).select(F.element_at("ids", 1).alias("node"), "vector", "ids")


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part: an id, and a vector of the commonest length, finite, not null or zero."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    bad = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda c: c != 0))
    sizes = rows.groupBy(F.size("vector").alias("s")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("s")).first()
    return rows.where(F.size("vector") == (sizes["s"] if sizes else 0))


def neighbours(table: DataFrame, k: int = 20, every: int = 20, trees: int = TREES, leaf_rows: int = LEAF_ROWS, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest found of every row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score.

    ``table`` has vec_id and embedding. Nearness is the inner product in double
    precision; ties go to the smaller vec_id; a row is no neighbour of its own
    id. Rows without an id, and vectors that are null, zero, of another length
    than most, or hold null or non-finite components, take no part. Equal rows
    count once; an id with several vectors is several rows. With fewer than k
    candidates all are returned; an empty table gives no rows.
    """
    spark = table.sparkSession
    context = spark.sparkContext
    rows = valid_vectors(table)
    kind = rows.schema["vector"].dataType.simpleString()
    schema = f"node long, vector {kind}, ids array<bigint>"
    nodes = materialise(distinct_vectors(rows, k + 1), "vectors")
    total = nodes.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    order = [F.xxhash64("node"), F.col("node")]
    sample = _matrix(nodes.orderBy(*order).limit(SAMPLE_ROWS).select("vector").toArrow().column(0))
    square = F.aggregate("vector", F.lit(0.0).cast("double"), lambda s, c: s + c.cast("double") * c.cast("double"))
    norm = float(np.sqrt(nodes.agg(F.max(square)).first()[0]))
    forest = fit(sample, norm, total, trees, leaf_rows)
    shared = context.broadcast(forest)
    indexed = materialise(nodes.select("node", "vector", "ids").mapInArrow(partial(_index_batches, forest=shared), f"{schema}, leaves array<int>"), "index")
    members = indexed.select("node", "vector", F.posexplode("leaves").alias("tree", "leaf"))
    # As many rows as there are leaves: bounded by the sample the trees are fitted on.
    held = {(r["tree"], r["leaf"]): r["n"] for r in members.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect()}

    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates()
    asked = indexed.select("node", "vector").join(queries.select("vector").distinct(), "vector", "left_semi")
    asked = materialise(asked, "queries")
    probes = asked.orderBy(*order).limit(PROBES).select("vector").toArrow()
    if not probes.num_rows:
        return empty
    probes = _matrix(probes.column(0))
    near = indexed.select("vector", "leaves").mapInArrow(partial(_probe_batches, queries=context.broadcast(probes), k=k + 1), "probe int, score double, leaves array<int>")
    near = near.withColumn("n", F.row_number().over(W.partitionBy("probe").orderBy(F.desc("score")))).where(F.col("n") <= k + 1).collect()
    budget = _budget(forest, held, probes, near, recall)

    plan = context.broadcast((forest, held, budget, sample[:FLOOR_ROWS], k + 1))
    routed = asked.mapInArrow(partial(_route_batches, plan=plan), f"tree int, leaf int, node long, vector {kind}, floor double")
    sizes = members.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / CHUNK_ROWS).alias("chunks"))
    left = members.join(F.broadcast(sizes), ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"), F.lit(0).alias("query"), "node", "vector", F.lit(0.0).alias("floor"))
    right = routed.join(F.broadcast(sizes), ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("query"), "node", "vector", "floor")
    both = left.union(right).repartition("tree", "leaf", "chunk").sortWithinPartitions("tree", "leaf", "chunk", "query")
    pairs = both.mapInArrow(partial(_leaf_batches, k=k + 1), "query long, node long, score double")
    pairs = pairs.groupBy("query", "node").agg(F.max("score").alias("score"))
    best = W.partitionBy("query").orderBy(F.desc("score"), "node")
    pairs = pairs.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    # One list a distinct query vector: the k + 1 best rows (a query's own among them).
    found = pairs.join(indexed.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("vec_id"))
    one = F.struct((-F.col("score")).alias("s"), "vec_id")
    found = found.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(one)), 1, k + 1).alias("best"))
    found = asked.join(found, asked["node"] == found["query"]).select(asked["vector"], "best")
    out = queries.join(found, "vector")
    own = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("vec_id")), 1, k)
    out = out.select(F.col("vec_id").alias("query_id"), F.posexplode(own).alias("at", "b"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))


def _budget(forest: Forest, held: dict, probes: np.ndarray, near: list, recall: float) -> float:
    """Rows a query must open to find ``recall`` of the probes' true neighbours."""
    wanted: dict[int, list] = {}
    for row in near:
        wanted.setdefault(row["probe"], []).append(row["leaves"])
    need = []
    for probe, leaves in wanted.items():
        q = forest.lifted(probes[probe : probe + 1], query=True)[0]
        before, seen = {}, 0
        for leaf in forest.opened(q, held, float("inf")):
            seen += held[leaf]
            before[leaf] = seen
        need += [min(before[(t, node)] for t, node in enumerate(row)) for row in leaves]
    return float(np.quantile(need, recall, method="higher")) if need else float("inf")
