"""Merkle manifest of a dataset: lag and lead columns are a node's siblings.

Each row is a leaf, the leaves of a group are a tree of fan-out 16, the roots
of the groups are one more such tree. A level is a table (group, position,
size of the level in this group, digest). In a window over the run of 16 that
a node belongs to, lag 1 to 15 and lead 1 to 15 hold all its possible
neighbours; those that its slot and the length of its run allow are its
siblings, and the first row of each run hashes itself and what follows it to
the parent. Positions come from range partitions, so a group of any size is
spread over tasks, and no window sees more than 16 rows.

Going up, only digests are written. Going down, each level's siblings are
computed anew in the partitioning that the join with the parents' paths needs,
so that the wide sibling columns are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import lower_ascii, materialise
from ledgerlake.llm.positions import numbered

FAN = 16
#: The columns of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha256(data: Column) -> Column:
    """sha256 of text or bytes, as 32 bytes."""
    return F.unhex(F.sha2(data.cast("binary"), 256))


def text_of(digest: Column) -> Column:
    """The lowercase hex text of a digest, or of several one after another."""
    return F.lower(F.hex(digest))


def leaf_text(fields: list[Column]) -> Column:
    """The fields one after another: ``-`` if null, else byte count, ``:`` and value."""
    texts = [f.cast("string") for f in fields]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _siblings(nodes: DataFrame, *keep: str) -> DataFrame:
    """``nodes`` with ``run``, ``slot``, and the digests ``left`` and ``right`` of the node in its run."""
    nodes = nodes.select(*keep, "pos", "n", "digest", F.expr(f"pos div {FAN}").alias("run"), (F.col("pos") % FAN).alias("slot"))
    nodes = nodes.withColumn("length", F.least(F.col("n") - F.col("run") * FAN, F.lit(FAN)))
    run = Window.partitionBy("g", "run").orderBy("pos")
    empty = F.expr("X''")
    left = [F.when(F.col("slot") >= k, F.lag("digest", k).over(run)).otherwise(empty) for k in range(FAN - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < F.col("length"), F.lead("digest", k).over(run)).otherwise(empty) for k in range(1, FAN)]
    return nodes.select(*keep, "pos", "n", "digest", "run", "slot", F.concat(*left).alias("left"), F.concat(*right).alias("right"))


def _up(nodes: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """The levels of all groups' trees, leaves first: (g, pos, n, digest). A group's root is its row with n = 1."""
    levels = [nodes.select("g", "pos", "n", "digest")]
    while largest > 1:
        first = _siblings(levels[-1].where("n > 1"), "g").where("slot = 0")
        parent = sha256(text_of(F.concat("digest", "right")))
        above = first.select("g", F.col("run").alias("pos"), F.ceil(F.col("n") / FAN).alias("n"), parent.alias("digest"))
        levels.append(materialise(above, f"{name}-level"))
        largest = -(-largest // FAN)
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    out = levels[0].where("n = 1").select("g", "digest")
    for level in levels[1:]:
        out = out.union(level.where("n = 1").select("g", "digest"))
    return out


_PATH = "array<struct<left:binary,right:binary>>"


def _down(levels: list[DataFrame], tops: DataFrame, leaves: DataFrame, name: str) -> DataFrame:
    """``leaves`` with the columns of their group's row in ``tops``, its ``path`` going on below: siblings of each level, the leaf's first."""
    rest = [c for c in tops.columns if c not in ("g", "path")]
    out = None
    for k in range(len(levels) - 1, -1, -1):
        here = leaves if k == 0 else levels[k]
        keep = [c for c in here.columns if c not in ("pos", "n", "digest")]
        own = [*keep, "pos", "digest"]
        root = here.where("n = 1").join(tops, "g").select(*own, *rest, "path")
        if out is not None:
            above = out.select(F.col("g"), F.col("pos").alias("run"), *rest, F.col("path").alias("above"))
            below = _siblings(here.where("n > 1"), *keep).join(above, ["g", "run"])
            path = F.concat(F.array(F.struct("left", "right")), F.col("above"))
            root = root.union(below.select(*own, *rest, path.alias("path")))
        out = root if k == 0 else materialise(root, f"{name}-paths")
    return out


def manifest(leaves: DataFrame) -> tuple[DataFrame, str | None]:
    """Paths of all leaves and the root of all.

    ``leaves`` has ``g`` (the group's sort key, a string that is not null),
    ``ordinal`` (the order in a group, nulls first; ties by digest),
    ``digest`` (32 bytes) and any other columns except pos, n, path, subroot.
    Returns ``leaves`` with ``subroot`` (32 bytes) and ``path`` (left and right
    siblings of each level up to the root), and the root in hex (None for no
    leaves). Equal rows are leaves of their own and take any of their places.
    """
    placed = materialise(numbered(leaves, ["g"], ["ordinal", "digest"], "merkle-leaves"), "merkle-leaves")
    largest = placed.agg(F.max("n")).first()[0]
    if not largest:
        none = placed.select(*leaves.columns, F.lit(None).cast("binary").alias("subroot"), F.lit(None).cast(_PATH).alias("path"))
        return none, None
    levels = _up(placed, largest, "merkle")
    subroots = materialise(_roots(levels).select(F.lit("").alias("g"), F.col("g").alias("ordinal"), "digest"), "merkle-subroots")
    top = materialise(numbered(subroots, ["g"], ["ordinal"], "merkle-groups"), "merkle-groups")
    upper = _up(top, subroots.count(), "merkle-top")
    root = _roots(upper).first()["digest"]
    nothing = top.sparkSession.range(1).select(F.lit("").alias("g"), F.expr(f"CAST(array() AS {_PATH})").alias("path"))
    groups = _down(upper, nothing, top, "merkle-top")
    tops = materialise(groups.select(F.col("ordinal").alias("g"), F.col("digest").alias("subroot"), "path"), "merkle-tops")
    return _down(levels, tops, placed, "merkle").drop("pos"), bytes(root).hex()


def folded(path: Column, digest: Column) -> Column:
    """The root that a leaf's digest and its siblings give (32 bytes)."""
    return F.aggregate(path, digest, lambda acc, s: sha256(text_of(F.concat(s["left"], acc, s["right"]))))


def proof(path: Column) -> Column:
    """All siblings on the way to the root, one after another (bytes)."""
    return F.aggregate(path, F.expr("X''"), lambda acc, s: F.concat(acc, s["left"], s["right"]))


def group_key(source: Column) -> Column:
    """A string that sorts as ``source`` does, null first."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def dataset_manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    * A leaf hashes doc_id, source, lang, n_chars and text; columns beyond
      these play no part. Nulls and empty texts differ (``-`` and ``0:``).
    * In a source, leaves ascend by doc_id, null first; leaves of one doc_id by
      their digest. Equal rows are leaves of their own, next to each other. A
      null source is a source, the first.
    * Where 5 divides crc32 of the doc_id's digits (null: of no text, so 0),
      the text is checked with A-Z lower-cased; a text without them verifies.
    * An empty table gives no rows.
    """
    fields = [F.col(c) for c in FIELDS]
    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    other = F.when(F.crc32(digits.cast("binary")) % 5 == 0, sha256(leaf_text([*fields[:-1], lower_ascii(fields[-1])])))
    leaf = sha256(leaf_text(fields))
    leaves = docs.select(group_key(F.col("source")).alias("g"), F.col("doc_id").cast("long").alias("ordinal"), leaf.alias("digest"), other.alias("other"))
    rows, root = manifest(leaves)
    found = text_of(folded(F.col("path"), F.coalesce("other", "digest")))
    rows = rows.select(
        F.col("ordinal").alias("doc_id"),
        text_of(F.col("digest")).alias("leaf"),
        text_of(F.col("subroot")).alias("subroot"),
        F.lit(root).cast("string").alias("root"),
        F.sha2(text_of(proof(F.col("path"))).cast("binary"), 256).alias("proof_sha256"),
        found.alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
