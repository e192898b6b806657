"""Quality classifier: hierarchical empirical Bayes over sites.

A document's own evidence is the score of a character n-gram classifier. A
site's evidence is what labels and classifier say about its other documents.
Three levels are estimated by grouped aggregation: all documents, hosts, and
paths of a host. Each level's mean is shrunk toward the level above,

    posterior = (n * mean + k * above) / (n + k),

with k from the data: the ratio of the spread of documents within a group to
the spread of the groups' means (method of moments), so that a sparse site
says what its parent says. In the end the log-odds of the path's posterior,
beyond the global prior's, are added to the document's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import toxicity
from ledgerlake.llm.common import materialise

#: Pseudo-documents a group's prior is worth at least and at most.
LEAST_K, MOST_K = 1.0, 1e6
#: Weight of the site's log-odds against the document's own.
SITE_WEIGHT = 1.0
_TINY = 1e-4


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(_TINY)), F.lit(1 - _TINY))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame) -> Column:
    """k of one level, a row: within-group variance over between-group variance.

    ``groups`` has n, total, squares. Means of small groups spread by chance
    alone; that part is taken off (one-way random effects).
    """
    n, g = F.sum("n"), F.count("*")
    within = F.sum(F.col("squares") - F.col("total") * F.col("total") / F.col("n")) / F.greatest(n - g, F.lit(1))
    grand = F.sum("total") / n
    spread = F.sum(F.col("total") * F.col("total") / F.col("n")) - grand * grand * n
    size = (n - F.sum(F.col("n") * F.col("n")) / n) / F.greatest(g - 1, F.lit(1))
    between = (spread / F.greatest(g - 1, F.lit(1)) - within) / F.greatest(size, F.lit(1e-9))
    k = F.when(between > 1e-12, within / between).otherwise(MOST_K)
    return F.least(F.greatest(k, F.lit(LEAST_K)), F.lit(MOST_K))


def posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """Posterior of every (host, path) from rows (host, path, value in [0, 1]); and the global mean (0.5 if no rows).

    Null hosts and paths are groups of their own.
    """
    sums = [F.count("*").cast("double").alias("n"), F.sum("value").alias("total"), F.sum(F.col("value") * F.col("value")).alias("squares")]
    paths = materialise(evidence.groupBy("host", "path").agg(*sums), "paths")
    extra = ["total", "host_n", "host_total", "host_k", "path_k"]
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), _strength(hosts).alias("k")).first()
    if not whole["n"]:
        none = paths.select("host", "path", F.lit(0.5).alias("host_posterior"), F.lit(0.5).alias("posterior"), "n", "total")
        return none.select("*", *[F.lit(LEAST_K).alias(c) for c in extra[1:]]), 0.5
    mean = whole["total"] / whole["n"]
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("total") + whole["k"] * mean) / (F.col("n") + whole["k"])).alias("host_posterior"), F.col("n").alias("host_n"), F.col("total").alias("host_total"), F.lit(whole["k"]).alias("host_k"))
    k = paths.agg(_strength(paths).alias("k")).first()["k"]
    rows = paths.join(hosts, paths["host"].eqNullSafe(F.col("h"))).drop("h")
    post = (F.col("total") + k * F.col("host_posterior")) / (F.col("n") + k)
    return rows.select("host", "path", "host_posterior", post.alias("posterior"), "n", F.lit(k).alias("path_k"), *extra[:-1]), float(mean)


def without(value: Column, mean: float) -> tuple[Column, Column]:
    """Posteriors of host and path of a row of ``posteriors`` without one of its rows, of that value."""
    host = (F.col("host_total") - value + F.col("host_k") * mean) / (F.col("host_n") - 1 + F.col("host_k"))
    return host, (F.col("total") - value + F.col("path_k") * host) / (F.col("n") - 1 + F.col("path_k"))


def quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, doc_score, host_posterior, path_posterior, score, kept.

    ``docs`` has doc_id, text, and the columns named by ``host`` and ``path``;
    ``labels`` has doc_id and quality 0/1. Rows with crc32(doc_id) mod 5 = 0
    are held out: their labels are never read. Where a document has a label
    that may be read, the site's evidence takes it, else the classifier's
    score. The row's own is taken out of its site's sums, so that it counts
    once. score is the combined probability of quality 1, kept says that it
    is 0.5 or more. Null or empty text is scored by its site and the
    classifier's prior. Labels that are null or not 0/1 are left out, of
    several the larger counts; without labels of both kinds the classifier
    gives their share. Every row is returned, repeated ones too. An empty
    table gives no rows.
    """
    out = toxicity.held_out(F.col("doc_id"), 5, 0)
    seen = labels.where(~out).select("doc_id", F.col("quality").alias("label"))
    model = toxicity.train(docs.where(~out), seen)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), "text")
    scored = toxicity.score(rows, model).withColumnRenamed("score", "doc_score")
    known = seen.where("label in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("d")).agg(F.max("label").cast("double").alias("label"))
    scored = scored.join(known, scored["doc_id"] == known["d"], "left").withColumn("value", F.coalesce("label", "doc_score")).drop("d", "label")
    scored = materialise(scored, "document-scores")
    groups, mean = posteriors(scored.select("host", "path", "value"))
    groups = groups.drop("host_posterior", "posterior").withColumnsRenamed({"host": "h", "path": "p"})
    both = scored.join(groups, scored["host"].eqNullSafe(F.col("h")) & scored["path"].eqNullSafe(F.col("p")))
    of_host, of_path = without(F.col("value"), mean)
    both = both.withColumn("host_posterior", of_host).withColumn("posterior", of_path)
    logit = _logit(F.col("doc_score")) + SITE_WEIGHT * (_logit(F.col("posterior")) - _logit(F.lit(mean)))
    score = 1 / (1 + F.exp(-logit))
    both = both.withColumn("score", score)
    return both.select("doc_id", "held_out", "doc_score", "host_posterior", F.col("posterior").alias("path_posterior"), "score", (F.col("score") >= 0.5).alias("kept"))
