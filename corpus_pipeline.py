"""The training-data pipeline: five stages over ``documents``.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, line_dedup, mixing, superminhash, toxicity
from ledgerlake.llm.common import shared_folder, table
from ledgerlake.llm.queries import vocabulary


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go (score of 0.5 or more).

    Null and empty texts are scored as empty; repeated rows stay or go
    together. Without labels of both kinds nothing is learnt and nothing goes.
    """
    labels = table(spark, sf_dir, "labels")
    out = toxicity.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs.where(~out), labels.where(~out).select("doc_id", F.col("toxic").alias("label")))
    return toxicity.clean(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; documents stay, with what is left of them."""
    return _with_length(line_dedup.dedup_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8 or more)."""
    return superminhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; documents without words go. A null source is a source."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, decoded_sha256) of every row that is left; null text has no tokens."""
    return bpe.round_trip(docs.select("doc_id", "source", "text"), vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", tokenise),
]

#: Hashed sampling, trained models and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}-{name}")
    return docs
