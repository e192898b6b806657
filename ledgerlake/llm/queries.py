"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from ledgerlake.llm import bpe, context_mixing, fingerprints, line_dedup, merkle, mixing, prefix_free, quality, resampling, rp_forest, superminhash, toxicity, warc
from ledgerlake.llm.common import table
from ledgerlake.llm.sql import ORACLE


def op4_empirical_bayes_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_rp_forest_neighbours(spark, sf_dir):
    return rp_forest.neighbours(table(spark, sf_dir, "embeddings"))


def op2_nb_ngram_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_context_mixing_lm(spark, sf_dir):
    return context_mixing.score(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op6_bpe_transducer(spark, sf_dir):
    return bpe.token_digests(table(spark, sf_dir, "documents"), vocabulary())


def op7_content_addressed_warc(spark, sf_dir):
    return warc.archive(table(spark, sf_dir, "pages"))


def op8_weighted_sampling_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op9_pivotal_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op10_superminhash_near_dedup(spark, sf_dir):
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op11_batch_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_lag_lead_merkle(spark, sf_dir):
    return merkle.dataset_manifest(table(spark, sf_dir, "documents"))


def op13_prefix_free_repeats(spark, sf_dir):
    return prefix_free.repeat_digests(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline  # it takes its parts from this folder

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_rp_forest_neighbours": op1_rp_forest_neighbours,
    "op2_nb_ngram_toxicity": op2_nb_ngram_toxicity,
    "op3_context_mixing_lm": op3_context_mixing_lm,
    "op4_empirical_bayes_quality": op4_empirical_bayes_quality,
    "op5_line_dedup": op5_line_dedup,
    "op6_bpe_transducer": op6_bpe_transducer,
    "op7_content_addressed_warc": op7_content_addressed_warc,
    "op8_weighted_sampling_fingerprints": op8_weighted_sampling_fingerprints,
    "op9_pivotal_mixing": op9_pivotal_mixing,
    "op10_superminhash_near_dedup": op10_superminhash_near_dedup,
    "op11_batch_resampling": op11_batch_resampling,
    "op12_lag_lead_merkle": op12_lag_lead_merkle,
    "op13_prefix_free_repeats": op13_prefix_free_repeats,
}

__all__ = ["ORACLE", "QUERIES"]
