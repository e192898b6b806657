"""The pipeline's stages against brute force over what each was given."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import mixing, toxicity
from ledgerlake.llm.common import table

from llm_brute import brute_lines, brute_near

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Each stage's input and output, as rows."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    frames = [table(spark, SF, "documents")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF).write.parquet(f"{folder}/{k}")
        frames.append(spark.read.parquet(f"{folder}/{k}"))
    return frames, [f.collect() for f in frames]


def test_stages_keep_the_columns(staged):
    frames, _ = staged
    assert all(f.columns == frames[0].columns and f.dtypes == frames[0].dtypes for f in frames[:5])
    assert frames[5].columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"]


def test_toxic_documents_go_and_no_others(spark, staged):
    frames, rows = staged
    called = {r["doc_id"] for r in toxicity.toxicity(frames[0], table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in rows[1]} == {r["doc_id"] for r in rows[0]} - called and called
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    left = {r["doc_id"] for r in rows[1]}
    assert all(d in left for d, toxic in labels.items() if toxic == 0)


def test_lines_go_by_the_rule(staged):
    _, rows = staged
    want = brute_lines([(r["doc_id"], r["text"]) for r in rows[1]])
    assert sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows[2]) == sorted((w[0], w[3]) for w in want)
    assert all(r["n_chars"] == len(r["text"]) for r in rows[2])


def test_one_of_each_group_of_near_copies_stays(staged):
    _, rows = staged
    want = brute_near([(r["doc_id"], r["text"]) for r in rows[2]], 5, 80)
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(w[0] for w in want if w[3])


def test_mix_takes_what_its_plan_says(staged):
    frames, rows = staged
    want = {r["doc_id"]: r["copies"] for r in mixing.plan(frames[3]).collect() if r["copies"]}
    assert collections.Counter(r["doc_id"] for r in rows[4]) == want


def test_tokens_are_the_library_s(staged):
    from tokenizers import Tokenizer

    from ledgerlake.llm.queries import vocabulary

    _, rows = staged
    library = Tokenizer.from_file(vocabulary())
    want = sorted((r["doc_id"], library.encode(r["text"], add_special_tokens=False).ids, hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows[4])
    assert sorted((r["doc_id"], list(r["ids"]), r["decoded_sha256"]) for r in rows[5]) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows[5])


def test_run_is_the_stages_in_order(spark, staged):
    _, rows = staged
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, rows[5]))


def _folder(spark, folder, rows, labels, schema="doc_id long, text string, lang string, source string, n_chars long, score double, rest string, keep string, _key long"):
    """A table folder; the last columns of the documents have names that the stages use."""
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def _row(i, text, source="s"):
    return (i, text, None, source, len(text or ""), 0.9, "r", "k", 1)


def test_run_with_nulls_repeats_and_clashing_columns(spark, tmp_path):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    rows = [_row(k, text(60), "a" if k % 3 else None) for k in range(40)]
    rows += [_row(50, rows[0][1] + " tail"), rows[1], rows[1], _row(60, None), _row(61, ""), _row(None, text(30)), _row(62, "x " * 30_000)]
    sf = _folder(spark, tmp_path, rows, [(k, 1, 0) for k in range(0, 40, 2)])
    out = corpus_pipeline.run(spark, sf).collect()
    texts = {r["doc_id"] for r in out}
    assert 50 not in texts and {60, 61}.isdisjoint(texts)  # a near copy goes, and texts without words are not taken
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in out)
    assert texts <= {r[0] for r in rows} and len(texts) > 20


def test_run_of_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, _folder(spark, tmp_path, [], [])).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 0, 0)], [(1, 1, 1)], [(1, None, None), (99, 1, 1)]])
def test_no_document_goes_where_nothing_can_be_learnt(spark, tmp_path, labels):
    rows = [_row(k, f"some words of text {k}") for k in range(1, 8)] + [_row(None, None)]
    sf = _folder(spark, tmp_path, rows, labels)
    kept = corpus_pipeline.drop_toxic(spark, table(spark, sf, "documents"), sf)
    assert sorted(map(str, kept.collect())) == sorted(map(str, table(spark, sf, "documents").collect()))


def test_cleaning_in_small_blocks_is_the_score(spark, monkeypatch):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels").select("doc_id", F.col("toxic").alias("label"))
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(-5).cast("long")))
    model = toxicity.train(docs, labels)
    gone = {r["doc_id"] for r in toxicity.score(docs.select("doc_id", "text"), model).collect() if r["score"] >= 0.5}
    kept = toxicity.clean(docs, model)
    assert gone and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - gone and kept.columns == docs.columns
