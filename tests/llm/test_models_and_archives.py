"""Nearest neighbours, classifiers, language model, archive and fingerprints on small tables."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import context_mixing, fingerprints, quality, rp_forest, toxicity, warc
from ledgerlake.llm.common import utf8_parts

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def vectors(n=900, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    rows = [(5000 + i, [float(v) for v in x[i]], 0) for i in range(n)]
    same = rows[5][1]
    rows += [(20 * k, same, 1) for k in range(1, 61)]  # one vector in very many rows, queries among them
    rows += [(100000, None, 0), (100020, [0.0] * dim, 0), (100040, [None] + same[1:], 0), (100060, [float("nan")] + same[1:], 0),
             (100080, [float("inf")] + same[1:], 0), (100100, same[:3], 0), (None, same, 0), rows[7], rows[-1]]
    return rows


def brute_neighbours(rows, k=20, every=20):
    good = {(i, tuple(np.float32(v))) for i, v, _ in rows if i is not None and v is not None and len(v) == len(rows[0][1]) and None not in v and np.isfinite(v).all() and any(v)}
    ids = np.array([g[0] for g in good])
    x = np.array([g[1] for g in good], np.float64)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        s = x @ x[q]
        order = sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != ids[q])[:k]
        out[int(ids[q])] = order
    return out


@pytest.mark.parametrize("leaf", [4096, 32])
def test_neighbours_against_brute_force(spark, leaf):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = collections.defaultdict(list)
    for r in rp_forest.neighbours(df, leaf_rows=leaf).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = brute_neighbours(rows)
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, 21))
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        hits += len({f[1] for f in found} & {b[1] for b in best})
        if leaf == 4096:  # one leaf a tree: exact
            assert [f[1] for f in found] == [b[1] for b in best] and np.allclose([f[2] for f in found], [-b[0] for b in best])
    assert hits >= 0.9 * 20 * len(want)


def test_few_or_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (40, [-1.0, 2.0])], kind)
    assert sorted((r[0], r[1], r[2]) for r in rp_forest.neighbours(few).collect()) == [(0, 1, 1), (0, 2, 40), (40, 1, 1), (40, 2, 0)]
    for rows in ([], [(0, None)], [(0, [0.0])], [(1, [1.0])], [(0, [1.0])]):
        assert rp_forest.neighbours(spark.createDataFrame(rows, kind)).count() == 0


def labelled(n=400, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        w = [rng.choice(words) for _ in range(rng.randint(3, 80))]
        if bad:
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(["Zqxworst", "vyzzawful", "qwrotten"])
        docs.append((i, " ".join(w), "s" + str(i % 5), "l", 0.5))
        if i % 3:
            labels.append((i, int(not bad), int(bad)))
    docs += [(None, "Zqxworst", None, None, None), (9000, None, "s1", None, 1.0), (9001, "", None, "l", 1.0), docs[4], (9002, "abé" * 20000, "s1", "l", 0.0)]
    labels += [labels[0], (1, None, None), (2, 5, 7), (None, 1, 1), (77777, 0, 1)]
    return docs, labels


def tables(spark):
    docs, labels = labelled()
    return (spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, score double"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs)


def is_held(i, parts=5, part=0):
    return zlib.crc32(str(i if i is not None else "").encode()) % parts == part


def test_toxicity_on_held_out_rows(spark):
    docs, labels, rows = tables(spark)
    got = toxicity.toxicity(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    out = got.collect()
    assert len(out) == len(rows)
    assert all(r["held_out"] == is_held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held) >= 0.95 * len(held)
    # Labels of held-out rows change nothing.
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id"), 5, 0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(str, toxicity.toxicity(docs, flipped).collect())) == sorted(map(str, out))


def test_toxicity_without_labels_or_rows(spark):
    docs, labels, rows = tables(spark)
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    assert toxicity.clean(docs, toxicity.Model(np.zeros(1 << 20, np.float32), -1.0)).columns == docs.columns


def test_ngrams_are_of_the_text_alone():
    alone = toxicity.ngrams(np.frombuffer(b"Some\ttext", np.uint8))
    again = toxicity.ngrams(np.frombuffer(b"sOME text", np.uint8))
    assert all((a == b).all() for a, b in zip(alone, again)) and [len(a) for a in alone] == [6, 5]


def test_quality_combines_site_and_document(spark):
    docs, labels, rows = tables(spark)
    got = quality.quality(docs, labels)
    out = got.collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert sum(r["kept"] == (r["doc_id"] % 4 != 0) for r in held) >= 0.95 * len(held)
    assert quality.quality(docs.limit(0), labels).count() == 0


def test_posteriors_shrink_sparse_sites(spark):
    rows = [("big", "a", 1.0)] * 300 + [("big", "b", 0.0)] * 100 + [("other", "a", 0.0)] * 300 + [("tiny", "x", 1.0), (None, None, 0.0)]
    post, mean = quality.posteriors(spark.createDataFrame(rows, "host string, path string, value double"))
    got = {(r["host"], r["path"]): r for r in post.collect()}
    assert mean == pytest.approx(301 / 702)
    assert got[("big", "a")]["posterior"] > 0.95 and got[("big", "b")]["posterior"] < 0.1
    assert mean < got[("tiny", "x")]["host_posterior"] < 1 and 0 < got[(None, None)]["posterior"] < mean


def lm_rows():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    after = {w: rng.sample(words, 3) for w in words}
    rows = []
    for i in range(300):  # each word has three that follow it
        text = [rng.choice(words)]
        for _ in range(rng.randint(0, 90)):
            text.append(rng.choice(after[text[-1]]))
        rows.append((i, " ".join(text)))
    return rows + [(None, "Ab  ab\néx"), (700, None), (701, ""), (702, " \t"), rows[3], (703, "neverseen " * 4000), (704, "y" * 300000)]


def test_language_model_counts_and_base(spark):
    rows = lm_rows()
    got = context_mixing.score(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, n_known int"))
    out = got.collect()
    tok = [(i, (t or "").encode().translate(LOW).split() + [None]) for i, t in rows]
    c = collections.Counter()
    for i, w in tok:
        if not is_held(i, 7, 2):
            c.update(w)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), is_held(i, 7, 2), len(w), sum(x in c for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for i, w in tok)
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in out) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    assert sum(r["score"] for r in held) > 0.6 * sum(r["base_score"] for r in held)


def test_language_model_without_training_texts(spark):
    held = [i for i in range(100) if is_held(i, 7, 2)][:3]
    df = spark.createDataFrame([(i, "some words") for i in held], "doc_id long, text string")
    out = context_mixing.score(df).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out] == [(3, 0, 0, 0.0)] * 3
    assert context_mixing.score(df.limit(0)).count() == 0


def lm_model(spark, docs, **options):
    return context_mixing.train(docs.select("doc_id", "text"), **options)[0]


def lm_symbols(model, texts, most=1 << 22):
    """(style, last, two, symbol) of every symbol, and its text."""
    raw, at = utf8_parts(pa.array(texts, pa.string()))
    out, rows = [], []
    for w, s in context_mixing.coded(model.coder, raw, at, most):
        out.append(np.stack([s.style, s.last, s.two, s.symbol]))
        rows.append(w.row[s.token])
    return np.concatenate(out, axis=1), np.concatenate(rows)


def path(coder, symbol):
    """(node, bit) from the root to the leaf."""
    a, b = coder.offsets[symbol], coder.offsets[symbol + 1]
    return list(zip(coder.nodes[a:b].tolist(), coder.bits[a:b].tolist()))[::-1]


def test_codes_and_probabilities_are_proper(spark):
    """Both ways of a bit add up to one, a tree's leaves are all of its space, and a context's symbols have a sum of one."""
    offsets, nodes, bits, logit = context_mixing.tree(np.array([5.0, 1, 1, 9, 2]))
    assert sum(2.0 ** -(offsets[i + 1] - offsets[i]) for i in range(5)) == 1
    docs = spark.createDataFrame([r[:2] for r in lm_rows()[:305]], "doc_id long, text string")
    model = lm_model(spark, docs)
    mixer = context_mixing.Mixer(model.coder)
    mixer.weights = np.random.default_rng(0).normal(size=mixer.weights.shape).astype(np.float32)
    mixer.refine = np.random.default_rng(1).normal(size=mixer.refine.shape).astype(np.float32)
    node = np.arange(8) % 4
    packed = np.stack([np.arange(8, dtype=np.int16) * 37 * k for k in (1, -2, 3)])
    p = [np.exp(mixer.log_p(node, packed, np.full(8, b, np.int8)).astype(float)) for b in (0, 1)]
    assert np.allclose(p[0] + p[1], 1, atol=1e-6)
    symbols, row = lm_symbols(model, [r[1] for r in lm_rows()[:305]])
    for at in (7, 40):  # all words that could stand here, asked together with the training symbols
        words = np.arange(model.coder.end + 2)
        asked = np.concatenate((np.repeat(symbols[:3, at : at + 1], len(words), axis=1), words[None]))
        both, first, inverse = np.unique(np.concatenate((symbols, asked), axis=1), axis=1, return_index=True, return_inverse=True)
        n = np.bincount(inverse.ravel()[: symbols.shape[1]], minlength=both.shape[1])
        price = context_mixing.priced(model, *both, n)[inverse.ravel()[symbols.shape[1] :]]
        assert sum(math.exp(-p / 4096) for p in price) == pytest.approx(1, abs=0.002)


def test_context_counts_are_exact(spark):
    """Each bit's packed logits against counts by node of each of its contexts, with and without its own."""
    rows = [r[:2] for r in lm_rows()[:305]] + [(800, "newword otherword newerword thirdword"), (801, "newwood otherwise")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_model(spark, docs, bucket_tokens=64)  # many buckets, and groups of common words
    assert model.buckets > 50 and model.groups.max() > 1
    symbols, row = lm_symbols(model, [r[1] for r in rows])
    learnt = np.array([not is_held(r[0], 7, 2) for r in rows])[row]
    end = model.coder.end
    _, *contexts = context_mixing._contexts(model, *symbols[:3])
    seen, style = collections.Counter(), collections.Counter()
    for i in np.flatnonzero(learnt):
        for k, h in enumerate(contexts):
            for node, bit in path(model.coder, symbols[3, i]):
                seen[k, int(h[i]), node, bit] += 1
        for node, bit in path(model.coder, symbols[3, i])[: context_mixing.TOP_BITS] if symbols[3, i] <= end + 1 else []:
            style[int(symbols[0, i]), node, bit] += 1
    both, first, inverse = np.unique(symbols, axis=1, return_index=True, return_inverse=True)
    n = np.bincount(inverse.ravel(), learnt, both.shape[1]).astype(np.int64)
    bits = context_mixing.bits_of(model, *both, n)
    at = collections.Counter()
    for j, r in enumerate(bits.row.tolist()):
        node, bit = path(model.coder, both[3, r])[at[r]]
        at[r] += 1
        assert (node, bit) == (bits.node[j], bits.bit[j])
        for k in range(3):
            if k or both[3, r] > end + 1:
                c = [seen[k, int(contexts[k][first[r]]), node, b] for b in (0, 1)]
            else:
                c = [style[int(both[0, r]), node, b] for b in (0, 1)]
            less = [max(x - (n[r] > 0 and b == bit), 0) for b, x in enumerate(c)]
            for got, want in ((bits.full, c), (bits.less, less)) if n[r] else ((bits.full, c),):
                assert got[k, j] == context_mixing._packed_logits(*[np.array([x]) for x in want])[0]
    assert sum(at.values()) == sum(len(path(model.coder, s)) for s in both[3])


@pytest.mark.parametrize("tokens", [1 << 18, 500])
def test_scores_against_whole_buckets(spark, tokens):
    """Every text's score is the sum of its symbols' prices, bucket by bucket, whatever blocks and partitions they travel in."""
    rows = [r[:2] for r in lm_rows()[:305]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").where("doc_id is not null")
    model = lm_model(spark, docs, bucket_tokens=tokens)
    rows = [r for r in rows if r[0] is not None]
    symbols, row = lm_symbols(model, [r[1] for r in rows])
    learnt = np.array([not is_held(r[0], 7, 2) for r in rows])[row]
    bucket = context_mixing._contexts(model, *symbols[:3])[0] % np.uint64(model.buckets)
    total = np.zeros(len(rows))
    for b in np.unique(bucket):
        on = np.flatnonzero(bucket == b)
        # The order in which a bucket learns is that of its symbols' hashes.
        _, first, inverse = np.unique(context_mixing._tuple_hash(*symbols[:, on]), return_index=True, return_inverse=True)
        price = context_mixing.priced(model, *symbols[:, on[first]], np.bincount(inverse, learnt[on]).astype(np.int64))
        total += np.bincount(row[on], price[inverse], len(rows))
    want = sorted((i, round(-t / 4096 / math.log(10), 6)) for (i, _), t in zip(rows, total))
    for parts in (1, 5):
        got = context_mixing.score(docs.repartition(parts, "doc_id"), bucket_tokens=tokens).select("doc_id", "score").collect()
        assert sorted((r[0], round(r[1], 6)) for r in got) == want


def test_long_texts_in_pieces_keep_their_contexts(spark):
    docs = spark.createDataFrame([r[:2] for r in lm_rows()[:305]], "doc_id long, text string")
    model = lm_model(spark, docs)
    text = " ".join(r[1] for r in lm_rows()[:60]) + "  unseen " + "y" * 5000 + " tail "
    a, b = (lm_symbols(model, [text], most)[0] for most in (1 << 22, 300))
    assert sorted(map(tuple, a.T.tolist())) == sorted(map(tuple, b.T.tolist()))


def test_mixer_learns_from_long_texts(spark, monkeypatch):
    """A training text of any length, in pieces, trains the gates: its symbols get cheaper."""
    i = next(i for i in range(9) if not is_held(i, 7, 2))
    text = "some words again " * 100_000
    model = lm_model(spark, spark.createDataFrame([(i, text)], "doc_id long, text string"))
    symbols, _ = lm_symbols(model, [text], 1 << 16)
    both, n = np.unique(symbols, axis=1, return_counts=True)
    learnt = (context_mixing.priced(model, *both, n) * n).sum()
    monkeypatch.setattr(context_mixing, "RATE", 0.0)
    assert learnt < (context_mixing.priced(model, *both, n) * n).sum()


def test_context_counts_over_32_bits(spark):
    docs = spark.createDataFrame([(i, "some words again some words") for i in range(9)], "doc_id long, text string")
    model = lm_model(spark, docs)
    words = np.arange(2)
    bits = context_mixing.bits_of(model, np.zeros(2, int), np.full(2, 1), np.full(2, 1), words, np.array([6_000_000_000, 1]))
    top = int(context_mixing._LOGIT * 256) * 4
    own = bits.row == 0
    last = own & (bits.node == path(model.coder, 0)[-1][0])
    assert (bits.full[1:, last] == np.where(bits.bit[last] == 1, top, -top) + 3).all()


def asked(monkeypatch, model, texts):
    """Rows for the buckets that a task makes of these texts, without a session."""
    task = types.SimpleNamespace(partitionId=lambda: 0)
    monkeypatch.setattr(context_mixing, "TaskContext", types.SimpleNamespace(get=lambda: task))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([i % 7 == 2 for i in range(len(texts))]), pa.array(texts, pa.string())], ["doc_id", "held_out", "text"])
    return context_mixing._ask_batches([batch], types.SimpleNamespace(value=model))


def test_memory_of_sending_symbols(spark, monkeypatch):
    """What a task holds while it sends a block's symbols stays small: two such workers share an executor with its heap."""
    model = lm_model(spark, spark.createDataFrame([r[:2] for r in lm_rows()[:305]], "doc_id long, text string"))
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 30_000, 300)) for _ in range(2300)]  # a block of 4 MB, all spelt
    tracemalloc.start()
    for _ in asked(monkeypatch, model, texts):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6


def test_symbols_sent_in_parts_are_the_same(spark, monkeypatch):
    rows = [r[1] for r in lm_rows()[:305]]
    model = lm_model(spark, spark.createDataFrame([r[:2] for r in lm_rows()[:305]], "doc_id long, text string"), bucket_tokens=500)
    found = []
    for block, send in ((1 << 19, 1 << 20), (3000, 1000)):
        monkeypatch.setattr(context_mixing, "_BLOCK", block)
        monkeypatch.setattr(context_mixing, "_SEND", send)
        n = collections.Counter()
        for batch in asked(monkeypatch, model, rows):
            for r in batch.to_pylist():
                if r["info"] is None:
                    symbols, texts = context_mixing._columns(r["symbols"], 6), context_mixing._columns(r["texts"], 1)[0]
                    owners = np.split(texts, np.cumsum(symbols[4])[:-1])
                    for symbol, own in zip(symbols[:4].T.tolist(), owners):
                        n.update((r["bucket"], *symbol, t) for t in own.tolist())
                    assert [sum(t % 7 != 2 for t in own.tolist()) for own in owners] == symbols[5].tolist()
        found.append(n)
    symbols, row = lm_symbols(model, rows)
    bucket = context_mixing._contexts(model, *symbols[:3])[0] % np.uint64(model.buckets)
    assert found[0] == found[1] == collections.Counter(zip(bucket.tolist(), *symbols.tolist(), row.tolist()))


def test_words_are_found_by_their_hashes():
    rng = np.random.default_rng(5)
    words = np.unique(np.concatenate((rng.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2), np.arange(9, dtype=np.uint64), ~np.arange(9, dtype=np.uint64))))
    coder = context_mixing.Coder(words, *[np.zeros(0)] * 6, 0, *[np.zeros(0)] * 2)
    asked = np.concatenate((words, words + np.uint64(1), words - np.uint64(1)))
    place = {w: i for i, w in enumerate(words.tolist())}
    assert coder.find(asked).tolist() == [place.get(w, -1) for w in asked.tolist()]


def test_planes_round_trip():
    x = np.array([[0, -5, 2**40], [1, 2, 3]])
    assert (context_mixing._columns(context_mixing._planes(*x), 2) == x).all()
    assert context_mixing._columns(context_mixing._planes(x[0][:0]), 1).shape == (1, 0)


def pages():
    long = "<p>é" + "x" * 1200
    rows = [(i, f"http://h/{i}", long) for i in range(40)] + [(100, "u\r\nInjected: 1", "short"), (101, None, "short"), (102, "u", None), (103, "u", ""), (None, "u", long),
            (104, "u", "WARC/1.1\r\nWARC-Type: fake\r\n\r\n" + "y" * 2000), (105, "u", "a" * 999), (106, "u", "a" * 999), (39, "again", long), (107, "u", "z" * 500000)]
    return rows


def test_warc_index_and_records(spark, tmp_path):
    df = spark.createDataFrame([(*r, "x", "y") for r in pages()], "page_id long, url string, html string, digest string, header string")
    path = str(tmp_path / "archive")
    got = sorted((tuple(r) for r in warc.archive(df, path).collect()), key=str)
    holder = {}
    for i, _, h in pages():
        holder[h or ""] = max(holder.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in pages():
        b = (h or "").encode()
        revisit = len(b) >= 1000 and holder[h or ""] != (-1 if i is None else i)
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", holder[h or ""] if revisit else None))
    assert got == sorted(want, key=str)
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len(holder)  # once each
    records = warc.read_records(spark, path).collect()
    assert len(records) == len(pages())
    for r in records:
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert "Injected" not in fields and body[: int(fields["Content-Length"])] + b"\r\n\r\n" == body
        assert fields["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(bytes(r["payload"])).hexdigest()


def test_damaged_payload_fails_the_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "page")], "page_id long, url string, html string")
    path = str(tmp_path / "archive")
    warc.write(df, path)
    stored = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"pagf")).toPandas()
    spark.createDataFrame(stored, "digest string, sha1 string, bytes long, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="payload is damaged"):
        warc.read_index(spark, path).collect()
    assert warc.archive(df.limit(0)).count() == 0


def bag(text):
    return collections.Counter(w for w in re.split(r"[\x20\x09-\x0d]+", text.encode().translate(LOW).decode()) if w)


def jaccard(a, b):
    a, b = bag(a), bag(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_fingerprints_estimate_generalised_jaccard(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(80)]
    rows = [(7 * i, " ".join(rng.choice(words) for _ in range(rng.randint(5, 150)))) for i in range(150)]
    rows += [(None, "null id ééé"), (5000, None), (5001, ""), (5002, " "), rows[3], (5003, rows[4][1].upper()), (5004, "é" * 31), (5005, "a b " * 30000)]
    df = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, range int, halo boolean")
    got = fingerprints.fingerprints(df)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = {(r["doc_id"], r["n_chars"], r["edited_sha256"]): r for r in got.collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    errors, prints = [], {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        k = len(t) // 3
        edited = t[: len(t) - k] + after[:k]
        r = got[(i, len(t), hashlib.sha256(edited.encode()).hexdigest())]
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        if bag(t):
            errors.append((r["near_edited"] - jaccard(t, edited), r["near_next"] - jaccard(t, after) if bag(after) else 0))
    errors = np.array(errors)
    assert abs(errors.mean(axis=0)).max() < 0.02 and errors.std(axis=0).max() < 0.09
    assert prints[rows[4][1]] == prints[rows[4][1].upper()] and len(prints[""]) == fingerprints.SLOTS * fingerprints.DIGITS


def test_fingerprints_of_one_or_no_document(spark):
    kind = "doc_id long, text string"
    one = fingerprints.fingerprints(spark.createDataFrame([(1, "abc def")], kind)).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest()
    assert fingerprints.fingerprints(spark.createDataFrame([], kind)).count() == 0


def test_fingerprints_have_all_64_slots(spark):
    """Likeness is counted in 64ths: a standard error of 0.0625 at 0.5."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefghijkl") for _ in range(20))) for i in range(40)]
    out = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {len(r["fingerprint"]) for r in out} == {64 * fingerprints.DIGITS}
    assert all(r[c] * 64 == int(r[c] * 64) for r in out for c in ("near_edited", "near_next"))
    assert any(r["near_edited"] * 48 != int(r["near_edited"] * 48) for r in out)


def test_quality_leaves_out_the_row_itself(spark):
    """A site of one document says nothing but its parent's, and a label does not move its own row's site."""
    docs, labels, _ = tables(spark)
    i = next(i for i in range(1, 400) if i % 3 and i % 4 and not is_held(i))
    docs = docs.withColumn("source", F.when(F.col("doc_id") == i, F.lit("alone")).otherwise(F.col("source")))
    out = quality.quality(docs, labels).collect()
    mean = sum(r["path_posterior"] for r in out) / len(out)
    row = next(r for r in out if r["doc_id"] == i)
    assert row["host_posterior"] == pytest.approx(row["path_posterior"]) and abs(row["path_posterior"] - mean) < 0.02
    assert row["score"] == pytest.approx(row["doc_score"], abs=1e-4)


def test_index_reads_whole_records(spark, tmp_path):
    """A header that does not fit its payload fails the index too."""
    df = spark.createDataFrame([(1, "u", "page")], "page_id long, url string, html string")
    path = str(tmp_path / "archive")
    warc.write(df, path)
    rows = spark.read.parquet(f"{path}/headers").withColumn("header", F.replace("header", F.lit("Content-Length: 4"), F.lit("Content-Length: 5"))).toPandas()
    spark.createDataFrame(rows, "digest string, header string").write.mode("overwrite").parquet(f"{path}/headers")
    with pytest.raises(Exception, match="record is damaged"):
        warc.read_index(spark, path).collect()
