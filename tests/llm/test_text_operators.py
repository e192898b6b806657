"""Line dedup, near dedup, mixing and BPE on small tables, against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, components, line_dedup, mixing, superminhash
from ledgerlake.llm.common import materialise

from llm_brute import brute_lines, brute_near

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep string, rest string, _doc long"


def frame(spark, rows):
    """rows of (doc_id, text, source); the other columns clash with names that operators use."""
    return spark.createDataFrame([(i, t, "en", s, 0, "k", "r", 7) for i, t, s in rows], DOCS)


def texts(seed=3):
    """Copies, near copies, short, empty and null texts, shared lines."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(6)]
    out = []
    for b in base:
        out += [b, b.upper(), b]
        for edits in (1, 2, 5, 12, 40):
            w = b.split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(words)
            out.append("  ".join(w) + "\n")
    shared = "This line of forty code points or more is in many texts."
    out += ["", None, " \t\n ", "one", "One", "one two", "a b c", "a b c d", "x " * 5000]
    out += [f"head {k}\n  {shared.upper() if k % 2 else shared}\t\n{shared}\nshort" for k in range(7)]
    return out


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (159, 41)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 40 for k in [*range(40, 61), *range(100, 160)]}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_brute_force(spark, width, percent):
    rows = [(3 * i + 1, t) for i, t in enumerate(texts())]
    rows += [(None, rows[0][1]), (4, "a b c d e f"), (4, "g h i j k"), rows[5]]
    df = frame(spark, [(i, t, "s") for i, t in rows])
    got = superminhash.near_duplicates(df, width, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_near(rows, width, percent)


def test_chain_of_near_copies_in_a_large_bucket(spark, monkeypatch):
    """Copies that drift: ends are far apart, neighbours are linked; blocks are smaller than the bucket."""
    monkeypatch.setattr(superminhash, "BLOCK_ROWS", 8)
    rng = random.Random(1)
    w = [f"t{k}" for k in range(200)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(w)))
        w[rng.randrange(200)] = f"n{i}"
    rows += [(1000 + i, " ".join(x if rng.random() > 0.12 else f"z{rng.random()}" for x in rows[0][1].split())) for i in range(40)]
    got = superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_near(rows, 3, 85)


def test_superminhash_agrees_with_jaccard():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    b = np.concatenate((a[:300], rng.integers(0, 1 << 63, 100).astype(np.uint64)))
    sig = superminhash.signatures(np.concatenate((a, b)), np.array([0, 400, 800]), 1024)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.05
    few = superminhash.signatures(a[:3], np.array([0, 3, 3]), 64)
    assert np.isfinite(few[0]).all() and np.isinf(few[1]).all()  # three elements fill all slots


def test_keep_first_keeps_columns_and_one_of_a_group(spark):
    rows = [(9, "a b c d e f g h", "s"), (2, "A b c d e f g h", "s"), (5, "other text of some words here", "s"), (5, "other text of some words here", "s"), (None, "a b c d e f g h", None), (7, None, "s")]
    got = superminhash.keep_first(frame(spark, rows))
    assert got.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted((str(r["doc_id"]), r["text"] or "", r["rest"]) for r in got.collect()) == [
        ("2", "A b c d e f g h", "r"), ("5", "other text of some words here", "r"), ("7", "", "r"), ("None", "a b c d e f g h", "r")]


def line_rows():
    rows = [(i, t) for i, t in enumerate(texts())]
    line = "é" * 39
    rows += [(200 + i, f"{line}\n{line}e\n{line}e") for i in range(6)]  # 39 code points are too few, 40 are not
    rows += [(None, rows[-1][1]), (None, rows[-1][1]), rows[-1], (205, "z"), (4, rows[-2][1] + "\n")]
    return rows


def test_lines_against_brute_force(spark):
    got = line_dedup.line_digests(frame(spark, [(d, t, "s") for d, t in line_rows()]))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_lines(line_rows())


def test_hot_line_over_many_ranges(spark, monkeypatch):
    """A line that every document holds is split between tasks, and each range's edges settle."""
    monkeypatch.setattr(line_dedup, "materialise", lambda df, name: materialise(df.repartitionByRange(16, *RANGE).sortWithinPartitions(*RANGE) if name == "lines" else df, name))
    RANGE = ["h1", "h2", F.col("doc_id").desc_nulls_last(), "text_key", "pos"]
    rows = [(i, "common line of forty characters and some more\nown line of document %d that is forty characters long" % (i // 3)) for i in range(300)]
    got = line_dedup.line_digests(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_lines(rows)


def test_stream_settles_edges_in_any_cut():
    """Every way to cut the sorted rows between two tasks gives the same drops."""
    import pyarrow as pa

    rows = [(1, 1, d, 0, p, 9) for d in (8, 7, 6, 5, 4, 3) for p in (0, 1)] + [(2, 1, d, 0, 0, 9) for d in (5, 4, 3, 2)]

    def run(part):
        batch = line_dedup._arrow(part, line_dedup._ROW_NAMES, line_dedup._ROW_TYPES)
        return [tuple(r.values()) for b in line_dedup._stream_runs(iter([batch]), 5) for r in pa.Table.from_batches([b]).to_pylist()]

    want = {r[1:] for r in [(0, *x) for x in rows if x[0] == 1 and x[2] != 8]}
    for cut in range(len(rows) + 1):
        out = run(rows[:cut]) + run(rows[cut:])
        docs = collections.defaultdict(set)
        for r in out:
            if r[0]:
                docs[r[1:3]].add(r[3])
        late = {r[1:] for r in out if r[0] == 1 and len(docs[r[1:3]]) >= 5 and r[3] != max(docs[r[1:3]])}
        assert {r[1:] for r in out if r[0] == 0} | late == want, cut


def test_dedup_lines_keeps_columns(spark):
    got = line_dedup.dedup_lines(frame(spark, [(d, t, "s") for d, t in line_rows()]))
    assert got.columns == [c.split()[0] for c in DOCS.split(", ")]
    rows = sorted(((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in got.collect()), key=str)
    assert rows == sorted(((r[0], r[3]) for r in brute_lines(line_rows())), key=str)


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return {**capped, **share}
        capped.update({s: 3.0 * sizes[s] for s in over})


def test_mixture_targets_and_totals(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * 1 for _ in range(rng.choice([0, 1, 5, 40, 200]))), rng.choice(["b", "a", "é", None, "Z"])) for i in range(3000)]
    rows += [(9000, "tiny", "small"), (9001, None, "none"), (9002, "", "none"), (None, "x y", "a"), rows[7], rows[7], rows[8]]
    df = frame(spark, rows)
    got = [tuple(r) for r in mixing.mixture(df).select("doc_id", "size", "source_size", "target", "taken").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [tuple(r) for r in mixing.mixture(df.repartition(5)).select("doc_id", "size", "source_size", "target", "taken").collect()]))
    sizes = collections.Counter({s: 0 for _, _, s in rows})
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    source = {(i, len((t or "").split())): s for i, t, s in rows}
    taken = collections.Counter()
    assert len(got) == len(rows)
    for i, size, total, target, n in got:
        s = source[(i, size)]
        assert total == sizes[s] and target == pytest.approx(want[s]) and 0 <= n <= 3 * size and (not size or n % size == 0)
        taken[s] += n
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.02 * t, 3), (s, taken[s], t)
    assert len({g for g in got if g[0] == rows[7][0]}) == 1  # equal rows share a decision
    assert mixing.mixture(df.limit(0)).count() == 0


def test_mix_repeats_rows(spark):
    df = frame(spark, [(i, "w " * (i % 7 + 1), f"s{i % 4}") for i in range(400)])
    got = collections.Counter(r["doc_id"] for r in mixing.mix(df).collect())
    want = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mixture(df).collect()}
    assert dict(got) == {d: n for d, n in want.items() if n} and mixing.mix(df).columns == df.columns


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coders(path):
    from tokenizers import Tokenizer

    vocabulary = bpe.read_vocabulary(path)
    return bpe.Encoder(**vocabulary), bpe.Decoder(vocabulary["vocab"], vocabulary["added"]), Tokenizer.from_file(path)


ODD = ["a", "ab", "-", "=", "'", "'re", "'s", " ", "\n", "\t", "é", "ß", "日本", "😀", "1", "٣", "\u0085", "<|endoftext|>", "the", "ing", "A", "_", "\x00", "\x1c", "²", "Ⅷ", "﻿", " "]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) * rng.choice([1, 1, 2, 7, 90]) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_bpe_is_the_library_s(coders, monkeypatch):
    encoder, decoder, library = coders
    for window in (1 << 16, 60):
        monkeypatch.setattr(bpe, "WINDOW", window)
        rows = odd_texts(400, window)
        got = encoder.encode_all(rows)
        assert got == [library.encode(t, add_special_tokens=False).ids for t in rows]
        assert [decoder.decode(ids) for ids in got] == [library.decode(ids, skip_special_tokens=False) for ids in got]


def test_stream_needs_only_the_lookahead(coders):
    encoder = coders[0]
    rng = random.Random(4)
    for k in range(12):
        data = ("".join(rng.choice("aeiounsthrl") for _ in range(2500)) if k % 2 else rng.choice(["a", "=-", "ing", "0", "\xc3"]) * 2500).encode("latin1")
        whole = encoder.tokens(data)
        assert list(encoder.stream([data[:700], data[700:]])) == whole
        assert encoder.tokens(data[:500]) == encoder.merge(data[:500])
        # Tokens that end the lookahead before a cut are those of the whole.
        cut, end, settled = 1500, 0, []
        for i in encoder.tokens(data[:cut]):
            end += encoder.width[i]
            if end <= cut - encoder.lookahead:
                settled.append(i)
        assert whole[: len(settled)] == settled


def test_decoder_of_any_ids(coders):
    _, decoder, library = coders
    rng = random.Random(6)
    for _ in range(20):
        ids = [rng.randrange(50257) for _ in range(60)]
        assert decoder.decode(ids) == library.decode(ids, skip_special_tokens=False) == "".join(decoder.chunks(ids, 3))


def test_token_digests(spark, path, coders):
    rows = [(i, t) for i, t in enumerate(odd_texts(60, 9) + ["", None, "word " * 30000])] + [(None, "x"), (1, "x")]
    got = bpe.token_digests(frame(spark, [(i, t, "s") for i, t in rows]), path).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = coders[2].encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    tokens = bpe.decode(bpe.encode(frame(spark, [(i, t, "s") for i, t in rows]), path), path)
    assert "text" not in tokens.columns and "rest" in tokens.columns
    assert sorted(map(str, [(r["doc_id"], r["decoded"]) for r in tokens.collect()])) == sorted(map(str, [(i, t or "") for i, t in rows]))


def test_empty_tables(spark, path):
    empty = frame(spark, []).limit(0)
    assert superminhash.near_duplicates(empty).count() == 0
    assert line_dedup.line_digests(empty).count() == 0
    assert bpe.token_digests(empty, path).count() == 0
    assert mixing.mix(empty).count() == 0 and superminhash.keep_first(empty).count() == 0


def test_hot_source_among_a_thousand_meets_in_blocks(spark, monkeypatch):
    """A hot source sampled far down: all its documents are large, and no group holds them all."""
    rows = [(i, "hot", "word " * (20 + i % 20)) for i in range(1500)]
    rows += [(10_000 + 2 * s + k, f"s{s:04d}", f"a{s} b{k} " + "c " * 28) for s in range(1000) for k in range(2)]
    longest, write = [0], mixing.materialise

    def spied(df, name):
        out = write(df, name)
        if "met" in out.columns:
            longest[0] = max(longest[0], out.agg(F.max(F.size("met.done"))).first()[0] or 0)
        return out

    monkeypatch.setattr(mixing, "materialise", spied)
    got = mixing.mixture(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert len(got) == len(rows) and longest[0] <= 2 * mixing.BLOCK
    hot = [r for r in got if r["doc_id"] < 10_000]
    assert all(r["size"] * mixing.LARGE > r["target"] for r in hot)
    assert abs(sum(r["taken"] for r in hot) - hot[0]["target"]) <= 40
