"""Merkle manifest, importance resampling and repeat removal, against brute force on hand-made tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import merkle, neighbours, positions, prefix_free, resampling

#: The last columns have names that the operators use themselves.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, pos long, row long, g string, path string, common long"
LOW = {c: c + 32 for c in range(65, 91)}


def frame(spark, rows):
    """rows of (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 5, 5, "g", "p", 5) for i, t, s in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Merkle


def brute_tree(nodes):
    paths, groups, now = [[] for _ in nodes], [[i] for i in range(len(nodes))], list(nodes)
    while len(now) > 1:
        above, joined = [], []
        for a in range(0, len(now), 16):
            run = now[a : a + 16]
            for s in range(len(run)):
                for i in groups[a + s]:
                    paths[i].append(("".join(run[:s]), "".join(run[s + 1 :])))
            above.append(sha("".join(run)))
            joined.append([i for g in groups[a : a + 16] for i in g])
        now, groups = above, joined
    return now[0], paths


def brute_manifest(rows):
    def leaf(i, t, s):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, "en", len(whole or ""), t)))

    by = collections.defaultdict(list)
    for i, t, s in rows:
        whole = t
        spoiled = t.translate(LOW) if t is not None and zlib.crc32(str(i if i is not None else "").encode()) % 5 == 0 else t
        by[s].append((i, leaf(i, t, s), leaf(i, spoiled, s)))
    keys = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in keys:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = brute_tree([x[1] for x in by[s]])
    root, tops = brute_tree([trees[s][0] for s in keys])
    out = []
    for s, top in zip(keys, tops):
        for (i, own, spoiled), below in zip(by[s], trees[s][1]):
            found = spoiled
            for left, right in below + top:
                found = sha(left + found + right)
            out.append((i, own, trees[s][0], root, sha("".join(a + b for a, b in below + top)), found, found == root))
    return sorted(out, key=str)


def manifest_rows():
    rng = random.Random(2)
    rows = [(i, f"Text {i}" if i % 3 else f"text {i}", "hot") for i in range(300)]  # three levels, the last run a single node
    rows += [(1000 + i, "T" * i, f"s{rng.randrange(40)}") for i in range(100)]  # sources enough for two levels
    rows += [(5, "A", None), (None, "B", None), (None, None, "é"), (7, "", "z"), (7, "", "z"), (7, "Q", "z"), (2000, "x" * 300_000, "")]
    return rows


def test_manifest_against_brute_force(spark):
    rows = manifest_rows()
    got = merkle.dataset_manifest(frame(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted([tuple(r) for r in got.collect()], key=str)
    assert got == brute_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 257])
def test_manifest_of_one_source(spark, n):
    rows = [(i, "T", "s") for i in range(n)]
    got = sorted([tuple(r) for r in merkle.dataset_manifest(frame(spark, rows)).collect()], key=str)
    assert got == (brute_manifest(rows) if n else [])


def test_no_window_of_the_manifest_spans_a_group(spark):
    plan = merkle.dataset_manifest(frame(spark, manifest_rows()))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow\b", line)]
    assert windows and all("run#" in line.split("], [", 1)[1] for line in windows)


def test_positions_of_ties_and_nulls(spark):
    rows = [(g, x) for g in ("a", None, "b") for x in (3, 1, 1, None, 2)] + [("hot", 1)] * 500
    got = positions.numbered(spark.createDataFrame(rows, "grp string, x long"), ["grp"], ["x"], "t").collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["grp"]].append((r["pos"], r["x"], r["n"]))
    for g, found in by.items():
        found.sort(key=lambda f: f[0])
        assert [f[0] for f in found] == list(range(len(found))) and {f[2] for f in found} == {len(found)}
        assert [f[1] for f in found] == ([1] * 500 if g == "hot" else [None, 1, 1, 2, 3])


# Resampling


def brute_resample(rows, target):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(t):
        w = word.findall((t or "").translate(LOW))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    own = [(i, *features(t)) for i, t, _ in rows]
    s, t = collections.Counter(b for _, _, f in own for b in f), collections.Counter(b for x in target for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, words, f in own:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in f)
        h = int(sha(f"42:{'' if i is None else i}")[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2]))
    for k, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def resample_rows():
    rng = random.Random(4)
    words = ["Alpha", "beta", "été", "x1", "2024", "日本", "w" * 64, "v" * 65, "long" * 100]
    gaps = [" ", "\n", "\x00", ", ", "_", "\x7f"]
    text = lambda n: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n))
    rows = [(i, text(rng.choice([0, 1, 2, 3, 19, 20, 40])), "s") for i in range(150)]
    rows += [(500, None, "s"), (501, "", None), (502, " .,\n", "s"), (None, text(30), "s"), (503, text(9000), "s"), (504, "ä" * 20_000 + " a b", "s")]
    return rows + [rows[30]] * 3 + [(900, rows[31][1], "s"), (900, text(25), "s")]


@pytest.mark.parametrize("block", [1 << 19, 2000])
def test_resampling_against_brute_force(spark, monkeypatch, block):
    """Small blocks cut the long texts into many pieces."""
    rows, target = resample_rows(), ["beta alpha", None, "", "x1 2024 été x1 2024"]
    monkeypatch.setattr(resampling, "_BLOCK", block)
    # The workers import the module anew, so the pieces are also checked here.
    raw = (rows[-5][1] or rows[154][1]).encode()
    for size in (block, 700):
        monkeypatch.setattr(resampling, "_BLOCK", size)
        parts = list(resampling._features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))
        found = collections.Counter(int(b) for _, _, bucket, _ in parts for b in bucket)
        w = resampling.WORD.findall(raw.lower())
        assert found == collections.Counter(zlib.crc32(b" ".join(w[i : i + k])) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1))
        assert sum(int(n[0]) for *_, n in parts) == len(w)
    got = resampling.resample(frame(spark, rows), spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_resample(rows, target)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(frame(spark, []), none).count() == 0
    rows = [(i, f"word{i} " * 25, "s") for i in range(40)]
    got = resampling.resample(frame(spark, rows), none).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_resample(rows, [])
    assert sum(r["rank"] is not None for r in got) == 2


def test_crc32_of_parts():
    rng = random.Random(1)
    words = [bytes(rng.randrange(97, 123) for _ in range(rng.choice([1, 2, 9, 63, 64, 65, 130, 5000]))) for _ in range(200)]
    text = b" ".join(words)
    spans = np.array([m.span() for m in resampling.WORD.finditer(text)])
    own = resampling.word_crcs(text, spans[:, 0], spans[:, 1])
    assert own.tolist() == [zlib.crc32(w) for w in words]
    both = resampling.append(own[:-1], np.diff(spans, axis=1)[1:, 0]) ^ own[1:]
    assert both.tolist() == [zlib.crc32(a + b) for a, b in zip(words, words[1:])]


# Repeats


def brute_repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    seen = collections.Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = [False] * (len(b) + 1)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not p for p, g in zip([False, *gone], gone))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeat_rows(length):
    rng = random.Random(length)
    text = lambda n: "".join(rng.choice("abcdeé 日") for _ in range(n))
    passages = [text(rng.randrange(length // 4, 3 * length)) for _ in range(8)]
    rows = [(i, "".join(text(rng.randrange(0, length)) + rng.choice(passages) for _ in range(rng.randrange(1, 6))), "s") for i in range(60)]
    base = text(8 * length)
    for k in range(12):  # near copies, cut at every sort of place
        cut = rng.randrange(len(base))
        rows.append((100 + k, base[:cut] + text(rng.randrange(0, 3)) + base[cut + rng.randrange(0, 2 * length) :], "s"))
    exact = "".join(rng.choice("xyz") for _ in range(length))
    rows += [(200, exact, "s"), (201, exact[1:] + "!", "s"), (202, exact, "s"), (203, exact[:-1], "s")]
    rows += [(300, "a" * (3 * length), "s"), (301, "ab" * (2 * length), "s"), (302, "-" * (length + 1), "s"), (303, "q" * length, "s")]
    rows += [(400, None, "s"), (401, "", "s"), (None, base, None), (None, exact, None), rows[3], rows[3], (3, "other", "s")]
    return rows


@pytest.mark.parametrize("length", [1, 7, 20, 64, 200])
def test_repeats_against_brute_force(spark, length):
    rows = repeat_rows(max(length, 12))
    got = prefix_free.repeat_digests(frame(spark, rows), length)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_repeats(rows, length)


def test_repeats_within_one_long_text(spark):
    """A text of several blocks; the passage that repeats lies in two of them."""
    rng = random.Random(0)
    long = "".join(rng.choice("abcdefgh") for _ in range(2 * prefix_free._BLOCK + 1000))
    passage = long[prefix_free._BLOCK - 300 : prefix_free._BLOCK + 300]
    rows = [(1, long + "|" + passage, "s"), (2, "z" + passage[:250], "s"), (3, passage[:199], "s")]
    got = {r["doc_id"]: r for r in prefix_free.remove_repeats(frame(spark, rows)).collect()}
    at = prefix_free._BLOCK - 300
    assert [tuple(s) for s in got[1]["spans"]] == [(at, at + 600), (len(long) + 1, len(long) + 601)]
    assert [tuple(s) for s in got[2]["spans"]] == [(1, 251)] and not got[3]["spans"] and bytes(got[2]["kept"]) == b"z"


def test_no_documents_no_repeats(spark):
    assert prefix_free.repeat_digests(frame(spark, [])).count() == 0


def test_first_triggers_depend_on_the_string_alone():
    rng = np.random.default_rng(3)
    for length in (1, 2, 5, 16, 40, 200, 1000):
        string = rng.integers(97, 100, length).astype(np.uint8)
        found = set()
        for _ in range(8):
            before, behind = (rng.integers(97, 100, rng.integers(0, 300)).astype(np.uint8) for _ in range(2))
            at, common = prefix_free.triggers(np.concatenate((before, string, behind)), length)
            found.add((int(at[len(before)]) - len(before), int(common[len(before)])))
        assert len(found) == 1


def test_equal_neighbours_in_any_cut():
    import pyarrow as pa

    keys = [1, 1, 2, 3, 3, 3, 4, 5, 5]
    for cut in range(len(keys) + 1):
        for size in (1, 2, 9):
            out = []
            for part in (keys[:cut], keys[cut:]):
                batches = [pa.RecordBatch.from_pydict({"k": pa.array(part[a : a + size], pa.int64())}) for a in range(0, len(part), size)]
                out += [r for b in neighbours._mark_batches(batches, ["k"]) for r in b.to_pylist()]
            assert [r["k"] for r in out] == keys
            edges = collections.Counter(r["k"] for r in out if r["edge"])
            assert [r["repeated"] or edges[r["k"]] > 1 for r in out] == [keys.count(k) > 1 for k in keys]
            assert all(any(r["first"] for r in out if r["k"] == k) for k in keys)


def test_hot_key_is_spread_over_ranges(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("x"))
    marked = neighbours.repeated(rows, ["k"], ["x"], "t", "repeated", keep={"k": "true"})
    got = {r["x"]: r["k"] for r in marked.collect()}
    assert got == {x: 7 for x in range(4000) if x % 3 == 0 or x == 7}
