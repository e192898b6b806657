"""Byte-level BPE as a bounded-lookahead streaming transducer, and its decoder.

Encoding. A later byte can change how a prefix is tokenised only near the
prefix's end. Compare the merges of a prefix with those of a longer text, in
rank order: where they differ, they differ in a zone at the prefix's end. At
rank r = (u, v) the zone can grow by one step to the left, by |u| bytes, and
only if v starts where the zone starts. The zone's first token then starts
with u for good, so the next step's v' must start with u. The longest sum of
|u| over such chains of rising ranks is therefore a sufficient lookahead of
the merge list (``lookahead``, computed once from the list). A token that
ends at least that many bytes before the end of what has been read is final:
it is emitted and its bytes are forgotten, so a piece of any length needs
constant memory.

Decoding feeds token bytes to an incremental UTF-8 state machine: it gives
characters as soon as they are complete and U+FFFD for what is not UTF-8.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import in_slices

#: Fixed value: the scheme's pieces, tried in this order at each position:
#: 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")
OTHER, LETTER, NUMBER, GAP = range(4)
#: Characters after a piece that can still change where it ends.
PIECE_LOOKAHEAD = 4
WINDOW = 1 << 16
CACHE_PIECES = 1 << 18
CACHE_BYTES = 64


def byte_alphabet() -> dict[str, int]:
    """The scheme's letter for each byte: printable Latin-1 stands for itself, the rest follow from U+0100."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def character_classes() -> bytes:
    """Class of each code point, by Unicode's letters, numbers and white space."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (GAP, r"\s+")):
        for m in regex.finditer(name, every):
            out[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
    return out.tobytes()


def piece_starts(code: np.ndarray, kind: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where pieces start in texts laid end to end (``at``: their offsets and the end).

    A piece is a run of one class, with the one space before it if there is
    one. Of a run of white space the last character stands apart if the text
    goes on. An apostrophe that starts a piece takes one of the fixed endings.
    """
    n = len(code)
    fresh = np.zeros(n + 4, bool)  # first character of a text
    fresh[at] = True
    run = fresh[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    space = code == 0x20
    start = run.copy()
    joined = np.flatnonzero(space[:-1] & (kind[1:] != GAP) & ~fresh[1:n]) if n else np.zeros(0, np.int64)
    start[joined + 1] = False
    if n > 1:
        start[:-1] |= (kind[:-1] == GAP) & (kind[1:] != GAP) & ~fresh[1:n]
    wide = np.concatenate((code, np.zeros(4, code.dtype)))
    same = np.concatenate((kind, np.full(4, GAP, np.uint8)))
    quote = np.flatnonzero((code == 0x27) & start & run)
    quote = quote[~fresh[quote + 1]]
    for ending in (*SHORT_ENDINGS, *LONG_ENDINGS):
        size = len(ending)
        hit = quote
        for k, c in enumerate(ending, 1):
            hit = hit[(wide[hit + k] == ord(c)) & ~fresh[hit + k]]
        start[hit + 1] = False
        after = hit + size + 1
        start[after[(same[after] == LETTER) & ~fresh[after]]] = True
    return np.flatnonzero(start)


def read_vocabulary(path: str) -> dict:
    """What executors need of a tokenizer file; read by the driver, then broadcast (its size is the vocabulary's)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_alphabet()
    as_bytes = lambda token: bytes(letters[c] for c in token)
    vocab = {as_bytes(t): i for t, i in spec["model"]["vocab"].items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    return {"vocab": vocab, "merges": [(as_bytes(a), as_bytes(b)) for a, b in merges], "added": added, "kinds": character_classes()}


def lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token that settle it, whatever follows (see the module's text)."""
    best: dict[bytes, int] = {}
    most = 0
    for u, v in merges:
        reach = len(u) + max((best.get(v[:n], 0) for n in range(1, len(v) + 1)), default=0)
        if reach > best.get(u, 0):
            best[u] = reach
        most = max(most, reach)
    return most


class Encoder:
    """Text to ids. Pieces up to ``CACHE_BYTES`` are remembered, in a cache of bounded size."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]], added: dict[str, int], kinds: bytes):
        self.vocab = vocab
        self.first = [vocab[bytes([b])] for b in range(256)]
        self.rule = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in reversed(list(enumerate(merges)))}
        self.width = {i: len(t) for t, i in vocab.items()}
        self.lookahead = lookahead(merges)
        self.added = added
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.kinds = np.frombuffer(kinds, np.uint8)
        self.cache: dict[str, tuple] = {}
        self._spines(merges)

    def _spines(self, merges) -> None:
        """Each token's right and left edge through its own merges: (token, rank that ends it)."""
        vocab, never = self.vocab, len(merges)
        self.right = {i: ((i, never),) for i in self.width}
        self.left = dict(self.right)
        for rank, (a, b) in enumerate(merges):
            i, x, y = vocab[a + b], vocab[a], vocab[b]
            self.right[i] = ((i, never), (y, rank), *self.right[y][1:])
            self.left[i] = ((i, never), (x, rank), *self.left[x][1:])
        #: Tokens that their own bytes give; the others never occur. One rule a token, or the edges mean nothing.
        made = [vocab[a + b] for a, b in merges]
        self.direct = len(set(made)) == len(made)
        real = set(self.first)
        for rank, (a, b) in enumerate(merges):
            if vocab[a] in real and vocab[b] in real and self.crossing(vocab[a], vocab[b]) == rank:
                real.add(vocab[a + b])
        self.longest: dict[bytes, int] = {}
        self.token: dict[bytes, int] = {}
        for t, i in vocab.items():
            if i in real:
                self.token[t] = i
                self.longest[t[:2]] = max(self.longest.get(t[:2], 0), len(t))
                self.longest[t[:1]] = max(self.longest.get(t[:1], 0), 1)
        self.fits: dict[int, bool] = {}

    def crossing(self, a: int, b: int) -> int | None:
        """Rank of the first merge across the border when a's bytes are followed by b's (None: [a, b] stays).

        A pair of edge tokens merges if both still stand at that rank; of equal pairs the left one goes first.
        """
        rule = self.rule.get
        ranks = [r[0] for x, x_end in self.right[a] for y, y_end in self.left[b] if (r := rule((x, y))) and r[0] < x_end and r[0] <= y_end]
        return min(ranks, default=None)

    def forget(self) -> None:
        """Empty the caches, at the end of a task: the worker goes on with other work."""
        self.cache.clear()
        self.fits.clear()

    def stands(self, a: int, b: int) -> bool:
        known = self.fits.get(key := a << 32 | b)
        if known is None:
            if len(self.fits) >= CACHE_PIECES:
                self.fits.clear()
            known = self.fits[key] = self.crossing(a, b) is None
        return known

    def tokens(self, data: bytes) -> list[int]:
        """BPE by search: ids are right if every adjacent pair stands, and only one row of ids does.

        Long tokens are tried first; an end from which no row goes on is not tried again.
        """
        if not self.direct:
            return self.merge(data)
        token, longest, width = self.token.get, self.longest.get, self.width
        ids: list[int] = []
        at, end, dead = 0, len(data), set()
        size = min(longest(data[:2], 1), end)
        while at < end:
            while size:
                if at + size not in dead and (i := token(data[at : at + size])) is not None and (not ids or self.stands(ids[-1], i)):
                    ids.append(i)
                    at += size
                    size = min(longest(data[at : at + 2], 1), end - at)
                    break
                size -= 1
            else:
                dead.add(at)
                size = width[ids.pop()]
                at -= size
                size -= 1
        return ids

    def merge(self, data: bytes) -> list[int]:
        """BPE by definition: the lowest-ranked adjacent pair is merged, leftmost first, until none is left."""
        ids = [self.first[b] for b in data]
        rule = self.rule.get
        while len(ids) > 1:
            low, pair = min(((r[0], p) for p in zip(ids, ids[1:]) if (r := rule(p))), default=(None, None))
            if pair is None:
                break
            whole, out, k = self.rule[pair][1], [], 0
            while k < len(ids):
                if k + 1 < len(ids) and ids[k] == pair[0] and ids[k + 1] == pair[1]:
                    out.append(whole)
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def stream(self, chunks):
        """Ids of one piece that arrives in chunks of bytes; each id is given once it is final."""
        held = b""
        for chunk in chunks:
            for a in range(0, len(chunk), 1024):
                held += chunk[a : a + 1024]
                if len(held) < 2 * self.lookahead + 1024:
                    continue
                done, final = 0, len(held) - self.lookahead
                for i in self.tokens(held):
                    if done + self.width[i] > final:
                        break
                    done += self.width[i]
                    yield i
                held = held[done:]
        yield from self.tokens(held)

    def piece(self, text: str) -> tuple:
        data = text.encode()
        if len(data) > CACHE_BYTES:
            return tuple(self.stream(data[a : a + WINDOW] for a in range(0, len(data), WINDOW)))
        ids = tuple(self.tokens(data))
        if len(self.cache) >= CACHE_PIECES:
            self.cache.clear()
        self.cache[text] = ids
        return ids

    def starts(self, text: str, at: list[int]) -> np.ndarray:
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return piece_starts(code, self.kinds[code], np.array(at, np.int64))

    def cut(self, text: str):
        """Pieces of a long text in order, a window of characters at a time."""
        at, size = 0, WINDOW
        while len(text) - at > size:
            part = text[at : at + size]
            sure = self.starts(part, [0, len(part)])
            sure = sure[sure <= size - PIECE_LOOKAHEAD].tolist()
            if len(sure) < 2:  # one piece fills the window
                size *= 2
                continue
            yield [part[a:b] for a, b in zip(sure, sure[1:])]
            at, size = at + sure[-1], WINDOW
        last = [*self.starts(text[at:], [0, len(text) - at]).tolist(), len(text) - at]
        yield [text[at + a : at + b] for a, b in zip(last, last[1:])]

    def ids(self, pieces: list[str]) -> list[int]:
        known, new = self.cache.get, self.piece
        return list(chain.from_iterable([known(p) or new(p) for p in pieces]))

    def encode(self, text: str) -> list[int]:
        """Ids as the tokenizers library gives them, without added special tokens."""
        out: list[int] = []
        parts = self.split.split(text) if self.split else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.added[part])
            elif part:
                for pieces in self.cut(part):
                    out += self.ids(pieces)
        return out

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """``encode`` of each text; short texts are cut into pieces together."""
        out: list = [None] * len(texts)
        group: list[int] = []
        size = 0
        special = tuple(self.added)
        for k, text in enumerate(texts):
            if len(text) > WINDOW or any(t in text for t in special):
                out[k] = self.encode(text)
                continue
            group.append(k)
            size += len(text)
            if size >= 4 * WINDOW:
                self._together(texts, group, out)
                group, size = [], 0
        self._together(texts, group, out)
        return out

    def _together(self, texts: list[str], group: list[int], out: list) -> None:
        whole = "".join(texts[k] for k in group)
        ends = np.cumsum([0, *(len(texts[k]) for k in group)])
        starts = self.starts(whole, ends)
        first = np.searchsorted(starts, ends).tolist()
        starts = [*starts.tolist(), len(whole)]
        pieces = [whole[a:b] for a, b in zip(starts, starts[1:])]
        for k, a, b in zip(group, first, first[1:]):
            out[k] = self.ids(pieces[a:b])


class Decoder:
    def __init__(self, vocab: dict[bytes, int], added: dict[str, int]):
        self.bytes = {i: t.encode() for t, i in added.items()} | {i: t for t, i in vocab.items()}

    def chunks(self, ids: list[int], size: int = 1 << 14):
        """Text as soon as it is complete, ``size`` ids at a time; special tokens stand for their own text."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for a in range(0, len(ids), size):
            yield state.decode(b"".join(map(self.bytes.__getitem__, ids[a : a + size])))
        yield state.decode(b"", True)

    def decode(self, ids: list[int]) -> str:
        return "".join(self.chunks(ids))


_MADE: dict = {}


def _coders(shared) -> tuple[Encoder, Decoder]:
    """One pair per Python worker, kept while tasks bring the same vocabulary."""
    it = shared.value
    key = (len(it["merges"]), hash(tuple(it["merges"])), hash(tuple(it["added"].items())))
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Encoder(**it), Decoder(it["vocab"], it["added"])
    return _MADE[key]


def _encode_batches(batches, shared, rest: list[str]):
    encoder, _ = _coders(shared)
    for part in in_slices(batches):
        ids = encoder.encode_all([t or "" for t in part.column("text").to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in rest), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
            [*rest, "n_tokens", "ids"],
        )
    encoder.forget()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` in place of ``text``; other columns and all rows stay.

    Null or empty text gives no ids. Columns named n_tokens or ids are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    docs = docs.drop("n_tokens", "ids")
    rest = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*docs.select(rest).schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(*rest, "text").mapInArrow(partial(_encode_batches, shared=shared, rest=rest), schema)


def _decode_batches(batches, shared, rest: list[str]):
    _, decoder = _coders(shared)
    for part in in_slices(batches):
        texts = [decoder.decode(ids or []) for ids in part.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(texts, pa.string())], [*rest, "decoded"])


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` with ``decoded``, the text of ``ids`` (null: empty), added; all columns and rows stay."""
    shared = tokens.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    tokens = tokens.drop("decoded")
    rest = tokens.columns
    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.StringType())])
    return tokens.mapInArrow(partial(_decode_batches, shared=shared, rest=rest), schema)


def _trip_batches(batches, shared, rest: list[str]):
    encoder, decoder = _coders(shared)
    for part in in_slices(batches):
        ids = encoder.encode_all([t or "" for t in part.column("text").to_pylist()])
        decoded = []
        for row in ids:
            sha = hashlib.sha256()
            for chunk in decoder.chunks(row):
                sha.update(chunk.encode())
            decoded.append(sha.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in rest), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
            [*rest, "n_tokens", "ids", "decoded_sha256"],
        )
    encoder.forget()


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` and ``decoded_sha256`` (of the text that the ids decode to) in place of ``text``.

    One pass encodes and decodes, so that a task has one vocabulary in memory.
    Null or empty text gives no ids. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    docs = docs.drop("n_tokens", "ids", "decoded_sha256")
    rest = [c for c in docs.columns if c != "text"]
    made = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded_sha256", T.StringType())]
    return docs.select(*rest, "text").mapInArrow(partial(_trip_batches, shared=shared, rest=rest), T.StructType([*docs.select(rest).schema.fields, *made]))


def _digest_batches(batches, shared):
    encoder, decoder = _coders(shared)
    names = {}
    for batch in in_slices(batches):
        count, ids_sha, text_sha = [], [], []
        for ids in encoder.encode_all([t or "" for t in batch.column("text").to_pylist()]):
            count.append(len(ids))
            sha = hashlib.sha256()
            for a in range(0, len(ids), 1 << 14):
                part = ids[a : a + (1 << 14)]
                sha.update(("," * bool(a) + ",".join([names.get(i) or names.setdefault(i, str(i)) for i in part])).encode())
            ids_sha.append(sha.hexdigest())
            sha = hashlib.sha256()
            for part in decoder.chunks(ids):
                sha.update(part.encode())
            text_sha.append(sha.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )
    encoder.forget()


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (ids encoded, then decoded again).

    Null text counts as empty: no tokens, digests of the empty string. Repeated
    rows each get their row; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id"), "text").mapInArrow(partial(_digest_batches, shared=shared), schema)
