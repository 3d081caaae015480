"""Byte-level BPE encoding and decoding without a regular expression.

The pre-tokeniser of the public rank files splits a text into contractions, runs of letters, of digits and of other
signs (each with at most one space before it) and white space. Here every code point gets a class (with one or two
code points of look-ahead folded in), every class is a transition function on seven states, and the functions form a
small monoid: composing them is one look-up in a table, and associative. So the state before each code point is an
inclusive scan, done over columns of a (blocks x width) array and then over the blocks' totals, all in numpy. A
boundary is a property of (state, class). The slices between boundaries go through a bounded cache to pair merging.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import json
import re
import sys
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from brindle.llm import common

# States: in white space, letters, digits, other signs; one or two letters of a contraction to go; closed.
W, L, N, O, C1, C2, E = range(7)
# Classes after look-ahead. WM: white space inside its token, WE: white space alone, SL SN SO: a space that opens a
# run, CL CN CO: letter, digit, other, A1 A2: apostrophe before one or two letters of a contraction.
WM, WE, SL, SN, SO, CL, CN, CO, A1, A2 = range(10)
CLASSES = 10
#: The code points with the White_Space property, and contractions by length.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Slices of at most so many bytes merge in matrices; no rank.
MATRIX, NONE = 48, 2**31 - 1
SHORT, LONG = ("s", "t", "m", "d"), ("re", "ve", "ll")


def _step(state: int, cls: int) -> int:
    if cls == CL:
        return {C1: E, C2: C1}.get(state, L)
    if cls in (A1, A2):
        return O if state == O else (C1 if cls == A1 else C2)
    return {WM: W, WE: E, SL: L, SN: N, SO: O, CN: N, CO: O}[cls]


def _starts(state: int, cls: int) -> bool:
    if cls == CL:
        return state not in (L, C1, C2)
    return {WM: state != W, CN: state != N, CO: state != O, A1: state != O, A2: state != O}.get(cls, True)


@functools.cache
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function id of each class (second half: the same at a text's start), composition table, functions, starts."""
    ids: dict[tuple[int, ...], int] = {}
    gens = [tuple(_step(s, c) for s in range(7)) for c in range(CLASSES)]
    gens += [(_step(E, c),) * 7 for c in range(CLASSES)]
    todo = [tuple(range(7)), *gens]
    while todo:
        f = todo.pop()
        if f not in ids:
            ids[f] = len(ids)
            todo += [tuple(g[f[s]] for s in range(7)) for g in gens]
    fs = sorted(ids, key=ids.get)
    table = np.array([[ids[tuple(g[f[s]] for s in range(7))] for g in fs] for f in fs], dtype=np.uint8 if len(fs) < 256 else np.uint16)
    starts = np.array([[_starts(s, c) for c in range(CLASSES)] for s in range(7)])
    return np.array([ids[g] for g in gens], dtype=table.dtype), table, np.array(fs, dtype=np.uint8), starts


@functools.cache
def _kinds() -> np.ndarray:
    """Kind of every code point: 0 other, 1 letter, 2 digit, 3 white space, 4 space."""
    first = {"L": 1, "N": 2}
    kinds = np.fromiter((first.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)), dtype=np.uint8, count=sys.maxunicode + 1)
    kinds[WHITE] = 3
    kinds[0x20] = 4
    return kinds


def _classes(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """first: whether a text starts at this code point. Look-ahead stops at the end of a text."""
    n = len(points)
    kind = _kinds()[points]
    nxt = np.zeros(n, np.uint8)
    nxt[:-1] = np.where(first[1:], 3, kind[1:])  # past the end counts as white space: the run is whole
    nxt[-1] = 3
    space, ahead = kind >= 3, nxt >= 3
    cls = np.array([CO, CL, CN, WM, WM], np.uint8)[kind]
    last = space & ~ahead
    cls[last] = WE
    opens = last & (kind == 4)
    cls[opens] = np.array([SO, SL, SN], np.uint8)[nxt[opens]]
    at = np.flatnonzero((points == 0x27) & (nxt == 1))
    if len(at):
        b = points[np.minimum(at + 1, n - 1)]
        two = np.minimum(at + 2, n - 1)
        c = np.where((at + 2 < n) & ~first[two], points[two], 0)
        cls[at[np.isin(b, [ord(x) for x in SHORT])]] = A1
        for x in LONG:
            cls[at[(b == ord(x[0])) & (c == ord(x[1]))]] = A2
    return cls


def scan_states(cls: np.ndarray, first: np.ndarray, width: int = 64) -> np.ndarray:
    """State before each code point, by a two-level scan of composed transition functions."""
    gen, table, fs, _ = _monoid()
    n = len(cls)
    identity = int(np.flatnonzero((fs == np.arange(7)).all(1))[0])
    blocks = -(-n // width)
    f = np.full(blocks * width, identity, table.dtype)
    f[:n] = gen[cls + CLASSES * first.astype(np.uint8)]
    f = np.ascontiguousarray(f.reshape(blocks, width).T)  # column j of every block is contiguous
    flat, m = table.ravel(), len(table)
    for j in range(1, width):
        f[j] = flat[f[j - 1].astype(np.int32) * m + f[j]]
    if blocks > width:  # totals of blocks by the same scan over functions
        total = _scan_functions(f[-1], width)
    else:
        total = f[-1].copy()
        for j in range(1, blocks):
            total[j] = flat[int(total[j - 1]) * m + total[j]]
    before = np.full(blocks, E, np.uint8)
    before[1:] = fs[total[:-1], E]
    states = np.empty((width, blocks), np.uint8)
    states[0] = before
    for j in range(1, width):
        states[j] = fs[f[j - 1], before]
    return states.T.reshape(-1)[:n]


def _scan_functions(f: np.ndarray, width: int) -> np.ndarray:
    _, table, fs, _ = _monoid()
    flat, m = table.ravel(), len(table)
    n = len(f)
    identity = int(np.flatnonzero((fs == np.arange(7)).all(1))[0])
    blocks = -(-n // width)
    g = np.full(blocks * width, identity, table.dtype)
    g[:n] = f
    g = np.ascontiguousarray(g.reshape(blocks, width).T)
    for j in range(1, width):
        g[j] = flat[g[j - 1].astype(np.int32) * m + g[j]]
    carry = identity
    carries = np.empty(blocks, table.dtype)
    for j, x in enumerate(g[-1].tolist()):
        carries[j] = carry
        carry = int(flat[carry * m + x])
    return flat[carries[None, :].astype(np.int32) * m + g].T.reshape(-1)[:n]


def boundaries(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """UTF-8 of all texts, byte offsets of slices (with the end), and each text's first slice (with the end)."""
    joined = "".join(texts)
    raw = joined.encode("utf-8", "surrogatepass")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    if not joined:
        return raw, np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.zeros(len(points), bool)
    first[starts[:-1][lengths > 0]] = True
    cls = _classes(points, first)
    starting = _monoid()[3].ravel()[scan_states(cls, first).astype(np.int32) * CLASSES + cls] | first
    at = np.flatnonzero(starting)
    if len(raw) == len(points):
        offsets = np.append(at, len(raw))
    else:
        width = 1 + (points > 0x7F).astype(np.uint8) + (points > 0x7FF) + (points > 0xFFFF)
        ends = np.cumsum(width, dtype=np.int64)
        offsets = np.append(ends[at] - width[at], len(raw))
    return raw, offsets, np.searchsorted(at, starts)


class PairTable:
    """(left id, right id) -> (rank, merged id), open addressing in numpy arrays, for look-ups by the million."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.bits = max(12, (len(pairs) * 12).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NONE, np.int32)
        self.merged = np.zeros(size, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # who finds a free slot first has it; the rest move on
            free = left[self.keys[at[left]] == -1]
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]] = keys[won]
            self.rank[at[won]], self.merged[at[won]] = values[won, 0], values[won, 1]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (a.astype(np.int64) << 32) | b
        at = self._slot(keys)
        seen = self.keys[at]
        open_ = np.flatnonzero((seen != keys) & (seen != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[open_]]
            open_ = open_[(seen != keys[open_]) & (seen != -1)]
        return self.rank[at], self.merged[at]  # an empty slot has no rank


class Merges(dict):
    """Slice -> its ids as little-endian unsigned 32-bit bytes. A cache of at most ``limit`` slices.

    Without ``pairs`` any two neighbours whose bytes together are a token merge, lowest rank first, and a slice that
    is a token stays whole; with ``pairs`` only the listed ones merge, in their order.
    """

    def __init__(self, ranks: dict[bytes, int], pairs: dict[tuple[bytes, bytes], int] | None = None, limit: int = 400_000):
        super().__init__()
        self.ranks, self.pairs, self.limit = ranks, pairs, limit
        self.tokens = {i: b for b, i in ranks.items()}
        self.added: dict[str, bytes] = {}  # tokens that are found before anything else, with their ids' bytes
        if pairs is None:
            halves = ((t[:i], t[i:], r) for t, r in ranks.items() for i in range(1, len(t)))
            table = {(ranks[a], ranks[b]): (r, r) for a, b, r in halves if a in ranks and b in ranks}
        else:
            table = {(ranks[a], ranks[b]): (r, ranks[a + b]) for (a, b), r in pairs.items()}
        self.table = PairTable(table)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

    def learn(self, pieces: set[bytes]) -> None:
        """Merge slices that the cache lacks, all slices of one length at once."""
        by_length: dict[int, list[bytes]] = {}
        for x in pieces:
            if self.pairs is None and x in self.ranks:
                self[x] = np.array([self.ranks[x]], "<u4").tobytes()
            elif len(x) <= MATRIX:
                by_length.setdefault(len(x), []).append(x)
            else:
                self[x] = np.array([self.ranks[t] for t in self.merge(x)], "<u4").tobytes()
        for n, some in by_length.items():
            self._merge_matrix(n, some)

    def _merge_matrix(self, n: int, pieces: list[bytes]) -> None:
        ids = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)].reshape(-1, n)
        if n == 1:
            rank = np.full((len(ids), 1), NONE, np.int32)
            merged = rank
        else:
            rank, merged = self.table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel())
            rank, merged = rank.reshape(-1, n - 1), merged.reshape(-1, n - 1)
        who = np.arange(len(ids))
        while True:
            at = rank.argmin(1)
            rows = np.arange(len(ids))
            open_ = rank[rows, at] != NONE
            width = 4 * ids.shape[1]
            done = np.flatnonzero(~open_)
            out = ids[done].astype("<u4").tobytes()
            for k, i in enumerate(who[done].tolist()):
                self[pieces[i]] = out[k * width : (k + 1) * width]
            if len(done) == len(ids):
                return
            ids, rank, merged, at, who = ids[open_], rank[open_], merged[open_], at[open_], who[open_]
            rows, cols = np.arange(len(ids)), np.arange(ids.shape[1] - 1)
            ids[rows, at] = merged[rows, at]
            keep = cols[None, :] + (cols[None, :] > at[:, None])
            ids = np.take_along_axis(ids, keep, 1)
            m = ids.shape[1]
            if m == 1:
                rank = np.full((len(ids), 1), NONE, np.int32)
                merged = rank
                continue
            # the pair at ``at`` is gone; its neighbours are looked up anew
            keep = np.minimum(cols[None, : m - 1] + (cols[None, : m - 1] >= at[:, None]), m - 1)
            rank, merged = np.take_along_axis(rank, keep, 1), np.take_along_axis(merged, keep, 1)
            for shift in (-1, 0):
                i = at + shift
                some = np.flatnonzero((i >= 0) & (i < m - 1))
                j = i[some]
                rank[some, j], merged[some, j] = self.table.find(ids[some, j], ids[some, j + 1])

    def rank(self, a: bytes, b: bytes) -> int | None:
        return self.ranks.get(a + b) if self.pairs is None else self.pairs.get((a, b))

    def merge(self, piece: bytes) -> list[bytes]:
        if self.pairs is None and piece in self.ranks:
            return [piece]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        if len(parts) > 96:
            return self._merge_long(parts)
        rank = self.rank
        ranks = [rank(a, b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1], parts[at])
            if at < len(ranks):
                ranks[at] = rank(parts[at], parts[at + 1])

    def _merge_long(self, parts: list[bytes]) -> list[bytes]:
        """The same by a heap and links, n log n in the slice's length."""
        n, rank = len(parts), self.rank
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i], parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] is not a or j >= n or parts[j] is not b:
                continue
            parts[i], parts[j] = a + b, None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
                if (r := rank(parts[i], parts[right[i]])) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[right[i]]))
            if (p := left[i]) >= 0 and (r := rank(parts[p], parts[i])) is not None:
                heapq.heappush(heap, (r, p, parts[p], parts[i]))
        return [x for x in parts if x is not None]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Added tokens, where the vocabulary has any, are found first, leftmost and longest, and what
        is between them is encoded piece by piece, as a text of its own."""
        if not self.added or not any(a in t for t in texts for a in self.added):
            return self._encode_plain(texts)
        split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        bits = [split.split(t) for t in texts]
        plain = iter(self._encode_plain([b for some in bits for b in some[::2]]))
        return [b"".join(self.added[b] if k % 2 else next(plain) for k, b in enumerate(some)) for some in bits]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        raw, offsets, firsts = boundaries(texts)
        at = offsets.tolist()
        pieces = [raw[a:b] for a, b in zip(at, at[1:])]
        if new := set(pieces).difference(self):
            if len(self) + len(new) > self.limit:
                self.clear()
                new = set(pieces)
            self.learn(new)
        ids = list(map(self.__getitem__, pieces))
        cut = firsts.tolist()
        return [b"".join(ids[a:b]) for a, b in zip(cut, cut[1:])]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, ids: bytes) -> np.ndarray:
        """Byte offset of each id in the decoded text, and the end."""
        return np.concatenate([[0], np.cumsum([len(self.tokens[i]) for i in np.frombuffer(ids, "<u4").tolist()], dtype=np.int64)]).astype(np.int64)


def byte_letters() -> dict[str, int]:
    """The usual printable stand-ins for bytes in byte-level vocabularies: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def load(path: str) -> Merges:
    """Ranks of a ``.tiktoken`` file, or vocabulary and merges of a byte-level ``.json`` file. Once a worker."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, added = whole["model"], whole.get("added_tokens") or []
        if odd := [t["content"] for t in added if t.get("lstrip") or t.get("rstrip") or t.get("single_word")]:
            raise ValueError(f"added tokens that take blanks or whole words are not known: {odd}")
        letters = byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        ranks = {to_bytes(k): v for k, v in model["vocab"].items() if all(c in letters for c in k)}
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        out = Merges(ranks, {(to_bytes(a), to_bytes(b)): i for i, (a, b) in enumerate(merges)})
        for t in added:
            out.added[t["content"]] = int(t["id"]).to_bytes(4, "little")
            out.tokens[t["id"]] = t["content"].encode()
        return out
    with open(path, "rb") as f:
        return Merges({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def chunks(texts: list[str | None], points: int = 3_000_000):
    """Runs of texts of about so many code points, for the numpy arrays' sake; a longer text comes alone."""
    some, n = [], 0
    for t in texts:
        t = t or ""
        if some and n + len(t) > points:
            yield some
            some, n = [], 0
        some.append(t)
        n += len(t)
    if some:
        yield some


# DataFrame operators


def encode(df: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, n_tokens, ids, token_offsets): ids as little-endian unsigned 32-bit integers, and the
    byte offset of each id in the text's UTF-8 (binary of signed 64-bit integers, with the end).

    One row for each input row, repeated rows included. A null or empty text has no ids. A null id stays null.
    """
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("token_offsets", T.BinaryType())])

    def run(batch):
        model = load(path)
        ids, offsets = [], []
        for some in chunks(batch.column(1).to_pylist()):
            for x in model.encode(some):
                ids.append(x)
                offsets.append(model.offsets(x).tobytes())
        return common.batch(schema, [batch.column(0), [len(x) // 4 for x in ids], ids, offsets])

    return common.map_batches(common.ids_and_texts(df, id_col, text_col), run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, text_bytes): the bytes that the ids stand for. Null ids decode to no bytes."""
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("text_bytes", T.BinaryType())])

    def run(batch):
        model = load(path)
        return common.batch(schema, [batch.column(0), [model.decode(x or b"") for x in batch.column(1).to_pylist()]])

    return common.map_batches(df.select(id_col, ids_col), run, schema)


def round_trip(df: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256), encoding and decoding in one pass, so that ids need not
    travel. Nulls, empty texts and repeated rows as in ``encode``."""
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batch):
        model = load(path)
        n, ids, decoded = [], [], []
        for some in chunks(batch.column(1).to_pylist()):
            for x in model.encode(some):
                n.append(len(x) // 4)
                ids.append(hashlib.sha256(x).hexdigest())
                decoded.append(hashlib.sha256(model.decode(x)).hexdigest())
        return common.batch(schema, [batch.column(0), n, ids, decoded])

    return common.map_batches(common.ids_and_texts(df, id_col, text_col), run, schema)

