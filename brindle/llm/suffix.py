"""Repeated passages: every byte covered by a 400-byte string that also starts elsewhere goes.

The judge is the sorted order of suffixes with its common prefixes (``bwt``), built column by column. What has to be
sorted is narrowed first, exactly:

1. Of equal texts one takes part; where a text of 400 bytes or more has a copy, all of it goes.
2. The leftmost of the least 100-byte hashes of a 400-byte window is its anchor. Equal windows have equal anchors at
   equal offsets, so only windows whose anchor's hash is found twice can repeat. Where all that an anchor's windows
   cover is found twice, at the same offsets, all of them repeat; one of these stands for the others in what follows.
3. The windows of other anchors, around the ends of repeated passages, fall into cells of 32 by their offset. All windows
   of a cell hold its inner string of 369 bytes; cells with an inner string of their own do not repeat.
4. The rest is sorted, groups of equal inner strings, many to a collection. In what is sorted the inner string is one
   symbol, so that 400 bytes are 32 symbols and a string has 63 at most. A group of over ``HOT`` strings (a passage with
   thousands of surroundings) is cut again into cells of 2: there a string is the inner symbol with one byte on either
   side, so no group has over 66,048 strings, however often the passage is found, and it is sorted in the same way.

Strings of steps 1 and 2 are compared by two independent 64-bit hashes (128 bits), inner strings by one: for an error two
of them would have to share it and the other 31 bytes of a window, too.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import bwt, common
from brindle.llm.minhash import mixed

LENGTH, GRAM, CELL, FINE = 400, 100, 32, 2
#: Length and gram for shorter passages: 50 words of prose have about 300 bytes, and 240 or more in 95 of 100 cases.
PASSAGE, PASSAGE_GRAM = 240, 64
#: Strings of a group up to which it is sorted as it is; larger groups are cut into cells of ``FINE`` windows first.
HOT = 4096
#: Symbols that are sorted together, about, and the bytes of an array from which on it lives in a file.
COLLECTION, SPILL = 500_000, 1 << 19
#: Rows that are broadcast at most (a few longs each); more are joined by a shuffle. The bounds are low, so that all but
#: small inputs run the same plan; names of texts, whose join would deal out all texts, have a larger one.
BROADCAST_ROWS, LIST_ROWS, NAME_ROWS = 5_000, 2_000, 50_000
#: Names of 64 bits that more than one text has, at most; expected are n * n / 2**65.
CLASHES = 10_000

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@functools.cache
def _powers(bits: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, 2**bits of each."""
    n = 1 << bits
    with np.errstate(over="ignore"):
        up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


class Sums:
    """Running sums of a text's bytes: hashes of any of its substrings, by the first or the second base."""

    def __init__(self, raw: np.ndarray, which: int):
        self.up, self.down = _powers(max(16, len(raw).bit_length()), _BASES[which])
        self.sums = np.empty(len(raw) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + np.uint64(0xD6E8FEB86659FD93) * np.asarray(salt, np.int64).view(np.uint64))


def anchors(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(hash, two hashes of all that its windows cover, position, first window, last window) of the anchors of a text's bytes."""
    n, w = len(raw), length - gram + 1
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    one, two = Sums(raw, 0), Sums(raw, 1)
    grams = mixed((one.sums[gram:] - one.sums[:-gram]) * one.down[: n - gram + 1])
    value = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    blocks = -(-len(value) // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max)
    padded[: len(value)] = value
    by_block = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(by_block, axis=1).ravel()
    behind = np.minimum.accumulate(by_block[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    least = np.minimum(behind[:count], ahead[w - 1 : w - 1 + count])
    position = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(position)) + 1])
    last = np.append(first[1:] - 1, count - 1)
    at = position[first]
    salt = (at - first) << 20 | last - first
    covered = (s.hashes(first, last + length, salt).view(np.int64) for s in (one, two))
    return grams[at].view(np.int64), *covered, at, first, last


def cells(raw: np.ndarray, position: np.ndarray, first: np.ndarray, last: np.ndarray, length: int = LENGTH, cell: int = CELL) -> tuple[np.ndarray, ...]:
    """(anchor, inner hash, two hashes of what its windows cover, first window, last window, start of the inner string)
    of the anchors' cells."""
    one, two = Sums(raw, 0), Sums(raw, 1)
    low, high = (position - last) // cell, (position - first) // cell
    n = high - low + 1
    which = np.repeat(np.arange(len(position)), n)
    g = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[which]
    end = position[which] - g * cell  # the latest window, where the inner string starts; the earliest is cell - 1 before
    a, b = np.maximum(end - cell + 1, first[which]), np.minimum(end, last[which])
    inner = one.hashes(end, end + length - cell + 1, g)
    salt = g << 12 | (end - a) << 6 | end - b
    return which, inner.view(np.int64), *(s.hashes(a, b + length, salt).view(np.int64) for s in (one, two)), a, b, end


LONG = T.LongType()


def _fields(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, LONG) for n in names])


#: A cell: what it is compared by, its text and windows, whether they are still open, and the bytes on both sides of
#: its inner string.
PIECE = T.StructType([*_fields("inner", "o1", "o2", "d", "a", "b", "e", "open"), T.StructField("sides", T.BinaryType())])


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _few(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a written table, to be broadcast where its count is bounded."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def _with_lists(texts: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """(d, text, lists of the columns): texts joined with the rows of their d. A text has fewer rows than bytes."""
    rows = common.staged(rows, "suffix-rows")
    lists = rows.groupBy("d").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    if rows.limit(LIST_ROWS + 1).count() <= LIST_ROWS:
        lists = F.broadcast(lists)
    return texts.join(lists, "d").select("d", "text", *(F.col("rows")[c].alias(c) for c in columns))


def _lists(batch, k: int) -> list[np.ndarray]:
    column = batch.column(k)
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()
    return [values[a:b] for a, b in zip(offsets, offsets[1:])]


def _find_anchors(batch, length: int, gram: int):
    out: list[list] = [[] for _ in range(7)]
    for d, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        found = anchors(_bytes(text.as_py()), length, gram)
        for c, v in zip(out, (np.full(len(found[0]), d, np.int64), *found)):
            c.append(v)
    return common.batch(_fields("d", "key", "w1", "w2", "at", "first", "last"), [np.concatenate(c) for c in out])


def _find_cells(batch, length: int):
    numbers: list[list] = [[] for _ in range(8)]
    sides: list[bytes] = []
    for d, text, at, first, last, open_ in zip(batch.column(0).to_pylist(), batch.column(1), *(_lists(batch, k) for k in (2, 3, 4, 5))):
        raw = _bytes(text.as_py())
        which, inner, o1, o2, a, b, e = cells(raw, at, first, last, length)
        for c, v in zip(numbers, (inner, o1, o2, np.full(len(a), d, np.int64), a, b, e, open_[which])):
            c.append(v)
        whole = raw.tobytes()
        sides += [whole[x:z] + whole[z + length - CELL + 1 : y + length] for x, y, z in zip(a.tolist(), b.tolist(), e.tolist())]
    return common.batch(PIECE, [*(np.concatenate(c) for c in numbers), sides])


def _cut_again(batch):
    """Cells of FINE windows out of cells of CELL. What they hold in common is told by the inner string's hash and bytes
    of the sides."""
    out: list[list] = [[] for _ in PIECE]
    long = lambda digest: int.from_bytes(digest, "little", signed=True)
    for inner, d, a, b, e, open_, sides in zip(*(batch.column(PIECE.names.index(c)).to_pylist() for c in ("inner", "d", "a", "b", "e", "open", "sides"))):
        left, right = sides[: e - a], sides[e - a :]
        for k in range((e - b) // FINE, (e - a) // FINE + 1):
            at = e - k * FINE  # the latest window
            x, y = max(a, at - FINE + 1), min(b, at)
            middle = left[at - a :], right[: at + CELL - FINE - e]
            name = hashlib.blake2b(b"%d %d %d " % (inner, k, len(middle[0])) + middle[0] + middle[1], digest_size=8).digest()
            some = left[x - a : at - a] + right[at + CELL - FINE - e : y + CELL - 1 - e]
            own = hashlib.blake2b(name + b"%d %d " % (at - x, at - y) + some, digest_size=16).digest()
            for c, v in zip(out, (long(name), long(own[:8]), long(own[8:]), d, x, y, at, open_, some)):
                c.append(v)
    return common.batch(PIECE, out)


def _decided(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of written cells: runs (d, a, b) of those found twice, and cells (PIECE and group, the number in the group) that
    have to be sorted, written: one of each kind, where a group has others and an open one."""
    names = ["inner", "o1", "o2"]
    kinds = split.groupBy(*names).agg(F.count("*").alias("n"), F.max("open").alias("open"), *(F.first(c).alias(c) for c in ("d", "a", "b", "e", "sides")))
    kinds = common.staged(kinds, "suffix-kinds")
    twice = kinds.where("n > 1 and open = 1").select(*names)
    doubled = split.where("open = 1").join(_few(common.staged(twice, "suffix-twice")), names).select("d", "a", "b")
    kinds = kinds.withColumn("open", F.when((F.col("open") == 1) & (F.col("n") == 1), 1).otherwise(0).cast("long"))
    groups = common.staged(kinds.groupBy("inner").agg(F.count("*").alias("group"), F.sum("open").alias("some")).where("group > 1 and some > 0").select("inner", "group"), "suffix-groups")
    return doubled, common.staged(kinds.join(_few(groups), "inner").select(*PIECE.names, "group"), "suffix-pieces")


def _sorted(pieces: DataFrame, cell: int) -> DataFrame:
    """Runs (d, a, b) of windows of open pieces that are found elsewhere in their group, by sorting."""
    collection, spill = COLLECTION, SPILL

    def sort(batches):
        """Collections of whole groups: rows come by inner string."""
        rows: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if size >= collection and row[0] != last:
                    yield from judged(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5]) + 1
                last = row[0]
        yield from judged(rows)
        common.trim()

    def judged(rows):
        if not rows:
            return
        inner, d, a, e, open_, sides = zip(*rows)
        before = np.array(e, np.int64) - np.array(a, np.int64)
        lengths = np.fromiter(map(len, sides), np.int64, len(sides)) + 1
        raw = np.frombuffer(b"".join(s[:k] + b"\0" + s[k:] for s, k in zip(sides, before.tolist())), np.uint8).astype(np.uint32)
        raw[np.cumsum(lengths) - lengths + before] = 256 + np.unique(np.array(inner, np.int64), return_inverse=True)[1]
        out: list[list[int]] = [[], [], []]
        for i, flags in enumerate(bwt.repeated(raw, lengths, cell, spill)):
            if open_[i] and flags.any():
                edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
                out[0] += [d[i]] * (len(edge) // 2)
                out[1] += (a[i] + edge[::2]).tolist()
                out[2] += (a[i] + edge[1::2] - 1).tolist()
        if out[0]:
            yield common.batch(_fields("d", "a", "b"), out)

    common.bound_batches(pieces.sparkSession)
    grouped = pieces.select("inner", "d", "a", "e", "open", "sides").repartition(common.shuffle_partitions(pieces.sparkSession), "inner").sortWithinPartitions("inner")
    return grouped.mapInArrow(sort, _fields("d", "a", "b"))


def windows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Of distinct texts (d, text): rows (d, a, b), runs of starts of windows of ``length`` bytes that also start elsewhere."""
    found = common.staged(common.map_batches(texts.where(F.octet_length("text") >= length), functools.partial(_find_anchors, length=length, gram=gram), _fields("d", "key", "w1", "w2", "at", "first", "last")), "suffix-anchors")
    twice = common.staged(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "suffix-keys")
    shared = common.staged(found.join(_few(twice), "key"), "suffix-shared")
    common.drop(found, twice)
    names = ["key", "w1", "w2"]
    kinds = common.staged(shared.groupBy(*names).agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("d", "at", "first", "last"))), "suffix-ranges")
    settled = shared.join(_few(common.staged(kinds.where("n > 1").select(*names), "suffix-settled")), names).select("d", F.col("first").alias("a"), F.col("last").alias("b"))
    keys = common.staged(kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("open")).where("kinds > 1 and open > 0").select("key"), "suffix-open")
    sources = kinds.join(_few(keys), "key").select("d", "at", "first", "last", (F.col("n") == 1).cast("long").alias("open"))
    split = common.staged(common.map_batches(_with_lists(texts, sources, ["at", "first", "last", "open"]), functools.partial(_find_cells, length=length), PIECE), "suffix-cells")
    doubled, pieces = _decided(split)
    runs = settled.unionAll(doubled).unionAll(_sorted(pieces.where(F.col("group") <= HOT), CELL))
    hot = pieces.where(F.col("group") > HOT)
    if not hot.isEmpty():
        again, fine = _decided(common.staged(common.map_batches(hot.select(*PIECE.names), _cut_again, PIECE), "suffix-fine"))
        runs = runs.unionAll(again).unionAll(_sorted(fine, FINE))
    return runs


def _spans(a: np.ndarray, b: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal removed runs of bytes from runs of window starts."""
    out: list[list[int]] = []
    for x, y in sorted(zip(a.tolist(), b.tolist())):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y + length)
        else:
            out.append([x, y + length])
    return [(x, y) for x, y in out]


def _named(texts: DataFrame) -> tuple[DataFrame, Callable[[Column, Column], Column]]:
    """Written rows (t1, t2, copies, one): distinct texts by two 64-bit hashes; and the expression that names a text by
    one of them, the second where the first is shared with another text."""
    names = common.staged(texts.groupBy("t1", "t2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("one")), "suffix-names")
    clashes = [r["t1"] for r in names.groupBy("t1").agg(F.count("*").alias("n")).where("n > 1").select("t1").limit(CLASHES + 1).collect()]
    if len(clashes) > CLASHES:
        raise RuntimeError(f"more than {CLASHES} texts share a 64-bit name")
    return names, lambda t1, t2: F.when(t1.isin(clashes), t2).otherwise(t1) if clashes else t1


def _hashes(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _texts(df: DataFrame, text_col: str, id_col: str) -> tuple[DataFrame, DataFrame, DataFrame, Callable[[Column], Column]]:
    """Rows (doc_id, d, n_bytes, sha256, copies) of all rows; (d, text) of all rows, and of distinct texts; and a function
    from a text to its name d."""
    texts = common.ids_and_texts(df, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    texts = texts.withColumns(dict(zip(("t1", "t2"), _hashes(F.col("text")))))
    slim = common.staged(texts.select("doc_id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256")), "suffix-slim")
    names, name = _named(slim)
    d = name(F.col("t1"), F.col("t2"))
    many = common.staged(names.where("copies > 1").select(d.alias("d"), "copies", "one"), "suffix-copies")
    texts = texts.withColumn("d", d)
    distinct = texts.join(_few(many, NAME_ROWS), "d", "left").where(F.col("copies").isNull() | F.col("doc_id").eqNullSafe(F.col("one"))).select("d", "text")
    lone = texts.join(_few(many, NAME_ROWS), "d", "left_anti").select("d", "text")
    rows = slim.withColumn("d", d).drop("t1", "t2").join(many.select("d", "copies"), "d", "left")
    return rows, lone, distinct, lambda text: name(*_hashes(F.coalesce(text.cast("string"), F.lit(""))))


def _removed(lone: DataFrame, runs: DataFrame, length: int, whole_characters: bool = False) -> DataFrame:
    """Written rows (d, n_removed, spans, kept) of the texts without a copy that lose bytes by ``runs`` of windows; kept is
    what is left, as bytes, with ``whole_characters`` without characters that a passage's end cuts."""
    schema = T.StructType([T.StructField("d", LONG), T.StructField("n_removed", LONG), T.StructField("spans", T.ArrayType(T.ArrayType(LONG))), T.StructField("kept", T.BinaryType())])

    def remove(batch):
        out = [[], [], [], []]
        for d, text, a, b in zip(batch.column(0).to_pylist(), batch.column(1), _lists(batch, 2), _lists(batch, 3)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            spans = _spans(a, b, length)
            kept, at = [], 0
            for x, y in spans:
                kept.append(raw[at:x])
                at = y
            kept.append(raw[at:])
            left = b"".join(kept)
            if whole_characters:  # only characters that a cut has broken are not valid
                left = "".join(k.decode("utf-8", "ignore") for k in kept).encode()
            for c, v in zip(out, (d, sum(y - x for x, y in spans), [list(s) for s in spans], left)):
                c.append(v)
        return common.batch(schema, out)

    return common.staged(common.map_batches(_with_lists(lone, runs, ["a", "b"]), remove, schema), "suffix-changed")


def covered(runs: DataFrame, length: int) -> DataFrame:
    """Rows (d, n): bytes that the runs' windows cover, overlaps once. A text has fewer runs than bytes."""
    ordered = runs.groupBy("d").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("runs"))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(s: Column, r: Column) -> Column:
        end = r["b"] + length
        return F.struct(F.greatest(s["end"], end).alias("end"), (s["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(s["end"], r["a"]))).alias("n"))

    return ordered.select("d", F.aggregate("runs", zero, add)["n"].alias("n"))


def report(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_bytes), one for each row of ``df``.

    n_passage_bytes counts the bytes covered by strings of 240 bytes that also start elsewhere: shorter passages, of about
    50 words, show there and are not removed. Other columns are by strings of 400 bytes.
    Texts are UTF-8; a null text is empty, and empty or short texts lose nothing. Repeated rows are copies of one
    another and lose everything if they have 400 bytes. Null ids stay null. Extra columns of any name are not read; an
    empty table gives no rows.
    """
    rows, lone, distinct, _ = _texts(df, text_col, id_col)
    passages = common.staged(covered(windows(distinct, PASSAGE, PASSAGE_GRAM), PASSAGE), "suffix-passages")
    # a repeated string of LENGTH lies in repeated ones of PASSAGE, and so does the other one, in texts that show it
    some = _few(common.staged(passages.where(F.col("n") >= LENGTH).select("d"), "suffix-some"), NAME_ROWS)
    changed = _removed(lone, windows(distinct.join(some, "d", "left_semi")), LENGTH)
    changed = changed.select("d", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    out = rows.join(changed, "d", "left").join(passages, "d", "left")
    copied = F.coalesce(F.col("copies"), F.lit(1)) > 1
    whole = copied & (F.col("n_bytes") >= LENGTH)
    passage = F.when(copied & (F.col("n_bytes") >= PASSAGE), F.col("n_bytes")).otherwise(F.coalesce("n", F.lit(0)))
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        passage.cast("long").alias("n_passage_bytes"),
    )


def cleaned(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", length_col: str = "n_chars", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``df`` with repeated passages of ``length`` bytes and more taken out of the texts. A text of which nothing is left becomes empty, and its row
    stays; a character that is cut by a passage's end goes whole. ``length_col``, where there is one, follows. Null
    texts stay null; other columns, whatever their names, and the order of columns stay."""
    rows, lone, distinct, d = _texts(df, text_col, id_col)
    changed = _removed(lone, windows(distinct, length, gram), length, whole_characters=True)
    gone = rows.where(F.col("copies") > 1).select("d").distinct().select("d", F.lit(b"").alias("kept"))
    changed = common.staged(changed.select("d", "kept").unionAll(gone), "suffix-kept")
    if changed.agg(F.coalesce(F.sum(F.length("kept") + 16), F.lit(0))).first()[0] <= 1 << 24:
        changed = F.broadcast(changed)
    text = F.col(f"x.`{text_col}`").cast("string")
    out = df.alias("x").join(changed.alias("c"), d(text) == F.col("c.d"), "left")
    hit = F.col("c.kept").isNotNull() & (F.octet_length(text) >= length)
    left = F.decode(F.col("c.kept"), "UTF-8")
    columns = []
    for c in df.columns:
        own = F.col(f"x.`{c}`")
        if c == text_col:
            columns.append(F.when(hit, left).otherwise(own).alias(c))
        elif c == length_col:
            columns.append(F.when(hit, F.length(left)).otherwise(own).cast(df.schema[c].dataType).alias(c))
        else:
            columns.append(own)
    return out.select(*columns)
