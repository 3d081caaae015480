"""Near-duplicate documents: MinHash bands for candidates, odd sketches to verify them, full sets to confirm.

A document is the set of its distinct five-word shingles. Documents with equal sets form a class, and only classes are
compared. Candidates are pairs of a bucket of a band that pass the length and the odd-sketch filter:

1. In buckets of up to ``SMALL`` classes all pairs meet, so a class has fewer than ``SMALL`` partners in each.
2. In a larger bucket every class meets the bucket's hub, the class that shares most with others (the largest sum of
   bucket sizes); a hub of a group of near copies is near its centre and links nearly all of them. Confirmed links make
   components, and a bucket whose classes are all of one component needs nothing more.
3. The classes of the other large buckets meet in a set-similarity join over all of them, by their rarest shingles
   (prefix, length and positional filters), where components differ. That join loses no pair at the threshold, so step 2
   only saves work, and its rows grow with the prefixes and not with the square of a bucket.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import common

WORDS, SIMILARITY = 5, (75, 100)
#: 50 bands of 5: a pair at similarity 0.75 shares no bucket with probability (1 - 0.75**5)**50 = 1.3e-6, at 0.8 2.5e-9.
BANDS, ROWS = 50, 5
#: Odd sketch of the 250 samples in 512 bits. At similarity 0.75 the XOR has 99 bits set on average, with a standard
#: deviation of 10.5; the filter lets six deviations more pass.
SKETCH_BITS, SKETCH_LIMIT = 512, 162
#: Rows that are broadcast at most, of a few longs each; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Classes of a bucket of which all pairs meet; larger buckets have a hub.
SMALL = 8
#: Parts that a hub's partners are dealt to.
SALTS = 64

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


@functools.cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, 2**bits of each."""
    n = 1 << bits
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles. Words are runs without ASCII white space, A-Z lower-cased;
    with fewer words the whole sequence is one shingle; a null text or one without words has none."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    solid = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.flatnonzero(np.diff(solid.view(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(max(12, len(raw).bit_length()))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    word = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    n = min(words, len(word))
    out = np.full(len(word) - n + 1, n, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xA0761D6478BD642F) + word[k : len(word) - n + 1 + k]
    return np.unique(mixed(out))


@functools.cache
def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return (rng.integers(0, 1 << 32, (n, 1), np.uint32) | np.uint32(1)), rng.integers(0, 1 << 32, (n, 1), np.uint32)


def minhash(hashes: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    a, b = _coefficients(n)
    h = (hashes >> np.uint64(32)).astype(np.uint32)[None, :]
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, h.shape[1], 1024):
        x = h[:, i : i + 1024] * a
        x += b
        np.minimum(out, x.min(1), out=out)
    return out


def bands(samples: np.ndarray, n: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.arange(n, dtype=np.uint64)
    for column in samples.reshape(n, rows).T:
        out = mixed(out * np.uint64(0xA0761D6478BD642F) + column)
    return out.view(np.int64)


def odd_sketch(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmap of the set {(i, i-th sample)}, as 64-bit words: an element flips one bit."""
    at = mixed(samples.astype(np.uint64) + (np.arange(len(samples), dtype=np.uint64) << np.uint64(32))) % np.uint64(bits)
    odd = (np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def sketched_similarity(xor_bits: float, samples: int = BANDS * ROWS, bits: int = SKETCH_BITS) -> float:
    """The similarity that an odd-sketch XOR of so many set bits stands for."""
    full = max(1e-9, 1 - 2 * min(xor_bits, bits / 2 - 0.5) / bits)
    return 1 - np.log(full) / np.log(1 - 2 / bits) / (2 * samples)


def set_name(hashes: np.ndarray) -> tuple[int, int]:
    """128-bit name of a set, as two longs."""
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _with_text_names(docs: DataFrame) -> DataFrame:
    """Two 64-bit hashes of the text that together name it; those of a null text are of their own."""
    return docs.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), F.col("text").isNull(), "text")})


def signatures(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, t1, t2, s1, s2, n_shingles, bands, sketch), one for each row: the names of text and set, the
    set's size, its band keys and its odd sketch; without shingles all but the names of the text and the size are null."""
    longs, long = T.ArrayType(T.LongType()), T.LongType()
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *(T.StructField(c, long) for c in ("t1", "t2", "s1", "s2", "n_shingles")), T.StructField("bands", longs), T.StructField("sketch", longs)])

    def run(batch):
        first, second, sizes, keys, sketches = [], [], [], [], []
        for text in batch.column(1):
            s = shingles(text.as_py())
            a, b = set_name(s) if len(s) else (None, None)
            first.append(a)
            second.append(b)
            sizes.append(len(s))
            samples = minhash(s) if len(s) else None
            keys.append(bands(samples) if len(s) else None)
            sketches.append(odd_sketch(samples) if len(s) else None)
        return common.batch(schema, [batch.column(0), batch.column(2), batch.column(3), first, second, sizes, keys, sketches])

    return common.map_batches(_with_text_names(common.ids_and_texts(df, id_col, text_col)), run, schema)


def _few(df: DataFrame) -> DataFrame:
    """``df``, a written table, to be broadcast where its count is bounded."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Written rows (node, shingles) with the full sets of the nodes; only their texts are fetched."""
    picks = common.staged(nodes.join(classes.select("node", "pick"), "node").select("node", F.col("pick.doc_id").alias("doc_id"), F.col("pick.t1").alias("t1"), F.col("pick.t2").alias("t2")), "minhash-picks")
    texts = _with_text_names(docs).alias("d").join(_few(picks).alias("p"), F.expr("d.t1 = p.t1 and d.t2 = p.t2 and d.doc_id <=> p.doc_id")).select("p.node", "d.text")
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))  # repeated rows
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def run(batch):
        return common.batch(schema, [batch.column(0), [shingles(t.as_py()).view(np.int64) for t in batch.column(1)]])

    out = common.staged(common.map_batches(texts, run, schema), "minhash-sets")
    common.drop(picks)
    return out


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) of nodes, those linked by their full sets, written. A node that is ``a`` of very many pairs is
    dealt to parts by its partners."""
    num, den = SIMILARITY
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    left = dealt.select("a", "salt").distinct().join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
    right = dealt.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    links = right.join(left, ["a", "salt"]).where(both * (den + num) >= (F.size("set_a") + F.size("set_b")) * num)
    return common.staged(links.select("a", "b"), "minhash-links")


def _plausible(a: str, b: str):
    """Sizes n and odd sketches of two prefixes of column names that a similarity of 0.75 allows."""
    num, den = SIMILARITY
    n, m, x, y = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.sketch"), F.col(f"{b}.sketch")
    bits = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return (F.least(n, m) * den >= F.greatest(n, m) * num) & (bits <= SKETCH_LIMIT)


def _prefix_pairs(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """Of (node, component, n, sketch): all plausible pairs of nodes of different components whose sets can reach the
    threshold, by the shingles of their prefixes in order of frequency.

    The larger set of a pair holds its first common shingle in its first n - ceil(0.75 n) + 1, the smaller one in its
    first n - ceil(6/7 n) + 1, as its overlap must be 3/7 of both sizes. Shingles that only one node has come first and
    are counted, not joined.
    """
    num, den = SIMILARITY
    tokens = sets.select("node", F.explode("shingles").alias("token"))
    shared = common.staged(tokens.groupBy("token").agg(F.count("*").alias("f")).where("f > 1"), "minhash-tokens")
    listed = tokens.join(shared, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("f", "token"))).alias("list"))  # no more than a text's words
    alone = F.col("n") - F.size("list")
    reach = F.col("n") - F.ceil(F.col("n") * num / den) + 1
    rows = listed.join(open_, "node").withColumn("alone", alone).withColumn("reach", reach).where("alone < reach")
    rows = rows.select("node", "component", "n", "sketch", "alone", F.posexplode(F.slice("list", F.lit(1), (F.col("reach") - F.col("alone")).cast("int"))).alias("k", "e"))
    rows = rows.select(F.col("e.token").alias("token"), "node", "component", "n", "sketch", (F.col("alone") + F.col("k")).alias("at"))
    rows = common.staged(rows, "minhash-prefixes")
    small = rows.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * (2 * num) / (num + den)))
    met = F.expr("a.token = b.token and a.component != b.component and (a.n < b.n or (a.n = b.n and a.node < b.node))")
    needed = F.ceil((F.col("a.n") + F.col("b.n")) * num / (num + den))
    left = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    pairs = small.alias("a").join(rows.alias("b"), met & (left >= needed) & _plausible("a", "b"))
    return common.staged(pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct(), "minhash-pairs")


def groups(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of ``df``.

    Documents are linked at a similarity of 0.75 or more of their full shingle sets; component_id is the least id that
    can be reached. A null or empty text has no shingles, is linked with nothing and stays. Null ids take part; the
    component has the least id that is not null, and a null id is kept only where its text is linked with no id.
    Repeated rows of the id that stays all stay, and so do rows of that id in the component with another text. Extra
    columns of any name are not read; an empty table gives no rows.
    """
    return _grouped(df, text_col, id_col).select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Rows of ``groups`` with the names (t1, t2) of their texts."""
    docs = common.ids_and_texts(df, id_col, text_col)
    rows = common.staged(signatures(docs), "minhash-rows")
    classes = rows.where("n_shingles > 0").groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("pick"), F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = common.staged(classes.withColumn("node", F.monotonically_increasing_id()), "minhash-classes")

    members = classes.select("node", F.explode("bands").alias("band"))
    buckets = common.staged(members.groupBy("band").agg(F.count("*").alias("size"), F.min("node").alias("a"), F.max("node").alias("b")).where("size > 1"), "minhash-buckets")
    two = buckets.where("size = 2").select("a", "b").distinct()  # both members are known
    wanted = common.staged(buckets.where("size > 2").select("band", "size"), "minhash-wanted")
    listed = common.staged(members.join(_few(wanted), "band"), "minhash-listed")
    score = listed.groupBy("node").agg(F.sum("size").alias("score"))
    of_node = common.staged(score.join(classes.select("node", "n", "sketch"), "node"), "minhash-scores")
    shared = common.staged(listed.join(of_node, "node"), "minhash-members")
    hubs = common.staged(shared.where(F.col("size") > SMALL).groupBy("band").agg(F.max(F.struct("score", "node", "n", "sketch")).alias("hub")), "minhash-hubs")
    small, large = shared.where(F.col("size") <= SMALL), shared.where(F.col("size") > SMALL)
    within = small.alias("a").join(small.alias("b"), F.expr("a.band = b.band and a.node < b.node") & _plausible("a", "b")).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    starred = large.alias("b").join(hubs.alias("h"), F.expr("b.band = h.band and b.node != h.hub.node") & _plausible("h.hub", "b")).select(F.col("h.hub.node").alias("a"), F.col("b.node").alias("b"))
    pairs = common.staged(_filtered(two, classes).unionAll(within).unionAll(starred).distinct(), "minhash-pairs")
    sets = _sets(pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct(), classes, docs)
    links = _confirmed(pairs, sets)
    common.drop(pairs, sets, hubs, wanted, buckets, listed, of_node)
    labels = common.components(links, "minhash-components")

    # large buckets of more than one component
    open_ = common.staged(large.join(labels, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"), "n", "sketch"), "minhash-open")
    unsettled = common.staged(open_.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("band"), "minhash-unsettled")
    left = common.staged(open_.join(_few(unsettled), "band", "left_semi").groupBy("node").agg(F.first("component").alias("component"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "minhash-left")
    common.drop(open_, unsettled, shared)
    done = [links, left]
    if not left.isEmpty():
        sets = _sets(left.select("node"), classes, docs)
        pairs = _prefix_pairs(left, sets)
        more = _confirmed(pairs, sets)
        common.drop(pairs, sets, labels)
        labels = common.components(links.unionAll(more), "minhash-components")
        done.append(more)

    named = classes.select("node", "s1", "s2", "id").join(labels, "node", "left").select("s1", "s2", "id", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = common.staged(named.join(least, "component").select("s1", "s2", "component_id"), "minhash-named")
    common.drop(classes, labels, *done)
    out = rows.select("doc_id", "t1", "t2", "n_shingles", "s1", "s2").join(named, ["s1", "s2"], "left")
    component = F.coalesce("component_id", "doc_id")
    kept = F.when(F.col("n_shingles") == 0, True).otherwise(F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    found = out.select("doc_id", "t1", "t2", "n_shingles", component.alias("component_id"), kept.alias("kept"))
    found.made_of = [rows, named]
    return found


def _filtered(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of pairs (a, b) of nodes, the plausible ones."""
    c = classes.select("node", "n", "sketch")
    with_a = pairs.alias("p").join(c.alias("a"), F.expr("p.a = a.node"))
    return with_a.join(c.alias("b"), F.expr("p.b = b.node")).where(_plausible("a", "b")).select(F.col("p.a").alias("a"), F.col("p.b").alias("b"))


def deduplicated(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that ``groups`` keeps, with all their columns, whatever their names. Rows are told apart by id
    and text: of rows that share an id, each goes or stays by its own text; null ids and null texts are values too."""
    found = _grouped(df, text_col, id_col)
    gone = _few(common.staged(found.where("not kept").select("doc_id", "t1", "t2").distinct(), "minhash-gone"))
    common.drop(*found.made_of)
    text = F.col(f"d.`{text_col}`").cast("string")
    same = (F.col(f"d.`{id_col}`").eqNullSafe(F.col("g.doc_id"))) & (F.xxhash64(text) == F.col("g.t1")) & (F.xxhash64(F.lit(1), text.isNull(), text) == F.col("g.t2"))
    return df.alias("d").join(gone.alias("g"), same, "left_anti")
