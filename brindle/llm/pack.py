"""Packing token sequences as a cutting-stock problem solved by column generation.

A document is cut into full sequences and one remainder. Remainders are counted by length bin; a linear program over
patterns (how many remainders of each bin share a sequence) has its columns priced by a knapsack over the bins, so it
sees a histogram of bounded size, however many documents there are. The rounded patterns are then dealt to the
documents by their rank within the bin.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import bpe, common

CAPACITY, BIN, END_ID = 2048, 8, 1
#: Documents to a bucket, about; ranks are counted within buckets and offset by the buckets before.
BUCKET = 50_000
#: Buckets at most, so that what is summed over them in one place and broadcast has a bound; documents to a bucket are
#: more beyond 200 million, and are sorted on disk where memory ends.
MAX_BUCKETS = 4096


def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best pattern for the values by dynamic programming (unbounded knapsack): its value and counts."""
    use = np.flatnonzero(values > 1e-12)
    v, s = values[use], sizes[use]
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(s, kind="stable")
    v, s, use = v[order], s[order], use[order]
    fit = np.searchsorted(s, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fit[c]:
            gain = best[c - s[:k]] + v[:k]
            i = int(gain.argmax())
            if gain[i] > best[c] + 1e-12:
                best[c], choice[c] = gain[i], i
    counts, c = np.zeros(len(values), np.int64), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[use[choice[c]]] += 1
            c -= int(s[choice[c]])
    return float(best[capacity]), counts


def inverted(a: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with partial pivoting; small enough to do without a linear algebra library and its threads."""
    m = len(a)
    work = np.hstack([a, np.eye(m)])
    for i in range(m):
        p = i + int(np.abs(work[i:, i]).argmax())
        work[[i, p]] = work[[p, i]]
        work[i] /= work[i, i]
        factor = work[:, i].copy()
        factor[i] = 0
        work -= factor[:, None] * work[i]
    return work[:, m:]


def first_basis(demand: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A greedy packing as a basis: each pattern takes the largest sizes that still fit and is used until one of them is
    exhausted; that size is its row. Later patterns hold no exhausted size, so the basis is triangular but for order."""
    left, m = demand.astype(float), len(sizes)
    columns, x = np.diag(capacity // sizes).astype(float), np.zeros(m)
    open_ = left > 0
    while open_.any():
        pattern, room = np.zeros(m), capacity
        for i in np.flatnonzero(open_)[::-1]:
            if n := int(min(room // sizes[i], max(1, left[i]))):
                pattern[i] = n
                room -= n * int(sizes[i])
        use = np.flatnonzero(pattern)
        times = left[use] / pattern[use]
        r = int(use[times.argmin()])
        columns[:, r], x[r] = pattern, times.min()
        left = np.maximum(left - pattern * times.min(), 0)
        open_[r] = False
        open_ &= left > 1e-9  # an exhausted size without a pattern of its own keeps the plain one, unused
    return columns, x


def generate(demand: np.ndarray, sizes: np.ndarray, capacity: int, gap: float = 2e-3, rounds: int = 5000) -> list[tuple[np.ndarray, float]]:
    """Patterns (counts by size) and how often, of the cutting-stock relaxation, by revised simplex with pricing. Stops
    at the optimum, or where the bound by the best price, or by the tokens alone, proves it within ``gap``."""
    m = len(sizes)
    if not m:
        return []
    columns, x = first_basis(demand, sizes, capacity)
    inverse = inverted(columns)
    least = float(demand @ sizes) / capacity  # no packing has fewer sequences
    for k in range(rounds):
        if x.sum() <= least * (1 + gap):
            break
        duals = inverse.sum(0)
        value, pattern = price(duals, sizes, capacity)
        if value <= 1 + max(1e-9, gap):
            break
        d = (inverse * pattern).sum(1)  # small; no threads of a linear algebra library
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        r = int(ratio.argmin())
        x = np.maximum(x - ratio[r] * d, 0)
        x[r] = ratio[r]
        columns[:, r] = pattern
        row = inverse[r] / d[r]
        inverse -= np.outer(d, row)
        inverse[r] = row
        if k % 200 == 199:  # rounding errors do not pile up
            inverse = inverted(columns)
            x = np.maximum((inverse * demand).sum(1), 0)
    return [(columns[:, i].astype(np.int64), float(x[i])) for i in range(m)]


def best_fit(counts: np.ndarray, sizes: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns for what is left after rounding: largest first, each where it fits most tightly."""
    room: list[list[np.ndarray]] = [[] for _ in range(capacity + 1)]
    out = []
    for i in np.argsort(-sizes, kind="stable"):
        for _ in range(int(counts[i])):
            free = next((f for f in range(int(sizes[i]), capacity + 1) if room[f]), None)
            if free is None:
                pattern = np.zeros(len(sizes), np.int64)
                out.append(pattern)
                free = capacity
            else:
                pattern = room[free].pop()
            pattern[i] += 1
            room[free - int(sizes[i])].append(pattern)
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, bin_: int = BIN) -> list[tuple[dict[int, int], int]]:
    """(pattern: remainders by bin, times) for remainders counted by bin. All of them find a place."""
    bins = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[b] for b in bins.tolist()], np.int64)
    out: list[tuple[np.ndarray, int]] = []
    left = demand.copy()
    for pattern, x in sorted(generate(demand.astype(float), bins, capacity // bin_), key=lambda p: -p[1]):
        times = int(x + 1e-6)
        if times and pattern.any():
            out.append((np.minimum(pattern, left), times)) if times == 1 else out.append((pattern, times))
            left = np.maximum(left - out[-1][0] * times, 0)
    out += [(p, 1) for p in best_fit(left, bins, capacity // bin_)]
    return [({int(b): int(c) for b, c in zip(bins, p) if c}, n) for p, n in out if p.any()]


def tokenised(df: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Rows (doc_id, doc_tokens, crcs): ids of each whole text and one end id, and the CRC-32 of each piece of
    ``capacity`` ids and of the rest. A null text has the end id alone."""
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("doc_tokens", T.LongType()), T.StructField("crcs", T.ArrayType(T.LongType()))])
    end = np.array([END_ID], "<u4").tobytes()

    def run(batch):
        model = bpe.load(path)
        n, crcs = [], []
        for some in bpe.chunks(batch.column(1).to_pylist()):
            for ids in model.encode(some):
                ids += end
                n.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[i : i + 4 * capacity]) for i in range(0, len(ids), 4 * capacity)])
        return common.batch(schema, [batch.column(0), n, crcs])

    return common.map_batches(common.ids_and_texts(df, id_col, text_col), run, schema)


def packed(df: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Full pieces are sequences of their own; remainders share sequences by the plan. Sequence ids count from 0 without
    gaps but for planned sequences that stay empty. Repeated rows, also of one id, are documents of their own. A null or
    empty text has the end id alone, a null id stays null, extra columns are not read, an empty table gives no rows.
    Ids are those of the library with ``add_special_tokens=False``: added tokens in a text have ids of their own.
    """
    docs = common.staged(tokenised(df, path, text_col, id_col, capacity), "pack-docs")
    total = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.floor(F.col("doc_tokens") / capacity)), F.lit(0)).cast("long").alias("full")).first()
    buckets = min(MAX_BUCKETS, max(8, -(-total["n"] // BUCKET)))
    rest = F.col("doc_tokens") % capacity
    order = F.struct("doc_id", "doc_tokens", "crcs")
    docs = docs.withColumn("rest", rest).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "crcs"), F.lit(buckets)))

    full = docs.where(F.col("doc_tokens") >= capacity).withColumn("k", F.floor(F.col("doc_tokens") / capacity))
    before = full.groupBy("bucket").agg(F.sum("k").alias("k")).select("bucket", F.sum("k").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)).alias("base"))
    running = F.sum("k").over(Window.partitionBy("bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    full = full.withColumn("first", F.coalesce(running, F.lit(0))).join(F.broadcast(before), "bucket")
    full = full.select("doc_id", "doc_tokens", "first", F.coalesce("base", F.lit(0)).alias("base"), F.posexplode(F.slice("crcs", F.lit(1), F.col("k").cast("int"))).alias("i", "crc"))
    full = full.select("doc_id", (F.col("i").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", (F.col("base") + F.col("first") + F.col("i")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    rests = docs.where("rest > 0").withColumn("bin", F.ceil(F.col("rest") / BIN).cast("int"))
    counts = common.staged(rests.groupBy("bin", "bucket").agg(F.count("*").alias("n")), "pack-counts")
    histogram = {r["bin"]: r["n"] for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect()}  # at most capacity / BIN rows
    patterns = plan(histogram, capacity)
    # for each bin, the ranks that each pattern takes
    ranges: dict[int, list[tuple[int, int, int]]] = {}
    taken = dict.fromkeys(histogram, 0)
    sequence = int(total["full"])
    for pattern, times in patterns:
        for b, a in pattern.items():
            ranges.setdefault(b, []).append((taken[b], a, sequence))
            taken[b] += a * times
        sequence += times
    arrays = {b: np.array(r, np.int64).T for b, r in ranges.items()}

    base = counts.select("bin", "bucket", F.coalesce(F.sum("n").over(Window.partitionBy("bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    ranked = rests.withColumn("rank", F.row_number().over(Window.partitionBy("bin", "bucket").orderBy(order)).cast("long") - 1)
    ranked = ranked.join(base, ["bin", "bucket"]).select("doc_id", "doc_tokens", "rest", F.element_at("crcs", -1).alias("crc"), "bin", (F.col("rank") + F.col("base")).alias("rank"))
    id_field = T.StructField("doc_id", df.schema[id_col].dataType)
    schema = T.StructType([id_field, *(T.StructField(c, T.LongType()) for c in ("doc_tokens", "rest", "crc", "sequence_id", "slot"))])

    def deal(batch):
        bins, ranks = batch.column(4).to_numpy(), batch.column(5).to_numpy()
        sequences, slots = np.empty(len(bins), np.int64), np.empty(len(bins), np.int64)
        for b in np.unique(bins).tolist():
            mine = np.flatnonzero(bins == b)
            start, each, first = arrays[b]
            i = np.searchsorted(start, ranks[mine], side="right") - 1
            inside = ranks[mine] - start[i]
            sequences[mine], slots[mine] = first[i] + inside // each[i], (capacity - b) * capacity + inside % each[i]
        return common.batch(schema, [*(batch.column(k) for k in range(4)), sequences, slots])

    dealt = common.map_batches(ranked, deal, schema)
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("offset", F.coalesce(F.sum("rest").over(ahead), F.lit(0)))
    dealt = dealt.select("doc_id", (F.col("doc_tokens") - F.col("rest")).alias("start"), F.col("rest").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    return full.unionAll(dealt)
