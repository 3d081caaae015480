"""Filter interaction audit: what each filter of an ordered chain removes, alone, first or after others.

Copies are found by sorting: rows are dealt in ranges of text fingerprint and id and sorted by fingerprint, full text and
id, so a copy's predecessor is the row before it, and a text that half of all rows share is spread over many tasks. Only
the first id of a text at the head of a range depends on earlier ranges; it waits for the boundaries, of which each range
has a few. Failures become a mask of five bits, masks become counters by part, and counters answer all orders.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import common

#: The filters' letters in the order of their bits, and their bounds.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, SIGNS = 200, 50, 3, b"#$%&*|"
COPY = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]

#: Bytes that begin no code point, and bytes that are no capital of ASCII.
_FOLLOWING, _NOT_CAPITAL = bytes(range(0x80, 0xC0)), bytes(b for b in range(256) if not 65 <= b <= 90)


def failures(text: bytes) -> int:
    """The bits of the filters but that for copies that a text in UTF-8 fails. Words lie between ASCII white space."""
    words = text.split()
    n, points = len(words), len(text.translate(None, _FOLLOWING))
    capitals = len(text.translate(None, _NOT_CAPITAL))
    found = (n < LEAST_WORDS) | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * n) << 1
    found |= (100 * capitals > MOST_CAPITALS_PERCENT * points) << 2
    return found | (len(text.translate(None, SIGNS)) < len(text)) << 3


def _judged(id_type: T.DataType):
    """Over a sorted range: rows (doc_id, part, mask), and for each text of the range's first and last fingerprint one
    edge row. A row that waits for earlier ranges has its text's digest."""
    schema = T.StructType([T.StructField("doc_id", id_type)]).add("part", "string").add("mask", "integer").add("range", "integer").add("fp", "long").add("digest", "binary").add("edge", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        text: bytes | None = None
        fp = head = None
        first = None  # the text's first id
        digest = b""  # of the text, while the range's first fingerprint lasts
        last: list[bytes] = []  # digests of the texts of the last fingerprint

        def edges(fp: int, digests: list[bytes]) -> pa.RecordBatch:
            n = len(digests)
            return common.batch(schema, [[None] * n, [None] * n, [0] * n, [here] * n, [fp] * n, digests, [True] * n])

        for batch in batches:
            ids, fps, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).cast(pa.binary())
            masks, waits = np.zeros(len(ids), np.int32), [None] * len(ids)
            mask = 0
            for i, (id_, f) in enumerate(zip(ids, fps)):
                now = texts[i].as_py()
                if f != fp:
                    if last and head == fp:
                        yield edges(fp, last)
                    head = f if head is None else head
                    fp, last, text = f, [], None
                if now != text:
                    text, first, mask = now, id_, failures(now)
                    digest = hashlib.sha256(now).digest()
                    last.append(digest)
                masks[i] = mask
                if id_ is not None and first is not None:
                    if id_ > first:
                        masks[i] |= COPY
                    elif f == head:
                        waits[i] = digest
            n = len(ids)
            yield common.batch(schema, [batch.column(0), batch.column(1), pa.array(masks), [here] * n, fps, waits, [False] * n])
        if last:
            yield edges(fp, last)
        common.trim()

    return run, schema


def masks(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask), one for each row: bit k is set where the row fails filter k.

    A null text is empty, a null part the empty string. A copy is a row whose text some smaller id has; a null id is
    neither smaller nor larger, and repeated rows of one id are no copies of one another. Words are split at ASCII white
    space, whole texts are judged, and an empty table has no rows.
    """
    part, text = F.coalesce(F.col(part_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), part.alias("part"), F.xxhash64(text).alias("fp"), text.alias("text"))
    # ranges are cut by columns of fixed width: what is sampled for them holds no text
    dealt = rows.repartitionByRange(common.shuffle_partitions(df.sparkSession), F.col("fp"), F.col("doc_id").asc_nulls_last()).sortWithinPartitions("fp", "text", F.col("doc_id").asc_nulls_last())
    common.bound_batches(df.sparkSession)
    run, schema = _judged(rows.schema["doc_id"].dataType)
    found = common.staged(dealt.mapInArrow(run, schema), "audit-rows")
    # a text goes on where an earlier range holds it too; a range has as many edges as its outer fingerprints have texts
    edges = found.where("edge").select("fp", "digest", "range").groupBy("fp", "digest").agg(F.min("range").alias("since"))
    waiting = found.where("not edge and digest is not null").join(edges, ["fp", "digest"], "left")
    settled = waiting.select("doc_id", "part", F.when(F.col("since") < F.col("range"), F.col("mask").bitwiseOR(F.lit(COPY))).otherwise(F.col("mask")).alias("mask"))
    return found.where("not edge and digest is null").select("doc_id", "part", "mask").unionAll(settled)


def counters(masked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): additive, so that counters of shares of a corpus can be summed. ``labels`` may have
    several rows of an id: one that says so is enough; null ids have no labels."""
    said = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = masked.where("doc_id is not null").join(said, F.col("doc_id") == F.col("_id"), "left").select("part", "mask", "good", "toxic")
    every = known.unionAll(masked.where("doc_id is null").select("part", "mask", F.lit(None).cast("int"), F.lit(None).cast("int")))
    return every.groupBy("part", "mask").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def orders(counted: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step, from counters that are merged here."""
    merged = counted.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    cells = merged.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    steps = cells.select("part", "cells", F.explode(F.lit(ORDERS)).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    steps = steps.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1))).withColumn("own", F.expr(f"shiftleft(1, ascii(filter) - {ord('A')})"))
    steps = steps.withColumn("before", F.expr(f"aggregate(slice(split(filter_order, ''), 1, step - 1), 0, (s, x) -> s + shiftleft(1, ascii(x) - {ord('A')}))"))

    def total(which, value: str = "n", times=lambda c: F.lit(1)) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(which(c["mask"]), c[value] * times(c)).otherwise(0))

    own, prior = F.col("own"), F.col("before")
    failing = lambda m: m.bitwiseAND(own) != 0
    removed = lambda m: failing(m) & (m.bitwiseAND(prior) == 0)
    # of a mask's k filters each comes first in one of k orders
    share = lambda c: (F.lit(len(ORDERS)) / F.bit_count(c["mask"])).cast("long")
    return steps.select(
        "part",
        "filter_order",
        "step",
        "filter",
        total(lambda m: m.bitwiseAND(own.bitwiseOR(prior)) == 0).alias("kept"),
        total(removed).alias("removed"),
        total(lambda m: failing(m) & (m.bitwiseAND(prior) != 0)).alias("redundant"),
        total(lambda m: m == own).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        total(failing, "n", share).alias("shapley"),
    )


def report(df: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "lang") -> DataFrame:
    """``orders`` of the counters of ``masks``: 600 rows for each part, none for an empty table. Extra columns of either
    table are not looked at."""
    return orders(counters(masks(df, text_col, id_col, part_col), labels.select(F.col(id_col).alias("doc_id"), "quality", "toxic")))
