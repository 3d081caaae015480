"""Importance resampling towards a target: hashed n-gram counts of the corpus and of the target give each bucket a gain,
a document's weight is the sum over its features, and Gumbel noise draws without replacement.

DuckDB, one connection a task, splits texts, makes n-grams by windows and hashes them by a registered CRC function; each
document's bucket counts, and each task's sums of them, are written as Parquet. Spark merges the sums, scores the
documents from their own counts, so that no text is read twice, and ranks them by ranges.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import common

#: Buckets, words of a feature at most, words that a document needs to be drawn, the share drawn in percent, the seed.
BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Characters that DuckDB gets at once; a longer text goes in pieces, each with the words that its last features need.
PIECE = 1 << 21
_SPLIT, _NEXT = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"), re.compile(rf"(?:[\x00-\x2F\x3A-\x60\x7B-\x7F]*{WORD}){{0,{LONGEST - 1}}}")
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})

#: Buckets of the features of pieces (row, text, extra): the last ``extra`` words begin no feature of theirs.
SQL = f"""WITH l AS (SELECT row, extra, regexp_extract_all(text, '{WORD}') AS l FROM pieces),
w AS (SELECT row, len(l) - extra AS own, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM l),
n AS (SELECT row, i <= own AS own, w AS a, lead(w) OVER d AS b, lead(w, 2) OVER d AS c FROM w WINDOW d AS (PARTITION BY row ORDER BY i)),
f AS (SELECT row, unnest([a, a || ' ' || b, a || ' ' || b || ' ' || c]) AS feature FROM n WHERE own)
SELECT row, CAST(crc32(feature) % {BUCKETS} AS INTEGER) AS bucket FROM f WHERE feature IS NOT NULL"""
WORDS_SQL = f"SELECT len(regexp_extract_all(text, '{WORD}')) - extra AS n FROM pieces ORDER BY row"


def crc32(features: pa.ChunkedArray | pa.Array) -> pa.Array:
    """zlib's CRC of each string's UTF-8 bytes."""
    some = features.combine_chunks() if isinstance(features, pa.ChunkedArray) else features
    return pa.array(np.fromiter(map(zlib.crc32, some.cast(pa.binary()).to_numpy(zero_copy_only=False)), np.uint32, len(some)))


def connect():
    """A DuckDB that keeps to one core and to memory: pieces are bounded, so nothing has to be spilled locally."""
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "800MB", "temp_directory": ""})
    con.create_function("crc32", crc32, ["VARCHAR"], "UINTEGER", type="arrow")
    return con


def pieces(text: str, size: int = PIECE) -> Iterator[tuple[str, int]]:
    """(piece, words at its end that belong to the next one); cut where no word is."""
    at = 0
    while len(text) - at > size:
        end = _SPLIT.search(text, at + size)
        if not end:
            break
        after = _NEXT.match(text, end.start()).end()
        yield text[at:after], len(re.findall(WORD, text[end.start() : after]))
        at = end.start()
    yield text[at:], 0


def counted(con, texts: list[str | None], size: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, buckets, counts) of each text; a null one has none."""
    todo: list[tuple[int, str, int]] = []
    held = 0
    found: dict[int, list] = {}

    def flush() -> None:
        nonlocal todo, held
        table = pa.table([pa.array(range(len(todo)), pa.int32()), pa.array([p[1] for p in todo], pa.string()), pa.array([p[2] for p in todo], pa.int32())], names=["row", "text", "extra"])
        con.register("pieces", table)
        n_words, flat = con.sql(WORDS_SQL).to_arrow_table()["n"].to_pylist(), con.sql(SQL).to_arrow_table()
        con.unregister("pieces")
        cells, n = np.unique(flat["row"].to_numpy().astype(np.int64) * BUCKETS + flat["bucket"].to_numpy(), return_counts=True)
        ends = np.searchsorted(cells, np.arange(len(todo) + 1) * BUCKETS)
        for (owner, _, _), words, a, b in zip(todo, n_words, ends, ends[1:]):
            found.setdefault(owner, []).append((words, cells[a:b] % BUCKETS, n[a:b]))
        todo, held = [], 0

    for i, text in enumerate(texts):
        for piece, extra in pieces((text or "").translate(_LOWER), size):
            if todo and held + len(piece) > size:
                flush()
            todo.append((i, piece, extra))
            held += len(piece)
    if todo:
        flush()
    for i in range(len(texts)):
        parts = found.pop(i)
        words, buckets, counts = parts[0]
        if len(parts) > 1:
            words = sum(p[0] for p in parts)
            sums = np.bincount(np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]), BUCKETS).astype(np.int64)
            buckets = np.flatnonzero(sums)
            counts = sums[buckets]
        yield words, buckets, counts


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)).cast(kind))


def features(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Written as Parquet: a row (doc_id, n_words, n_features, buckets, counts) for each row of ``df``, and a row for each
    task with the sums of its counts in ``sums``."""
    rows = common.ids_and_texts(df, id_col, text_col)
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()), T.StructField("buckets", T.ArrayType(T.ShortType())), T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("sums", T.ArrayType(T.LongType()))])
    common.bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, con = np.zeros(BUCKETS, np.int64), connect()
        for batch in batches:
            found = list(counted(con, batch.column(1).to_pylist()))
            if not found:
                continue
            buckets, counts = _lists([f[1] for f in found], pa.int16()), _lists([f[2] for f in found], pa.int32())
            each, ends = counts.values.to_numpy().astype(np.int64), counts.offsets.to_numpy()
            sums += np.bincount(buckets.values.to_numpy(), each, BUCKETS).astype(np.int64)
            running = np.concatenate([[0], np.cumsum(each)])
            yield common.batch(schema, [batch.column(0), [f[0] for f in found], pa.array(running[ends[1:]] - running[ends[:-1]]), buckets, counts, pa.nulls(len(found), pa.list_(pa.int64()))])
        con.close()
        if sums.any():
            yield common.batch(schema, [[None], [None], [None], [None], [None], [sums.tolist()]])
        common.trim()

    return common.staged(rows.mapInArrow(run, schema), "resample-features")


def merged(found: DataFrame) -> dict[int, int]:
    """Bucket -> count over all tasks: at most ``BUCKETS`` rows reach the driver."""
    sums = found.where("sums is not null").select(F.posexplode("sums").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r["bucket"]: r["n"] for r in sums.collect()}


def gains(corpus: dict[int, int], target: dict[int, int]) -> np.ndarray:
    """Each bucket's gain: the logarithm of its share in the target over that in the corpus, in thousandths, rounded down."""
    s_all, t_all = sum(corpus.values()), sum(target.values())
    s = np.array([corpus.get(k, 0) for k in range(BUCKETS)])
    t = np.array([target.get(k, 0) for k in range(BUCKETS)])
    return np.floor(1000 * np.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS)))).astype(np.int64)


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight)."""
    rows = found.where("sums is null").select("doc_id", "n_words", "n_features", "buckets", "counts")
    schema = T.StructType([*(f for f in rows.schema if f.name in ("doc_id", "n_words", "n_features")), T.StructField("weight", T.LongType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        buckets, counts = batch.column(3), batch.column(4)
        each = gain[buckets.flatten().to_numpy()] * counts.flatten().to_numpy().astype(np.int64)
        running = np.concatenate([[0], np.cumsum(each)])
        ends = np.cumsum([0, *(n or 0 for n in buckets.value_lengths().to_pylist())])
        return common.batch(schema, [batch.column(0), batch.column(1), batch.column(2), pa.array(running[ends[1:]] - running[ends[:-1]])])

    return common.map_batches(rows, run, schema)


def ranked(df: DataFrame, keys: list, out: str) -> DataFrame:
    """Rows with their place from 1 in the order of ``keys``: ranges are sorted each for itself, and a place is the one in
    the range behind all rows of earlier ranges. The driver sees one count a range."""
    spark = df.sparkSession
    ordered = df.repartitionByRange(common.shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    placed = common.staged(ordered.withColumn("_at", F.monotonically_increasing_id()), "resample-ranked")
    width = 33  # fixed value: bits of the row's number in its partition
    sizes = {r["range"]: r["n"] for r in placed.groupBy(F.shiftright("_at", width).cast("int").alias("range")).agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(k, 0)
    before = spark.createDataFrame(list(enumerate(starts)), "_range int, _before long")
    inside = F.col("_at").bitwiseAND(F.lit((1 << width) - 1))
    both = placed.join(F.broadcast(before), F.shiftright("_at", width).cast("int") == F.col("_range"))  # a row a range
    return both.select(*df.columns, (F.col("_before") + inside + 1).alias(out))


def resample(df: DataFrame, target: DataFrame, text_col: str = "text", id_col: str = "doc_id", target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one for each row; rank counts the drawn rows from the best score on.

    Null and empty texts have no features and weight 0. Rows with fewer than ``least_words`` words are never drawn; of the
    others ``percent`` in a hundred are, rounded down. A null id counts as an empty one and comes last among equal scores;
    repeated rows are rows of their own. An empty table gives no rows; an empty target makes all of its counts 0. Extra
    columns are not looked at.
    """
    found = features(df, text_col, id_col)
    wanted = features(target.withColumn("_row", F.lit(0)), target_text, "_row")
    gain = gains(merged(found), merged(wanted))
    common.drop(wanted)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    rows = weighted(found, gain).withColumn("score", F.col("weight") + noise)
    rows = common.staged(rows, "resample-scores")
    common.drop(found)
    able = rows.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    places = ranked(able.drop("n_words"), [F.desc("score"), F.col("doc_id").asc_nulls_last()], "rank")
    rest = rows.where(F.col("n_words") < least_words)
    return places.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(rest.drop("n_words").withColumn("rank", F.lit(None).cast("long")))
