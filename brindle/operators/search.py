"""Hybrid search: cosine over vectors and trigram similarity over text, fused."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions import shared
from brindle.functions import text as t

#: Weights, candidates of each branch, results, least trigram similarity, vector length.
SEMANTIC, LEXICAL = 0.7, 0.3
CANDIDATES, TOP_K, LEAST, DIM = 50, 10, 0.3, 1024


def hashed_vector(text: str, dim: int = DIM) -> list[float]:
    """Deterministic stand-in for an embedding model: signed hashes of words and trigrams, unit length."""
    v = np.zeros(dim)
    for w in text.lower().split():
        for g in [w, *(w[i : i + 3] for i in range(len(w) - 2))]:
            h = int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "little")
            v[h % dim] += 1 if h >> 63 else -1
    n = np.linalg.norm(v)
    return (v / n if n else v).tolist()


def hashed_vectors(texts: list[str]) -> list[list[float]]:
    return [hashed_vector(x) for x in texts]


def embed(df: DataFrame, column: str, out: str, embedder=hashed_vectors) -> DataFrame:
    """Adds a vector column; null text counts as empty. ``embedder`` takes a batch of texts and gives their vectors; it is
    loaded once a worker."""

    @F.pandas_udf("array<float>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(list(embedder(s.fillna("").tolist())), index=s.index, dtype=object)

    return df.withColumn(out, run(F.col(column)))


def semantic(df: DataFrame, vector: str, query: list[float] | Column, key: str, n: int = CANDIDATES) -> DataFrame:
    q = query if isinstance(query, Column) else F.array(*map(F.lit, query))
    return df.where(F.col(vector).isNotNull()).select(key, t.cosine(F.col(vector), q).alias("semantic")).orderBy(F.desc("semantic"), key).limit(n)


def question_grams(spark: SparkSession, query: str) -> list[str]:
    """Trigrams of a question, computed once."""
    return spark.range(1).select(t.trigrams(F.lit(query)).alias("g")).first()["g"]


def _spread(df: DataFrame) -> DataFrame:
    """A small table of long texts may be one row group, which is one task: its rows are dealt to all cores. Larger tables
    have tasks enough and are not moved."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    small = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < cores * (128 << 20)
    return df.repartition(cores) if small else df


def lexical(df: DataFrame, text: str, query: str, key: str, n: int = CANDIDATES, least: float = LEAST, keep: tuple[str, ...] = ()) -> DataFrame:
    """key, lexical and the columns ``keep`` of the best, whole texts compared."""
    wanted = F.lit(question_grams(df.sparkSession, query)).cast("array<string>")
    rows = _spread(df.select(key, F.col(text).alias("_text"), *(F.col(c).alias(f"_{c}") for c in keep)))
    score = t.trigram_similarity(t.trigrams(F.col("_text")), wanted)
    found = rows.select(key, score.alias("lexical"), *(F.col(f"_{c}").alias(c) for c in keep)).where(F.col("lexical") >= least)
    return found.orderBy(F.desc("lexical"), key).limit(n)


def hybrid(df: DataFrame, query: str, vector_query: list[float] | Column, key: str, text: str, vector: str, top_k: int = TOP_K, where: Column | None = None, vectors: DataFrame | None = None) -> DataFrame:
    """key, text, score of the best: filter first, two bounded candidate sets, one outer join, weighted sum, and the texts
    of the ``top_k`` last. Where the vectors are in a table of their own, ``vectors`` has them by the same key; only rows
    that both tables have are looked at then, and each table is scored alone."""
    some = df.where(where) if where is not None else df
    near, texts = some, some
    if vectors is not None:
        near = vectors.select(key, vector).join(some.select(key), key, "left_semi")
        texts = some.select(key, text).join(vectors.select(key), key, "left_semi")
    both = semantic(near, vector, vector_query, key).join(lexical(texts, text, query, key), key, "full_outer")
    score = F.coalesce("semantic", F.lit(0.0)) * SEMANTIC + F.coalesce("lexical", F.lit(0.0)) * LEXICAL
    best = both.select(key, score.alias("score")).orderBy(F.desc("score"), key).limit(top_k)
    # top_k rows: broadcast whatever the table
    return df.select(key, text).join(F.broadcast(best), key).orderBy(F.desc("score"), key).limit(top_k)


# Indexes: the same results as the scans above, from tables laid out so that a search reads a part of them.

#: Cells of a vector index: the square root of the number of rows, at least and, by the centres' components, which go to every
#: task, at most.
CELLS, CENTRE_NUMBERS, SLACK = 64, 4_000_000, 1e-6


def write_lexical_index(df: DataFrame, text: str, key: str, path: str) -> None:
    """Three tables: ``rows`` with each row's trigrams, by row number; ``postings``, a row for each trigram of a row, in order
    of trigram and number of trigrams, so that a search reads the pages of its trigrams and lengths only; and ``grams`` with
    the length of each list. A trigram that very many rows have is spread over files."""
    spark = df.sparkSession
    texts = shared.spread(df.select(F.col(key).alias("key"), F.col(text).alias("text")))
    found = texts.select("key", F.coalesce(t.trigrams(F.col("text")), F.array().cast("array<string>")).alias("grams"))
    found.withColumn("row", F.monotonically_increasing_id()).select("row", "key", F.size("grams").alias("n"), "grams").write.option("parquet.block.size", 1 << 22).parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    postings = rows.select(F.explode("grams").alias("gram"), "n", "row").repartitionByRange("gram", "n", "row").sortWithinPartitions("gram", "n", "row")
    postings.write.option("parquet.block.size", 1 << 22).option("parquet.page.size", 1 << 16).parquet(f"{path}/postings")
    spark.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count("*").alias("n")).repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/grams")


@dataclass
class Probe:
    """How a question is answered from the index: the trigrams whose lists are read, and what follows for the rest."""

    grams: list[str]  # of the question
    lists: list[str]  # the rarest of them
    least_n: int
    most_n: int
    least: float
    listed: int  # rows that the lists have
    all_listed: int  # rows that the lists of all the question's trigrams have

    def needed(self, n: Column) -> Column:
        """Trigrams that a row with ``n`` of them shares, if it reaches the least similarity."""
        return F.ceil(F.lit(self.least) * (n + len(self.grams)) / (1 + self.least) - 1e-9)

    def hits(self, n: Column) -> Column:
        """Of these, those among the lists read: all but what the unread ones could give."""
        return F.greatest(F.lit(1), self.needed(n) - (len(self.grams) - len(self.lists)))


def lexical_probe(spark: SparkSession, path: str, query: str, least: float = LEAST) -> Probe:
    """A row that reaches ``least`` shares at least ``need`` of the question's q trigrams, so it is in one of the lists of any
    q - need + 1 of them: the rarest ones. Further lists are read as long as they add no more than half of that, since each
    of them raises by one the hits that a candidate needs."""
    if least <= 0:
        raise ValueError("without a least similarity every row is a result: use lexical")
    grams = question_grams(spark, query)
    sizes = dict.fromkeys(grams, 0) | {r["gram"]: r["n"] for r in spark.read.parquet(f"{path}/grams").where(F.col("gram").isin(grams)).collect()}  # a row a trigram of the question
    order = sorted(grams, key=lambda g: (sizes[g], g))
    need = max(1, math.ceil(least * len(grams) - 1e-9))
    take = len(grams) - need + 1
    bound = 1.5 * sum(sizes[g] for g in order[:take])
    while take < len(order) and sum(sizes[g] for g in order[: take + 1]) <= bound:
        take += 1
    return Probe(grams, order[:take], math.ceil(least * len(grams) - 1e-9), math.floor(len(grams) / least + 1e-9), least, sum(sizes[g] for g in order[:take]), sum(sizes.values()))


#: Candidates up to which rows are looked up by a filter that reaches the pages; beyond, they are joined.
LOOKED_UP = 2_000


def lexical_indexed(spark: SparkSession, path: str, query: str, key: str, n: int = CANDIDATES, least: float = LEAST) -> DataFrame:
    """``lexical`` from an index, exactly: lists of the rarest trigrams give candidates by the number of hits that their
    length asks for, and the candidates' own trigrams decide."""
    probe = lexical_probe(spark, path, query, least)
    rows = spark.read.parquet(f"{path}/rows")
    if not probe.grams:
        return rows.where("false").select(F.col("key").alias(key), F.lit(0.0).alias("lexical"))
    listed = spark.read.parquet(f"{path}/postings").where(F.col("gram").isin(probe.lists) & F.col("n").between(probe.least_n, probe.most_n))
    candidates = listed.groupBy("row").agg(F.count("*").alias("hits"), F.first("n").alias("n")).where(F.col("hits") >= probe.hits(F.col("n"))).select("row")
    few = [r["row"] for r in candidates.limit(LOOKED_UP + 1).collect()]
    own = rows.where(F.col("row").isin(few)) if len(few) <= LOOKED_UP else rows.join(candidates, "row", "left_semi")
    score = t.trigram_similarity(F.col("grams"), F.lit(probe.grams).cast("array<string>"))
    return own.select(F.col("key").alias(key), score.alias("lexical")).where(F.col("lexical") >= least).orderBy(F.desc("lexical"), key).limit(n)


def _placed(centres: np.ndarray):
    """Of vectors: the nearest centre and the distance to it, both on the unit sphere; cell -1 where there is no direction."""

    @F.pandas_udf("cell int, distance double")
    def run(s: pd.Series) -> pd.DataFrame:
        cells, distances = np.full(len(s), -1, np.int32), np.zeros(len(s))
        for i, v in enumerate(s):
            x = np.asarray(v, float) if v is not None else np.zeros(0)
            if len(x) == centres.shape[1] and np.isfinite(norm := np.linalg.norm(x)) and norm > 0:
                squares = 2 - 2 * (centres @ (x / norm))
                cells[i] = squares.argmin()
                distances[i] = np.sqrt(max(0.0, squares[cells[i]]))
        return pd.DataFrame({"cell": cells, "distance": distances})

    return run


def cells_for(rows: int, dim: int) -> int:
    return min(max(CELLS, math.isqrt(rows)), max(CELLS, CENTRE_NUMBERS // max(1, dim)))


def write_vector_index(df: DataFrame, vector: str, key: str, path: str, cells: int | None = None) -> None:
    """Rows with a vector, a folder a cell; and each cell's centre, radius and number of rows. Centres are rows, picked by
    a hash of the key: they set what a search reads, not what it finds."""
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    if cells is None:
        size = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first()
        cells = cells_for(size["n"], size["d"] or 0)
    picked = [np.array(r["vector"]) for r in rows.orderBy(F.xxhash64("key"), "key").limit(cells).collect() if None not in r["vector"]]
    usable = [v / np.linalg.norm(v) for v in picked if np.isfinite(v).all() and v.any() and len(v) == len(picked[0])]
    centres = np.array(usable) if usable else np.zeros((0, 0))
    placed = rows.withColumn("p", _placed(centres)("vector")) if usable else rows.withColumn("p", F.struct(F.lit(-1).alias("cell"), F.lit(0.0).alias("distance")))
    placed = placed.select("key", "vector", "p.distance", "p.cell")
    placed.write.partitionBy("cell").parquet(f"{path}/rows")
    sizes = rows.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows").groupBy("cell").agg(F.max("distance").alias("radius"), F.count("*").alias("n")).collect()  # a row a cell
    found = [(r["cell"], centres[r["cell"]].tolist() if r["cell"] >= 0 else None, r["radius"], r["n"]) for r in sizes]
    rows.sparkSession.createDataFrame(found, "cell int, centre array<double>, radius double, n long").coalesce(1).write.parquet(f"{path}/cells")


def semantic_indexed(spark: SparkSession, path: str, query: list[float], key: str, n: int = CANDIDATES) -> DataFrame:
    """``semantic`` from an index, exactly: the nearest cells that hold ``n`` rows give a bound, and a cell is read beyond
    them only where its radius lets it hold a row within the bound. Vectors without a direction are always read."""
    q = np.asarray(query, float)
    q = q / np.linalg.norm(q)
    cells = [(r["cell"], max(0.0, float(np.linalg.norm(q - np.array(r["centre"]))) - r["radius"]) if r["centre"] else 0.0, r["n"]) for r in spark.read.parquet(f"{path}/cells").collect()]
    if not cells:
        return spark.createDataFrame([], f"{key} long, semantic double")
    rows = spark.read.parquet(f"{path}/rows").withColumnRenamed("key", key)
    near, held = [], 0
    for cell, _, size in sorted((c for c in cells if c[0] >= 0), key=lambda c: c[1]):
        if held < n:
            near.append(cell)
            held += size
    first = semantic(rows.where(F.col("cell").isin(near)), "vector", query, key, n).agg(F.count("semantic").alias("n"), F.min("semantic").alias("least")).first()
    bound = np.sqrt(max(0.0, 2 - 2 * first["least"])) + SLACK if first["n"] == n else np.inf
    return semantic(rows.where(F.col("cell").isin([c for c, low, _ in cells if low <= bound])), "vector", query, key, n)
