"""Approximate nearest vectors from layered proximity graphs, a graph a shard.

Rows are dealt to shards of bounded size by a hash of the key. A shard's graph has layers: each holds about a sixteenth of
the nodes below it, and links a node with near ones in different directions. A search goes down the layers and then
outward from the best nodes found (a beam), comparing 8-bit codes only; shards are searched side by side and their beams
merged. Whole vectors are read for the best of the merged beam alone, by filters on a sorted column, and ranked exactly.
``checked`` makes the results exact: what the graphs found bounds what a pass over the whole vectors has to give.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brindle.functions import text as t

#: Rows of a shard, about; links of a node in the upper layers, twice as many in the lowest; candidates for its links.
SHARD_ROWS, LINKS, CANDIDATES = 16_384, 16, 96
#: Nodes of a shard's beam to one result, and of the merged beam those whose whole vectors are read. Questions of a call at
#: most: they go to every task.
BEAM, RANKED, QUESTIONS = 1.5, 1.5, 10_000
#: Whole vectors up to which they are looked up by a filter that reaches the pages; beyond, they are joined. Similarities that
#: are held at once by an exact check, and what rounding may take from one.
LOOKED_UP, HELD, SLACK = 2_000, 4_000_000, 1e-9
#: Fixed value: bits of a node's number in its shard.
NODE_BITS = 24


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, of whatever magnitude they are."""
    x = vectors / np.abs(vectors).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def encoded(x: np.ndarray) -> np.ndarray:
    """8 bits a component, each row by its own scale: only directions are compared."""
    return np.rint(x / np.abs(x).max(1, keepdims=True) * 127).astype(np.int8)


def nearest(x: np.ndarray, k: int, block: int = 512) -> np.ndarray:
    """Of each row the k nearest others, from the nearest on; blocks of rows bound the memory."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int32)
    for at in range(0, len(x), block):
        s = x[at : at + block] @ x.T
        s[np.arange(len(s)), at + np.arange(len(s))] = -np.inf
        some = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else np.empty((len(s), 0), int)
        out[at : at + block] = np.take_along_axis(some, np.argsort(-np.take_along_axis(s, some, 1), axis=1, kind="stable"), 1)
    return out


def spread(x: np.ndarray, near: np.ndarray, most: int) -> list[list[int]]:
    """Of each row's candidates those that no nearer chosen one is nearer to than the row is; filled up with the nearest."""
    out = []
    for i, candidates in enumerate(near):
        vectors = x[candidates]
        mine, among = vectors @ x[i], vectors @ vectors.T
        open_, chosen = np.ones(len(candidates), bool), []
        for j in range(len(candidates)):
            if open_[j] and len(chosen) < most:
                chosen.append(j)
                open_ &= among[j] <= mine
        left = [j for j in range(len(candidates)) if j not in set(chosen)][: max(0, most // 2 - len(chosen))]
        out.append([int(candidates[j]) for j in chosen + left])
    return out


def both_ways(links: list[list[int]], most: int) -> list[list[int]]:
    """Links also lead back, as long as a node has room; a node that none leads to is linked from its nearest ones."""
    out = [list(dict.fromkeys(v)) for v in links]
    for i, found in enumerate(links):
        for rank, j in enumerate(found):
            if i not in out[j] and (len(out[j]) < most or rank < 2):
                out[j].append(i)
    return out


def layers(x: np.ndarray, names: np.ndarray, links: int = LINKS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(nodes, offsets, targets) from the lowest layer up; a node is in layer l with a chance of ``links`` to the power -l,
    by the hash ``names`` of its key, so that the same rows give the same graph."""
    chance = (names.astype(np.uint64) >> np.uint64(11)).astype(float) / (1 << 53)
    level = np.floor(-np.log(np.maximum(chance, 1e-300)) / np.log(links)).astype(int)
    out, nodes = [], np.arange(len(x))
    for depth in range(64):
        most = 2 * links if depth == 0 else links
        found = both_ways(spread(x[nodes], nearest(x[nodes], min(CANDIDATES, 6 * most)), most), 2 * most)
        offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
        out.append((nodes.astype(np.int32), offsets, nodes[np.array([j for v in found for j in v], int)].astype(np.int32)))
        above = nodes[level[nodes] > depth]
        if len(above) < 2 or len(nodes) <= links:
            break
        nodes = above
    return out


class Graph:
    """A shard's graph, ready to be searched."""

    def __init__(self, codes: np.ndarray, layers_: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.codes = codes.astype(np.float32)
        self.codes /= np.maximum(np.sqrt((self.codes * self.codes).sum(1, keepdims=True)), 1e-9)
        self.layers = layers_
        self.compared = 0

    def _links(self, depth: int, node: int) -> np.ndarray:
        nodes, offsets, targets = self.layers[depth]
        at = node if depth == 0 else int(np.searchsorted(nodes, node))
        return targets[offsets[at] : offsets[at + 1]]

    def search(self, question: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities by codes) of the beam, from the best on."""
        top = self.layers[-1][0]
        self.compared += len(top)
        scores = self.codes[top] @ question
        entries = [(float(scores[k]), int(top[k])) for k in np.argsort(-scores, kind="stable")[:4]]
        for depth in range(len(self.layers) - 1, -1, -1):
            width = beam if depth == 0 else 8
            seen = {n for _, n in entries}
            todo = [(-s, n) for s, n in entries]
            heapq.heapify(todo)
            best = sorted(entries)[-width:]
            heapq.heapify(best)
            while todo:
                s, node = heapq.heappop(todo)
                if len(best) >= width and -s < best[0][0]:
                    break
                new = [n for n in self._links(depth, node).tolist() if n not in seen]
                if not new:
                    continue
                seen.update(new)
                self.compared += len(new)
                for score, n in zip((self.codes[new] @ question).tolist(), new):
                    if len(best) < width or score > best[0][0]:
                        heapq.heappush(todo, (-score, n))
                        heapq.heappush(best, (score, n))
                        if len(best) > width:
                            heapq.heappop(best)
            entries = sorted(best, reverse=True)
        return np.array([n for _, n in entries]), np.array([s for s, _ in entries])


def write_graph_index(df: DataFrame, vector: str, key: str, path: str, shard_rows: int = SHARD_ROWS) -> None:
    """Graphs (a row a shard) and whole vectors (sorted by shard and node). Vectors that are null, zero, or hold a null or a
    value that is not finite, are in neither; all others must have one length. Equal keys are rows of their own."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.where(v.isNotNull() & finite).select(F.col(key).alias("key"), v.alias("vector"))
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    placed = rows.withColumn("name", F.xxhash64("key")).withColumn("shard", F.pmod("name", F.lit(shards)))
    kind = rows.schema["key"].dataType
    schema = T.StructType([T.StructField("at", T.LongType()), T.StructField("key", kind), T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("shard", T.LongType()), T.StructField("codes", T.BinaryType()), T.StructField("layers", T.ArrayType(T.ArrayType(T.BinaryType())))])

    def build(found: pa.Table) -> pa.Table:
        found = found.combine_chunks().sort_by([("name", "ascending"), ("key", "ascending")])
        x = unit(np.array(found["vector"].to_pylist()))
        shard, n = found["shard"][0].as_py(), found.num_rows
        built = [[part.tobytes() for part in layer] for layer in layers(x.astype(np.float32), found["name"].to_numpy().view(np.uint64))]
        names = to_arrow_schema(schema)
        nodes = pa.table([pa.array((shard << NODE_BITS) + np.arange(n)), found["key"], found["vector"], pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, names.field("layers").type)], names=names.names).cast(names)
        whole = pa.table([[None], pa.nulls(1, names.field("key").type), [None], [shard], [encoded(x).tobytes()], [built]], schema=names)
        return pa.concat_tables([nodes, whole])

    done = placed.groupBy("shard").applyInArrow(build, schema)
    staged = f"{path}/built"
    done.write.parquet(staged)  # built once; both tables are read from here
    built = df.sparkSession.read.schema(schema).parquet(staged)
    built.where("shard is not null").select("shard", "codes", "layers").write.option("parquet.page.size.row.check.min", "1").option("parquet.block.size", 1 << 20).parquet(f"{path}/graphs")
    built.where("at is not null").select("at", "key", "vector").repartitionByRange("at").sortWithinPartitions("at").write.option("parquet.page.size", 1 << 16).option("parquet.block.size", 1 << 24).parquet(f"{path}/vectors")
    fs = df.sparkSession._jvm.org.apache.hadoop.fs.Path(staged)
    fs.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(fs, True)


def beams(spark: SparkSession, path: str, questions: list[list[float]], beam: int) -> DataFrame:
    """(question, at, score, compared): the beams of all shards for each question, by its place in the list; ``compared``
    counts the codes that were looked at in the shard for all questions."""
    if len(questions) > QUESTIONS:
        raise ValueError(f"more than {QUESTIONS} questions: ask in parts")
    asked = unit(np.array(questions, float)).astype(np.float32)
    names = pa.schema([("question", pa.int32()), ("at", pa.int64()), ("score", pa.float64()), ("compared", pa.int64())])

    def run(batches):
        for batch in batches:
            for shard, codes, layers_ in zip(batch["shard"].to_pylist(), batch["codes"].to_pylist(), batch["layers"].to_pylist()):
                graph = Graph(np.frombuffer(codes, np.int8).reshape(-1, asked.shape[1]), [tuple(np.frombuffer(b, np.int32) for b in layer) for layer in layers_])
                for k, q in enumerate(asked):
                    before = graph.compared
                    nodes, scores = graph.search(q, beam)
                    n = len(nodes)
                    yield pa.record_batch([pa.array(np.full(n, k, np.int32)), pa.array((shard << NODE_BITS) + nodes), pa.array(scores.astype(float)), pa.array(np.full(n, graph.compared - before))], schema=names)

    return spark.read.parquet(f"{path}/graphs").select("shard", "codes", "layers").mapInArrow(run, "question int, at long, score double, compared long")


def semantic_graph(spark: SparkSession, path: str, questions: list[list[float]], key: str, n: int = 50, beam: float = BEAM, ranked: float = RANKED) -> DataFrame:
    """(question, key, semantic): the ``n`` best found for each question, exact similarities, not surely the nearest of all."""
    found = beams(spark, path, questions, int(beam * n))
    best = Window.partitionBy("question").orderBy(F.desc("score"), "at")
    merged = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= int(ranked * n))  # Spark cuts groups before it sends them
    wanted = merged.select("question", "at").collect()  # ranked * n rows a question
    rows, places = spark.read.parquet(f"{path}/vectors"), sorted({r["at"] for r in wanted})
    if len(places) <= LOOKED_UP:
        rows = rows.where(F.col("at").isin(places))
    asked = spark.createDataFrame([(k, [float(x) for x in q]) for k, q in enumerate(questions)], "question int, asked array<double>")
    pairs = spark.createDataFrame(wanted, "question int, at long")
    scored = pairs.join(rows, "at").join(F.broadcast(asked), "question").select("question", F.col("key").alias(key), t.cosine(F.col("vector"), F.col("asked")).alias("semantic"))
    place = F.row_number().over(Window.partitionBy("question").orderBy(F.desc("semantic"), key))
    return scored.withColumn("_r", place).where(F.col("_r") <= n).drop("_r")


def checked(spark: SparkSession, path: str, questions: list[list[float]], found: DataFrame, key: str, n: int) -> DataFrame:
    """(question, key, semantic): the ``n`` nearest of all vectors for each question, by similarity and key. ``found`` are
    the results of ``semantic_graph`` for them: only what reaches the ``n``-th of a question is looked at any further, by
    matrix products over blocks of vectors; of a block ``n`` rows a question leave the task at most, whatever is tied."""
    asked = np.array(questions, float).reshape(len(questions), -1)
    units, norms = unit(asked), np.sqrt((asked * asked).sum(1))
    least = np.full(len(asked), -np.inf)
    place = F.row_number().over(Window.partitionBy("question").orderBy(F.desc("semantic"), key))
    for r in found.withColumn("_r", place).where(F.col("_r") == n).select("question", "semantic").collect():  # a row a question
        least[r["question"]] = r["semantic"] - SLACK
    rows = spark.read.parquet(f"{path}/vectors").select("key", "vector")
    schema = T.StructType([T.StructField("question", T.IntegerType()), T.StructField(key, rows.schema["key"].dataType), T.StructField("semantic", T.DoubleType())])
    step = max(1, HELD // max(1, len(asked)))

    def run(batches):
        names = to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                some = batch.slice(start, step)
                x = some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)
                row, question = np.nonzero(unit(x) @ units.T >= least)
                if not len(row):
                    continue
                # row by row, so that equal vectors are equally near wherever they are
                near, q = x[row], asked[question]
                score = (near * q).sum(1) / (np.sqrt((near * near).sum(1)) * norms[question])
                keys = some.column(0).take(pa.array(row))
                hits = pa.table([pa.array(question.astype(np.int32)), keys, pa.array(score)], schema=names)
                hits = hits.sort_by([("question", "ascending"), ("semantic", "descending"), (key, "ascending")])
                q = hits["question"].to_numpy()
                best = np.arange(len(q)) - np.searchsorted(q, q, side="left") < n
                yield from hits.filter(pa.array(best)).combine_chunks().to_batches()

    all_ = rows.mapInArrow(run, schema)
    return all_.withColumn("_r", place).where(F.col("_r") <= n).drop("_r")
