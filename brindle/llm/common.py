"""Shared plumbing: tables in the shared folder, Arrow batches, components of a link graph."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brindle.functions import shared


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; an error where it is unset, but for local mode."""
    return shared.folder(spark)


def staged(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to a table of its own in the shared folder and read it back.

    Cuts lineage: what follows is recomputed from replicated files, not from lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", 1 << 24).options(**(options or {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, and let Spark's cleaner see which shuffles are done with."""
    for df in tables:
        if path := getattr(df, "staged_at", None):
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    if tables:
        gc.collect()
        tables[0].sparkSession._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bound_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Arrow batches hold ``limit`` bytes, about, however long the texts: both ends of the pipe hold a few of them."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(key, "64m").lower())
    if not now or int(now[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[now[2]] > limit:
        spark.conf.set(key, f"{limit}b")


def trim() -> None:
    """Give memory that a task no longer needs back to the system: workers live on, and stages follow one another."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with a function of one batch; empty results are left out."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out
        trim()

    return df.mapInArrow(run, schema)


def batch(schema: T.StructType, columns: list) -> pa.RecordBatch:
    """A batch of ``schema`` from Arrow arrays or lists."""
    fields = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)


def ids_and_texts(df: DataFrame, id_col: str, text_col: str, id_as: str = "doc_id") -> DataFrame:
    return df.select(F.col(id_col).alias(id_as), F.col(text_col).cast("string").alias("text"))


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of links ``(a, b)``: rows ``(node, component)``, component the smallest node reachable.

    Alternates large-star and small-star steps. Both send each node's neighbours to the least one; hubs hold no
    neighbour list, since only minima (pre-aggregated before the shuffle) and joins on the node are used. Tables
    are written after each round, and only their size and a change count reach the driver.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    e = staged(e, name)
    for _ in range(max_rounds):
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: neighbours above u move to the least neighbour of u
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        # small star: u and its smaller neighbours move to the least of them
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small_least.select("u", F.col("m").alias("v")))
        new = staged(small.where("u != v").distinct(), name)
        # done when it is a forest of stars: one parent a node and no parent with a parent
        n = new.agg(F.count("*").alias("n"), F.count_distinct("u").alias("d")).first()
        done = n["n"] == n["d"] and new.select("u").join(new.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()
        drop(e)
        e = new
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out.staged_at = e.staged_at
    return out
