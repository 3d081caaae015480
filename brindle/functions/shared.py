"""The folder that driver and executors share, and rows dealt to all cores."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a temporary folder in local mode, as in tests; an error on a cluster, whose
    executors would not see such a folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="brindle-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """HotSpot leaves methods of over 8,000 bytes to its interpreter, and mapping and normalising make such. Within, Spark makes
    smaller ones of them. The session's limit comes back after."""
    name, limit = "spark.sql.codegen.hugeMethodLimit", 8000
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), limit))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to a new table in the shared folder and read from there: what several results need is computed once."""
    at = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with compiled(df.sparkSession):
        df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def spread(df: DataFrame) -> DataFrame:
    """The rows of a table as read, dealt to two tasks a core where they come in fewer, for steps that cost much a row: a row
    group of a Parquet file is one task, and one of narrow rows holds a million."""
    n = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)
