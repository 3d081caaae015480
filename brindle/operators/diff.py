"""Comparison with ground truth by counts: rows that share a key pair up, and pairs are counted without being made.

A key with m rows on one side and n on the other has m * n pairs. Values become canonical, so that two are equal exactly
where their canonical forms are; pairs that are equal in a column, or in all, are products of counts by key and form.
"""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brindle.functions import text as t


def canonical(c: Column) -> Column:
    """Nulls are null; numbers go by value, the rest by the stripped text."""
    text = c.cast("string")
    number = t.number(text) + F.lit(0.0)
    return F.when(~t.missing(c), F.coalesce(F.concat(F.lit("n"), number.cast("string")), F.concat(F.lit("s"), t.ustrip(text))))


def equal(a: Column, b: Column) -> Column:
    """Nulls are equal; numbers by value where both are; else the stripped text."""
    return canonical(a).eqNullSafe(canonical(b))


def _sides(auto: DataFrame, golden: DataFrame, key: str, by: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the key as ``_k``, the columns of ``by`` and the canonical columns to compare, and their names."""
    for side, df in (("auto", auto), ("golden", golden)):
        if key not in df.columns:
            raise KeyError(f"{key} is no column of {side}")
    columns = [c for c in golden.columns if c in auto.columns and c != key and c not in by]
    shaped = lambda df: df.select(*by, F.col(key).alias("_k"), *(canonical(F.col(c)).alias(c) for c in columns))
    return shaped(auto), shaped(golden), columns


def _counted(a: DataFrame, g: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """(names, n_a, n_g): rows of each side by equal names, nulls being equal."""
    left = a.groupBy(*names).agg(F.count("*").alias("n_a"))
    right = g.groupBy(*names).agg(F.count("*").alias("n_g")).select(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(names)), "n_g")
    both = left.join(right, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(names)], how)
    return both.select(*(F.coalesce(F.col(c), F.col(f"_g{i}")).alias(c) for i, c in enumerate(names)), F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_g", F.lit(0)).alias("n_g"))


def counts(auto: DataFrame, golden: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """A row (by group): rows_match, rows_mismatch, rows_only_in_auto, rows_only_in_golden, match_rate over all."""
    by = by or []
    a, g, columns = _sides(auto, golden, key, by)
    of_key = _counted(a, g, [*by, "_k"], "full_outer")
    pairs = F.col("n_a") * F.col("n_g")
    whole = of_key.groupBy(*by).agg(F.coalesce(F.sum(pairs), F.lit(0)).alias("pairs"), F.coalesce(F.sum(F.when(F.col("n_g") == 0, F.col("n_a"))), F.lit(0)).alias("rows_only_in_auto"), F.coalesce(F.sum(F.when(F.col("n_a") == 0, F.col("n_g"))), F.lit(0)).alias("rows_only_in_golden"))
    same = _counted(a, g, [*by, "_k", *columns]).groupBy(*by).agg(F.coalesce(F.sum(pairs), F.lit(0)).alias("rows_match"))
    out = whole.join(same, by, "left") if by else whole.join(same)  # one row each
    match = F.coalesce("rows_match", F.lit(0))
    every = F.col("pairs") + F.col("rows_only_in_auto") + F.col("rows_only_in_golden")
    return out.select(*by, match.alias("rows_match"), (F.col("pairs") - match).alias("rows_mismatch"), "rows_only_in_auto", "rows_only_in_golden", F.coalesce(F.try_divide(match.cast("double"), every), F.lit(0.0)).alias("match_rate"))


def column_mismatches(auto: DataFrame, golden: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """Rows (by, column, n): pairs that differ in a column."""
    by = by or []
    a, g, columns = _sides(auto, golden, key, by)
    if not columns:
        return a.select(*by, F.lit("").alias("column"), F.lit(0).cast("long").alias("n")).where(F.lit(False))
    cells = lambda df: df.select(*by, "_k", F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in columns))).alias("c")).select(*by, "_k", "c.*")
    pairs = F.sum(F.col("n_a") * F.col("n_g"))
    all_ = _counted(a, g, [*by, "_k"]).groupBy(*by).agg(pairs.alias("pairs"))
    same = _counted(cells(a), cells(g), [*by, "_k", "column", "v"]).groupBy(*by, "column").agg(pairs.alias("same"))
    named = all_.select(*by, "pairs", F.explode(F.array(*map(F.lit, columns))).alias("column"))
    out = named.join(same, [*by, "column"], "left").withColumn("n", F.col("pairs") - F.coalesce("same", F.lit(0)))
    return out.where("n > 0").select(*by, "column", "n")


def samples(auto: DataFrame, golden: DataFrame, key: str, n: int = 10) -> DataFrame:
    """(key, wrong): the first ``n`` differing pairs by key: a report, so the limit is the feature. Of a key no more than
    n + 1 kinds of rows a side are paired; these hold n differing pairs, if there are so many."""
    a, g, columns = _sides(auto, golden, key, [])
    pairs = F.sum(F.col("n_a") * F.col("n_g"))
    every = _counted(a, g, ["_k"]).select("_k", (F.col("n_a") * F.col("n_g")).alias("pairs"))
    same = _counted(a, g, ["_k", *columns]).groupBy("_k").agg(pairs.alias("same")).select(F.col("_k").alias("_s"), "same")
    wrong = every.join(same, F.col("_k").eqNullSafe(F.col("_s")), "left").where(F.col("pairs") > F.coalesce("same", F.lit(0)))
    keys = F.broadcast(wrong.orderBy("_k").limit(n).select(F.col("_k").alias("_w")))
    first = Window.partitionBy("_k").orderBy(*columns)

    def some(df: DataFrame, prefix: str) -> DataFrame:
        kinds = df.join(keys, F.col("_k").eqNullSafe(F.col("_w"))).select("_k", *columns).distinct()
        return kinds.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= n + 1).select(F.col("_k").alias(f"{prefix}_k"), *(F.col(c).alias(f"{prefix}_{c}") for c in columns))

    both = some(a, "a").join(some(g, "g"), F.col("a_k").eqNullSafe(F.col("g_k")))
    differ = F.array_compact(F.array(*(F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"g_{c}")), F.lit(c)) for c in columns)))
    return both.select(F.col("a_k").alias(key), differ.alias("wrong")).where("size(wrong) > 0").orderBy(key, "wrong").limit(n)


def stem(path: str) -> str:
    return PurePosixPath(path).stem


def _parquet_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, values) of small Parquet files of whatever schemas, all in one scan: a row's values as text by column."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).where("path like '%.parquet'").select("path", "content")

    def run(batches):
        import pyarrow as pa
        from pyarrow import parquet

        schema = pa.schema([("path", pa.string()), ("values", pa.map_(pa.string(), pa.string()))])
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                table = parquet.ParquetFile(pa.BufferReader(content.as_buffer()))
                for part in table.iter_batches(batch_size=1_000):
                    rows = [[(c, None if v is None else str(v)) for c, v in r.items()] for r in part.to_pylist()]
                    yield pa.record_batch([pa.array([path] * len(rows), pa.string()), pa.array(rows, schema.field("values").type)], schema=schema)

    return files.mapInArrow(run, "path string, values map<string,string>")


def _sheet_rows(spark: SparkSession, folder: str, names: set[str]) -> DataFrame:
    """(path, values) of the first sheets of workbooks: the first row names the columns, of equal names the first counts."""
    from brindle.sources import xlsx

    wanted = F.broadcast(spark.createDataFrame([(n,) for n in sorted(names)], "_name string"))  # a row a file
    cells = xlsx.read_cells(spark, folder).where("error is null and sheet_idx = 0").join(wanted, F.element_at(F.split("file_path", "/"), -1) == F.col("_name"), "left_semi")
    clean = F.transform("cells", lambda c, i: F.coalesce(F.nullif(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit("")), F.concat(F.lit("Unnamed: "), i.cast("string"))))
    heads = cells.where("row_idx = 1").select(F.col("file_path").alias("_head"), clean.alias("names"))
    both = cells.where("row_idx > 1").join(heads, F.col("file_path") == F.col("_head"))
    pairs = F.filter(F.transform("names", lambda n, i: F.struct(n.alias("n"), F.get("cells", i).alias("v"), i.alias("i"))), lambda p: F.array_position("names", p["n"]) == p["i"] + 1)
    return both.select(F.col("file_path").alias("path"), F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["n"], p["v"]))).alias("values"))


def load_golden(spark: SparkSession, folder: str, stems: list[str]) -> DataFrame | None:
    """Ground truth of source files by their stems, as text with ``stem``: ``<stem>.parquet``, else the first sheet of
    ``<stem>.xlsx`` with its header in the first row. None where no file has any. However many files there are, the Parquet
    ones are read in one scan and the workbooks in another."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    there = {f.getPath().getName(): f.getPath().toString() for f in fs.listStatus(at)} if fs.exists(at) else {}
    wanted = set(stems)
    tables = {s: there[f"{s}.parquet"] for s in wanted if f"{s}.parquet" in there}
    books = {f"{s}.xlsx" for s in wanted - set(tables) if f"{s}.xlsx" in there}
    parts = ([_parquet_rows(spark, sorted(tables.values()))] if tables else []) + ([_sheet_rows(spark, folder, books)] if books else [])
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
    # a table may be a folder: its name is the first below the given one
    rows = rows.select(F.regexp_extract("path", r"/([^/]+?)\.(?:parquet|xlsx)(?:/[^/]*)?$", 1).alias("stem"), "values")
    columns = sorted(r["c"] for r in rows.select(F.explode(F.map_keys("values")).alias("c")).distinct().collect())  # a row a column
    return rows.select("stem", *(F.col("values")[c].alias(c) for c in columns))
