"""Failing rows as records with machine-readable reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators import normalize

RECORD = "row_index long, source_file string, source_sheet string, raw_row string, stage_failed string, fail_reason string, severity string, run_id string, quarantined_at timestamp"


def severity(reason: Column) -> Column:
    hard = F.contains(reason, F.lit("required empty")) | F.contains(reason, F.lit("no source column"))
    return F.when(hard, "error").otherwise("warning")


def first_failed(reason: Column) -> Column:
    return F.trim(F.substring_index(F.substring_index(reason, ";", 1), ":", 1))


def extract(df: DataFrame, run_id: str, source_file: Column, row_index: Column) -> DataFrame:
    """A record for each row with a reason; raw_row is its JSON, nulls kept, of the columns without an underscore."""
    raw = F.to_json(F.struct(*(c for c in df.columns if not c.startswith("_"))), {"ignoreNullFields": "false"})
    sheet = F.col("_source_sheet") if "_source_sheet" in df.columns else F.lit(None).cast("string")
    reason = F.col("_quarantine_reason")
    return df.where(reason.isNotNull()).select(
        row_index.cast("long").alias("row_index"), source_file.alias("source_file"), sheet.alias("source_sheet"), raw.alias("raw_row"), first_failed(reason).alias("stage_failed"), reason.alias("fail_reason"), severity(reason).alias("severity"), F.lit(run_id).alias("run_id"), F.current_timestamp().alias("quarantined_at")
    )


def save(records: DataFrame, root: str) -> None:
    records.write.mode("append").partitionBy("run_id").parquet(root)


def listed(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The run's records; none where nothing was saved."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).parquet(root).where(F.col("run_id") == run_id)


def reprocess(records: DataFrame, row_schema: str) -> tuple[DataFrame, DataFrame]:
    """(passing, failing) rows after normalising once more. Checks for required values belong to mapping and are not
    repeated. ``row_schema`` is that of raw_row."""
    rows = records.select("source_file", "row_index", F.from_json("raw_row", row_schema).alias("r")).select("source_file", "row_index", "r.*")
    again = normalize.normalize(rows)
    return again.where("_quarantine_reason is null"), again.where("_quarantine_reason is not null")
