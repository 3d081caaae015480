"""New rows in a landing folder, taken in micro-batches by the same plan as a batch run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brindle import config
from brindle.operators import mapping, normalize
from brindle.plans.runs import Runs


def standardise_stream(spark: SparkSession, landing: str, schema: str, form: str, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Rows of ``landing`` (JSON lines by ``schema``) mapped and normalised into ``out``, partitioned by batch, so a batch
    that is tried again replaces itself."""
    rule = config.rule(form)

    def batch(df: DataFrame, batch_id: int) -> None:
        done = normalize.drop_working(normalize.normalize(mapping.apply_mapping(df, rule, keep=())))
        done.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = spark.readStream.schema(schema).json(landing).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def workbook_stream(spark: SparkSession, landing: str, runs: Runs, checkpoint: str, commit: bool = False, once: bool = True) -> StreamingQuery:
    """Workbooks that land in a folder, each in one run: a micro-batch is a run with quarantine, audit, metrics and gate, named
    by the batch, so that a batch that is tried again does its run again. Files that came before with the same content are
    passed over. Runs that may be promoted are, with ``commit``."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").load(landing)

    def batch(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        try:
            runs.run_new(landing, commit, f"landed_{batch_id:09d}")
        except ValueError:  # the gate's answer: the run stays a dry run
            if not commit:
                raise

    writer = files.select("path").writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
