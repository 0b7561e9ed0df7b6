"""Incremental load as Structured Streaming: new CSV files -> one reconciliation run per micro-batch.

The batch model's "incremental" mode is "run again on the new file and upsert". Here a file
stream with a fixed all-text schema feeds ``foreachBatch``; each micro-batch is validated,
deduplicated and merged into the target store by the same ``ReconciliationJob`` used in batch.
The merge is an upsert, so a micro-batch replayed after a crash leaves the same table (only the
load stamp moves); the stream's checkpoint folder records which files were done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline import schema as S
from ledgerline.functions.text import null_tokens_to_null
from ledgerline.plans.keyjoin import materialize
from ledgerline.plans.pipeline import ReconciliationJob
from ledgerline.plans.runs import run_by_id, run_history
from ledgerline.session import scratch_owner
from ledgerline.sources.csv import ORDER_TAGS, row_numbers


def text_schema(columns: list[str] | None = None) -> T.StructType:
    cols = columns or (S.OPS_COLUMNS + [S.HASH_COLUMN])
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def _with_row_order(df: DataFrame) -> DataFrame:
    """Row order inside a micro-batch: by file path, then position in the file; decides keep-first.

    Files are dealt to tasks by size, so the scan position alone is not file order.
    """
    tagged = materialize(df.withColumn("_pos", F.monotonically_increasing_id()))[0]
    return row_numbers(tagged, tagged).drop(*ORDER_TAGS)


def _done(spark: SparkSession, runs_dir: str, pipeline_id: str) -> bool:
    """Whether a replayed micro-batch already has its record of success (one record for each batch)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(runs_dir)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return False
    return not run_by_id(run_history(spark, runs_dir), pipeline_id).filter("status = 'success'").isEmpty()


def start_incremental_load(spark: SparkSession, input_dir: str, job: ReconciliationJob, checkpoint: str,
                           columns: list[str] | None = None, trigger_once: bool = False,
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination``/``stop`` as usual)."""
    schema = text_schema(columns)
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(input_dir)
    stream = stream.select(*[null_tokens_to_null(F.col(c)).alias(c) for c in stream.columns],
                           F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))

    def load(batch: DataFrame, epoch_id: int) -> None:
        # the query's id lives in its checkpoint: another stream, or one begun anew, has records of its own
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        pipeline_id = f"stream_{stream_id}_{epoch_id}"
        if batch.isEmpty() or (stream_id and _done(spark, job.runs_dir, pipeline_id)):
            return
        with scratch_owner(spark):
            job.run(_with_row_order(batch), pipeline_id=pipeline_id)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()
