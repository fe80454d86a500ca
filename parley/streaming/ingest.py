"""Structured Streaming ingestion of transcription results.

New stage-2 result files are read as a stream; every micro-batch is
de-duplicated per key (latest processing time wins) and upserted into the
transcripts table with the same partition-scoped MERGE rewrite as the batch
job.  The upsert is idempotent, so a micro-batch replayed after a failure
leaves the table as one delivery would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parley.operators import reports
from parley.operators import upsert as up
from parley.plans import pipeline
from parley.sinks import writers

RESULT_SCHEMA = T.StructType([
    T.StructField("parent_folder", T.StringType(), True),
    T.StructField("filename", T.StringType(), True),
    T.StructField("full_path", T.StringType(), True),
    T.StructField("file_id", T.StringType(), True),
    T.StructField("duration_seconds", T.DoubleType(), True),
    T.StructField("num_chunks", T.IntegerType(), True),
    T.StructField("transcription_text", T.StringType(), True),
    T.StructField("processing_timestamp", T.TimestampNTZType(), True),
    T.StructField("error_message", T.StringType(), True),
])


def read_results_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Stage-2 result files (Parquet) under ``path`` as a stream."""
    return (spark.readStream.schema(RESULT_SCHEMA).option("maxFilesPerTrigger", max_files)
                 .parquet(path))


def upsert_batch(spark: SparkSession, table: str, batch: DataFrame, on_error: str = "overwrite") -> None:
    """One micro-batch: latest row per key, ingestion time, MERGE."""
    latest = up.latest_per_key(batch, pipeline.KEYS, "processing_timestamp")
    source = latest.withColumn("ingestion_timestamp", F.col("processing_timestamp"))
    # A late batch never replaces rows of a later run.  The comparison reads
    # the touched folders' keys and times only.
    folders = [r[0] for r in source.select("parent_folder").distinct().limit(
        writers.MAX_LISTED_PARTITIONS + 1).collect()]
    held = spark.table(table)
    if len(folders) <= writers.MAX_LISTED_PARTITIONS:
        held = held.where(F.col("parent_folder").isin([f for f in folders if f is not None]))
    newer = held.select(*pipeline.KEYS, F.col("processing_timestamp").alias("_held"))
    source = (source.join(newer, pipeline.KEYS, "left")
              .where(F.col("_held").isNull() | (F.col("processing_timestamp") >= F.col("_held")))
              .drop("_held"))
    writers.merge_into_table(spark, table, source, pipeline.KEYS, on_error=on_error)


def start_upsert_stream(spark: SparkSession, results: DataFrame, table: str, checkpoint: str,
                        on_error: str = "overwrite", trigger: dict | None = None) -> StreamingQuery:
    """Continuously merge ``results`` into ``table``.  ``checkpoint`` must be
    on shared, reliable storage (e.g. under ``spark.checkpoint.dir``)."""
    writers.ensure_transcripts_table(spark, table)

    def each(batch: DataFrame, epoch_id: int) -> None:
        upsert_batch(batch.sparkSession, table, batch, on_error)

    w = results.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def rate_audit_stream(requests: DataFrame, ts_col: str, limit: int, watermark: str = "2 minutes",
                      key_cols=(), window: str = "1 minute") -> DataFrame:
    """Calls per window (and key) on a stream; a window is emitted once the
    watermark passes its end, and its state is then dropped.  Event time
    must be a session-zone TIMESTAMP for a watermark, so NTZ is cast."""
    if requests.schema[ts_col].dataType != T.TimestampType():
        requests = requests.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return reports.rate_audit(requests.withWatermark(ts_col, watermark), ts_col, limit,
                              key_cols=key_cols, window=window)
