import os
import tempfile

from pyspark.sql import functions as F

from parley.streaming import ingest
from parley.operators import upsert


def _results(spark, rows):
    df = spark.createDataFrame(rows, "parent_folder string, filename string, transcription_text string, ts string, error_message string")
    return df.select("parent_folder", "filename",
                     F.concat_ws("/", F.lit("/calls"), "parent_folder", "filename").alias("full_path"),
                     F.lit("id").alias("file_id"), F.lit(2.0).alias("duration_seconds"),
                     F.lit(1).alias("num_chunks"), "transcription_text",
                     F.to_timestamp_ntz("ts").alias("processing_timestamp"), "error_message")


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")],
                               "k string, t int, v string")
    got = sorted(map(tuple, upsert.latest_per_key(df, ["k"], "t").collect()))
    assert got == [("a", 3, "z"), ("b", 1, "q")]


def test_stream_upsert(spark):
    base = tempfile.mkdtemp(prefix="parley-stream-")
    src, ckpt = os.path.join(base, "in"), os.path.join(base, "ckpt")
    table = "stream_transcripts"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    _results(spark, [("a", "1.wav", "v1", "2024-01-01 00:00:00", None),
                     ("a", "2.wav", "w1", "2024-01-01 00:00:00", None)]).write.mode("append").parquet(src)
    q = ingest.start_upsert_stream(spark, ingest.read_results_stream(spark, src), table, ckpt)
    q.processAllAvailable()
    # a second run lands twice for the same key in one file set: latest wins
    _results(spark, [("a", "1.wav", "v2", "2024-01-02 00:00:00", None),
                     ("a", "1.wav", "v3", "2024-01-03 00:00:00", None),
                     ("b", "1.wav", "n1", "2024-01-02 00:00:00", None)]).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    got = sorted((r.parent_folder, r.filename, r.transcription_text) for r in spark.table(table).collect())
    assert got == [("a", "1.wav", "v3"), ("a", "2.wav", "w1"), ("b", "1.wav", "n1")]


def test_rate_audit_stream(spark):
    base = os.path.join(tempfile.mkdtemp(prefix="parley-rate-"), "events")
    rows = [("2024-01-01 00:00:%02d" % s,) for s in range(0, 50, 5)] + [("2024-01-01 00:05:00",)]
    spark.createDataFrame(rows, "t string").select(F.to_timestamp_ntz("t").alias("ts")).write.parquet(base)
    stream = spark.readStream.schema("ts timestamp_ntz").parquet(base)
    audit = ingest.rate_audit_stream(stream, "ts", limit=5, watermark="1 minute")
    q = audit.writeStream.outputMode("append").format("memory").queryName("rate_audit_t").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("rate_audit_t").collect()
    assert [(r.calls, r.over_limit) for r in got] == [(10, True)]   # 00:05 window still open
