from pyspark.sql import functions as F

from testdata import SF_SMALL
from parley.config import SizeLimits
from parley.functions import text as tfn
from parley.functions import wav as wfn
from parley.plans import stand_ins  # noqa: E402
from parley.plans import pipeline
from parley.sources import tables


def test_stage_jobs_end_to_end(spark):
    conv = tables.read_table(spark, SF_SMALL, "conversations")
    client = stand_ins.EchoClient(1800)
    lim = SizeLimits(max_payload_bytes=2048)
    chunks = pipeline.run_preprocess_calls(spark, conv, "20240101")
    results = pipeline.run_transcribe(spark, chunks, client, "20240101", limits=lim,
                                      run_ts="2024-01-01 00:00:00", parallelism=3)
    n_calls = conv.select("conv_id").distinct().count()
    assert spark.table(results).count() == n_calls
    pipeline.run_merge(spark, results, "calls.call_transcriptions",
                       ingestion_ts="2024-01-01 01:00:00", cleanup=[chunks])
    assert spark.table("calls.call_transcriptions").count() == n_calls
    assert not spark.catalog.tableExists(chunks)
    # re-running the same results is idempotent
    pipeline.run_merge(spark, results, "calls.call_transcriptions", ingestion_ts="2024-01-01 01:00:00")
    assert spark.table("calls.call_transcriptions").count() == n_calls
    n = pipeline.run_enrich(spark, "calls.call_transcriptions", "calls.enriched",
                            run_ts="2024-01-02 00:00:00", eval_table="calls.eval_metrics")
    assert n == n_calls
    gold = spark.table("calls.enriched")
    with_text = spark.table("calls.call_transcriptions").filter(F.col("transcription_text").isNotNull()).count()
    assert gold.count() == with_text
    assert {r.scorer for r in spark.table("calls.eval_metrics").collect()} == {"captures_main_topics", "safety"}
    # appending again duplicates (create-or-append semantics)
    pipeline.run_enrich(spark, "calls.call_transcriptions", "calls.enriched", run_ts="2024-01-02 00:00:00")
    assert spark.table("calls.enriched").count() == 2 * with_text


def test_enrich_empty_source_exits(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS calls")
    spark.createDataFrame([], "parent_folder string, filename string, transcription_text string") \
        .write.mode("overwrite").saveAsTable("calls.empty_src")
    assert pipeline.run_enrich(spark, "calls.empty_src", "calls.never_written") == 0
    assert not spark.catalog.tableExists("calls.never_written")


def test_build_prompt_and_silence(spark):
    df = spark.createDataFrame([("it's fine",), (None,)], "t string")
    rows = df.select(tfn.build_prompt("t", "Say it's so:\n").alias("p")).collect()
    assert rows[0].p == "Say it's so:\nit's fine" and rows[1].p is None
    import io
    import wave
    b = bytes(spark.range(1).select(wfn.silence_wav(1.0)).head()[0])
    with wave.open(io.BytesIO(b)) as w:
        assert w.getnframes() == 16000 and w.getframerate() == 16000
        assert set(w.readframes(16000)) == {0}


def test_current_user(spark):
    assert tables.current_user(spark)


def test_cli_merge_enrich_report(spark, capsys):
    from parley.__main__ import main
    conv = tables.read_table(spark, SF_SMALL, "conversations")
    chunks = pipeline.run_preprocess_calls(spark, conv, "cli1")
    results = pipeline.run_transcribe(spark, chunks, stand_ins.EchoClient(1800), "cli1",
                                      limits=SizeLimits(max_payload_bytes=2048))
    assert main(["merge", "--results", results, "--target", "calls.cli_transcripts",
                 "--cleanup", chunks], spark=spark) == 0
    assert main(["enrich", "--source", "calls.cli_transcripts", "--gold", "calls.cli_gold"],
                spark=spark) == 0
    assert main(["report", "errors", "--table", results], spark=spark) == 0
    assert main(["report", "sentiment", "--table", "calls.cli_gold"], spark=spark) == 0
    assert main(["report", "summary", "--table", results, "--rows", "2"], spark=spark) == 0
    out = capsys.readouterr().out
    assert "error_type" in out and "sentiment" in out and "merged into calls.cli_transcripts" in out
    assert "preview" in out
