"""Pipeline stages: recordings -> chunks -> transcripts -> upsert -> gold.

The plan functions (``infer_calls``, ``transcribe_*``, ``chunk_documents``,
``to_transcripts``) return lazy DataFrames.  The ``run_*`` stage jobs read
one table and write the next through :mod:`parley.sinks`, so stages are
materialised between remote calls and decoding steps.
"""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.config import ChunkSpec, SizeLimits
from parley.functions.time import run_timestamp
from parley.operators import chunking, inference, reassemble as ra
from parley.sources import recordings

# Speech runs at about 15 characters per second; used to give a text
# recording a duration.
CHARS_PER_SECOND = 15.0

TRANSCRIPT_COLUMNS = ["parent_folder", "filename", "full_path", "duration_seconds", "num_chunks",
                      "transcription_text", "processing_timestamp", "ingestion_timestamp"]
KEYS = ["parent_folder", "filename"]


def _ts(ts: datetime | str | Column | None) -> Column:
    return run_timestamp(ts)


def infer_calls(conversations: DataFrame, client, limits: SizeLimits = SizeLimits(),
                parallelism: int | None = None) -> DataFrame:
    """Per-chunk inference results for recorded calls (one chunk per turn).

    A narrow plan: one scan, no join.  Turns with a NULL call or turn id
    stay in the result.
    """
    return infer_call_chunks(recordings.call_chunks(conversations), client, limits, parallelism)


def infer_call_chunks(chunks: DataFrame, client, limits: SizeLimits = SizeLimits(),
                      parallelism: int | None = None, full_errors: bool = False) -> DataFrame:
    """The same from a stored chunk listing (``conv_id, chunk_idx, payload``)."""
    sized = chunks.select("conv_id", "chunk_idx", "payload").withColumn(
        "chunk_chars", F.char_length("payload").cast("long"))
    return inference.infer_chunks(sized, client, limits=limits, n_col=None, parallelism=parallelism,
                                  full_errors=full_errors)


def call_results(inferred: DataFrame, run_ts=None, fanout: int = ra.DEFAULT_FANOUT,
                 full_errors: bool = False) -> DataFrame:
    """Stage-2 rows per call from per-chunk results."""
    blocks = ra.reassemble(inferred, ["conv_id"], sums=["chunk_chars"], fanout=fanout,
                           blocks_only=True)
    return calls_of_blocks(blocks, run_ts, full_errors)


def calls_of_blocks(blocks: DataFrame, run_ts=None, full_errors: bool = False) -> DataFrame:
    """Stage-2 rows per call from block rows."""
    merged = ra.join_blocks(blocks, ["conv_id"], sums=["chunk_chars"], full_errors=full_errors)
    return merged.select(*recordings.call_keys(),
                         (F.col("sum_chunk_chars") / F.lit(CHARS_PER_SECOND)).alias("duration_seconds"),
                         "num_chunks", "transcription_text",
                         _ts(run_ts).alias("processing_timestamp"), "error_message",
                         *(["error_full"] if full_errors else []))


def transcribe_calls(conversations: DataFrame, client, *, limits: SizeLimits = SizeLimits(),
                     run_ts=None, fanout: int = ra.DEFAULT_FANOUT,
                     full_errors: bool = False) -> DataFrame:
    """Stage-2 result rows (all rows, errors included) for recorded calls."""
    return call_results(infer_calls(conversations, client, limits), run_ts, fanout, full_errors)


def chunk_documents(documents: DataFrame, spec: ChunkSpec) -> DataFrame:
    """Stage 1 for long text recordings: chunk plan by characters."""
    recs = recordings.document_recordings(documents)
    return chunking.chunk_text(recs, "text", spec, out_col="payload")


def transcribe_documents(documents: DataFrame, client, *, spec: ChunkSpec,
                         limits: SizeLimits = SizeLimits(), run_ts=None,
                         fanout: int = ra.DEFAULT_FANOUT) -> DataFrame:
    """Chunk, infer and reassemble long recordings (chunks overlap)."""
    chunks = chunk_documents(documents, spec).select(
        "doc_id", "parent_folder", "filename", "full_path", "file_id", "length",
        "num_chunks", "chunk_idx", "payload")
    inferred = inference.infer_chunks(chunks, client, limits=limits)
    merged = ra.reassemble(inferred, ["doc_id"], firsts=["parent_folder", "filename", "full_path",
                                                         "file_id", "length"], fanout=fanout)
    return merged.select("parent_folder", "filename", "full_path", "file_id",
                         (F.col("length") / F.lit(CHARS_PER_SECOND)).alias("duration_seconds"),
                         "num_chunks", "transcription_text",
                         _ts(run_ts).alias("processing_timestamp"), "error_message")


def successes(results: DataFrame) -> DataFrame:
    """Stage-1 style filter: rows without an error."""
    return results.filter(F.col("error_message").isNull())


def failures(results: DataFrame) -> DataFrame:
    return results.filter(F.col("error_message").isNotNull())


def to_transcripts(results: DataFrame, ingestion_ts=None) -> DataFrame:
    """Project stage-2 rows to the durable transcript schema (drops
    ``file_id`` and ``error_message``) with an ingestion timestamp."""
    return results.withColumn("ingestion_timestamp", _ts(ingestion_ts)).select(*TRANSCRIPT_COLUMNS)


# ---------------------------------------------------------------------------
# Stage jobs: each reads a table, writes a table.  Tables between stages
# cut lineage, so a lost executor recomputes from the last stage, and a
# remote call never runs twice for one row within a job.
# ---------------------------------------------------------------------------
def _record(spark, schema: str, stage: str, run_id: str, started: float, results: DataFrame) -> None:
    """One row of the stage's run in ``stage_runs``: rows with and without an error, elapsed time."""
    n = results.agg(F.count(F.lit(1)).alias("total"),
                    F.count_if(F.col("error_message").isNotNull()).alias("failed")).first()
    row = [(stage, run_id, n["total"], n["total"] - n["failed"], n["failed"], time.time() - started)]
    spark.createDataFrame(row, "stage string, run_id string, total bigint, succeeded bigint, "
                               "failed bigint, seconds double").write.mode("append").saveAsTable(
        f"{schema}.stage_runs")


def run_preprocess_calls(spark, conversations: DataFrame, run_id: str, schema: str = "calls") -> str:
    """Stage 1 for recorded calls: chunk listing (one chunk per turn)."""
    from parley.sinks import writers
    from parley.sources import recordings as rec
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    name = writers.stage_table_name(f"{schema}.chunks", run_id)
    rec.call_chunks(conversations).write.mode("overwrite").saveAsTable(name)
    return name


def _store_answers(spark, inferred: DataFrame, keys: list[str], run_id: str, run_ts,
                   schema: str) -> DataFrame:
    """The answers of all chunks, stored once, and the request log made from them.

    Every later step reads the stored answers, so no call is made twice.
    """
    from parley.sinks import writers
    name = writers.stage_table_name(f"{schema}.chunk_results", run_id)
    inferred.write.mode("overwrite").saveAsTable(name)
    answers = spark.table(name)
    log = inference.request_log(answers, _ts(run_ts), keys)
    log.write.mode("overwrite").saveAsTable(writers.stage_table_name(f"{schema}.request_log", run_id))
    return answers


def run_transcribe(spark, chunks_table: str, client, run_id: str, *, limits: SizeLimits = SizeLimits(),
                   run_ts=None, schema: str = "calls", fanout: int = ra.DEFAULT_FANOUT,
                   parallelism: int | None = None) -> str:
    """Stage 2: infer every chunk, reassemble per call, write all rows.

    Stores the answers (``chunk_results``), the request log with whole
    messages (``request_log``), the blocks and the results.
    """
    from parley.sinks import writers
    started = time.time()
    answers = _store_answers(
        spark, infer_call_chunks(spark.table(chunks_table), client, limits, parallelism, True),
        ["conv_id"], run_id, run_ts, schema)
    # Blocks are the durable form: spread over tasks however large a call is;
    # readers of a call too large for one row read its blocks in order.
    blocks_name = writers.stage_table_name(f"{schema}.transcription_blocks", run_id)
    blocks = ra.reassemble(answers, ["conv_id"], sums=["chunk_chars"], fanout=fanout,
                           blocks_only=True, full_col="chunk_error_full")
    writers.overwrite_stage(blocks, blocks_name)
    results = calls_of_blocks(spark.table(blocks_name), run_ts, full_errors=True)
    name = writers.stage_table_name(f"{schema}.transcription_results", run_id)
    writers.overwrite_stage(results, name)
    _record(spark, schema, "transcribe", run_id, started, spark.table(name))
    return name


def run_merge(spark, results_table: str, target_table: str, *, ingestion_ts=None,
              on_error: str = "overwrite", cleanup: list[str] | None = None) -> None:
    """Stage 3: upsert the stage results into the durable table, then drop
    the stage tables."""
    from parley.sinks import writers
    writers.ensure_transcripts_table(spark, target_table)
    source = spark.table(results_table).withColumn("ingestion_timestamp", _ts(ingestion_ts))
    writers.merge_into_table(spark, target_table, source, KEYS, on_error=on_error)
    if cleanup:
        writers.drop_tables(spark, cleanup)


def run_enrich(spark, source_table: str, gold_table: str, *, run_ts=None,
               eval_table: str | None = None, central_summary: bool = False,
               corpus_topics: bool = False) -> int:
    """Stage 4: enrich, materialise gold once, score it, append.

    ``central_summary`` takes summaries by sentence centrality,
    ``corpus_topics`` topics by phrase scores between the heavy terms of the
    source.  Returns the number of source rows; an empty source exits early.
    """
    from parley.operators import central, enrich as en, evaluate as ev, topics
    from parley.sinks import writers
    source = spark.table(source_table)
    if source.isEmpty():
        return 0
    gold = en.enrich(source, _ts(run_ts))
    if central_summary:
        gold = central.with_central_summary(gold).drop("lead_weight")
    if corpus_topics:
        heavy = [r.term for r in topics.heavy_terms(source).collect()]
        gold = topics.with_topics(gold, heavy)
    # Materialise once: previews, scores and the write all read the same
    # rows instead of re-running the enrichment.
    staged = writers.stage_table_name(gold_table, "staging")
    gold.write.mode("overwrite").saveAsTable(staged)
    gold = spark.table(staged)
    if eval_table:
        ev.metrics(ev.score(gold)).write.mode("overwrite").saveAsTable(eval_table)
    writers.create_or_append(gold, gold_table)
    writers.drop_tables(spark, [staged])
    return spark.table(source_table).count()


# ---------------------------------------------------------------------------
# Audio recordings: discover -> normalise -> chunk payload table -> transcribe
# ---------------------------------------------------------------------------
AUDIO_META_COLUMNS = ["parent_folder", "filename", "full_path", "file_id"]


def run_preprocess_audio(spark, root: str, run_id: str, *, spec: ChunkSpec = ChunkSpec(),
                         max_files: int | None = None, schema: str = "calls",
                         parallelism: int | None = None, split_bytes: int | None = None,
                         chunk_root: str | None = None) -> tuple[str, str]:
    """Stage 1 for audio files under ``root``.

    With ``split_bytes`` recordings of any size are read in ranges of about
    that many bytes; without it a recording is one row, one too large for
    that an error, and ``parallelism`` spreads the decoding over that many
    tasks.  Both give the same chunks.
    Writes (a) the per-file metadata table (duration, chunk count, chunk
    names, error; success rows only), (b) the chunk payload table with one
    WAV per chunk as a binary column, where a file that cannot be decoded is
    a row with ``error_message``, and (c) ``preprocessing_failures``, the
    files that gave none, with why.  ``max_files`` bounds a run to the first
    files by path.  With ``chunk_root`` the chunks are also written there as
    files, and the metadata names those.  Returns the names of (a) and (b).
    """
    from parley.sinks import chunk_files, writers
    from parley.sources import audio
    started = time.time()
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    norm_name = writers.stage_table_name(f"{schema}.normalized_audio", run_id)
    if split_bytes:
        found = audio.read_wav_chunks(spark, root, spec, split_bytes=split_bytes, max_files=max_files)
    else:
        files = audio.read_audio(spark, root, max_files=max_files)
        if parallelism:
            files = files.repartition(parallelism)
        audio.normalize_audio(files, method="sinc").write.mode("overwrite").saveAsTable(norm_name)
        norm = spark.table(norm_name)
        found = audio.audio_chunks(norm, spec).unionByName(
            norm.where(F.col("error_message").isNotNull()), allowMissingColumns=True)
    payload_name = writers.stage_table_name(f"{schema}.chunk_payloads", run_id)
    # Decode once; everything else reads the stored rows, mostly without the payload.
    found.select(*AUDIO_META_COLUMNS, "length", "duration_seconds", "num_chunks", "chunk_idx",
                 F.col("wav").alias("payload"), "error_message").write.mode("overwrite").saveAsTable(payload_name)
    spark.sql(f"DROP TABLE IF EXISTS {norm_name}")
    stored = spark.table(payload_name)
    if chunk_root:
        chunk_files.write_chunk_files(readable(stored), chunk_root)
        names = chunk_files.chunk_addresses(F.col("full_path"), F.col("file_id"), F.col("num_chunks"),
                                            chunk_root)
    else:
        names = writers.chunk_paths(F.col("file_id"), F.col("num_chunks"))
    files = stored.groupBy(*AUDIO_META_COLUMNS, "length").agg(
        F.max("duration_seconds").alias("duration_seconds"), F.max("num_chunks").alias("num_chunks"),
        F.min("error_message").alias("error_message"))
    meta = files.withColumn("chunk_paths", F.when(F.col("error_message").isNull(), names))
    meta_name = writers.stage_table_name(f"{schema}.preprocessing_metadata", run_id)
    writers.overwrite_stage(meta.select(*AUDIO_META_COLUMNS, "duration_seconds", "num_chunks",
                                        "chunk_paths", "error_message"), meta_name, success_only=True)
    writers.overwrite_stage(
        files.where(F.col("error_message").isNotNull()).select(*AUDIO_META_COLUMNS, "length",
                                                               "error_message"),
        writers.stage_table_name(f"{schema}.preprocessing_failures", run_id))
    _record(spark, schema, "preprocess", run_id, started, files)
    return meta_name, payload_name


def readable(chunks: DataFrame) -> DataFrame:
    """Chunk rows of files without an error anywhere."""
    if "error_message" not in chunks.columns:
        return chunks
    failed = chunks.where(F.col("error_message").isNotNull()).select("full_path").distinct()
    return (chunks.where(F.col("error_message").isNull()).drop("error_message")
            .join(failed, "full_path", "left_anti"))


def run_transcribe_audio(spark, payload_table: str, client, run_id: str, *,
                         limits: SizeLimits = SizeLimits(), run_ts=None, schema: str = "calls",
                         fanout: int = ra.DEFAULT_FANOUT, parallelism: int | None = None,
                         concurrency: int = 1) -> str:
    """Stage 2 for audio: every WAV chunk through the size guard and the
    client, reassembled per file in chunk order; all rows written.

    Stores answers, request log and blocks as :func:`run_transcribe` does.
    """
    started = time.time()
    chunks = readable(spark.table(payload_table)).withColumn(
        "_size", F.octet_length("payload").cast("long"))
    inferred = inference.infer_chunks(chunks, client, size_col="_size", limits=limits,
                                      parallelism=parallelism, concurrency=concurrency,
                                      full_errors=True)
    answers = _store_answers(spark, inferred, AUDIO_META_COLUMNS, run_id, run_ts, schema)
    return _audio_results(spark, answers, run_id, run_ts, schema, fanout, started)


def _audio_results(spark, answers: DataFrame, run_id: str, run_ts, schema: str, fanout: int,
                   started: float) -> str:
    from parley.sinks import writers
    # file_id is an attribute: different paths can share one.
    firsts = ["parent_folder", "filename", "file_id", "duration_seconds"]
    blocks_name = writers.stage_table_name(f"{schema}.transcription_blocks", run_id)
    writers.overwrite_stage(ra.reassemble(answers, ["full_path"], firsts=firsts, fanout=fanout,
                                          blocks_only=True, full_col="chunk_error_full"), blocks_name)
    merged = ra.join_blocks(spark.table(blocks_name), ["full_path"], firsts=firsts, full_errors=True)
    results = merged.select(*AUDIO_META_COLUMNS, "duration_seconds", "num_chunks",
                            "transcription_text", _ts(run_ts).alias("processing_timestamp"),
                            "error_message", "error_full")
    name = writers.stage_table_name(f"{schema}.transcription_results", run_id)
    writers.overwrite_stage(results, name)
    _record(spark, schema, "transcribe", run_id, started, spark.table(name))
    return name


def run_transcribe_throttled(spark, payload_table: str, client, run_id: str, folder: str, *,
                             send=None, limits: SizeLimits = SizeLimits(), run_ts=None,
                             schema: str = "calls", fanout: int = ra.DEFAULT_FANOUT,
                             concurrency: int = 1, every: str = "1 second",
                             timeout: float | None = None) -> str:
    """Stage 2 for audio within the endpoint's rate limit, with retries.

    ``folder`` (shared) keeps the stream's checkpoint and every attempt, so
    a job that is started again goes on where it was.  Refused chunks are
    sent again after a back-off, and after the last attempt end as errors.
    The request log has one row for each attempt.
    """
    from parley.sinks import writers
    from parley.streaming import throttle
    started, send = time.time(), send or throttle.SendLimits()
    folders = throttle.Folders(folder)
    chunks = f"{folder}/chunks"
    # written once: a stream reads files as they were when it first saw them
    readable(spark.table(payload_table)).write.mode("ignore").parquet(chunks)
    held = spark.read.parquet(chunks)
    query = throttle.start_sending(spark, chunks, held.schema, ["full_path", "chunk_idx"], client,
                                   folders, send=send, limits=limits, every=every,
                                   concurrency=concurrency)
    throttle.wait_for_all(query, spark, folders, held.count(), timeout)
    attempts = throttle.answers(spark, folders)
    log = inference.request_log(attempts, F.timestamp_millis("released_ms").cast("timestamp_ntz"),
                                [*AUDIO_META_COLUMNS, "attempt"])
    log.write.mode("overwrite").saveAsTable(writers.stage_table_name(f"{schema}.request_log", run_id))
    return _audio_results(spark, attempts.where("final"), run_id, run_ts, schema, fanout, started)
