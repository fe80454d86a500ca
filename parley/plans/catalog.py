"""Registered queries and their independent SQL oracles.

Every query reads the given tables (whole tables, no id subsets or row
caps) and returns a lazy DataFrame.  The oracle for each is plain SQL
that DuckDB runs over the same parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley import config
from parley.config import ChunkSpec, SizeLimits
from parley.functions import json as jfn
from parley.functions import paths, pcm
from parley.functions import text as tfn
from parley.operators import central, enrich, evaluate, inference, reports, unsafe, upsert
from parley.plans import pipeline, stand_ins
from parley.sinks import writers
from parley.sources import recordings
from parley.sources.tables import read_table

# ---- fixed parameters of the registered queries ---------------------------
RUN_TS = "2024-02-01 00:00:00"          # run A (processing and ingestion)
RERUN_TS = "2024-02-02 00:00:00"        # run B
CALL_LIMITS = SizeLimits(max_payload_bytes=2048)            # file limit 1528 B
RERUN_LIMITS = SizeLimits(max_payload_bytes=260)            # file limit 194 B
CALL_REQUEST_LIMIT = 1800                                    # endpoint cap, JSON bytes
REFUSE_EVERY = 5                                             # 503 for texts of such lengths
DOC_SPEC = ChunkSpec(max_len=3000, overlap=15)
DOC_LIMITS = SizeLimits(max_payload_bytes=4096)             # file limit 3056 B
DOC_REQUEST_LIMIT = 4000
# Small limits belong to the error-path queries and the upsert's re-run; all
# other queries see whole texts under the production limits.
PRODUCTION = SizeLimits()
NO_CAP = 10 ** 12
# ----------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle.strip()
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def t(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, root, name)


# ---------------------------------------------------------------------------
# SQL building blocks (DuckDB dialect) shared by several oracles
# ---------------------------------------------------------------------------
def _mb(expr: str) -> str:
    return f"printf('%.2f', ({expr}) / 1048576.0)"


def _guard_sql(nbytes: str, idx: str, n: str, limits: SizeLimits, request_limit: int,
               chars: str | None = None) -> str:
    req = f"(4 * (({nbytes} + 2) // 3) + {limits.envelope_bytes})"
    return f"""CASE
      WHEN {nbytes} > {limits.file_limit}
        THEN printf('CHUNK_TOO_LARGE: Chunk %d/%d is %s MB', {idx} + 1, {n}, {_mb(nbytes)})
      WHEN {req} > {limits.max_payload_bytes}
        THEN printf('PAYLOAD_TOO_LARGE: %s MB', {_mb(req)})
      WHEN {req} > {request_limit}
        THEN 'ENDPOINT_ERROR: MAX_REQUEST_SIZE_EXCEEDED - '
             || left('Request size ' || {req} || ' exceeds the limit of {request_limit} bytes', 100)
      {f"WHEN {chars} % {REFUSE_EVERY} = 0 THEN 'ENDPOINT_ERROR: HTTP_503 - busy'" if chars else ""}
    END"""


def _call_results_sql(limits: SizeLimits, request_limit: int, run_ts: str,
                      where: str = "TRUE", table: str = "conversations", refuse: bool = False,
                      cut: int = config.FILE_ERROR_CHARS) -> str:
    """Stage-2 rows of the call pipeline, as a subquery."""
    guard = _guard_sql("strlen(text)", "turn", "n", limits, request_limit,
                       "length(text)" if refuse else None)
    return f"""(
  WITH c AS (
    SELECT conv_id, turn, text, count(*) OVER (PARTITION BY conv_id) AS n
    FROM {table} WHERE {where}),
  g AS (SELECT conv_id, turn, text, {guard} AS chunk_error FROM c)
  SELECT 'team_' || CAST(conv_id % 10 AS VARCHAR) AS parent_folder,
         printf('conversation_%03d.wav', conv_id) AS filename,
         '/recordings/team_' || CAST(conv_id % 10 AS VARCHAR) || '/'
           || printf('conversation_%03d.wav', conv_id) AS full_path,
         'team_' || CAST(conv_id % 10 AS VARCHAR) || '_'
           || printf('conversation_%03d_wav', conv_id) AS file_id,
         sum(length(text)) / 15.0 AS duration_seconds,
         CAST(count(*) AS INTEGER) AS num_chunks,
         string_agg(CASE WHEN chunk_error IS NULL THEN text END, ' ' ORDER BY turn) AS transcription_text,
         TIMESTAMP '{run_ts}' AS processing_timestamp,
         left(string_agg(chunk_error, '; ' ORDER BY turn), {cut}) AS error_message
  FROM g GROUP BY conv_id)"""


def _calls(spark, root, limits=CALL_LIMITS, request_limit=CALL_REQUEST_LIMIT, run_ts=RUN_TS,
           conv: DataFrame | None = None, refuse: int | None = REFUSE_EVERY, **options) -> DataFrame:
    """Calls on the error path: small limits, a request cap, a busy endpoint."""
    conv = conv if conv is not None else t(spark, root, "conversations")
    return pipeline.transcribe_calls(conv, stand_ins.EchoClient(request_limit, refuse_every=refuse),
                                     limits=limits, run_ts=run_ts, **options)


def _whole_calls(spark, root, conv: DataFrame | None = None) -> DataFrame:
    """Calls under the production limits: every turn's text is in."""
    return _calls(spark, root, PRODUCTION, None, conv=conv, refuse=None)


# ---------------------------------------------------------------------------
# transcription: inference per chunk, ordered reassembly, error capture
# ---------------------------------------------------------------------------
CALLS_P = _call_results_sql(PRODUCTION, NO_CAP, RUN_TS)
CALLS_A = _call_results_sql(CALL_LIMITS, CALL_REQUEST_LIMIT, RUN_TS, refuse=True)
CALLS_UNCUT = _call_results_sql(CALL_LIMITS, CALL_REQUEST_LIMIT, RUN_TS, refuse=True, cut=10 ** 9)


@register("transcribe_calls", f"SELECT * FROM {CALLS_P}")
def q_transcribe_calls(spark, root):
    return _whole_calls(spark, root)


def _ts(v: str):
    return pipeline._ts(v)


def _with_keys(inferred: DataFrame) -> DataFrame:
    return inferred.select("*", *recordings.call_keys())


# --- stage-2 derived outputs ---------------------------------------------------
@register("run_summary", f"""
SELECT count(*) AS total,
       count(*) FILTER (WHERE error_message IS NULL) AS success,
       count(*) FILTER (WHERE error_message IS NOT NULL) AS failed
FROM {CALLS_A}""")
def q_run_summary(spark, root):
    return reports.run_summary(_calls(spark, root))


@register("error_taxonomy", f"""
SELECT CASE WHEN contains(error_message, 'CHUNK_TOO_LARGE') THEN 'CHUNK_TOO_LARGE'
            WHEN contains(error_message, 'PAYLOAD_TOO_LARGE') THEN 'PAYLOAD_TOO_LARGE'
            WHEN contains(error_message, 'MAX_REQUEST_SIZE_EXCEEDED') THEN 'MAX_REQUEST_SIZE_EXCEEDED'
            ELSE 'OTHER' END AS error_type,
       count(*) AS count
FROM {CALLS_UNCUT} WHERE error_message IS NOT NULL GROUP BY 1 ORDER BY count DESC, error_type""")
def q_error_taxonomy(spark, root):
    return reports.error_taxonomy(_calls(spark, root, full_errors=True))


@register("stage_success", f"SELECT * FROM {CALLS_A} WHERE error_message IS NULL")
def q_stage_success(spark, root):
    return pipeline.successes(_calls(spark, root))


@register("error_rows", f"SELECT filename, error_message FROM {CALLS_A} WHERE error_message IS NOT NULL")
def q_error_rows(spark, root):
    return pipeline.failures(_calls(spark, root)).select("filename", "error_message")


@register("preview", f"SELECT filename, left(transcription_text, 100) AS preview FROM {CALLS_P}")
def q_preview(spark, root):
    return _whole_calls(spark, root).select("filename", tfn.preview("transcription_text").alias("preview"))


@register("request_log", f"""
WITH c AS (SELECT conv_id, turn, strlen(text) AS nbytes, length(text) AS chars,
                  4 * ((strlen(text) + 2) // 3) + 45 AS req FROM conversations)
SELECT TIMESTAMP '{RUN_TS}' AS request_ts,
       'team_' || CAST(conv_id % 10 AS VARCHAR) || '_' || printf('conversation_%03d_wav', conv_id) AS file_id,
       turn AS chunk_idx,
       CASE WHEN nbytes > {CALL_LIMITS.file_limit} OR req > {CALL_LIMITS.max_payload_bytes} THEN NULL
            WHEN req > {CALL_REQUEST_LIMIT} THEN 400 WHEN chars % {REFUSE_EVERY} = 0 THEN 503
            ELSE 200 END AS status,
       req AS request_bytes,
       CASE WHEN nbytes > {CALL_LIMITS.file_limit} OR req > {CALL_LIMITS.max_payload_bytes} THEN 'blocked'
            WHEN req > {CALL_REQUEST_LIMIT} OR chars % {REFUSE_EVERY} = 0 THEN 'failed'
            ELSE 'ok' END AS outcome
FROM c""")
def q_request_log(spark, root):
    inferred = pipeline.infer_calls(t(spark, root, "conversations"),
                                    stand_ins.EchoClient(CALL_REQUEST_LIMIT,
                                                         refuse_every=REFUSE_EVERY), CALL_LIMITS)
    return inference.request_log(_with_keys(inferred), _ts(RUN_TS))


# --- long recordings: chunk plan, chunk text, inference over overlaps --------
def _doc_chunks_sql(spec: ChunkSpec = DOC_SPEC) -> str:
    step = spec.step
    return f"""(
  WITH d AS (
    SELECT doc_id, text, lang, source, length(text) AS len,
           CASE WHEN length(text) <= {spec.max_len} THEN 1
                ELSE CAST(floor(length(text) / {step}) AS BIGINT) + 1 END AS n
    FROM documents)
  SELECT doc_id, text, lang, source, len, CAST(n AS INTEGER) AS num_chunks, i AS chunk_idx,
         i * {step} AS chunk_start, least(len, i * {step} + {spec.max_len}) AS chunk_end
  FROM d, unnest(range(n)) AS r(i))"""


DOC_CHUNKS = _doc_chunks_sql()


@register("chunk_plan", f"SELECT doc_id, num_chunks, chunk_idx, chunk_start, chunk_end FROM {DOC_CHUNKS}")
def q_chunk_plan(spark, root):
    docs = t(spark, root, "documents").select(
        "doc_id", F.char_length("text").cast("long").alias("len"))
    from parley.operators import chunking
    return chunking.plan_chunks(docs, "len", DOC_SPEC).select(
        "doc_id", "num_chunks", "chunk_idx", "chunk_start", "chunk_end")


@register("chunk_text", f"""
SELECT doc_id, chunk_idx, substring(text, chunk_start + 1, chunk_end - chunk_start) AS payload
FROM {DOC_CHUNKS}""")
def q_chunk_text(spark, root):
    return pipeline.chunk_documents(t(spark, root, "documents"), DOC_SPEC).select(
        "doc_id", "chunk_idx", "payload")


def _doc_results_sql(spec: ChunkSpec = DOC_SPEC, limits: SizeLimits = DOC_LIMITS,
                     request_limit: int = DOC_REQUEST_LIMIT) -> str:
    guard = _guard_sql("strlen(payload)", "chunk_idx", "num_chunks", limits, request_limit)
    return f"""(
  WITH c AS (SELECT doc_id, lang, source, len, num_chunks, chunk_idx,
                    substring(text, chunk_start + 1, chunk_end - chunk_start) AS payload
             FROM {_doc_chunks_sql(spec)}),
  g AS (SELECT *, {guard} AS chunk_error FROM c)
  SELECT source AS parent_folder, printf('doc_%d.wav', doc_id) AS filename,
         printf('/corpus/%s/%s/doc_%d.wav', lang, source, doc_id) AS full_path,
         source || '_' || printf('doc_%d_wav', doc_id) AS file_id,
         any_value(len) / 15.0 AS duration_seconds,
         CAST(count(*) AS INTEGER) AS num_chunks,
         string_agg(CASE WHEN chunk_error IS NULL THEN payload END, ' ' ORDER BY chunk_idx) AS transcription_text,
         TIMESTAMP '{RUN_TS}' AS processing_timestamp,
         left(string_agg(chunk_error, '; ' ORDER BY chunk_idx), 1000) AS error_message
  FROM g GROUP BY doc_id, lang, source)"""


@register("transcribe_documents", f"SELECT * FROM {_doc_results_sql(DOC_SPEC, PRODUCTION, NO_CAP)}")
def q_transcribe_documents(spark, root):
    return pipeline.transcribe_documents(t(spark, root, "documents"), stand_ins.EchoClient(),
                                         spec=DOC_SPEC, limits=PRODUCTION, run_ts=RUN_TS)


@register("preprocess_documents", f"""
WITH d AS (SELECT doc_id, lang, source, len, max(num_chunks) AS num_chunks,
                  string_agg(printf('{writers.CHUNK_ROOT}/%s_chunk%d.wav',
                                    source || '_' || printf('doc_%d_wav', doc_id), chunk_idx), '|'
                             ORDER BY chunk_idx) AS chunk_paths
           FROM {DOC_CHUNKS} GROUP BY ALL)
SELECT source AS parent_folder, printf('doc_%d.wav', doc_id) AS filename,
       printf('/corpus/%s/%s/doc_%d.wav', lang, source, doc_id) AS full_path,
       source || '_' || printf('doc_%d_wav', doc_id) AS file_id,
       len / 15.0 AS duration_seconds, num_chunks, chunk_paths,
       CAST(NULL AS VARCHAR) AS error_message,
       CAST(len(string_split(chunk_paths, '|')) AS INTEGER) AS decoded_chunks
FROM d""")
def q_preprocess_documents(spark, root):
    meta = writers.chunk_manifest(recordings.document_recordings(t(spark, root, "documents")),
                                  DOC_SPEC, chars_per_second=pipeline.CHARS_PER_SECOND)
    return meta.withColumn("decoded_chunks", F.size(tfn.decode_list("chunk_paths")))


# --- sizes, paths, inventory ----------------------------------------------------
@register("payload_size", f"""
SELECT doc_id, strlen(text) AS nbytes, 4 * ((strlen(text) + 2) // 3) AS base64_bytes,
       4 * ((strlen(text) + 2) // 3) + 45 AS payload_bytes,
       printf('%.2f', (4 * ((strlen(text) + 2) // 3) + 45) / 1048576.0) AS payload_mb,
       {_guard_sql("strlen(text)", "0", "1", DOC_LIMITS, 10**12)} AS guard
FROM documents""")
def q_payload_size(spark, root):
    d = t(spark, root, "documents").select("doc_id", tfn.byte_length("text").alias("nbytes"))
    return d.select("doc_id", "nbytes", tfn.base64_length("nbytes").alias("base64_bytes"),
                    tfn.payload_size("nbytes").alias("payload_bytes"),
                    tfn.format_mib(tfn.payload_size("nbytes")).alias("payload_mb"),
                    inference.size_guard(F.col("nbytes"), F.lit(0), F.lit(1), DOC_LIMITS).alias("guard"))


@register("inventory", """
SELECT count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS total_bytes,
       printf('%.1f', coalesce(sum(strlen(text)), 0) / 1048576.0) AS total_mb
FROM documents WHERE doc_id % 4 < 2""")
def q_inventory(spark, root):
    """Files of four kinds by id; two of them are audio."""
    kinds = F.array(*[F.lit(x) for x in (".wav", ".mp3", ".txt", ".WAV")])
    recs = recordings.document_recordings(t(spark, root, "documents"))
    recs = recs.withColumn("full_path", F.concat(
        F.replace("full_path", F.lit(".wav"), F.lit("")),
        F.element_at(kinds, (F.col("doc_id") % 4).cast("int") + 1)))
    return reports.inventory(recs, "full_path", "nbytes", suffixes=(".wav", ".mp3"))


@register("path_parts", """
SELECT page_id, url AS full_path, string_split(url, '/')[-1] AS filename,
       string_split(url, '/')[-2] AS parent_folder,
       regexp_replace(concat_ws('_', string_split(url, '/')[-2], string_split(url, '/')[-1]), '[/.]', '_', 'g') AS file_id,
       replace(url, 'https://', '') AS stripped
FROM pages""")
def q_path_parts(spark, root):
    recs = recordings.page_recordings(t(spark, root, "pages"))
    return recs.select("page_id", "full_path", "filename", "parent_folder", "file_id",
                       paths.strip_prefix("full_path", "https://").alias("stripped"))


_PAGE_PARTS = """(SELECT url AS full_path, string_split(url, '/')[-1] AS filename,
       string_split(url, '/')[-2] AS parent_folder,
       regexp_replace(concat_ws('_', string_split(url, '/')[-2], string_split(url, '/')[-1]), '[/.]', '_', 'g') AS file_id
FROM pages)"""


# Two ways to file the same parts: (source, a_b.wav) and (source_a, b.wav).
_FILED = """(SELECT CASE WHEN doc_id // 20 % 2 = 0 THEN source ELSE source || '_' || lang END AS parent_folder,
       CASE WHEN doc_id // 20 % 2 = 0 THEN lang || '_' ELSE '' END || CAST(doc_id % 7 AS VARCHAR) || '.wav' AS filename
FROM documents)"""


@register("file_id_collisions", f"""
SELECT regexp_replace(parent_folder || '_' || filename, '[/.]', '_', 'g') AS file_id,
       count(DISTINCT concat_ws('/', parent_folder, filename)) AS n_pairs,
       min(concat_ws('/', parent_folder, filename)) AS first_pair,
       max(concat_ws('/', parent_folder, filename)) AS last_pair
FROM {_FILED} GROUP BY 1 HAVING count(DISTINCT concat_ws('/', parent_folder, filename)) > 1""")
def q_file_id_collisions(spark, root):
    even = F.floor(F.col("doc_id") / 20) % 2 == 0
    number = F.concat((F.col("doc_id") % 7).cast("string"), F.lit(".wav"))
    files = t(spark, root, "documents").select(
        F.when(even, F.col("source")).otherwise(F.concat_ws("_", "source", "lang")).alias("parent_folder"),
        F.when(even, F.concat(F.col("lang"), F.lit("_"), number)).otherwise(number).alias("filename"))
    return reports.file_id_collisions(files.withColumn(
        "file_id", paths.file_id(F.col("parent_folder"), F.col("filename"))))


@register("upsert_dup_keys", f"""
SELECT parent_folder, filename, count(*) AS n_rows, count(DISTINCT full_path) AS n_full_path,
       min(full_path) AS first_full_path, max(full_path) AS last_full_path
FROM {_PAGE_PARTS} GROUP BY parent_folder, filename HAVING count(*) > 1""")
def q_upsert_dup_keys(spark, root):
    return upsert.duplicate_keys(recordings.page_recordings(t(spark, root, "pages")),
                                 ["parent_folder", "filename"], detail="full_path")


@register("pcm_quantize", """
SELECT vec_id, list_transform(embedding, lambda x: CAST(trunc(greatest(least(x * CAST(32767 AS FLOAT),
         CAST(32767 AS FLOAT)), CAST(-32768 AS FLOAT))) AS SMALLINT)) AS pcm
FROM embeddings""")
def q_pcm_quantize(spark, root):
    return t(spark, root, "embeddings").select("vec_id", pcm.pcm16("embedding").alias("pcm"))


@register("rate_limit_audit", """
SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end,
       count(*) AS calls, count(*) > 1 AS over_limit
FROM events GROUP BY ALL""")
def q_rate_limit_audit(spark, root):
    """One endpoint, one call a minute: the test events are sparse."""
    return reports.rate_audit(t(spark, root, "events").select("ts"), "ts", limit=1)


# Bodies of five kinds by event id: as given, cut off, without the field, of
# another type, null.
_PROPS_SQL = """CASE event_id % 5 WHEN 1 THEN left(props, length(props) - 1) WHEN 2 THEN '{"j": 1}'
       WHEN 3 THEN '{"k": "many"}' WHEN 4 THEN NULL ELSE props END"""


def _props(ev: DataFrame) -> DataFrame:
    kind = F.col("event_id") % 5
    body = (F.when(kind == 1, F.expr("left(props, length(props) - 1)"))
             .when(kind == 2, F.lit('{"j": 1}')).when(kind == 3, F.lit('{"k": "many"}'))
             .when(kind != 4, F.col("props")))
    return ev.select("event_id", body.alias("props"))


@register("parse_props", f"""
WITH e AS (SELECT event_id, {_PROPS_SQL} AS props FROM events)
SELECT event_id, CASE WHEN json_valid(props) THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CASE WHEN json_valid(props) IS NOT TRUE THEN 'EXCEPTION: malformed JSON'
            WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL
              THEN 'EXCEPTION: missing field k' END AS error_message
FROM e""")
def q_parse_props(spark, root):
    ev = _props(t(spark, root, "events"))
    parsed = ev.withColumns({"_p": F.from_json("props", "k INT"), "_ok": F.try_parse_json("props")})
    k = F.when(F.col("_ok").isNotNull(), F.col("_p.k"))
    return parsed.select("event_id", k.alias("k"), F.when(
        F.col("_ok").isNull(), F.lit("EXCEPTION: malformed JSON")).when(
        k.isNull(), F.lit("EXCEPTION: missing field k")).alias("error_message"))


# Analysis answers of five kinds by conversation and turn: complete, without a
# field, with a number, with a null, cut off.
@register("contract_violations", f"""
SELECT conv_id, turn, CASE (conv_id + turn) % 5 WHEN 0 THEN [] WHEN 1 THEN ['main_topics']
         WHEN 2 THEN ['speaker_2', 'conversation_summary'] WHEN 3 THEN ['speaker_1']
         ELSE [{", ".join(f"'{f}'" for f in jfn.ANALYSIS_FIELDS)}] END AS violations
FROM conversations""")
def q_contract_violations(spark, root):
    conv = t(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    kind = (F.col("conv_id") + F.col("turn")) % 5
    values = {"speaker_1": F.col("role"), "speaker_2": F.lit("other"), "main_topics": F.lit("a, b"),
              "conversation_tone": F.lit("casual"), "conversation_summary": F.col("text")}
    fields = {f: values[f].alias(f) for f in jfn.ANALYSIS_FIELDS}
    whole = F.to_json(F.struct(*fields.values()))
    without = F.to_json(F.struct(*[c for f, c in fields.items() if f != "main_topics"]))
    number = F.to_json(F.struct(*[F.col("turn").alias(f) if f in ("speaker_2", "conversation_summary")
                                  else c for f, c in fields.items()]))
    null = F.concat(F.lit('{"speaker_1": null, '), F.substring(F.to_json(F.struct(
        *[c for f, c in fields.items() if f != "speaker_1"])), F.lit(2), F.lit(2 ** 30)))
    answer = (F.when(kind == 0, whole).when(kind == 1, without).when(kind == 2, number)
               .when(kind == 3, null).otherwise(F.expr("left(whole, length(whole) - 1)")))
    answers = conv.withColumn("whole", whole).withColumn("answer", answer)
    return jfn.with_contract_violations(answers, "answer").select("conv_id", "turn", "violations")


# --- upsert ------------------------------------------------------------------
def _upsert_inputs(spark, root):
    conv = t(spark, root, "conversations")
    target = pipeline.to_transcripts(_whole_calls(spark, root, conv), RUN_TS)
    # distinct: one row per call on the build side, however many turns it has
    rerun_calls = conv.join(conv.filter(F.col("role") == "system").select("conv_id").distinct(),
                            "conv_id", "left_semi")
    source = _calls(spark, root, RERUN_LIMITS, CALL_REQUEST_LIMIT, RERUN_TS, conv=rerun_calls,
                    refuse=None)
    source = source.withColumn("ingestion_timestamp", _ts(RERUN_TS))
    return target, source


_TCOLS = ", ".join(pipeline.TRANSCRIPT_COLUMNS)
_UPSERT_CTE = f"""
WITH target AS (
  SELECT parent_folder, filename, full_path, duration_seconds, num_chunks, transcription_text,
         processing_timestamp, TIMESTAMP '{RUN_TS}' AS ingestion_timestamp
  FROM {CALLS_P}),
source AS (
  SELECT *, TIMESTAMP '{RERUN_TS}' AS ingestion_timestamp
  FROM {_call_results_sql(RERUN_LIMITS, CALL_REQUEST_LIMIT, RERUN_TS,
                          "conv_id IN (SELECT conv_id FROM conversations WHERE role = 'system')")})"""
_MERGED_SQL = f"""{_UPSERT_CTE},
merged AS (
  SELECT * FROM target t WHERE NOT EXISTS (
    SELECT 1 FROM source s WHERE s.parent_folder = t.parent_folder AND s.filename = t.filename)
  UNION ALL SELECT {_TCOLS} FROM source)"""


@register("upsert_basic", f"{_MERGED_SQL} SELECT * FROM merged")
def q_upsert_basic(spark, root):
    target, source = _upsert_inputs(spark, root)
    return upsert.merge_keyed(target, source, pipeline.KEYS)


@register("upsert_idempotent", f"{_MERGED_SQL} SELECT * FROM merged")
def q_upsert_idempotent(spark, root):
    target, source = _upsert_inputs(spark, root)
    once = upsert.merge_keyed(target, source, pipeline.KEYS)
    return upsert.merge_keyed(once, source, pipeline.KEYS)


@register("upsert_keep_good", f"""{_UPSERT_CTE},
eff AS (SELECT * FROM source s WHERE NOT (s.error_message IS NOT NULL AND EXISTS (
          SELECT 1 FROM target t WHERE s.parent_folder = t.parent_folder AND s.filename = t.filename)))
SELECT * FROM target t WHERE NOT EXISTS (
    SELECT 1 FROM eff s WHERE s.parent_folder = t.parent_folder AND s.filename = t.filename)
UNION ALL SELECT {_TCOLS} FROM eff""")
def q_upsert_keep_good(spark, root):
    target, source = _upsert_inputs(spark, root)
    return upsert.merge_keyed(target, source, pipeline.KEYS, on_error="keep_good")


@register("latest_calls", f"""{_MERGED_SQL}
SELECT filename, duration_seconds, left(transcription_text, 100) AS preview
FROM merged ORDER BY ingestion_timestamp DESC, parent_folder, filename LIMIT 5""")
def q_latest_calls(spark, root):
    target, source = _upsert_inputs(spark, root)
    merged = upsert.merge_keyed(target, source, pipeline.KEYS)
    top = reports.latest(merged, 5, "ingestion_timestamp")
    return top.select("filename", "duration_seconds", tfn.preview("transcription_text").alias("preview"))


@register("cluster_layout", f"{_MERGED_SQL} SELECT * FROM merged")
def q_cluster_layout(spark, root):
    target, source = _upsert_inputs(spark, root)
    return writers.clustered(upsert.merge_keyed(target, source, pipeline.KEYS), pipeline.KEYS)


@register("bounded_batch", """
SELECT printf('/corpus/%s/%s/doc_%d.wav', lang, source, doc_id) AS full_path, length(text) AS length,
       (SELECT count(*) FROM documents) - 100 AS remaining
FROM documents ORDER BY full_path LIMIT 100""")
def q_bounded_batch(spark, root):
    recs = recordings.document_recordings(t(spark, root, "documents"))
    return reports.bounded_batch(recs.select("full_path", "length"), 100)


# --- enrichment (gold) and evaluation ------------------------------------------
ENRICH_TS = "2024-02-03 00:00:00"


def _sq(s: str) -> str:
    return s.replace("'", "''")


# Some callers introduce themselves, some are rude: the test texts do neither.
_SPOKEN_SQL = """(SELECT conv_id, turn, role,
  CASE WHEN conv_id % 3 = 0 AND turn = 0 THEN 'My name is Anna. ' || text
       WHEN conv_id % 3 < 2 AND turn = 1 THEN 'This is Peter. ' || text
       WHEN conv_id % 4 = 1 THEN text || ' Pathetic worthless pathetic worthless pathetic worthless.'
       ELSE text END AS text FROM conversations)"""


def _spoken(conv: DataFrame) -> DataFrame:
    cid, turn, text = F.col("conv_id"), F.col("turn"), F.col("text")
    rude = " Pathetic worthless pathetic worthless pathetic worthless."
    said = (F.when((cid % 3 == 0) & (turn == 0), F.concat(F.lit("My name is Anna. "), text))
             .when((cid % 3 < 2) & (turn == 1), F.concat(F.lit("This is Peter. "), text))
             .when(cid % 4 == 1, F.concat(text, F.lit(rude))).otherwise(text))
    return conv.withColumn("text", said)


def _gold_sql() -> str:
    lex = ", ".join([f"('{_sq(k)}', {v}, 0)" for k, v in sorted(enrich.POSITIVE_TERMS.items())]
                    + [f"('{_sq(k)}', 0, {v})" for k, v in sorted(enrich.NEGATIVE_TERMS.items())])
    toks = r"regexp_split_to_array(lower({x}), '[^\p{{L}}]+')"
    return f"""
WITH tr AS (
  SELECT parent_folder, filename, full_path, duration_seconds, num_chunks, transcription_text,
         processing_timestamp, TIMESTAMP '{RUN_TS}' AS ingestion_timestamp
  FROM {_call_results_sql(PRODUCTION, NO_CAP, RUN_TS, table=_SPOKEN_SQL)}
  WHERE transcription_text IS NOT NULL),
lex(term, pw, nw) AS (VALUES {lex}),
tok AS (SELECT parent_folder, filename, unnest({toks.format(x="transcription_text")}) AS w FROM tr),
hits AS (
  SELECT tr.parent_folder, tr.filename,
         CAST(coalesce(sum(lex.pw), 0) AS INTEGER) AS pos_hits,
         CAST(coalesce(sum(lex.nw), 0) AS INTEGER) AS neg_hits
  FROM tr LEFT JOIN tok ON tok.parent_folder = tr.parent_folder AND tok.filename = tr.filename
          LEFT JOIN lex ON lex.term = tok.w
  GROUP BY tr.parent_folder, tr.filename),
lab AS (
  SELECT *, CASE WHEN pos_hits = 0 AND neg_hits = 0 THEN 'neutral'
                 WHEN pos_hits > 0 AND neg_hits > 0 AND pos_hits < neg_hits * 2
                      AND neg_hits < pos_hits * 2 THEN 'mixed'
                 WHEN pos_hits > neg_hits THEN 'positive' ELSE 'negative' END AS sentiment
  FROM hits),
ss AS (
  SELECT parent_folder, filename,
         list_filter(list_transform(regexp_extract_all(transcription_text, '{enrich.SENTENCE_PATTERN}'),
                                    lambda x: trim(x)), lambda x: x <> '') AS sents
  FROM tr),
s AS (SELECT parent_folder, filename, unnest(sents) AS sent, generate_subscripts(sents, 1) - 1 AS si FROM ss),
ct AS (
  SELECT parent_folder, filename, si,
         unnest(list_filter({toks.format(x="sent")}, lambda w: length(w) >= {enrich.CONTENT_MIN_LEN})) AS w
  FROM s),
tf AS (SELECT parent_folder, filename, w, count(*) AS c FROM ct GROUP BY ALL),
sc AS (
  SELECT s.parent_folder, s.filename, s.si, s.sent, coalesce(sum(tf.c), 0) AS score
  FROM s LEFT JOIN ct ON ct.parent_folder = s.parent_folder AND ct.filename = s.filename AND ct.si = s.si
         LEFT JOIN tf ON tf.parent_folder = ct.parent_folder AND tf.filename = ct.filename AND tf.w = ct.w
  GROUP BY s.parent_folder, s.filename, s.si, s.sent),
rk AS (SELECT *, row_number() OVER (PARTITION BY parent_folder, filename ORDER BY score DESC, si) AS rn FROM sc),
summ AS (
  SELECT parent_folder, filename,
         string_agg(sent, ' ' ORDER BY si) FILTER (WHERE rn <= {enrich.SUMMARY_SENTENCES}) AS summary,
         max(CASE WHEN rn = 1 THEN sent END) AS conversation_summary
  FROM rk GROUP BY parent_folder, filename),
topic AS (
  SELECT parent_folder, filename, string_agg(w, ', ' ORDER BY c DESC, w) AS main_topics
  FROM (SELECT *, row_number() OVER (PARTITION BY parent_folder, filename ORDER BY c DESC, w) AS rn FROM tf)
  WHERE rn <= {enrich.TOPIC_COUNT} GROUP BY parent_folder, filename),
feat AS (
  SELECT tr.parent_folder, tr.filename,
         length(transcription_text) - length(replace(transcription_text, '?', '')) AS q,
         len(list_filter({toks.format(x="transcription_text")}, lambda w: w <> '')) AS nw,
         len(ss.sents) AS ns,
         regexp_extract_all(transcription_text, '{_sq(enrich.NAME_INTRO_PATTERN)}', 1) AS names
  FROM tr JOIN ss ON ss.parent_folder = tr.parent_folder AND ss.filename = tr.filename),
gold AS (
  SELECT tr.*, lab.sentiment, summ.summary,
         coalesce(feat.names[1], 'Speaker 1') AS speaker_1,
         coalesce(list_filter(feat.names, lambda x: x <> feat.names[1])[1], 'Speaker 2') AS speaker_2,
         coalesce(topic.main_topics, '') AS main_topics,
         CASE WHEN lab.sentiment = 'negative' THEN 'tense'
              WHEN lab.sentiment = 'positive' THEN 'friendly'
              WHEN lab.sentiment = 'mixed' THEN 'mixed'
              WHEN feat.q >= {enrich.TONE_QUESTIONS} THEN 'inquisitive'
              WHEN feat.nw >= feat.ns * {enrich.TONE_FORMAL_WORDS} THEN 'formal'
              ELSE 'casual' END AS conversation_tone,
         summ.conversation_summary,
         TIMESTAMP '{ENRICH_TS}' AS enriched_timestamp
  FROM tr
  JOIN lab ON lab.parent_folder = tr.parent_folder AND lab.filename = tr.filename
  JOIN feat ON feat.parent_folder = tr.parent_folder AND feat.filename = tr.filename
  LEFT JOIN summ ON summ.parent_folder = tr.parent_folder AND summ.filename = tr.filename
  LEFT JOIN topic ON topic.parent_folder = tr.parent_folder AND topic.filename = tr.filename)"""


GOLD = _gold_sql()


def _transcripts_a(spark, root) -> DataFrame:
    conv = _spoken(t(spark, root, "conversations"))
    return pipeline.to_transcripts(_whole_calls(spark, root, conv), RUN_TS)


def _gold(spark, root) -> DataFrame:
    return enrich.enrich(_transcripts_a(spark, root), _ts(ENRICH_TS))


@register("sentiment", f"""{GOLD}
SELECT lab.parent_folder, lab.filename, pos_hits, neg_hits, sentiment FROM lab""")
def q_sentiment(spark, root):
    tr = _transcripts_a(spark, root).filter(F.col("transcription_text").isNotNull())
    return enrich.with_sentiment(tr, keep_scores=True).select(
        "parent_folder", "filename", "pos_hits", "neg_hits", "sentiment")


@register("sentiment_distribution", f"""{GOLD}
SELECT sentiment, count(*) AS count FROM gold GROUP BY sentiment ORDER BY count DESC, sentiment""")
def q_sentiment_distribution(spark, root):
    return reports.distribution(_gold(spark, root), "sentiment")


@register("summary", f"{GOLD} SELECT parent_folder, filename, summary FROM gold")
def q_summary(spark, root):
    return _gold(spark, root).select("parent_folder", "filename", "summary")


@register("enrich_gold", f"{GOLD} SELECT * FROM gold")
def q_enrich_gold(spark, root):
    return _gold(spark, root)


@register("tone_distribution", f"""{GOLD}
SELECT conversation_tone, count(*) AS count FROM gold GROUP BY 1 ORDER BY count DESC, conversation_tone""")
def q_tone_distribution(spark, root):
    tr = _transcripts_a(spark, root).filter(F.col("transcription_text").isNotNull())
    return reports.distribution(enrich.with_tone(tr), "conversation_tone")


@register("append_gold", f"""{GOLD}
SELECT parent_folder, filename, sentiment, summary, enriched_timestamp FROM gold
UNION ALL
SELECT parent_folder, filename, sentiment, summary, enriched_timestamp + INTERVAL 1 DAY FROM gold""")
def q_append_gold(spark, root):
    """The gold table after two runs: appending is not idempotent."""
    tr = _transcripts_a(spark, root)
    cols = ["parent_folder", "filename", "sentiment", "summary", "enriched_timestamp"]
    runs = [enrich.enrich(tr, _ts(ts)).select(*cols) for ts in (ENRICH_TS, "2024-02-04 00:00:00")]
    return runs[0].unionByName(runs[1])


_SCORES_SQL = f"""{GOLD},
sco AS (
  SELECT parent_folder, filename,
         list_filter(string_split(coalesce(main_topics, ''), ', '), lambda x: x <> '') AS tl,
         list_filter({r"regexp_split_to_array(lower(coalesce(summary, '')), '[^\p{L}]+')"}, lambda w: w <> '') AS sw
  FROM gold),
cov AS (
  SELECT parent_folder, filename,
         CASE WHEN len(tl) > 0 THEN len(list_filter(tl, lambda x: list_contains(sw, lower(x)))) / len(tl)
              ELSE 0.0 END AS cov,
         CASE WHEN len(list_filter(sw, lambda w: list_contains([{", ".join(f"'{w}'" for w in sorted(set(evaluate.DENY_TERMS)))}], w))) = 0
              THEN 1.0 ELSE 0.0 END AS safe
  FROM sco),
scores AS (
  SELECT parent_folder, filename, 'captures_main_topics' AS scorer, cov AS score, cov >= {evaluate.COVERAGE_PASS} AS passed FROM cov
  UNION ALL
  SELECT parent_folder, filename, 'safety' AS scorer, safe AS score, safe >= 1.0 AS passed FROM cov)"""


@register("eval_records", f"""{GOLD}
SELECT parent_folder, filename, MAP {{'transcript': transcription_text}} AS inputs, summary AS outputs FROM gold""")
def q_eval_records(spark, root):
    return evaluate.eval_records(_gold(spark, root))


@register("eval_scores", f"{_SCORES_SQL} SELECT * FROM scores")
def q_eval_scores(spark, root):
    return evaluate.score(_gold(spark, root))


@register("eval_metrics", f"""{_SCORES_SQL}
SELECT scorer, count(*) AS n_records, round(avg(score), 6) AS mean_score,
       count(*) FILTER (WHERE passed) AS n_passed,
       count(*) FILTER (WHERE passed) / count(*) AS pass_rate
FROM scores GROUP BY scorer""")
def q_eval_metrics(spark, root):
    return evaluate.metrics(evaluate.score(_gold(spark, root)))


@register("eval_sample", f"""{GOLD}
SELECT parent_folder, filename, MAP {{'transcript': transcription_text}} AS inputs, summary AS outputs
FROM gold ORDER BY md5(parent_folder || '/' || filename) LIMIT 10""")
def q_eval_sample(spark, root):
    return evaluate.hash_sample(evaluate.eval_records(_gold(spark, root)), 10)


@register("safety_vs_labels", f"""
WITH d AS (
  SELECT l.toxic,
         len(list_filter(regexp_split_to_array(lower(d.text), '[^\\p{{L}}]+'),
             lambda w: list_contains([{", ".join(f"'{w}'" for w in sorted(set(evaluate.DENY_TERMS)))}], w))) > 0 AS flagged
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
SELECT toxic, flagged, count(*) AS docs FROM d GROUP BY toxic, flagged""")
def q_safety_vs_labels(spark, root):
    docs = t(spark, root, "documents").select("doc_id", "text")
    labels = t(spark, root, "labels").select("doc_id", "toxic")
    flagged = docs.join(labels, "doc_id").select(
        "toxic", (evaluate.deny_hits(F.col("text")) > 0).alias("flagged"))
    return flagged.groupBy("toxic", "flagged").agg(F.count(F.lit(1)).alias("docs"))


@register("central_summary", central.summary_sql("documents", "doc_id", "text"))
def q_central_summary(spark, root):
    docs = t(spark, root, "documents").select("doc_id", "text")
    return central.with_central_summary(docs, "text").select("doc_id", "summary", "lead_weight")


_UNSAFE_SQL = unsafe.unsafe_sql("documents", "doc_id", "text")


@register("unsafe_terms", _UNSAFE_SQL)
def q_unsafe_terms(spark, root):
    docs = t(spark, root, "documents").select("doc_id", "text")
    return unsafe.with_unsafe_terms(docs, "text").select("doc_id", "n_hits", "terms")


@register("unsafe_vs_labels", f"""
SELECT toxic, n_hits > 0 AS flagged, count(*) AS docs
FROM labels JOIN ({_UNSAFE_SQL}) USING (doc_id) GROUP BY ALL""")
def q_unsafe_vs_labels(spark, root):
    """The labelled documents by label and by whether they hold an unsafe term."""
    labels = t(spark, root, "labels").select("doc_id", "toxic")
    found = q_unsafe_terms(spark, root).join(labels, "doc_id")
    return (found.groupBy("toxic", (F.col("n_hits") > 0).alias("flagged"))
                 .agg(F.count(F.lit(1)).alias("docs")))


# --- audio: embeddings read as 8 kHz recordings -> 16 kHz chunks ---------------
AUDIO_SPEC = ChunkSpec(max_len=5, overlap=1)     # milliseconds


# Samples of a vector read at 8 kHz, and at 16 kHz by linear interpolation.
_AUDIO_SQL = """
WITH a AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(trunc(greatest(least(x * CAST(32767 AS FLOAT),
           CAST(32767 AS FLOAT)), CAST(-32768 AS FLOAT))) AS INTEGER)) AS s FROM embeddings),
u AS (
  SELECT vec_id, label, 2 * len(s) AS n_out, list_transform(range(2 * len(s)), lambda k:
           CAST(CASE WHEN k % 2 = 0 OR k = 2 * len(s) - 1 THEN s[k // 2 + 1]
                ELSE round_even((s[k // 2 + 1] + s[k // 2 + 2]) / 2.0, 0) END AS INTEGER)) AS x FROM a),
b AS (
  SELECT *, CAST(round(n_out / 16.0) AS BIGINT) AS length_ms FROM u),
c AS (
  SELECT *, CASE WHEN length_ms <= {max_len} THEN 1
                 ELSE CAST(floor(length_ms / {step}) AS BIGINT) + 1 END AS n FROM b),
k AS (
  SELECT vec_id, label, length_ms, n, i AS chunk_idx, i * {step} AS chunk_start,
         least(length_ms, i * {step} + {max_len}) AS chunk_end,
         x[i * {step} * 16 + 1 : least(length_ms, i * {step} + {max_len}) * 16] AS part
  FROM c, unnest(range(n)) AS r(i))""".replace("{max_len}", str(AUDIO_SPEC.max_len)).replace(
    "{step}", str(AUDIO_SPEC.step))


@register("audio_chunks", f"""{_AUDIO_SQL}
SELECT vec_id, printf('vec_%d.wav', vec_id) AS filename, printf('label_%d', label) AS parent_folder,
       8000 AS source_rate, length_ms, CAST(n AS INTEGER) AS num_chunks, chunk_idx, chunk_start, chunk_end,
       array_to_string(list_transform(part, lambda v: printf('%02X%02X', v & 255, (v >> 8) & 255)), '') AS samples
FROM k""")
def q_audio_chunks(spark, root):
    from parley.sources import audio
    recs = recordings.embedding_recordings(t(spark, root, "embeddings"))
    chunks = audio.audio_chunks(audio.normalize_audio(recs), AUDIO_SPEC)
    return chunks.select("vec_id", "filename", "parent_folder", "source_rate", "length_ms",
                         "num_chunks", "chunk_idx", "chunk_start", "chunk_end",
                         F.hex(F.substring("wav", F.lit(45), F.octet_length("wav"))).alias("samples"))


# Made of the contract's fields; a caller brings its own instruction.
PROMPT = f"Answer as JSON with the fields {', '.join(jfn.ANALYSIS_FIELDS)}.\n\n"


@register("build_prompt", f"""
SELECT parent_folder, filename, '{_sq(PROMPT)}' || transcription_text AS prompt
FROM {CALLS_P} WHERE transcription_text IS NOT NULL""")
def q_build_prompt(spark, root):
    res = _whole_calls(spark, root).filter(F.col("transcription_text").isNotNull())
    return res.select("parent_folder", "filename",
                      tfn.build_prompt("transcription_text", PROMPT).alias("prompt"))


# --- response / error envelopes built from the tables, then decoded -----------
# 200 bodies of eleven kinds by conversation and turn.
def _response_bodies(conv: DataFrame) -> DataFrame:
    rec = F.struct(F.col("text").alias("transcription"))
    empty = F.struct(F.col("role").alias("speaker"))
    kind = (F.col("conv_id") + F.col("turn")) % 11
    bodies = [F.to_json(F.struct(F.array(rec).alias("predictions"))),
              F.to_json(F.struct(F.array(rec).alias("dataframe_records"))),
              F.to_json(F.struct(F.array(empty).alias("predictions"))),
              F.concat(F.lit("<html>"), F.col("role"), F.lit("</html>")),
              F.expr("left(to_json(named_struct('predictions', array(named_struct('t', text)))), 20)"),
              F.lit("[1]"), F.to_json(F.struct(F.array("text").alias("predictions"))),
              F.to_json(F.struct(rec.alias("predictions"))), F.lit(None).cast("string"),
              F.lit('{"predictions": []}'),
              F.lit('{"predictions": [{"transcription": null, "error": "decoder failed"}]}')]
    body = F.when(kind == 0, bodies[0])
    for i, b in enumerate(bodies[1:], 1):
        body = body.when(kind == i, b)
    return conv.select("conv_id", "turn", body.alias("payload"))


class _Replay:
    """Answers 200 with the body that the payload holds; ``<none>`` stands for no body."""

    def __call__(self, payload):
        return 200, None if payload == "<none>" else payload


@register("response_decode", f"""
WITH r AS (SELECT conv_id, turn, text, (conv_id + turn) % 11 AS kind FROM conversations)
SELECT conv_id, turn,
       CASE WHEN kind IN (0, 1) THEN text WHEN kind = 2 THEN '' END AS transcription,
       CASE WHEN kind IN (3, 4, 8) THEN 'EXCEPTION: response is not JSON'
            WHEN kind IN (6, 7, 9) THEN 'EXCEPTION: malformed response envelope'
            WHEN kind = 10 THEN 'ENDPOINT_ERROR: {inference.MODEL_ERROR_CODE} - decoder failed' END AS error,
       CASE WHEN kind IN (0, 1, 2, 5) THEN 'ok' ELSE 'failed' END AS outcome
FROM r""")
def q_response_decode(spark, root):
    bodies = _response_bodies(t(spark, root, "conversations")).withColumn(
        "payload", F.coalesce("payload", F.lit("<none>"))).withColumnRenamed("turn", "chunk_idx")
    inferred = inference.infer_chunks(bodies, _Replay(), n_col=None)
    log = inference.request_log(inferred, _ts(RUN_TS), ["conv_id", "chunk_text", "chunk_error"])
    return log.select("conv_id", F.col("chunk_idx").alias("turn"),
                      F.col("chunk_text").alias("transcription"), F.col("chunk_error").alias("error"),
                      "outcome")


@register("error_decode", """
SELECT event_id,
       CASE WHEN event_type = 'error'
              THEN 'ENDPOINT_ERROR: HTTP_503 - ' || left('upstream ' || CAST(user_id AS VARCHAR) || ' unavailable', 100)
            WHEN event_type = 'signup'
              THEN 'ENDPOINT_ERROR: UNKNOWN - ' || left('rejected ' || props, 100)
            ELSE 'ENDPOINT_ERROR: ' || upper(event_type) || '_FAILED - '
                 || left('value ' || printf('%.2f', value), 100) END AS error
FROM events""")
def q_error_decode(spark, root):
    ev = t(spark, root, "events").select("event_id", "event_type", "user_id", "value", "props")
    status = F.when(F.col("event_type") == "error", F.lit(503)).otherwise(F.lit(400))
    body = (F.when(F.col("event_type") == "error",
                   F.concat(F.lit("upstream "), F.col("user_id").cast("string"), F.lit(" unavailable")))
             .when(F.col("event_type") == "signup",
                   F.to_json(F.struct(F.concat(F.lit("rejected "), F.col("props")).alias("message"))))
             .otherwise(F.to_json(F.struct(
                 F.concat(F.upper("event_type"), F.lit("_FAILED")).alias("error_code"),
                 F.format_string("value %.2f", F.col("value")).alias("message")))))
    return ev.select("event_id", jfn.endpoint_error(status, body).alias("error"))


@register("latest_per_call", f"""{_UPSERT_CTE},
both_runs AS (
  SELECT parent_folder, filename, full_path, duration_seconds, num_chunks, transcription_text,
         processing_timestamp, error_message
  FROM {CALLS_P}
  UNION ALL
  SELECT parent_folder, filename, full_path, duration_seconds, num_chunks, transcription_text,
         processing_timestamp, error_message FROM source)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY parent_folder, filename
                               ORDER BY processing_timestamp DESC) AS rn FROM both_runs)
WHERE rn = 1""")
def q_latest_per_call(spark, root):
    """Two runs' rows for the same calls, one row per call: the latest run
    wins (how a stream resolves a key seen twice in one micro-batch)."""
    _, source = _upsert_inputs(spark, root)
    cols = ["parent_folder", "filename", "full_path", "duration_seconds", "num_chunks",
            "transcription_text", "processing_timestamp", "error_message"]
    both = _whole_calls(spark, root).select(*cols).unionByName(source.select(*cols))
    return upsert.latest_per_key(both, pipeline.KEYS, "processing_timestamp")


# Small chunks under a tight size cap: long recordings collect many chunk
# errors, so the per-file message reaches the 1000-character cut.
TIGHT_SPEC = ChunkSpec(max_len=500, overlap=10)
TIGHT_LIMITS = SizeLimits(max_payload_bytes=700)            # file limit 522 B


@register("error_truncate", f"""
SELECT file_id, num_chunks, error_message, length(error_message) AS error_chars,
       length(transcription_text) AS text_chars
FROM {_doc_results_sql(TIGHT_SPEC, TIGHT_LIMITS, DOC_REQUEST_LIMIT)}""")
def q_error_truncate(spark, root):
    res = pipeline.transcribe_documents(t(spark, root, "documents"),
                                        stand_ins.EchoClient(DOC_REQUEST_LIMIT), spec=TIGHT_SPEC,
                                        limits=TIGHT_LIMITS, run_ts=RUN_TS)
    return res.select("file_id", "num_chunks", "error_message",
                      F.char_length("error_message").cast("long").alias("error_chars"),
                      F.char_length("transcription_text").cast("long").alias("text_chars"))


def _resample_sql(rate: int, target: int) -> str:
    """Windowed-sinc weights for each phase, and every output as an exact integer sum of samples."""
    from math import ceil

    from parley.functions import resample as rs
    r = rs.Resampler(rate, target)
    cutoff = 1.0 if r.up >= r.down else rs.ROLLOFF * r.up / r.down
    half, one = ceil(rs.ZEROS / cutoff), 1 << rs.BITS
    window = " + ".join(f"{a} * cos({k} * turn)" for k, a in enumerate(rs.WINDOW))
    return f"""
WITH a AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(trunc(greatest(least(x * CAST(32767 AS FLOAT),
           CAST(32767 AS FLOAT)), CAST(-32768 AS FLOAT))) AS BIGINT)) AS s FROM embeddings),
taps AS (
  SELECT phase, k, k - phase / {r.up}.0 AS d, pi() * (k - phase / {r.up}.0) / {half} AS turn
  FROM range({r.up}) p(phase), range({1 - half}, {half + 1}) q(k)),
raw AS (
  SELECT phase, k, CAST(round_even(CASE WHEN abs(d) > {half} THEN 0 ELSE {cutoff!r}
           * CASE WHEN d = 0 THEN 1 ELSE sin(pi() * {cutoff!r} * d) / (pi() * {cutoff!r} * d) END
           * ({window}) END * {one}, 0) AS BIGINT) AS w FROM taps),
weights AS (
  SELECT phase, k, w + CASE WHEN k = 0 THEN {one} - sum(w) OVER (PARTITION BY phase) ELSE 0 END AS w
  FROM raw),
outputs AS (
  SELECT vec_id, s, unnest(range(CAST(round_even(len(s) * {r.up} / {r.down}.0, 0) AS BIGINT))) AS n FROM a),
sums AS (
  SELECT vec_id, n, sum(CAST(s[least(greatest(n * {r.down} // {r.up} + k, 0), len(s) - 1) + 1] AS HUGEINT)
                        * {one >> 15} * w) AS total
  FROM outputs JOIN weights ON phase = (n * {r.down}) % {r.up} GROUP BY vec_id, n),
samples AS (
  SELECT vec_id, n, CAST(greatest(least(floor((total + {1 << (2 * rs.BITS - 16)})
           / {1 << (2 * rs.BITS - 15)}.0), 32767), -32768) AS BIGINT) AS v FROM sums)
SELECT vec_id, count(*) AS frames,
       string_agg(printf('%02X%02X', v & 255, (v >> 8) & 255), '' ORDER BY n) AS samples
FROM samples GROUP BY vec_id"""


RESAMPLE_RATE = 24_000


@register("audio_resample", _resample_sql(RESAMPLE_RATE, config.TARGET_SAMPLE_RATE))
def q_audio_resample(spark, root):
    """Embedding vectors as 24 kHz recordings, low-pass filtered to 16 kHz."""
    from parley.sources import audio
    recs = recordings.embedding_recordings(t(spark, root, "embeddings"), RESAMPLE_RATE)
    return audio.normalize_audio(recs, method="sinc").select(
        "vec_id", (F.octet_length("pcm") / 2).cast("long").alias("frames"), F.hex("pcm").alias("samples"))


@register("transcribe_audio", f"""{_AUDIO_SQL}
SELECT printf('/embeddings/label_%d/vec_%d.wav', label, vec_id) AS full_path,
       printf('label_%d', label) || '_' || printf('vec_%d_wav', vec_id) AS file_id,
       CAST(count(*) AS INTEGER) AS num_chunks,
       string_agg('frames ' || len(part) || ' sum ' || CAST(coalesce(list_sum(part), 0) AS BIGINT), ' '
                  ORDER BY chunk_idx) AS transcription_text,
       CAST(NULL AS VARCHAR) AS error_message
FROM k GROUP BY vec_id, label""")
def q_transcribe_audio(spark, root):
    """Embedding vectors as recordings: normalise, chunk into WAVs, send each
    chunk through the guard and a WAV-reading stand-in, reassemble by path."""
    from parley.operators import reassemble as ra
    from parley.sources import audio
    recs = recordings.embedding_recordings(t(spark, root, "embeddings"))
    chunks = audio.audio_chunks(audio.normalize_audio(recs), AUDIO_SPEC).select(
        "full_path", "file_id", "num_chunks", "chunk_idx", F.col("wav").alias("payload"))
    inferred = inference.infer_chunks(chunks, stand_ins.WavSumClient(), limits=PRODUCTION)
    return ra.reassemble(inferred, ["full_path"], firsts=["file_id"]).select(
        "full_path", "file_id", "num_chunks", "transcription_text", "error_message")
