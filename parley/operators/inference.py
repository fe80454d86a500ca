"""Batch inference over chunks with per-row error capture.

Plan: size guard (JVM columns) -> one ``mapInArrow`` that calls the
injected client only for rows the guard let through -> response decoding
(JVM columns).  The Python step is just the remote call; everything else
stays in whole-stage codegen.  Work is parallel per chunk, not per file.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import config
from parley.config import SizeLimits
from parley.functions import json as jfn
from parley.functions import text as tfn
from parley.functions.batches import batch_pieces

STATUS_EXCEPTION = -1
# A control character that no JSON text, header or message holds unescaped.
COUNT_MARK = "\x01"
NO_PAYLOAD = f"{config.EXCEPTION_PREFIX}chunk has no payload"
# A 200 response without a transcription (our code, not the endpoint's).
MODEL_ERROR_CODE = "MODEL_ERROR"


# --------------------------------------------------------------------------
# size guard
# --------------------------------------------------------------------------
def size_guard(size: Column, idx: Column, n: Column | None, limits: SizeLimits) -> Column:
    """Guard message or NULL.

    With ``n`` None the chunk count stands as ``COUNT_MARK`` in the message,
    to be filled in where the chunks of a recording meet anyway (see
    :func:`parley.operators.reassemble.reassemble`).

    ``CHUNK_TOO_LARGE: Chunk {i+1}/{n} is {MB} MB`` when the raw chunk is over
    the file limit, else ``PAYLOAD_TOO_LARGE: {MB} MB`` when the JSON request
    (base64 + envelope) is over the payload limit.
    """
    payload = tfn.payload_size(size, limits.envelope_bytes)
    too_large = config.CHUNK_TOO_LARGE_FORMAT
    if n is None:
        head, tail = too_large.split("/%d", 1)
        message = F.concat(F.format_string(head, idx + F.lit(1)), F.lit("/" + COUNT_MARK),
                           F.format_string(tail, tfn.format_mib(size)))
    else:
        message = F.format_string(too_large, idx + F.lit(1), n, tfn.format_mib(size))
    return (F.when(size > F.lit(limits.file_limit), message)
             .when(payload > F.lit(limits.max_payload_bytes),
                   F.format_string(config.PAYLOAD_TOO_LARGE_FORMAT, tfn.format_mib(payload))))


# --------------------------------------------------------------------------
# clients
# --------------------------------------------------------------------------
class HttpEndpointClient:
    """POST ``{"dataframe_records": [{"audio_base64": ...}]}`` to a serving URL.

    ``payload`` is raw audio bytes (or text, encoded as UTF-8).  Network
    failures raise and are captured per row by :func:`infer_chunks`.
    """

    def __init__(self, url: str, token: str | None = None, timeout: float = 300.0):
        self.url, self.token, self.timeout = url, token, timeout

    def __call__(self, payload) -> tuple[int, str]:
        import urllib.error
        import urllib.request

        raw = payload.encode("utf-8") if isinstance(payload, str) else bytes(payload)
        body = json.dumps({config.REQUEST_ENVELOPE: [
            {config.AUDIO_FIELD: base64.b64encode(raw).decode("ascii")}]}).encode("utf-8")
        headers = {"Content-Type": "application/json"}
        if self.token:
            headers["Authorization"] = f"Bearer {self.token}"
        req = urllib.request.Request(self.url, data=body, headers=headers, method="POST")
        try:
            with urllib.request.urlopen(req, timeout=self.timeout) as resp:
                return resp.status, resp.read().decode("utf-8", "replace")
        except urllib.error.HTTPError as e:  # non-2xx with a body
            return e.code, e.read().decode("utf-8", "replace")


# --------------------------------------------------------------------------
# the operator
# --------------------------------------------------------------------------
def _call_one(client: Client, payload) -> tuple[int, str]:
    try:
        s, b = client(payload)
        return int(s), b
    except Exception as e:  # row-level capture: job continues
        return STATUS_EXCEPTION, f"{config.EXCEPTION_PREFIX}{e}"


def _call_partition(client: Client, payload_col: str, guard_col: str, returned: list[str],
                    concurrency: int):
    def run(batches):
        pool = None
        if concurrency > 1:
            from concurrent.futures import ThreadPoolExecutor
            pool = ThreadPoolExecutor(max_workers=concurrency)
        try:
            # Requests, answers and their copies take a few times the payloads, so calls that
            # run one by one hold a piece of a batch; calls in flight together need all its rows.
            for batch in batches if pool else batch_pieces(batches, column=payload_col):
                status: list[int | None] = [None] * batch.num_rows
                body: list[str | None] = [None] * batch.num_rows
                guards = batch.column(guard_col).to_pylist()
                todo = [(i, p.as_py()) for i, p in enumerate(batch.column(payload_col))
                        if guards[i] is None and p.is_valid]
                calls = (pool.map(lambda ip: _call_one(client, ip[1]), todo) if pool
                         else (_call_one(client, p) for _, p in todo))
                for (i, _), (s, b) in zip(todo, calls, strict=True):
                    status[i], body[i] = s, b
                # Arrow columns pass through as they are, nulls beside large ids too
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in returned), pa.array(status, pa.int32()),
                     pa.array(body, pa.string())], [*returned, "_status", "_body"])
        finally:
            if pool:
                pool.shutdown(wait=True)
    return run


Client = Callable[[object], tuple[int, str]]


def infer_chunks(chunks: DataFrame, client: Client, *, payload_col: str = "payload",
                 size_col: str | None = None, idx_col: str = "chunk_idx",
                 n_col: str | None = "num_chunks", limits: SizeLimits = SizeLimits(),
                 keep_payload: bool = False, parallelism: int | None = None,
                 concurrency: int = 1, full_errors: bool = False,
                 exception_chars: int = config.PREPROCESS_ERROR_CHARS) -> DataFrame:
    """Call ``client`` once per chunk that passes the size guard.

    Adds ``status`` (int, NULL when not called), ``request_bytes``,
    ``chunk_text`` (NULL unless a transcription came back) and
    ``chunk_error`` (guard, endpoint, model or exception message).  A 200
    response whose transcription is JSON null, or that cannot be decoded,
    counts as a failed chunk, and so does a chunk without a payload.
    ``n_col`` None leaves the chunk count in guard messages open.
    ``full_errors`` adds ``chunk_error_full``, the same messages uncut.
    Filters placed before this operator are applied before any call;
    Catalyst cannot push them through the Python step.

    ``parallelism``: spread chunks round-robin over that many tasks before
    calling (a remote endpoint is latency-bound, so more concurrent callers
    than scan splits can pay off); the default keeps the input partitioning.
    ``concurrency``: requests in flight per task (a thread pool; results keep
    row order).  Size both against the endpoint's rate limit.
    """
    size = F.col(size_col) if size_col else tfn.byte_length(payload_col)
    count = F.col(n_col) if n_col else None
    guarded = chunks.withColumns({
        "request_bytes": tfn.payload_size(size, limits.envelope_bytes),
        "_guard": F.when(F.col(payload_col).isNull(), F.lit(NO_PAYLOAD)).otherwise(
            size_guard(size, F.col(idx_col), count, limits))})
    if parallelism:
        guarded = guarded.repartition(parallelism)
    # The payload goes to Python but only comes back when asked for: the
    # larger half of the Arrow traffic is avoided.
    passed = [f for f in guarded.schema.fields if keep_payload or f.name != payload_col]
    out_schema = T.StructType(passed + [
        T.StructField("_status", T.IntegerType(), True),
        T.StructField("_body", T.StringType(), True)])
    called = guarded.mapInArrow(
        _call_partition(client, payload_col, "_guard", [f.name for f in passed], concurrency),
        out_schema)
    ok = F.col("_status") == F.lit(200)
    parsed = F.col("_resp")
    decoded = jfn.transcription_of(parsed)
    text = F.when(ok & F.col("_malformed").isNull(), decoded)

    def error(whole: bool) -> Column:
        def cut(message: Column, chars: int) -> Column:
            return message if whole else F.left(message, F.lit(chars))
        model = F.coalesce(jfn.model_error_of(parsed), F.lit("null transcription"))
        return (F.when(F.col("_guard").isNotNull(), F.col("_guard"))
                .when(F.col("_status") == F.lit(STATUS_EXCEPTION),
                      cut(F.col("_body"), len(config.EXCEPTION_PREFIX) + exception_chars))
                .when(~ok, jfn.endpoint_error("_status", "_body", whole))
                .when(F.col("_malformed").isNotNull(), F.col("_malformed"))
                .when(jfn.has_envelope(parsed) & decoded.isNull(),
                      F.concat(F.lit(f"{config.ENDPOINT_ERROR_PREFIX}{MODEL_ERROR_CODE}"
                                     f"{config.ENDPOINT_ERROR_SEPARATOR}"),
                               cut(model, config.ENDPOINT_MESSAGE_CHARS))))
    errors = {"chunk_error": error(False)} | ({"chunk_error_full": error(True)} if full_errors else {})
    # Parse each 200 body once; every field below reads the parsed value.
    called = called.withColumns({"_resp": F.when(ok, jfn.parse_response("_body")),
                                 "_malformed": F.when(ok, jfn.malformed_response("_body"))})
    out = (called.withColumns({"status": F.col("_status"), "chunk_text": text, **errors})
                 .drop("_status", "_body", "_guard", "_resp", "_malformed"))
    return out


def request_log(inferred: DataFrame, run_ts: datetime | Column, key_cols=("file_id",)) -> DataFrame:
    """One log row per chunk: what an inference table records.

    Where the answers hold whole messages (``full_errors``), the log does too.
    """
    message = [F.col("chunk_error_full").alias("error")] if "chunk_error_full" in inferred.columns else []
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    outcome = (F.when(F.col("status").isNull(), F.lit("blocked"))
                .when(F.col("status") == F.lit(STATUS_EXCEPTION), F.lit("exception"))
                .when(F.col("chunk_error").isNotNull(), F.lit("failed"))
                .otherwise(F.lit("ok")))
    return inferred.select(ts.alias("request_ts"), *key_cols, "chunk_idx", "status",
                           "request_bytes", outcome.alias("outcome"), *message)
