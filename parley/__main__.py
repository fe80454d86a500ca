"""Command line: the pipeline stages as jobs.

    python -m parley preprocess-audio --root /data/calls --run-id 20240101
    python -m parley preprocess-calls --conversations /data/calls.parquet --run-id 20240101
    python -m parley transcribe --payloads calls.chunk_payloads_20240101 \
        --endpoint https://host/serving/asr --token-env ASR_TOKEN --run-id 20240101
    python -m parley merge --results calls.transcription_results_20240101 \
        --target calls.call_transcriptions --cleanup calls.chunk_payloads_20240101
    python -m parley enrich --source calls.call_transcriptions --gold calls.enriched \
        --eval calls.eval_metrics
    python -m parley report errors --table calls.transcription_results_20240101
    python -m parley report sentiment --table calls.enriched

The session comes from ``spark-submit`` / the cluster; nothing here sets
cluster configuration.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="parley")
    sub = p.add_subparsers(dest="cmd", required=True)

    a = sub.add_parser("preprocess-audio", help="discover, normalise and chunk audio files")
    a.add_argument("--root", required=True)
    a.add_argument("--run-id", required=True)
    a.add_argument("--schema", default="calls")
    a.add_argument("--max-files", type=int)
    a.add_argument("--chunk-ms", type=int, default=300_000)
    a.add_argument("--overlap-ms", type=int, default=1_500)

    a.add_argument("--split-bytes", type=int, default=128 << 20, help="bytes of audio a task reads")
    a.add_argument("--chunk-root", help="also write every chunk as a file under this folder")

    c = sub.add_parser("preprocess-calls", help="list the turns of recorded calls as chunks")
    c.add_argument("--conversations", required=True, help="Parquet path of the calls")
    c.add_argument("--run-id", required=True)
    c.add_argument("--schema", default="calls")

    t = sub.add_parser("transcribe", help="send chunks to a speech endpoint, reassemble per file")
    t.add_argument("--payloads", required=True)
    t.add_argument("--endpoint", required=True)
    t.add_argument("--token-env", help="name of the environment variable holding the token")
    t.add_argument("--run-id", required=True)
    t.add_argument("--schema", default="calls")
    t.add_argument("--timeout", type=float, default=300.0)
    t.add_argument("--parallelism", type=int)
    t.add_argument("--concurrency", type=int, default=1)
    t.add_argument("--text", action="store_true", help="the chunks are turns of recorded calls")
    t.add_argument("--throttle", metavar="FOLDER",
                   help="keep to the rate limit and retry, with this shared folder for the state")
    t.add_argument("--calls-per-minute", type=int, default=1000)
    t.add_argument("--attempts", type=int, default=5)

    m = sub.add_parser("merge", help="upsert stage results into the transcripts table")
    m.add_argument("--results", required=True)
    m.add_argument("--target", required=True)
    m.add_argument("--keep-good", action="store_true",
                   help="a failed re-run never replaces an existing transcript")
    m.add_argument("--cleanup", nargs="*", default=[])

    e = sub.add_parser("enrich", help="sentiment, summary, analysis; score; append to gold")
    e.add_argument("--source", required=True)
    e.add_argument("--gold", required=True)
    e.add_argument("--eval")
    e.add_argument("--central-summary", action="store_true", help="summaries by sentence centrality")
    e.add_argument("--corpus-topics", action="store_true", help="topics by phrases between heavy terms")

    r = sub.add_parser("report", help="print a report")
    r.add_argument("kind", choices=["errors", "sentiment", "summary"])
    r.add_argument("--table", required=True)
    r.add_argument("--rows", type=int, default=20)
    return p


def main(argv=None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"parley-{args.cmd}").getOrCreate()
    from parley.config import ChunkSpec
    from parley.operators import inference, reports
    from parley.plans import pipeline
    now = datetime.now(tz=timezone.utc).replace(tzinfo=None)

    if args.cmd == "preprocess-audio":
        meta, payloads = pipeline.run_preprocess_audio(
            spark, args.root, args.run_id, spec=ChunkSpec(args.chunk_ms, args.overlap_ms),
            max_files=args.max_files, schema=args.schema, split_bytes=args.split_bytes,
            chunk_root=args.chunk_root)
        print(f"metadata: {meta}\npayloads: {payloads}")
    elif args.cmd == "preprocess-calls":
        calls = spark.read.parquet(args.conversations)
        print(f"chunks: {pipeline.run_preprocess_calls(spark, calls, args.run_id, args.schema)}")
    elif args.cmd == "transcribe":
        token = os.environ.get(args.token_env) if args.token_env else None
        client = inference.HttpEndpointClient(args.endpoint, token, args.timeout)
        if args.text:
            name = pipeline.run_transcribe(spark, args.payloads, client, args.run_id, run_ts=now,
                                           schema=args.schema, parallelism=args.parallelism)
        elif args.throttle:
            from parley.streaming.throttle import SendLimits
            name = pipeline.run_transcribe_throttled(
                spark, args.payloads, client, args.run_id, args.throttle, run_ts=now,
                send=SendLimits(calls=args.calls_per_minute, attempts=args.attempts,
                                lanes=min(16, args.calls_per_minute)),
                schema=args.schema, concurrency=args.concurrency)
        else:
            name = pipeline.run_transcribe_audio(spark, args.payloads, client, args.run_id, run_ts=now,
                                                 schema=args.schema, parallelism=args.parallelism,
                                                 concurrency=args.concurrency)
        print(f"results: {name}")
    elif args.cmd == "merge":
        pipeline.run_merge(spark, args.results, args.target, ingestion_ts=now,
                           on_error="keep_good" if args.keep_good else "overwrite",
                           cleanup=args.cleanup)
        print(f"merged into {args.target}")
    elif args.cmd == "enrich":
        n = pipeline.run_enrich(spark, args.source, args.gold, run_ts=now, eval_table=args.eval,
                                central_summary=args.central_summary, corpus_topics=args.corpus_topics)
        print("no records to process" if n == 0 else f"enriched {args.gold} from {n} records")
    elif args.cmd == "report":
        df = spark.table(args.table)
        if args.kind == "errors":
            reports.run_summary(df).show()
            reports.error_taxonomy(df).show(args.rows, truncate=False)
            (df.filter(F.col("error_message").isNotNull()).select("filename", "error_message")
               .orderBy("filename").show(5, truncate=100))
        elif args.kind == "sentiment":
            reports.distribution(df, "sentiment").show(args.rows)
        else:
            df.select("filename", "duration_seconds", F.left("transcription_text", F.lit(100))
                      .alias("preview")).orderBy("filename").show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
