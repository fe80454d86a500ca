"""Scaling probe: the call pipeline on the conversations table replicated
k times (fresh conversation ids per copy), timed per stage.

    python scripts/scale_probe.py /root/testdata/sf0.1 1 10 40

Replication only multiplies the given rows; it is a local check that time
grows with the data and nothing degrades (no hot task, no driver step).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    reps = [int(x) for x in sys.argv[2:]] or [1, 10, 40]
    from pyspark.sql import functions as F

    from parley.config import SizeLimits
    from parley.operators import enrich
    from parley.plans import pipeline, stand_ins
    from parley.session import build_session
    from parley.sources.tables import read_table

    spark = build_session()
    conv = read_table(spark, sf, "conversations")
    span = conv.agg(F.max("conv_id")).head()[0] + 1
    out = []
    for k in reps:
        big = (spark.range(k).crossJoin(conv)
               .select((F.col("conv_id") + F.col("id") * F.lit(span)).alias("conv_id"),
                       "turn", "role", "text")
               .repartition(8).cache())
        n = big.count()
        t0 = time.time()
        res = pipeline.transcribe_calls(big, stand_ins.EchoClient(1800),
                                        limits=SizeLimits(max_payload_bytes=2048),
                                        run_ts="2024-01-01 00:00:00")
        res.write.format("noop").mode("overwrite").save()
        t1 = time.time()
        gold = enrich.enrich(pipeline.to_transcripts(res, "2024-01-01 00:00:00"),
                             "2024-01-01 00:00:00")
        gold.write.format("noop").mode("overwrite").save()
        t2 = time.time()
        out.append({"copies": k, "turns": n, "transcribe_s": round(t1 - t0, 2),
                    "transcribe_and_enrich_s": round(t2 - t1, 2)})
        big.unpersist()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
