import json
import os
import sys
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from parley.config import SizeLimits
from parley.plans import stand_ins
from parley.streaming import throttle
from parley.streaming.throttle import Folders, SendLimits


class Refusing:
    """Notes the time of every call in a file, refuses each chunk some times."""

    def __init__(self, log: str):
        self.log = log

    def __call__(self, payload):
        seen = os.path.join(self.log, payload.split()[0])
        tries = len(os.listdir(seen)) if os.path.isdir(seen) else 0
        os.makedirs(seen, exist_ok=True)
        with open(os.path.join(seen, str(time.time_ns())), "w"):
            pass
        refusals = int(payload.split()[1])
        if tries < refusals:
            return 429, json.dumps({"error_code": "REQUEST_LIMIT_EXCEEDED", "message": "later"})
        return 200, json.dumps({"predictions": [{"transcription": payload.upper()}]})


def _call_times(log):
    return sorted(int(t) // 1_000_000 for _, _, names in os.walk(log) for t in names)


def _most_in(times, window_ms):
    return max(sum(t <= u < t + window_ms for u in times) for t in times)


@pytest.fixture
def small_state(spark):
    """Few state partitions: the test has four lanes."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _write(spark, path, rows):
    spark.createDataFrame(rows, "call string, chunk_idx int, payload string").repartition(2).write.mode(
        "append").parquet(path)


def test_limit_retries_dead_letters_and_restart(small_state):
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark = small_state
    base = tempfile.mkdtemp(prefix="parley-send-")
    chunks, log, folders = f"{base}/chunks", f"{base}/log", Folders(f"{base}/job")
    os.makedirs(log)
    # refusals: none for most, two for every 5th, more than the attempts for the 7th
    rows = [(f"c{i // 4}", i % 4, f"k{i} {9 if i == 7 else 2 if i % 5 == 0 else 0} words") for i in range(24)]
    rows.append(("big", 0, "k99 0 " + "x" * 5000))          # too large: guarded, never called
    _write(spark, chunks, rows[:18])
    schema = spark.read.parquet(chunks).schema
    send = SendLimits(calls=6, window_ms=4_000, lanes=2, attempts=3, backoff_ms=500)
    args = (spark, chunks, schema, ["call", "chunk_idx"], Refusing(log), folders)
    options = {"send": send, "limits": SizeLimits(max_payload_bytes=4096), "every": "300 milliseconds"}

    query = throttle.start_sending(*args, **options)
    deadline = time.time() + 45
    while len(_call_times(log)) < 8 and time.time() < deadline:
        time.sleep(0.1)
    query.stop()                                             # in the middle
    first = _call_times(log)
    assert 8 <= len(first) < 30
    _write(spark, chunks, rows[18:])                         # more work arrives meanwhile
    query = throttle.start_sending(*args, **options)
    throttle.wait_for_all(query, spark, folders, len(rows), timeout=240, poll=0.5)

    got = throttle.answers(spark, folders)
    final = got.where("final").collect()
    assert sorted((r["call"], r["chunk_idx"]) for r in final) == sorted((c, i) for c, i, _ in rows)
    by_key = {(r["call"], r["chunk_idx"]): r for r in final}
    for call, idx, payload in rows:
        r, (name, refusals) = by_key[call, idx], payload.split()[:2]
        if call == "big":
            assert r["chunk_error"].startswith("CHUNK_TOO_LARGE") and r["status"] is None
        elif int(refusals) >= send.attempts:                 # a dead letter
            assert r["attempt"] == 3 and r["chunk_text"] is None
            assert "REQUEST_LIMIT_EXCEEDED" in r["chunk_error"]
        else:
            assert r["chunk_text"] == payload.upper() and r["chunk_error"] is None
    assert got.where("NOT final").where(F.col("chunk_error").isNull()).count() == 0
    times = _call_times(log)
    assert _most_in(times, send.window_ms) <= send.calls     # in every window, also over the restart
    assert len(times) >= len(rows) - 1 + 2 * sum(r[2].split()[1] == "2" for r in rows)


def test_quota_and_bounds():
    send = SendLimits(calls=10, lanes=4)
    assert [send.quota(i) for i in range(4)] == [3, 3, 2, 2]
    with pytest.raises(ValueError):
        SendLimits(calls=3, lanes=4)
    with pytest.raises(ValueError):
        SendLimits(attempts=0)
    assert stand_ins.EchoClient(refuse_every=4)("abcd")[0] in throttle.RETRIED_STATUSES
