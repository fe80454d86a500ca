import pytest

from parley.config import SizeLimits
from parley.plans import stand_ins  # noqa: E402
from parley.operators import inference, reassemble
from parley.operators.upsert import merge_keyed


def test_reassemble_order_and_errors(spark):
    rows = [("f", 2, "c", None), ("f", 0, "a", None), ("f", 1, None, "E1"), ("f", 3, None, "E2"),
            ("g", 0, None, "only error"), ("h", 0, "", None), ("h", 1, "x", None)]
    df = spark.createDataFrame(rows, "k string, chunk_idx long, chunk_text string, chunk_error string")
    for fanout in (None, 1, 2, 512):
        out = {r.k: r for r in reassemble.reassemble(df, ["k"], fanout=fanout).collect()}
        assert out["f"].transcription_text == "a c" and out["f"].error_message == "E1; E2"
        assert out["f"].num_chunks == 4
        assert out["g"].transcription_text is None and out["g"].error_message == "only error"
        assert out["h"].transcription_text == " x" and out["h"].error_message is None


def test_reassemble_invariant_to_partitioning(spark):
    import random
    random.seed(1)
    rows = [("k%d" % (i % 7), i, f"t{i}" if i % 5 else None, None if i % 5 else f"e{i}")
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, chunk_idx long, chunk_text string, chunk_error string")
    a = {r.k: tuple(r) for r in reassemble.reassemble(df.repartition(1), ["k"], fanout=None).collect()}
    b = {r.k: tuple(r) for r in reassemble.reassemble(df.repartition(13), ["k"], fanout=64).collect()}
    assert a == b
    assert len(a["k0"][3]) <= 1000                 # error text cut at 1000


def test_error_cut_at_1000(spark):
    rows = [("f", i, None, "X" * 300) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, chunk_idx long, chunk_text string, chunk_error string")
    r = reassemble.reassemble(df, ["k"]).head()
    assert len(r.error_message) == 1000


# Ship this module's classes to Python workers by value.
import sys  # noqa: E402

from pyspark import cloudpickle  # noqa: E402

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Flaky:
    """Raises for one payload, answers 503 for another."""

    def __call__(self, payload):
        if payload == "boom":
            raise RuntimeError("connection reset")
        if payload == "busy":
            return 503, "upstream busy"
        if payload == "null":
            return 200, '{"predictions": [{"transcription": null, "error": "decoder failed"}]}'
        return 200, '{"dataframe_records": [{"transcription": "%s"}]}' % payload.upper()


def test_infer_chunks_error_capture(spark):
    rows = [("f", 0, 4, "ok"), ("f", 1, 4, "boom"), ("f", 2, 4, "busy"), ("f", 3, 4, "null"),
            ("g", 0, 1, "x" * 50)]
    df = spark.createDataFrame(rows, "k string, chunk_idx long, num_chunks int, payload string")
    lim = SizeLimits(max_payload_bytes=100, max_file_bytes=40)
    out = {(r.k, r.chunk_idx): r for r in inference.infer_chunks(df, Flaky(), limits=lim).collect()}
    assert out[("f", 0)].chunk_text == "OK" and out[("f", 0)].chunk_error is None
    assert out[("f", 1)].chunk_error == "EXCEPTION: connection reset"
    assert out[("f", 2)].chunk_error == "ENDPOINT_ERROR: HTTP_503 - upstream busy"
    assert out[("f", 3)].chunk_error == "ENDPOINT_ERROR: MODEL_ERROR - decoder failed"
    assert out[("f", 3)].chunk_text is None
    assert out[("g", 0)].status is None
    assert out[("g", 0)].chunk_error == "CHUNK_TOO_LARGE: Chunk 1/1 is 0.00 MB"


def test_echo_client_limits():
    c = stand_ins.EchoClient(request_limit=60)
    assert c("abc")[0] == 200
    status, body = c("x" * 40)
    assert status == 400 and "MAX_REQUEST_SIZE_EXCEEDED" in body


TCOLS = "k1 string, k2 string, v string, ts long"


def _df(spark, rows, schema=TCOLS):
    return spark.createDataFrame(rows, schema)


def test_merge_semantics(spark):
    target = _df(spark, [("a", "1", "old", 1), ("b", "1", "keep", 1), ("c", "1", "good", 1)])
    source = _df(spark, [("a", "1", None, 2, "x", None), ("d", "1", "new", 2, "y", None),
                         ("c", "1", None, 2, "z", "failed")],
                 "k1 string, k2 string, v string, ts long, file_id string, error_message string")
    got = sorted(tuple(r) for r in merge_keyed(target, source, ["k1", "k2"]).collect())
    assert got == [("a", "1", None, 2), ("b", "1", "keep", 1), ("c", "1", None, 2), ("d", "1", "new", 2)]
    keep = sorted(tuple(r) for r in merge_keyed(target, source, ["k1", "k2"], on_error="keep_good").collect())
    assert ("c", "1", "good", 1) in keep and ("a", "1", None, 2) in keep
    # idempotent: applying the same source twice equals once
    once = merge_keyed(target, source, ["k1", "k2"])
    twice = merge_keyed(once, source, ["k1", "k2"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert merge_keyed(target, source, ["k1", "k2"]).columns == target.columns


def test_merge_rejects_duplicate_source_keys(spark):
    target = _df(spark, [("a", "1", "old", 1)])
    source = _df(spark, [("a", "1", "x", 2), ("a", "1", "y", 3)])
    with pytest.raises(Exception, match="MERGE_CARDINALITY_VIOLATION"):
        merge_keyed(target, source, ["k1", "k2"]).collect()


def test_merge_requires_target_columns(spark):
    target = _df(spark, [("a", "1", "old", 1)])
    source = spark.createDataFrame([("a", "1")], "k1 string, k2 string")
    with pytest.raises(ValueError):
        merge_keyed(target, source, ["k1", "k2"])


def test_concurrent_calls_keep_order(spark):
    import time as _t

    class Slow:
        def __call__(self, payload):
            _t.sleep(0.01 * (len(payload) % 3))
            if payload.startswith("bad"):
                raise ValueError("no")
            return 200, '{"predictions": [{"transcription": "%s"}]}' % payload

    rows = [("f", i, 60, ("bad" if i % 7 == 0 else "p") + str(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, chunk_idx long, num_chunks int, payload string")
    seq = {r.chunk_idx: (r.chunk_text, r.chunk_error) for r in inference.infer_chunks(df, Slow()).collect()}
    par = {r.chunk_idx: (r.chunk_text, r.chunk_error)
           for r in inference.infer_chunks(df, Slow(), concurrency=8, parallelism=3).collect()}
    assert seq == par
    assert seq[1] == ("p1", None) and seq[7] == (None, "EXCEPTION: no")
