"""Whole texts, malformed answers, colliding ids, plan shapes."""

import io
import os
import struct
import sys
import tempfile
import time
import wave

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from testdata import SF
from parley.config import ChunkSpec, SizeLimits
from parley.operators import chunking, inference, reassemble, reports
from parley.plans import catalog, pipeline, stand_ins
from parley.sinks import writers
from parley.sources import audio, tables


# Ship this module's classes to Python workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_every_character_is_enriched(spark):
    conv = tables.read_table(spark, SF, "conversations")
    turns, chars, calls = conv.agg(F.count("*"), F.sum(F.length("text")),
                                   F.count_distinct("conv_id")).first()
    merged = catalog.queries()["transcribe_calls"](spark, SF)
    got = merged.agg(F.sum(F.length("transcription_text")), F.count("error_message")).first()
    assert tuple(got) == (chars + turns - calls, 0)
    spoken = catalog._spoken(conv).agg(F.sum(F.length("text"))).first()[0]
    gold = catalog.queries()["enrich_gold"](spark, SF)
    assert gold.agg(F.sum(F.length("transcription_text"))).first()[0] == spoken + turns - calls


@pytest.mark.parametrize("query, column", [
    ("error_taxonomy", "error_type"), ("rate_limit_audit", "over_limit"), ("parse_props", "error_message"),
    ("contract_violations", "violations"), ("response_decode", "error"), ("response_decode", "outcome"),
    ("enrich_gold", "speaker_1"), ("enrich_gold", "speaker_2"),
    ("tone_distribution", "conversation_tone"), ("request_log", "status"), ("error_rows", "error_message")])
def test_flags_take_several_values(spark, query, column):
    assert catalog.queries()[query](spark, SF).select(column).distinct().count() > 1


def test_safety_fails_somewhere_and_a_matched_row_turns_null(spark):
    scores = catalog.queries()["eval_scores"](spark, SF).where("scorer = 'safety'")
    assert {r[0] for r in scores.select("passed").distinct().collect()} == {True, False}
    target, source = catalog._upsert_inputs(spark, SF)
    nulls = source.where("transcription_text IS NULL").join(
        target.where("transcription_text IS NOT NULL"), pipeline.KEYS, "left_semi")
    assert nulls.count() > 0


class Fixed:
    def __call__(self, payload):
        return 200, None if payload == "none" else payload


def test_malformed_answers_are_errors(spark):
    bodies = ["<html>", '{"predictions": [', "[1]", '{"predictions": ["hello"]}', '{"predictions": {"a": 1}}',
              "none", '{"predictions": []}', '{"other": 1}', '{"predictions": null}',
              '{"predictions": [{"transcription": "x"}]}', None]
    df = spark.createDataFrame([(i, len(bodies), b) for i, b in enumerate(bodies)],
                               "chunk_idx long, num_chunks int, payload string")
    rows = inference.infer_chunks(df, Fixed()).orderBy("chunk_idx").collect()
    broken, envelope = "EXCEPTION: response is not JSON", "EXCEPTION: malformed response envelope"
    assert [r.chunk_error for r in rows] == [broken, broken, None, envelope, envelope, broken, envelope,
                                             None, envelope, None, inference.NO_PAYLOAD]
    assert [r.chunk_text for r in rows] == [None] * 9 + ["x", None]


def test_null_turns_and_calls_stay_and_the_plan_is_narrow(spark):
    conv = spark.createDataFrame([(1, 0, "user", "a"), (1, None, "user", "b"), (None, 0, "user", "c")],
                                 "conv_id bigint, turn bigint, role string, text string")
    out = pipeline.transcribe_calls(conv, stand_ins.EchoClient())
    assert sum(r.num_chunks for r in out.collect()) == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = pipeline.transcribe_calls(tables.read_table(spark, SF, "conversations"),
                                          stand_ins.EchoClient())
        plan = whole._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") <= 2 and plan.count("FileScan") == 1 and "Join" not in plan


def test_counts_in_messages_are_filled_in(spark):
    conv = spark.createDataFrame([(1, i, "user", "x" * 100) for i in range(12)],
                                 "conv_id bigint, turn bigint, role string, text string")
    row = pipeline.transcribe_calls(conv, stand_ins.EchoClient(), limits=SizeLimits(60),
                                    full_errors=True).head()
    assert row.error_full.split("; ")[11] == "CHUNK_TOO_LARGE: Chunk 12/12 is 0.00 MB"


def test_taxonomy_reads_uncut_errors(spark):
    rows = [("f", i, None, "ENDPOINT_ERROR: MAX_REQUEST_SIZE_EXCEEDED - " + "x" * 50) for i in range(25)]
    rows += [("f", 25, None, "CHUNK_TOO_LARGE: Chunk 26/26 is 20.00 MB")]
    df = spark.createDataFrame(rows, "k string, chunk_idx long, chunk_text string, chunk_error string")
    merged = reassemble.reassemble(df, ["k"], full_errors=True)
    assert reports.error_taxonomy(merged).head().error_type == "CHUNK_TOO_LARGE"


def test_chunking_is_linear_and_carries_no_text(spark):
    spec = ChunkSpec(3000, 15)
    for text in ("é" * 7000, "ab" * 150_000, "x" * 3000, ""):
        df = spark.createDataFrame([(1, text)], "id long, text string")
        rows = chunking.chunk_text(df, "text", spec).orderBy("chunk_idx").collect()
        n = 1 if len(text) <= 3000 else len(text) // spec.step + 1
        assert [r.chunk_text for r in rows] == [text[i * spec.step:i * spec.step + 3000] for i in range(n)]

    def seconds(n):
        df = spark.range(1).select(F.repeat(F.lit("é"), n).alias("text"))
        t = time.perf_counter()
        chunking.chunk_text(df, "text", spec).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t
    seconds(100_000)
    assert seconds(4_000_000) < 4 * seconds(1_000_000) + 3
    plan = chunking.chunk_text(tables.read_table(spark, SF, "documents"), "text", spec
                               )._jdf.queryExecution().optimizedPlan().toString()
    assert all("text#" not in line.split("], ", 1)[-1].split("[_block")[0] or "inline" in line
               for line in plan.split("\n") if line.strip().startswith("+- Generate"))


def _wav(kind, bits, channels, rate, body):
    fmt = struct.pack("<HHIIHH", kind, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits)
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<I", 16) + fmt + \
        b"data" + struct.pack("<I", len(body)) + body


@pytest.mark.parametrize("rate", [8000, 16000, 44100, 48000])
def test_wav_encodings_agree(rate):
    rnd = np.random.default_rng(3)
    x = rnd.uniform(-0.9, 0.9, 150_001)
    ints = np.round(x * 2 ** 23).astype(np.int64)
    three = b"".join(int(v).to_bytes(3, "little", signed=True) for v in ints)
    as32 = (ints * 256).astype("<i4").tobytes()
    real = (ints / 2 ** 23).astype("<f8").tobytes()
    whole = [audio.decode_normalize(_wav(k, b, 1, rate, body), "a.wav") for k, b, body in
             ((1, 24, three), (1, 32, as32), (3, 64, real))]
    assert whole[0][4] == whole[1][4] == whole[2][4]
    n = int(round(len(x) * 16000 / rate))
    expected = np.interp(np.arange(n) * (rate / 16000), np.arange(len(x)), ints / 2 ** 23)
    got = np.frombuffer(whole[0][4], "<i2")
    assert len(got) == n and np.abs(got - expected * 32768).max() <= 1.01


def test_stereo_blocks_and_bad_files():
    left = np.arange(-70_000, 70_000) // 4
    both = np.column_stack([left, -left]).astype("<i2").tobytes()
    assert set(audio.decode_normalize(_wav(1, 16, 2, 16000, both), "a.wav")[4]) == {0}
    for bad in (b"", b"RIFFxxxxWAVE", _wav(1, 12, 1, 8000, b"ab"), _wav(7, 8, 1, 8000, b"ab")):
        with pytest.raises(ValueError):
            audio.decode_normalize(bad, "a.wav")


class Hello:
    def __call__(self, payload):
        return 200, '{"predictions": [{"transcription": "hi"}]}'


def _file(root, folder, name, samples):
    os.makedirs(os.path.join(root, folder), exist_ok=True)
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(16000)
        w.writeframes(np.zeros(samples, "<i2").tobytes())
    with open(os.path.join(root, folder, name), "wb") as f:
        f.write(buffer.getvalue())


def test_colliding_ids_oversize_and_failed_files(spark):
    root = tempfile.mkdtemp(prefix="parley-collide-")
    _file(root, "a_b", "c.wav", 1600)
    _file(root, "a", "b_c.wav", 1600)
    _file(root, "z", "large.wav", 40_000)
    with open(os.path.join(root, "z", "bad.wav"), "wb") as f:
        f.write(b"no")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "50000")
    try:
        meta, payloads = pipeline.run_preprocess_audio(spark, root, "col1", parallelism=3)
        limited, _ = pipeline.run_preprocess_audio(spark, root, "col2", max_files=2)
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert spark.table(meta).count() == 2 and spark.table(limited).count() == 2
    failed = {r.filename: r.error_message for r in spark.table("calls.preprocessing_failures_col1").collect()}
    assert set(failed) == {"large.wav", "bad.wav"} and "larger" in failed["large.wav"]
    results = pipeline.run_transcribe_audio(spark, payloads, Hello(), "col1")
    rows = spark.table(results).collect()
    assert len(rows) == 2 and len({r.file_id for r in rows}) == 1
    assert {r.transcription_text for r in rows} == {"hi"}


def test_ranking_agrees_with_a_plain_loop():
    from collections import Counter

    import pandas as pd

    from parley.operators import enrich
    rnd = np.random.default_rng(5)
    words = [f"word{c}" for c in "abcdefgh"]
    rows = [None, "", "one", "\n", "b b\na a a"] + [
        "\n".join(" ".join(rnd.choice(words, rnd.integers(0, 6))) for _ in range(rnd.integers(1, 9)))
        for _ in range(60)]
    out = enrich._rank_batch(pd.Series(rows, index=range(7, 7 + len(rows))), 2, 3)
    for text, (_, got) in zip(rows, out.iterrows(), strict=True):
        if text is None:
            assert got.top_sentences is None and got.topics is None
            continue
        lines = [line.split(" ") if line else [] for line in text.split("\n")]
        count = Counter(w for line in lines for w in line)
        order = sorted(range(len(lines)), key=lambda i: (-sum(count[w] for w in lines[i]), i))
        assert got.top_sentences == sorted(order[:2]) and got.best_sentence == order[0]
        assert got.topics == [w for w, _ in sorted(count.items(), key=lambda p: (-p[1], p[0]))[:3]]


def test_tone_needs_no_ranking(spark):
    plan = catalog.queries()["tone_distribution"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "rank" not in plan
    assert writers.MAX_LISTED_PARTITIONS > 0


def test_block_rows_are_stored_and_give_the_calls(spark):
    conv = tables.read_table(spark, SF, "conversations")
    chunks = pipeline.run_preprocess_calls(spark, conv, "blk")
    results = pipeline.run_transcribe(spark, chunks, stand_ins.EchoClient(), "blk", fanout=3,
                                      run_ts="2024-01-01 00:00:00")
    blocks = spark.table("calls.transcription_blocks_blk")
    assert blocks.count() > spark.table(results).count()
    direct = pipeline.transcribe_calls(conv, stand_ins.EchoClient(), run_ts="2024-01-01 00:00:00")
    assert spark.table(results).drop("error_full").exceptAll(direct).count() == 0


def test_ranking_holds_pieces_of_a_batch(spark, monkeypatch):
    import pandas as pd

    from parley.operators import enrich
    seen = []
    rank = enrich._rank_batch
    monkeypatch.setattr(enrich, "_rank_batch", lambda rows, *a: seen.append(rows.str.len().sum()) or rank(rows, *a))
    rows = pd.Series(["alpha bravo charlie\nbravo delta"] * 200_000 + [None, ""])
    out = enrich._make_ranker(2, 3).func(rows)
    assert len(out) == len(rows) and max(seen) < 2 << 20 and len(seen) > 5
    assert out.iloc[-3].to_dict() == rank(rows.iloc[:1], 2, 3).iloc[0].to_dict()
    assert out["top_sentences"].iloc[-2] is None and list(out.index) == list(range(len(rows)))
    assert list(enrich._make_ranker(2, 3).func(rows.iloc[:0]).columns) == ["top_sentences", "topics", "best_sentence"]
