import io
import os
import tempfile
import wave

import numpy as np
from pyspark.sql import functions as F

from parley.config import ChunkSpec
from parley.functions import wav as wfn
from parley.sources import audio
from parley.sinks import writers


def _wav_bytes(samples: np.ndarray, rate: int, channels: int = 1) -> bytes:
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(samples.astype("<i2").tobytes())
    return buf.getvalue()


def _tree():
    root = tempfile.mkdtemp(prefix="parley-audio-")
    os.makedirs(os.path.join(root, "team_a"))
    os.makedirs(os.path.join(root, "team_b", "deep"))
    t = np.arange(16000 * 2)
    tone = (np.sin(2 * np.pi * 440 * t / 16000) * 10000).astype(np.int16)
    with open(os.path.join(root, "team_a", "call_1.wav"), "wb") as f:
        f.write(_wav_bytes(tone, 16000))                                   # 2 s, 16 kHz mono
    st = np.repeat(np.arange(44100) % 200, 2).astype(np.int16)
    with open(os.path.join(root, "team_b", "deep", "call_2.wav"), "wb") as f:
        f.write(_wav_bytes(st, 44100, channels=2))                         # 1 s, 44.1 kHz stereo
    with open(os.path.join(root, "team_a", "LOUD.WAV"), "wb") as f:       # upper case: not scanned
        f.write(_wav_bytes(tone, 16000))
    with open(os.path.join(root, "team_b", "voice.mp3"), "wb") as f:      # no codec: error row
        f.write(b"ID3fake")
    with open(os.path.join(root, "team_b", "broken.wav"), "wb") as f:     # corrupt header
        f.write(b"RIFFxxxxWAVEjunk")
    with open(os.path.join(root, "team_b", "notes.txt"), "w") as f:        # ignored
        f.write("hello")
    return root


def test_scan_prunes_content_and_filters_glob(spark):
    root = _tree()
    listing = audio.list_audio(spark, root)
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]
    names = sorted(r.filename for r in listing.collect())
    assert names == ["broken.wav", "call_1.wav", "call_2.wav", "voice.mp3"]
    r = {x.filename: x for x in listing.collect()}["call_2.wav"]
    assert r.parent_folder == "deep" and r.file_id == "deep_call_2_wav"


def test_normalize_and_chunk(spark):
    root = _tree()
    norm = {r.filename: r for r in audio.normalize_audio(audio.read_audio(spark, root)).collect()}
    ok = norm["call_1.wav"]
    assert ok.error_message is None and ok.source_rate == 16000 and ok.length_ms == 2000
    assert len(ok.pcm) == 2000 * audio.BYTES_PER_MS
    st = norm["call_2.wav"]
    assert st.source_channels == 2 and st.source_rate == 44100 and st.length_ms == 1000
    assert "MP3" in norm["voice.mp3"].error_message
    assert norm["broken.wav"].error_message
    chunks = audio.audio_chunks(audio.normalize_audio(audio.read_audio(spark, root)),
                                ChunkSpec(max_len=700, overlap=100)).filter(
        F.col("filename") == "call_1.wav").orderBy("chunk_idx").collect()
    assert [(c.chunk_start, c.chunk_end) for c in chunks] == [(0, 700), (600, 1300), (1200, 1900),
                                                               (1800, 2000)]
    with wave.open(io.BytesIO(bytes(chunks[1].wav)), "rb") as w:
        assert w.getframerate() == 16000 and w.getnchannels() == 1
        assert w.getnframes() == 700 * 16
        frames = w.readframes(w.getnframes())
    assert frames == bytes(ok.pcm)[600 * 32:1300 * 32]


def test_wav_header_matches_wave_module(spark):
    samples = np.array([0, 1, -1, 32767, -32768, 1234], dtype=np.int16)
    df = spark.createDataFrame([(samples.tolist(),)], "s array<short>")
    got = bytes(df.select(wfn.wav_file(wfn.pcm16_bytes(F.col("s")), 8000)).head()[0])
    assert got == _wav_bytes(samples, 8000)


def test_write_chunk_payloads(spark):
    root = _tree()
    chunks = audio.audio_chunks(audio.normalize_audio(audio.read_audio(spark, root)),
                                ChunkSpec(max_len=700, overlap=100))
    out = tempfile.mkdtemp(prefix="parley-chunks-")
    writers.write_chunk_payloads(chunks.withColumnRenamed("wav", "payload"), out)
    back = spark.read.parquet(out)
    assert back.count() == chunks.count()
    p = back.filter(F.col("chunk_idx") == 0).select("chunk_path").orderBy("chunk_path").first()[0]
    assert p.endswith("_chunk0.wav")


class SampleCounter:
    """Stand-in ASR: 'transcribes' a WAV chunk as its frame count."""

    def __call__(self, payload):
        with wave.open(io.BytesIO(bytes(payload)), "rb") as w:
            n = w.getnframes()
        return 200, '{"predictions": [{"transcription": "frames %d"}]}' % n


def test_audio_stage_jobs(spark):
    import sys
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    from parley.config import SizeLimits
    from parley.plans import pipeline
    root = _tree()
    meta, payloads = pipeline.run_preprocess_audio(spark, root, "a1", spec=ChunkSpec(700, 100))
    m = {r.filename: r for r in spark.table(meta).collect()}
    assert set(m) == {"call_1.wav", "call_2.wav"}                # errors stay out of stage 1
    assert m["call_1.wav"].num_chunks == 4 and m["call_1.wav"].chunk_paths.count("|") == 3
    res = pipeline.run_transcribe_audio(spark, payloads, SampleCounter(), "a1",
                                        limits=SizeLimits(max_payload_bytes=40_000),
                                        run_ts="2024-01-01 00:00:00", concurrency=4)
    out = {r.filename: r for r in spark.table(res).collect()}
    # 700 ms chunks = 22444 B WAV -> payload 29973 B: within limits; 1 s file -> 2 chunks
    assert out["call_1.wav"].transcription_text == "frames 11200 frames 11200 frames 11200 frames 3200"
    assert out["call_2.wav"].transcription_text == "frames 11200 frames 6400"
    assert out["call_1.wav"].error_message is None
    tight = pipeline.run_transcribe_audio(spark, payloads, SampleCounter(), "a2",
                                          limits=SizeLimits(max_payload_bytes=20_000))
    t = {r.filename: r for r in spark.table(tight).collect()}
    assert t["call_1.wav"].error_message.startswith("CHUNK_TOO_LARGE: Chunk 1/4 is 0.02 MB")
    assert t["call_1.wav"].transcription_text == "frames 3200"
    limited, _ = pipeline.run_preprocess_audio(spark, root, "a3", max_files=1)
    assert spark.table(limited).count() == 1


class LongExcuse:
    """Refuses every second chunk with a message of 3000 characters."""

    def __call__(self, payload):
        if len(payload) % 4:
            raise RuntimeError("no " + "x" * 3000)
        return 200, '{"predictions": [{"transcription": "heard"}]}'


def test_stage_jobs_store_log_blocks_files_and_times(spark):
    import sys
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    from parley.plans import pipeline
    from parley.sinks import chunk_files
    from parley.streaming.throttle import SendLimits
    root, files = _tree(), tempfile.mkdtemp(prefix="parley-chunkfiles-")
    with open(os.path.join(root, "team_a", "odd.wav"), "wb") as f:
        f.write(_wav_bytes(np.arange(16_000), 16_000)[:-1] + b"")       # cut-off last sample
    meta, payloads = pipeline.run_preprocess_audio(spark, root, "log1", spec=ChunkSpec(700, 100),
                                                   split_bytes=9_000, chunk_root=files)
    # the files that the metadata names hold the payloads
    stored = {(r.full_path, r.chunk_idx): bytes(r.payload) for r in
              pipeline.readable(spark.table(payloads)).collect()}
    back = {(r.full_path, r.chunk_idx): bytes(r.payload) for r in
            chunk_files.read_chunk_files(spark, spark.table(meta), files).collect()}
    assert back == stored and len(back) == 8

    name = pipeline.run_transcribe_audio(spark, payloads, LongExcuse(), "log1")
    log = spark.table("calls.request_log_log1").collect()
    assert len(log) == len(stored)
    refused = [r for r in log if r.outcome == "exception"]
    assert all(len(r.error) == len("EXCEPTION: no ") + 3000 for r in refused)
    results = {r.full_path: r for r in spark.table(name).collect()}
    for path, r in results.items():
        n = sum(x.full_path == path for x in refused)
        assert (r.error_full or "").count("x" * 3000) == n and len(r.error_message or "") <= 1000
    blocks = spark.table("calls.transcription_blocks_log1")
    assert blocks.select("full_path").distinct().count() == len(results)
    runs = {r.stage: r for r in spark.table("calls.stage_runs").where("run_id = 'log1'").collect()}
    assert (runs["preprocess"].total, runs["preprocess"].failed) == (5, 2)
    assert runs["transcribe"].total == 3 and runs["transcribe"].seconds > 0

    folder = tempfile.mkdtemp(prefix="parley-throttle-")
    throttled = pipeline.run_transcribe_throttled(
        spark, payloads, SampleCounter(), "log2", folder, timeout=200, every="300 milliseconds",
        send=SendLimits(calls=6, window_ms=2000, lanes=2))
    plain = pipeline.run_transcribe_audio(spark, payloads, SampleCounter(), "log3")
    columns = ["full_path", "num_chunks", "transcription_text", "duration_seconds", "error_message"]
    assert sorted(map(tuple, spark.table(throttled).select(*columns).collect())) == \
        sorted(map(tuple, spark.table(plain).select(*columns).collect()))
    assert spark.table("calls.request_log_log2").where("attempt = 1").count() == len(stored)
