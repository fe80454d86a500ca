import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_audio import _tree, _wav_bytes

from parley.config import ChunkSpec
from parley.functions.resample import Resampler
from parley.sources import audio, wav_ranges

COLUMNS = ["path", "source_rate", "source_channels", "duration_seconds", "length_ms", "num_chunks",
           "chunk_idx", "chunk_start", "chunk_end", "wav"]


def _sine(hertz, rate, seconds, peak=0.5):
    return np.round(np.sin(2 * np.pi * hertz * np.arange(int(rate * seconds)) / rate) * peak * 32767)


def _resampled(x, rate, target=16_000, blocks=1):
    r = Resampler(rate, target)
    n = r.length(len(x))
    cuts = np.linspace(0, n, blocks + 1).astype(int)
    return np.concatenate([r.pcm16(lambda a, b: x[a:b] / 32768, len(x), a, b)
                           for a, b in zip(cuts[:-1], cuts[1:])])


def test_what_the_new_rate_cannot_hold_is_filtered_out():
    for hertz in (8_900, 10_000, 15_000, 21_000):
        out = _resampled(_sine(hertz, 44_100, 2), 44_100)[800:-800]
        assert np.abs(out).max() <= 0.5 * 32767 / 1000          # 60 dB below the tone
    for hertz in (50, 440, 3_000, 6_000):
        out = _resampled(_sine(hertz, 44_100, 2), 44_100)
        want = _sine(hertz, 16_000, 2)
        assert np.abs(out[800:-800] - want[800:-800]).max() <= 8


@pytest.mark.parametrize("rate", [8_000, 11_025, 16_000, 22_050, 44_100, 48_000, 44_099])
def test_block_size_changes_no_sample(rate):
    x = np.random.default_rng(rate).integers(-32768, 32768, 30_000).astype(float)
    whole = _resampled(x, rate)
    assert len(whole) == round(len(x) * 16_000 / rate)
    for blocks in (2, 7, 101):
        assert np.array_equal(whole, _resampled(x, rate, blocks=blocks))
    if rate == 16_000:
        assert np.array_equal(whole, x)
    if rate == 8_000:
        assert np.array_equal(whole[::2], x)                     # old samples stay
    flat = _resampled(np.full(5000, 1234.0), rate)
    assert (flat == 1234).all()


def test_no_samples():
    assert len(_resampled(np.empty(0), 44_100)) == 0
    assert len(_resampled(np.array([5.0]), 44_100)) == 0
    assert _resampled(np.array([5.0]), 8_000).tolist() == [5, 5]


@pytest.mark.parametrize("split", [128 << 20, 50_000, 7_000])
def test_same_chunks_as_whole_files(spark, split):
    root = _tree()
    rnd = np.random.default_rng(3)
    for k, (rate, channels, n) in enumerate([(8_000, 1, 30_011), (48_000, 2, 100_000), (16_000, 1, 0),
                                             (16_000, 1, 9_600), (44_100, 1, 1)]):
        with open(os.path.join(root, f"x{k}.wav"), "wb") as f:
            f.write(_wav_bytes(rnd.integers(-9000, 9000, n * channels), rate, channels))
    for spec in (ChunkSpec(700, 100), ChunkSpec(600, 0, drop_empty=True)):
        norm = audio.normalize_audio(audio.read_audio(spark, root), method="sinc")
        want = sorted(map(tuple, audio.audio_chunks(norm, spec).select(*COLUMNS).collect()))
        found = audio.read_wav_chunks(spark, root, spec, split_bytes=split)
        got = sorted(map(tuple, found.where("error_message IS NULL").select(*COLUMNS).collect()))
        assert got == want and len(want) > 15
        errors = found.where("error_message IS NOT NULL")
        assert sorted(r["filename"] for r in errors.select("filename").collect()) == \
            ["broken.wav", "voice.mp3"]
        assert errors.where(F.col("chunk_idx").isNotNull() | F.col("wav").isNotNull()).count() == 0


def test_ranges_cover_every_file_once():
    files = [("a", 0), ("b", 10), ("c", 95), ("d", 30), ("e", 5)]
    tasks = wav_ranges.split_files(files, 40)
    flat = [r for t in tasks for r in t.ranges]
    for name, size in files:
        mine = [(b, e) for a, _, b, e in flat if a == name]
        assert mine[0][0] == 0 and mine[-1][1] == size
        assert all(x[1] == y[0] for x, y in zip(mine, mine[1:]))
    assert all(sum(e - b for *_, b, e in t.ranges) <= 40 for t in tasks)
    assert wav_ranges.split_files([], 40) == []


def test_a_recording_of_3_gb_is_read_in_ranges(spark):
    root = tempfile.mkdtemp(prefix="parley-large-")
    path, frames = os.path.join(root, "long.wav"), 375_000_000       # 3 GB, mostly a hole
    mark = _sine(440, 48_000, 1).astype("<i2")
    with open(path, "wb") as f:
        f.write(_wav_bytes(np.zeros(0), 48_000, 4)[:40] + (8 * frames).to_bytes(4, "little"))
        f.seek(44 + 8 * 300_000_000)
        f.write(np.repeat(mark, 4).tobytes())
        f.truncate(44 + 8 * frames)
    assert os.path.getsize(path) > 3 * 10**9
    spec = ChunkSpec(300_000, 1_500)
    seen = audio.read_wav_chunks(spark, root, spec).select(
        "chunk_idx", "num_chunks", "chunk_start", "chunk_end", F.length("wav").alias("bytes"),
        (F.length(F.replace(F.hex("wav"), F.lit("0"), F.lit(""))) > 100).alias("heard"))
    assert seen.rdd.getNumPartitions() >= 20
    rows = sorted(seen.collect())
    assert len(rows) == rows[0]["num_chunks"] == 7_812_500 // 298_500 + 1
    assert all(r["bytes"] == 44 + 32 * (r["chunk_end"] - r["chunk_start"]) for r in rows)
    heard = [r["chunk_idx"] for r in rows if r["heard"]]
    assert heard == [r["chunk_idx"] for r in rows if r["chunk_start"] < 6_251_000
                     and r["chunk_end"] > 6_250_000]
