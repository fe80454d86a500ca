"""A data source of audio chunks whose partitions are byte ranges of WAV files.

Planning lists the files and cuts them into ranges, without opening any.  A
task reads a file's header, plans its chunks and makes those whose first
frame lies in its range, reading the frames they need and the few beside
them that the resampling filter looks at.  So a file of any size is read by
many tasks, a task holds one chunk, and a lost task reads only its own range
again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from parley import config
from parley.config import ChunkSpec
from parley.functions.resample import Resampler
from parley.sources import audio
from parley.sources.files import list_files, open_store

SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("source_rate", T.IntegerType()), T.StructField("source_channels", T.IntegerType()),
    T.StructField("duration_seconds", T.DoubleType()), T.StructField("length_ms", T.LongType()),
    T.StructField("error_message", T.StringType()), T.StructField("num_chunks", T.IntegerType()),
    T.StructField("chunk_idx", T.LongType()), T.StructField("chunk_start", T.LongType()),
    T.StructField("chunk_end", T.LongType()), T.StructField("wav", T.BinaryType())])
_ARROW = pa.schema([("path", pa.string()), ("length", pa.int64()), ("source_rate", pa.int32()),
                    ("source_channels", pa.int32()), ("duration_seconds", pa.float64()),
                    ("length_ms", pa.int64()), ("error_message", pa.string()),
                    ("num_chunks", pa.int32()), ("chunk_idx", pa.int64()),
                    ("chunk_start", pa.int64()), ("chunk_end", pa.int64()), ("wav", pa.binary())])


@dataclass
class Ranges(InputPartition):
    """Ranges (address, size, begin, end) of one task; small files share one."""

    ranges: list[tuple[str, int, int, int]]


def split_files(files: list[tuple[str, int]], split_bytes: int) -> list[Ranges]:
    """Ranges of at most ``split_bytes``, packed in order into tasks of about that much."""
    tasks, held, size = [], [], 0
    for address, length in files:
        for begin in range(0, max(1, length), split_bytes):
            end = min(begin + split_bytes, length)
            if held and size + end - begin > split_bytes:
                tasks.append(Ranges(held))
                held, size = [], 0
            held.append((address, length, begin, end))
            size += end - begin
    return [*tasks, Ranges(held)] if held else tasks


def alternatives(glob: str) -> list[str]:
    """The patterns of a glob with one ``{a,b}`` group."""
    if "{" not in glob:
        return [glob]
    head, rest = glob.split("{", 1)
    group, tail = rest.split("}", 1)
    return [head + a + tail for a in group.split(",")]


def planned_chunks(length_ms: int, spec: ChunkSpec) -> tuple[int, Iterator[tuple[int, int, int]]]:
    """The chunk count and (index, start, end) in milliseconds, as ``chunking.chunk_bounds`` says."""
    n = 1 if length_ms <= spec.max_len else length_ms // spec.step + 1
    bounds = ((i, i * spec.step, min(length_ms, i * spec.step + spec.max_len)) for i in range(n))
    if spec.drop_empty:
        kept = [b for b in bounds if b[2] > b[1]]
        return len(kept), iter(kept)
    return n, bounds


def wav_bytes(pcm: np.ndarray, rate: int) -> bytes:
    """Mono 16-bit samples as a WAV file, as ``parley.functions.wav`` writes it."""
    size = 2 * len(pcm)
    fields = [(16, 4), (1, 2), (1, 2), (rate, 4), (2 * rate, 4), (2, 2), (16, 2)]
    return b"".join([b"RIFF", (size + 36).to_bytes(4, "little"), b"WAVEfmt ",
                     *(v.to_bytes(n, "little") for v, n in fields),
                     b"data", size.to_bytes(4, "little"), pcm.astype("<i2").tobytes()])


def range_chunks(read, layout: audio.Layout, size: int, begin: int, end: int, spec: ChunkSpec,
                 target: int) -> Iterator[tuple]:
    """The rows, after path and length, of the chunks that begin in a byte range of a file."""
    filtered = Resampler(layout.rate, target)
    outputs = filtered.length(layout.frames)
    duration = outputs / target
    length_ms = int(round(duration * 1000))
    count, bounds = planned_chunks(length_ms, spec)

    def samples(a: int, b: int) -> np.ndarray:
        return layout.mono(read(layout.begin + a * layout.frame, (b - a) * layout.frame))
    per_ms = target // 1000
    for index, start, stop in bounds:
        first = start * per_ms * filtered.down // filtered.up      # input frame it begins at
        at = 0 if index == 0 else min(layout.begin + first * layout.frame, size - 1)
        if at >= end and end < size:
            return
        if begin <= at < end or (begin == 0 and at == 0):
            pcm = filtered.pcm16(samples, layout.frames, min(start * per_ms, outputs),
                                 min(stop * per_ms, outputs))
            yield (layout.rate, layout.channels, duration, length_ms, None, count, index, start,
                   stop, wav_bytes(pcm, target))


class WavReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.patterns = alternatives(options.get("glob", config.AUDIO_GLOB))
        self.split = int(options.get("splitbytes", 128 << 20))
        self.spec = ChunkSpec(int(options.get("maxlen", config.MAX_CHUNK_MS)),
                              int(options.get("overlap", config.CHUNK_OVERLAP_MS)),
                              options.get("dropempty", "false").lower() == "true")
        self.most = int(options.get("maxfiles", -1))
        self.target = int(options.get("rate", config.TARGET_SAMPLE_RATE))

    def partitions(self) -> list[Ranges]:
        _, files = list_files(self.root)
        chosen = [(address, size) for address, path, size in files
                  if any(fnmatchcase(path.rsplit("/", 1)[-1], p) for p in self.patterns)]
        return split_files(chosen if self.most < 0 else chosen[:self.most], self.split)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for address, size, begin, end in partition.ranges:
            layout = None
            try:
                store, path, _ = open_store(address)
                with store.open_input_file(path) as file:
                    def get(at: int, n: int, file=file) -> bytes:
                        return file.read_at(n, at)
                    layout = audio.wav_layout(get, size, path)
                    for row in range_chunks(get, layout, size, begin, end, self.spec, self.target):
                        yield self.batch(address, size, row)
            except (ValueError, OSError) as e:
                if begin == 0 or layout is not None:      # a bad header is one error row a file
                    yield self.batch(address, size, (
                        *[None] * 4, str(e)[:config.PREPROCESS_ERROR_CHARS], *[None] * 5))

    @staticmethod
    def batch(address: str, size: int, row: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip((address, size, *row), _ARROW, strict=True)],
            schema=_ARROW)


class WavChunks(DataSource):
    """``spark.read.format("wav_chunks").load(root)``.

    Options: ``glob``, ``maxLen`` and ``overlap`` in milliseconds,
    ``dropEmpty``, ``splitBytes``, ``maxFiles`` (the first by path; -1: all) and
    ``rate`` (whole kilohertz).
    """

    @classmethod
    def name(cls) -> str:
        return "wav_chunks"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WavReader:
        return WavReader({k.lower(): v for k, v in self.options.items()})
