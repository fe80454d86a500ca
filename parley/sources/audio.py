"""Audio recordings: discovery, normalisation to 16 kHz mono, chunk files.

Discovery is Spark's ``binaryFile`` source: a recursive listing filtered by
a case-sensitive glob, with the ``content`` column pruned unless asked for.
Decoding and resampling need a codec, so they are the one Python step
(``mapInArrow`` over batches bounded in bytes); slicing chunks and writing
WAV headers are column expressions.  Recordings larger than a row are read
in ranges by :func:`read_wav_chunks`.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import config
from parley.config import ChunkSpec
from parley.functions import paths, wav
from parley.functions.resample import Resampler
from parley.operators import chunking

BYTES_PER_MS = config.TARGET_SAMPLE_RATE * 2 // 1000   # PCM16 mono at 16 kHz


def _reader(spark: SparkSession, glob: str):
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", "true"))


def list_audio(spark: SparkSession, root: str, glob: str = config.AUDIO_GLOB) -> DataFrame:
    """Discovered files: path, length, filename, parent_folder, full_path,
    file_id.  Only the listing is read (``ReadSchema`` has no content)."""
    return _reader(spark, glob).load(root).select("path", "length").transform(paths.with_path_parts)


def read_audio(spark: SparkSession, root: str, glob: str = config.AUDIO_GLOB,
               max_files: int | None = None) -> DataFrame:
    """Listing plus file bytes (``content``).

    A file above ``spark.sql.sources.binaryFile.maxLength`` cannot be one
    row: it keeps its listing row with NULL content, which
    :func:`normalize_audio` turns into an error row, and its bytes are never
    read.  ``max_files`` takes the first files by path; they are chosen from
    the listing (at most that many paths reach the driver), and only those
    are read.
    """
    most = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))
    if max_files is None:
        listing, source = list_audio(spark, root, glob), [root]
    else:
        listing = list_audio(spark, root, glob).orderBy("path").limit(max_files)
        source = [r["path"] for r in listing.collect()]
        listing = list_audio(spark, root, glob).where(F.col("path").isin(source))
    oversize = listing.where(F.col("length") > most).withColumn(
        "content", F.lit(None).cast("binary")).select("path", "length", "content")
    if not source:
        return oversize.transform(paths.with_path_parts)
    # Filters on length are applied before a file is opened.
    files = (_reader(spark, glob).load(source).where(F.col("length") <= most)
             .select("path", "length", "content"))
    return files.unionByName(oversize).transform(paths.with_path_parts)


NORMALIZED_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), True),
    T.StructField("source_rate", T.IntegerType(), True),
    T.StructField("source_channels", T.IntegerType(), True),
    T.StructField("duration_seconds", T.DoubleType(), True),
    T.StructField("length_ms", T.LongType(), True),
    T.StructField("pcm", T.BinaryType(), True),
    T.StructField("error_message", T.StringType(), True),
])


_BLOCK_FRAMES = 1 << 16
_PCM, _FLOAT, _EXTENSIBLE = 1, 3, 0xFFFE


def _decoder(kind: int, width: int):
    """Frames' bytes to floats: 8 to 32-bit PCM, 32 and 64-bit float."""
    if kind == _FLOAT and width in (4, 8):
        return lambda raw: np.frombuffer(raw, f"<f{width}").astype(np.float64)
    if kind != _PCM or width not in (1, 2, 3, 4):
        raise ValueError(f"unsupported WAV encoding {kind} of {8 * width} bits")
    if width == 1:
        return lambda raw: (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    if width == 3:
        def three(raw):
            parts = np.frombuffer(raw, np.uint8).reshape(-1, 3)
            wide = np.zeros((len(parts), 4), np.uint8)
            wide[:, 1:] = parts
            return wide.view("<i4").ravel() / 2.0 ** 31
        return three
    return lambda raw: np.frombuffer(raw, f"<i{width}") / 2.0 ** (8 * width - 1)


class Layout(NamedTuple):
    """Where and how a WAV file holds its samples."""

    rate: int
    channels: int
    frame: int                    # bytes of a frame
    begin: int                    # of the first frame
    frames: int
    decode: Callable[[bytes], np.ndarray]

    def mono(self, raw) -> np.ndarray:
        """Floats in [-1, 1) of whole frames, the channels averaged."""
        return self.decode(raw).reshape(-1, self.channels).mean(axis=1)


def wav_layout(read: Callable[[int, int], bytes], size: int, path: str) -> Layout:
    """The layout of a WAV file of ``size`` bytes; ``read(at, n)`` gives some of them.

    Only chunk headers and the format are read.  A data chunk whose size
    does not fit its 32 bits (RF64) or that is cut off goes to the file's end.
    """
    if path.endswith(".mp3"):
        raise ValueError("MP3 decoding is not available; convert to WAV first")
    head = bytes(read(0, 12))
    if len(head) < 12 or head[:4] not in (b"RIFF", b"RF64") or head[8:12] != b"WAVE":
        raise ValueError("not a RIFF WAVE file")
    at, layout = 12, None
    while at + 8 <= size:
        name_size = bytes(read(at, 8))
        name, length = name_size[:4], int.from_bytes(name_size[4:], "little")
        at += 8
        if name == b"fmt ":
            layout = bytes(read(at, min(length, 40)))
        elif name == b"data":
            length = min(length, size - at)
            break
        at += length + length % 2
    else:
        layout = None
    if layout is None or len(layout) < 16:
        raise ValueError("WAV file without format or data")
    kind, channels, rate = (int.from_bytes(layout[a:b], "little") for a, b in ((0, 2), (2, 4), (4, 8)))
    bits = int.from_bytes(layout[14:16], "little")
    if bits % 8:
        raise ValueError(f"unsupported WAV sample size of {bits} bits")
    width = bits // 8
    if kind == _EXTENSIBLE and len(layout) >= 26:
        kind = int.from_bytes(layout[24:26], "little")
    if not channels or not rate:
        raise ValueError("WAV file without channels or rate")
    decode, frame = _decoder(kind, width), width * channels
    return Layout(rate, channels, frame, at, length // frame, decode)


def _linear(samples: Callable[[int, int], np.ndarray], n: int, rate: int, target_rate: int) -> bytes:
    """All outputs by linear interpolation, in blocks of frames."""
    n_out = int(round(n * target_rate / rate))
    pcm, done, last = bytearray(), 0, np.empty(0)
    for begin in range(0, n, _BLOCK_FRAMES):
        end = min(begin + _BLOCK_FRAMES, n)
        block = samples(begin, end)
        block, begin = np.concatenate([last, block]), begin - len(last)
        # outputs whose right neighbour is here; the last block gives all that are left
        stop = n_out if end == n else min(n_out, -(-(end - 1) * target_rate // rate))
        place = np.arange(done, max(done, stop), dtype=np.int64) * rate
        left = np.minimum(place // target_rate, n - 1)
        right = np.minimum(left + 1, n - 1)
        share = (place - left * target_rate) / target_rate
        low = block[left - begin]
        x = low + (block[right - begin] - low) * np.where(right > left, share, 0)
        pcm += np.clip(np.round(x * 32768.0), -32768, 32767).astype("<i2").tobytes()
        done, last = max(done, stop), block[-1:]
    return bytes(pcm)


def decode_normalize(data: bytes, path: str, target_rate: int = config.TARGET_SAMPLE_RATE,
                     method: str = "linear"):
    """WAV bytes -> (rate, channels, duration s, length ms, PCM16 mono bytes).

    Channels are averaged, then resampled to ``target_rate`` in blocks of
    frames: beside the file and its result only one block is held.
    ``method`` "sinc" filters out what the new rate cannot hold (see
    :mod:`parley.functions.resample`); "linear" interpolates between
    neighbours, exact where an output falls on an input sample.  MP3 needs a
    codec that is not available: such files fail with an error message
    instead of stopping the job.
    """
    view = memoryview(data)
    layout = wav_layout(lambda at, n: view[at:at + n], len(view), path)

    def samples(a: int, b: int) -> np.ndarray:
        return layout.mono(view[layout.begin + a * layout.frame:layout.begin + b * layout.frame])
    if method == "linear":
        pcm = _linear(samples, layout.frames, layout.rate, target_rate)
    elif method == "sinc":
        filtered = Resampler(layout.rate, target_rate)
        pcm = filtered.pcm16(samples, layout.frames, 0, filtered.length(layout.frames)).tobytes()
    else:
        raise ValueError(f"unknown resampling method {method}")
    duration = len(pcm) // 2 / target_rate
    return layout.rate, layout.channels, duration, int(round(duration * 1000)), pcm


def normalize_audio(files: DataFrame, content_col: str = "content",
                    target_rate: int = config.TARGET_SAMPLE_RATE,
                    error_chars: int = config.PREPROCESS_ERROR_CHARS,
                    method: str = "linear") -> DataFrame:
    """Per file: 16 kHz mono PCM16, duration, length in ms; a file that
    cannot be decoded yields a row with ``error_message`` (job continues).

    A file is one row here.  :func:`read_wav_chunks` reads recordings of any
    size.  Metadata columns pass through as Arrow columns, nulls included.
    """

    keep = [f for f in files.schema.fields if f.name != content_col]
    extra = [f for f in NORMALIZED_SCHEMA.fields if f.name != "path"]
    out_schema = T.StructType(keep + extra)
    names = [f.name for f in extra]
    kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.binary(), pa.string()]

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):          # one recording's bytes at a time
                one = batch.slice(at, 1)
                data, path = one.column(content_col)[0].as_buffer(), one.column("path")[0].as_py()
                try:
                    if data is None:
                        raise ValueError("file is larger than one row can hold")
                    row = (*decode_normalize(data, path or "", target_rate, method), None)
                except Exception as e:  # row-level capture
                    row = (None, None, None, None, None, str(e)[:error_chars])
                yield pa.RecordBatch.from_arrays(
                    [*(one.column(f.name) for f in keep),
                     *(pa.array([v], k) for v, k in zip(row, kinds, strict=True))],
                    [f.name for f in keep] + names)

    # Metadata columns pass through the Python step: no join back.
    return files.mapInArrow(run, out_schema)


def read_wav_chunks(spark: SparkSession, root: str, spec: ChunkSpec = ChunkSpec(),
                    glob: str = config.AUDIO_GLOB, split_bytes: int = 128 << 20,
                    max_files: int | None = None) -> DataFrame:
    """The chunks of all recordings under ``root``, however large they are.

    The rows of ``audio_chunks(normalize_audio(read_audio(...), method="sinc"))``,
    but a recording never is a row: tasks read byte ranges of about
    ``split_bytes`` (see :mod:`parley.sources.wav_ranges`).  A file that
    cannot be decoded gives one row with ``error_message`` and null chunk
    columns, and so does every range of a file that cannot be read.
    ``max_files`` takes the first files by path.
    """
    from parley.sources.wav_ranges import WavChunks
    spark.dataSource.register(WavChunks)
    chunks = (spark.read.format(WavChunks.name()).option("glob", glob)
              .option("maxLen", spec.max_len).option("overlap", spec.overlap)
              .option("dropEmpty", str(spec.drop_empty).lower()).option("splitBytes", split_bytes)
              .option("maxFiles", -1 if max_files is None else max_files).load(root))
    return chunks.transform(paths.with_path_parts)


def audio_chunks(normalized: DataFrame, spec: ChunkSpec = ChunkSpec()) -> DataFrame:
    """Explode normalised recordings into WAV chunk payloads (``wav``),
    sliced from the PCM bytes by milliseconds, header written in the JVM.

    The slices are made before the rows are exploded: a chunk's row carries
    its own bytes, not the recording's.
    """
    ok = normalized.filter(F.col("error_message").isNull())
    keep = [c for c in normalized.columns if c != "pcm"]

    def cut(b):
        start = b["chunk_start"] * F.lit(BYTES_PER_MS) + F.lit(1)
        size = (b["chunk_end"] - b["chunk_start"]) * F.lit(BYTES_PER_MS)
        part = F.substring(F.col("pcm"), start.cast("int"), size.cast("int"))
        return F.struct(b["chunk_idx"].alias("chunk_idx"), b["chunk_start"].alias("chunk_start"),
                        b["chunk_end"].alias("chunk_end"),
                        wav.wav_file(part, config.TARGET_SAMPLE_RATE).alias("wav"))
    bounds = chunking.chunk_bounds(F.col("length_ms"), spec)
    return ok.select(*keep, F.size(bounds).alias("num_chunks"), F.inline(F.transform(bounds, cut)))
