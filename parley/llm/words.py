"""Word and batch helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import ensure_checkpoint_dir


def ascii_words(text: str | None, lower: bool = True) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; null gives none.

    ``bytes.split`` separates at exactly these six characters and
    ``bytes.lower`` maps A-Z alone.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def crc_mod(key: str, mod: int) -> Column:
    """``crc32(key as text) mod n``, the split rule of the labelled queries.

    A null key counts as the empty text.
    """
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")),
                  F.lit(mod))


def give_back() -> None:
    """Return freed memory of this Python worker to the machine.

    Workers serve one stage after the other; what their allocators keep of
    one is not there for the next, nor for the JVM beside them.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):      # not glibc
        pass


def small_batches(batches: Iterator[pa.RecordBatch], text: str,
                  most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one holds about ``most`` bytes of text."""
    for batch in batches:
        start, size = 0, 0
        lengths = pc.binary_length(batch.column(text)).to_pylist()
        for i, n in enumerate(lengths):
            size += n or 0
            if size >= most:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)
    give_back()


BLOCK_BUFFER = 12 << 20
BLOCKS = "_part int, _blob binary"


def deal_blocks(pieces: Iterator[tuple[np.ndarray, pa.RecordBatch]], schema: pa.Schema,
                buffer: int = BLOCK_BUFFER) -> Iterator[pa.RecordBatch]:
    """Rows as compressed Arrow streams, one for each part and buffer of rows.

    ``pieces`` gives the part of every row of a batch.  Texts cross a
    shuffle at a fraction of their size this way, and never as JVM rows.
    """
    def flush(held: list[tuple[np.ndarray, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        part = np.concatenate([p for p, _ in held])
        table = pa.Table.from_batches([b for _, b in held]).cast(schema)
        order = np.argsort(part, kind="stable")
        found, first = np.unique(part[order], return_index=True)
        blobs = []
        for rows in np.split(order, first[1:]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(
                    compression="zstd")) as writer:
                writer.write_table(table.take(pa.array(rows)))
            blobs.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(blobs, pa.binary())], ["_part", "_blob"])
    held: list[tuple[np.ndarray, pa.RecordBatch]] = []
    waiting = 0
    for part, batch in pieces:
        if batch.num_rows:
            held.append((part, batch))
            waiting += batch.nbytes
        if waiting >= buffer:
            yield from flush(held)
            held, waiting = [], 0
    if held:
        yield from flush(held)


def blocks_table(blobs: pa.ChunkedArray) -> pa.Table | None:
    """The rows of dealt blocks, None for no block."""
    give_back()                            # of the chunk before
    tables = [pa.ipc.open_stream(b).read_all() for b in blobs.to_pylist()]
    return pa.concat_tables(tables) if tables else None


def planes(values: np.ndarray) -> bytes:
    """Little-endian bytes, the lowest of all values first: compresses well."""
    raw = np.ascontiguousarray(values)
    return raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes()


def unplanes(blob: bytes | memoryview, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    raw = np.frombuffer(blob, np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(raw.T).view(dtype).ravel()


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of a text column over all rows."""
    return df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0


def parts_for(size: int, each: int) -> int:
    """How many partitions of about ``each`` units hold ``size`` units."""
    return max(1, -(-int(size) // int(each)))


def stage(df: DataFrame) -> DataFrame:
    """The rows, written as Parquet in the shared checkpoint folder and read again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
