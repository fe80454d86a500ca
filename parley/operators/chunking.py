"""Overlapping chunk plan (audio milliseconds or text characters)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.config import ChunkSpec


def chunk_count(length: Column, spec: ChunkSpec) -> Column:
    """1 if ``length <= max_len`` else ``floor(length / step) + 1``."""
    return F.when(length <= F.lit(spec.max_len), F.lit(1)).otherwise(
        F.floor(length / F.lit(spec.step)).cast("int") + F.lit(1))


def chunk_bounds(length: Column, spec: ChunkSpec) -> Column:
    """Array of ``struct(chunk_idx, chunk_start, chunk_end)`` covering ``[0, length)``.

    Chunk i is ``[i*step, min(length, i*step + max_len))``.  As in the
    original plan, a length that is a multiple of the step ends with an
    empty chunk and a small remainder gives a last chunk that lies inside
    the previous one; ``spec.drop_empty`` removes empty chunks.
    """
    n = chunk_count(length, spec)
    idx = F.sequence(F.lit(0).cast("long"), (n - F.lit(1)).cast("long"))

    def bound(i):
        start = (i.cast("long") * F.lit(spec.step)).cast("long")
        end = F.least(length.cast("long"), start + F.lit(spec.max_len))
        return F.struct(i.alias("chunk_idx"), start.alias("chunk_start"), end.alias("chunk_end"))

    arr = F.transform(idx, bound)
    if spec.drop_empty:
        arr = F.filter(arr, lambda b: b["chunk_end"] > b["chunk_start"])
    return arr


def plan_chunks(df: DataFrame, length_col: str, spec: ChunkSpec = ChunkSpec()) -> DataFrame:
    """Explode each row into its chunks; adds ``num_chunks, chunk_idx,
    chunk_start, chunk_end``.

    A narrow transform: every row expands in its own task, no shuffle.
    """
    arr = chunk_bounds(F.col(length_col), spec)
    return (df.withColumn("_chunks", arr)
              .withColumn("num_chunks", F.size("_chunks"))
              .select("*", F.inline("_chunks"))
              .drop("_chunks"))


# Chunks cut from one block of a text: a block is found by one scan from the
# text's start, its chunks by scans from the block's start.
BLOCK_CHUNKS = 64


def chunk_text(df: DataFrame, text_col: str, spec: ChunkSpec,
               out_col: str = "chunk_text", keep_text: bool = False) -> DataFrame:
    """Chunk a text column by characters; adds the chunk's substring.

    The slices are made before the rows are exploded, so the text is not
    carried into every chunk's row, and in two levels, so finding a
    character position never scans the text from its start for every chunk.
    """
    keep = [c for c in df.columns if keep_text or c != text_col]
    size, count = F.char_length(text_col).cast("long"), chunk_count(F.col("_len"), spec)
    measured = df.withColumn("_len", size).withColumn("_n", count)
    last_block = F.floor((F.col("_n") - F.lit(1)) / F.lit(BLOCK_CHUNKS)).cast("long")
    step, width = spec.step * BLOCK_CHUNKS, spec.step * (BLOCK_CHUNKS - 1) + spec.max_len
    blocks = F.transform(F.sequence(F.lit(0).cast("long"), last_block), lambda b: F.struct(
        b.alias("_block"), F.substring(F.col(text_col), (b * step + 1).cast("int"),
                                       F.lit(width)).alias("_part")))
    parts = measured.select(*keep, "_len", "_n", F.inline(blocks))
    first = F.col("_block") * F.lit(BLOCK_CHUNKS)
    chosen = F.sequence(first, F.least((F.col("_n") - F.lit(1)).cast("long"),
                                       first + F.lit(BLOCK_CHUNKS - 1)))

    def chunk(i: Column) -> Column:
        start = (i * F.lit(spec.step)).cast("long")
        end = F.least(F.col("_len"), start + F.lit(spec.max_len))
        at = (start - F.col("_block") * F.lit(step) + F.lit(1)).cast("int")
        return F.struct(i.alias("chunk_idx"), start.alias("chunk_start"), end.alias("chunk_end"),
                        F.substring(F.col("_part"), at, (end - start).cast("int")).alias(out_col))
    made = F.transform(chosen, chunk)
    n = F.col("_n")
    if spec.drop_empty:
        made = F.filter(made, lambda c: c["chunk_end"] > c["chunk_start"])
        n = F.size(chunk_bounds(F.col("_len"), spec))
    return parts.select(*keep, n.cast("int").alias("num_chunks"), F.inline(made))
