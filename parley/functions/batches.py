"""Pieces of Arrow batches: rows a batch are fixed, but texts differ in length."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20


def pieces(sizes: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of rows that begin in the same ``limit`` bytes.

    A piece is longer than ``limit`` by at most its last row.
    """
    block = (np.cumsum(sizes) - sizes) // limit
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    yield from zip(starts.tolist(), [*starts[1:].tolist(), len(sizes)], strict=False)


def batch_pieces(batches: Iterator[pa.RecordBatch], limit: int = PIECE_BYTES,
                 column: int | str = 0) -> Iterator[pa.RecordBatch]:
    """Batches cut by the size of one column, a string or binary, the first by default."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
        for start, stop in pieces(sizes, limit):
            yield batch.slice(start, stop - start)


def by_pieces(texts: pd.Series, apply: Callable, empty, limit: int = PIECE_BYTES):
    """``apply`` on pieces of ``texts``, its results one below the other."""
    sizes = texts.str.len().fillna(0).to_numpy().astype(np.int64)
    found = [apply(texts.iloc[a:b].reset_index(drop=True)) for a, b in pieces(sizes, limit)]
    return pd.concat(found, ignore_index=True) if found else empty
