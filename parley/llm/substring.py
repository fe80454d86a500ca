"""Repeated-passage removal with a count-min prefilter.

A window is ``window`` consecutive words of one document.  Documents are
dealt by a hash of their id into chunks of bounded text size, and all steps
are one plan over that single shuffle of the texts:

1. Every chunk sketches its windows: a row of count-min cells for each of
   two hashes, sparse, with counts up to two, sent in slices of cells.
2. Each slice adds up the sketches of all chunks and tells every chunk which
   of its own cells hold two or more.  Cells can only overestimate, so no
   repeated window is lost; nothing is broadcast and nothing is capped.
3. Every chunk sends the 128-bit digests of the windows estimated repeated,
   one row for each digest with its first document there; these are grouped
   exactly, and each chunk learns which digests begin earlier elsewhere.
4. A window goes if its digest began earlier in the chunk or elsewhere; the
   words it covers are removed.  All is judged on the input texts.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.words import (BLOCKS, ascii_words, blocks_table, deal_blocks, parts_for,
                              planes, small_batches, text_bytes, unplanes)

WINDOW = 20
CHUNK_TEXT_BYTES = 6 << 20
SLICE_CELLS = 1 << 20        # windows a slice of the sketch or a bucket of digests serves
_ROWS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)      # one odd multiplier a sketch row
_BASE = 0x5851F42D4C957F2D | 1
_SEGMENT = 1 << 20
_LAST = (1 << 63) - 1                                  # order of a null id

_BLOBS = "_chunk int, _slice int, _blob binary"


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


_TABLE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@lru_cache(maxsize=1)
def _segment_powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; made in each worker, not sent to it."""
    return _powers(_BASE, _SEGMENT), _powers(pow(_BASE, -1, 1 << 64), _SEGMENT)


class Words:
    """Words of one text joined by one space, with the place of each."""

    def __init__(self, text: str | None, window: int):
        words = ascii_words(text, lower=False)
        self.joined = b" ".join(words)
        self.n = len(words)
        self.starts = np.fromiter(accumulate((len(w) + 1 for w in words), initial=0),
                                  np.int64, self.n + 1)
        self.window = window
        self.windows = max(0, self.n - window + 1)

    def hashes(self) -> np.ndarray:
        """A 64-bit polynomial hash of every window's bytes."""
        out = np.empty(self.windows, np.uint64)
        at = 0
        while at < self.windows:
            begin = self.starts[at]
            to = int(np.searchsorted(self.starts, begin + _SEGMENT, "right")) - self.window
            to = min(max(to, at + 1), self.windows)
            first = self.starts[at:to] - begin
            after = self.starts[at + self.window:to + self.window] - 1 - begin
            size = int(after[-1])
            up, down = (_segment_powers() if size < _SEGMENT else
                        (_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)))
            raw = np.frombuffer(self.joined, np.uint8, size, int(begin))
            total = np.zeros(size + 1, np.uint64)
            np.cumsum(_TABLE[raw] * up[:size], out=total[1:])
            out[at:to] = (total[after] - total[first]) * down[first]
            at = to
        return _mix(out)

    def digest(self, i: int) -> bytes:
        return xxhash.xxh3_128_digest(
            self.joined[self.starts[i]:self.starts[i + self.window] - 1])


class Sketch:
    """Shape of the count-min sketch and its sparse coding.

    The width is a power of two of about 16 cells for each window of the
    corpus.  A chunk's cells are sorted and stored as gaps; the largest code
    of the gap type means that many cells further on, without a cell there.
    """

    def __init__(self, windows: int, chunks: int):
        self.bits = min(60, max(16, (16 * max(1, windows)).bit_length()))
        self.slice_bits = min(self.bits - 8, parts_for(windows, SLICE_CELLS).bit_length())
        self.low = self.bits - self.slice_bits
        self.gap = np.dtype(np.uint16 if chunks < 500 else np.uint32)
        self.most = int(np.iinfo(self.gap).max)

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        return _mix(hashes * np.uint64(_ROWS[row])) >> np.uint64(64 - self.bits)

    def bounds(self, cells: np.ndarray) -> np.ndarray:
        edges = np.arange((1 << self.slice_bits) + 1, dtype=np.uint64) << np.uint64(self.low)
        return np.searchsorted(cells, edges)

    def code(self, cells: np.ndarray) -> bytes:
        """Sorted cells of one slice."""
        low = (cells & np.uint64((1 << self.low) - 1)).astype(np.int64)
        gaps = np.diff(low, prepend=0)
        jumps = gaps // self.most
        out = np.full(len(gaps) + int(jumps.sum()), self.most, self.gap)
        out[np.arange(len(gaps)) + np.cumsum(jumps)] = gaps % self.most
        return zstandard.compress(planes(out), 1)

    def decode(self, blob: bytes) -> np.ndarray:
        codes = unplanes(zstandard.decompress(blob), self.gap)
        return np.cumsum(codes, dtype=np.int64)[codes != self.most]


def _texts(table: pa.Table, key: str, text: str, window: int):
    """Row order (id, text; null ids last) and the words of each row."""
    keys = [_LAST if k is None else k for k in table.column(key).to_pylist()]
    values = table.column(text).to_pylist()
    order = sorted(range(len(keys)), key=lambda i: (keys[i], values[i] or ""))
    return keys, order, {i: Words(values[i], window) for i in order}


def _all_hashes(order, words) -> np.ndarray:
    return np.concatenate([np.empty(0, np.uint64), *(words[i].hashes() for i in order)])


def _estimated_repeated(sketch: Sketch, hashes: np.ndarray, replies: dict[int, bytes]) -> np.ndarray:
    """Windows whose cells hold two or more in both rows of the merged sketch."""
    repeated = np.ones(len(hashes), bool)
    for row in range(len(_ROWS)):
        cells, place = np.unique(sketch.cells(hashes, row), return_inverse=True)
        bounds = sketch.bounds(cells)
        full = np.zeros(len(cells), bool)
        for s in np.flatnonzero(np.diff(bounds)):
            a, b = bounds[s], bounds[s + 1]
            bits = np.frombuffer(replies[row << sketch.slice_bits | int(s)], np.uint8)
            full[a:b] = np.unpackbits(bits, count=b - a)
        repeated &= full[place]
    return repeated


def _with_parts(parts: np.ndarray, rows: pa.RecordBatch, text: str):
    at = 0
    for batch in small_batches([rows], text):
        yield parts[at:at + batch.num_rows], batch
        at += batch.num_rows


def _blob_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    chunk, part, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"_chunk": pa.array(chunk, pa.int32()), "_slice": pa.array(part, pa.int32()),
                     "_blob": pa.array(blob, pa.binary())})


def remove_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_TEXT_BYTES,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with their columns, plus n_words, n_removed and kept_text.

    ``kept_text`` joins the words that stay by one space.  A word goes if a
    window that covers it also starts earlier: in a smaller id, or earlier
    in the same document.  Null texts have no words; texts shorter than a
    window lose none.  Rows of equal id follow each other in text order and
    null ids come last, and the earlier one's windows start earlier.  Input
    columns with the names of the three results are replaced.
    """
    size = text_bytes(docs, text)
    chunks = parts_for(size, chunk_bytes)
    windows = size // 6                      # about six bytes a word; sizes the sketch only
    sketch = Sketch(windows, chunks)
    buckets = parts_for(windows, SLICE_CELLS)
    given = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    kept_schema = T.StructType([*(docs.schema[c] for c in given),
                                T.StructField("n_words", T.LongType()),
                                T.StructField("n_removed", T.LongType()),
                                T.StructField("kept_text", T.StringType())])
    # every row's chunk stands first, whatever the other columns are called
    placed = docs.select(F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int"), *given)

    def dealt(batches):
        for batch in batches:
            rows = pa.RecordBatch.from_arrays(batch.columns[1:], given)
            yield from deal_blocks(_with_parts(batch.column(0).to_numpy(), rows, text), rows.schema)

    def sketched(part: tuple[pa.Scalar, ...], blocks: pa.Table) -> pa.Table:
        table = blocks_table(blocks.column("_blob"))
        _, order, words = _texts(table, key, text, window)
        hashes, rows = _all_hashes(order, words), []
        for row in range(len(_ROWS)):
            cells = np.sort(sketch.cells(hashes, row))
            again = np.zeros(len(cells), bool)
            again[2:] = (cells[2:] == cells[1:-1]) & (cells[2:] == cells[:-2])
            cells = cells[~again]            # counts up to two
            bounds = sketch.bounds(cells)
            rows += [(part[0].as_py(), row << sketch.slice_bits | int(s),
                      sketch.code(cells[bounds[s]:bounds[s + 1]]))
                     for s in np.flatnonzero(np.diff(bounds))]
        return _blob_table(rows)

    def merged(part: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunk = table.column("_chunk").to_pylist()
        blobs = table.column("_blob").to_pylist()
        total = np.zeros(1 << sketch.low, np.uint8)      # saturates at two
        for blob in blobs:
            cells = sketch.decode(blob)                  # sorted, each once or twice
            again = cells[1:][cells[1:] == cells[:-1]]
            total[cells] = np.minimum(total[cells] + 1, 2)
            total[again] = 2
        out = []
        for c, blob in zip(chunk, blobs, strict=True):
            cells = sketch.decode(blob)
            cells = cells[np.diff(cells, prepend=-1) > 0]
            out.append((c, part[0].as_py(), np.packbits(total[cells] > 1).tobytes()))
        return _blob_table(out)

    def flagged(table: pa.Table, replies: pa.Table):
        keys, order, words = _texts(table, key, text, window)
        told = dict(zip(replies.column("_slice").to_pylist(), replies.column("_blob").to_pylist(),
                        strict=True))
        repeated = _estimated_repeated(sketch, _all_hashes(order, words), told)
        at = 0
        for i in order:
            n = words[i].windows
            yield keys[i], i, words[i], np.flatnonzero(repeated[at:at + n])
            at += n

    def candidates(part: tuple[pa.Scalar, ...], blocks: pa.Table, replies: pa.Table) -> pa.Table:
        table = blocks_table(blocks.column("_blob"))
        first: dict[bytes, int] = {}
        for k, _, text_words, starts in flagged(table, replies):
            for s in starts.tolist():
                first.setdefault(text_words.digest(s), k)
        if not first:
            return _blob_table([])
        digests = np.frombuffer(b"".join(first), "<u8").reshape(-1, 2)
        rows = np.column_stack([digests, np.array(list(first.values()), np.int64).view(np.uint64)])
        bucket = rows[:, 0] % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        rows, bucket = rows[order], bucket[order]
        bounds = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        return _blob_table([(part[0].as_py(), int(b), rows[bounds[b]:bounds[b + 1]].tobytes())
                            for b in np.flatnonzero(np.diff(bounds))])

    def earlier(part: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        blobs = table.column("_blob").to_pylist()
        rows = np.frombuffer(b"".join(blobs), "<u8").reshape(-1, 3)
        chunk = np.repeat(table.column("_chunk").to_numpy(), [len(b) // 24 for b in blobs])
        order = np.lexsort((rows[:, 2].view(np.int64), rows[:, 1], rows[:, 0]))
        rows, chunk = rows[order], chunk[order]
        later = np.zeros(len(rows), bool)
        later[1:] = (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 1])
        rows, chunk = rows[later, :2], chunk[later]
        if not len(rows):
            return _blob_table([])
        order = np.argsort(chunk, kind="stable")
        rows, chunk = rows[order], chunk[order]
        told, bounds = np.unique(chunk, return_index=True)
        return _blob_table([(int(c), -1, mine.tobytes()) for c, mine in
                            zip(told, np.split(rows, bounds[1:]), strict=True)])

    def cleaned(part: tuple[pa.Scalar, ...], blocks: pa.Table, told: pa.Table) -> pa.Table:
        table = blocks_table(blocks.column("_blob"))
        elsewhere = pc.equal(told.column("_slice"), -1)
        gone = b"".join(told.filter(elsewhere).column("_blob").to_pylist())
        seen = {gone[at:at + 16] for at in range(0, len(gone), 16)}
        n = table.num_rows
        n_words, n_removed, kept = [0] * n, [0] * n, [""] * n
        for _, i, w, starts in flagged(table, told.filter(pc.invert(elsewhere))):
            edges = np.zeros(w.n + 1, np.int64)
            for s in starts.tolist():
                digest = w.digest(s)
                if digest in seen:
                    edges[s] += 1
                    edges[s + window] -= 1
                else:
                    seen.add(digest)
            removed = np.cumsum(edges[:-1]) > 0
            n_words[i], n_removed[i] = w.n, int(removed.sum())
            kept[i] = (w.joined if not n_removed[i] else b" ".join(
                [w.joined[w.starts[j]:w.starts[j + 1] - 1] for j in np.flatnonzero(~removed)]
            )).decode("utf-8", "surrogatepass")
        out = table.select(given)
        for name, values, kind in (("n_words", n_words, pa.int64()),
                                   ("n_removed", n_removed, pa.int64()),
                                   ("kept_text", kept, pa.string())):
            out = out.append_column(name, pa.array(values, kind))
        return out

    by_chunk = placed.mapInArrow(dealt, BLOCKS).groupBy("_part")
    replies = (by_chunk.applyInArrow(sketched, _BLOBS)
               .groupBy("_slice").applyInArrow(merged, _BLOBS))
    gone = (by_chunk.cogroup(replies.groupBy("_chunk")).applyInArrow(candidates, _BLOBS)
            .groupBy("_slice").applyInArrow(earlier, _BLOBS))
    told = replies.union(gone)
    return by_chunk.cogroup(told.groupBy("_chunk")).applyInArrow(cleaned, kept_schema)
