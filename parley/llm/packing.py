"""Best-two-fit packing of tokenized documents into fixed-length sequences.

Documents are tokenized where they are read and cut into pieces of at most
one sequence.  Only the pieces' lengths are packed: they are dealt by a hash
of (document, piece) into groups of a bounded number of tokens, and each
group fills its own sequences, so no task sees the whole corpus and a long
document or a hot source spreads over all groups.  Each group leaves at most
a few part-filled sequences.

Packing a group: open a sequence and fill it greedily with the largest
piece that fits, until none does.  Then take its smallest piece out again if
two unpacked pieces fit the gap that leaves more tightly than it did.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.presplit import Presplitter, WordCache
from parley.llm.words import parts_for, small_batches, text_bytes

CAPACITY = 2048
GROUP_TEXT_BYTES = 32 << 20      # about 8 million tokens a packing group
END_ID = 0

_PIECE = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
          "ids binary")
_PLACED = _PIECE + ", sequence_id bigint, offset bigint"


@lru_cache(maxsize=2)
def _tokenizer(vocabulary: str):
    """Splitter and word cache of this Python worker; words are encoded by the library."""
    split = Presplitter(vocabulary)
    return split, WordCache(lambda word: array("I", split.ids(word)).tobytes())


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document: ids by the vocabulary, then ``END_ID``.

    A null or empty text is one piece holding the end id alone.  A document
    longer than ``capacity`` is cut there, and only there.  ``ids`` are
    little-endian unsigned 32-bit integers, null unless ``keep_ids``.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        split, cache = _tokenizer(vocabulary)
        end, width = array("I", [END_ID]).tobytes(), 4 * capacity
        for batch in small_batches(batches, text):
            rows: list[tuple] = []
            for doc, value in zip(batch.column(key).to_pylist(), batch.column(text).to_pylist(),
                                  strict=True):
                ids = b"".join(map(cache.__getitem__, split(value))) + end
                for k, at in enumerate(range(0, len(ids), width)):
                    cut = ids[at:at + width]
                    rows.append((doc, k, at // 4, len(cut) // 4, zlib.crc32(cut),
                                 cut if keep_ids else None))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    return docs.select(key, text).mapInArrow(run, _PIECE)


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices into ``lengths``; every index in exactly one bin.

    Lengths must be from 1 to ``capacity``.  Ties go to the index that comes
    last in the input.  Present lengths are one bit each of an integer, so
    the largest that fits a gap is one mask and one ``bit_length``.
    """
    by_length: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i, n in enumerate(lengths):
        by_length[n].append(i)
    present = sum(1 << n for n in range(1, capacity + 1) if by_length[n])

    def take(n: int) -> int:
        nonlocal present
        i = by_length[n].pop()
        if not by_length[n]:
            present &= ~(1 << n)
        return i

    def largest(gap: int) -> int:
        return (present & ((2 << gap) - 1)).bit_length() - 1

    def best_pair(gap: int, more_than: int) -> tuple[int, int] | None:
        """The two unpacked lengths with the largest sum in (more_than, gap]."""
        best, found = more_than, None
        a = largest(gap - 1)
        while a > 0 and 2 * a > best:            # a is the larger of the two
            b = largest(min(gap - a, a))
            if b == a and len(by_length[a]) < 2:
                b = largest(a - 1)
            if b > 0 and a + b > best:
                best, found = a + b, (a, b)
                if best == gap:
                    break
            a = largest(a - 1)
        return found

    bins = []
    while present:
        filled, gap = [], capacity
        while gap > 0 and (n := largest(gap)) > 0:
            filled.append(take(n))
            gap -= n
        if gap > 0 and len(filled) > 1:
            smallest = filled[-1]                # pieces went in by falling length
            n = lengths[smallest]
            pair = best_pair(gap + n, n)
            if pair:
                filled.pop()
                filled += [take(pair[0]), take(pair[1])]
                by_length[n].append(smallest)
                present |= 1 << n
        bins.append(filled)
    return bins


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False,
         group_bytes: int = GROUP_TEXT_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece with its sequence and its place there.

    Columns: those of :func:`pieces`, ``sequence_id`` (unique over the
    corpus, otherwise any number) and ``offset`` (gapless from 0 within a
    sequence).  Repeated rows are packed as documents of their own; rows
    with a null key too.  An empty table gives an empty result; other
    columns are not read.
    """
    groups = parts_for(text_bytes(docs, text), group_bytes)

    def place(group: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.drop_columns("_group").sort_by(
            [(c, "ascending") for c in ("length", "doc_id", "piece", "ids_crc32")])
        order, sequence, offset = [], [], []
        lengths = table.column("length").to_pylist()
        for k, members in enumerate(best_two_fit(lengths, capacity)):
            at = 0
            for i in members:
                order.append(i)
                sequence.append(group[0].as_py() << 32 | k)
                offset.append(at)
                at += lengths[i]
        return (table.take(pa.array(order, pa.int64()))
                .append_column("sequence_id", pa.array(sequence, pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64())))

    # the checksum spreads rows of one id, or of none, unless they are the same text
    dealt = pieces(docs, vocabulary, capacity, keep_ids, key, text).withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.lit(groups)).cast("int"))
    return dealt.groupBy("_group").applyInArrow(place, _PLACED)
