"""Document fingerprints by an invertible Bloom lookup sketch.

A text is the set of its paragraphs: lines, cut after sentence ends and in
runs of at most 16 words, each as a 64-bit digest; the k-th repeat of a
paragraph is a digest of its own.  A sketch puts every digest into three of
its cells, which keep a count, the XOR of the digests and the XOR of a check
hash.  Subtracting the sketches of two versions leaves the cells of the
digests in one but not the other, and peeling cells that hold a single
digest recovers them.  When peeling stops early, both versions are sketched
again with three times the cells and other hashes.

Documents follow each other by id.  They are shuffled once, into ranges of
ids of bounded text size, and the first document of a range is also sent to
the range before it.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.words import (BLOCKS, blocks_table, deal_blocks, parts_for, small_batches,
                              text_bytes)

CELLS = 48          # of the smallest sketch, a multiple of HASHES
HASHES = 3
GROWTH = 3
RUN_WORDS = 16
RANGE_TEXT_BYTES = 4 << 20
_LAST = (1 << 63) - 1
_PIECE = re.compile(r"[^\n.!?]*(?:[.!?]+(?=\s|$)|[.!?]+|\n|$)\s*")
_RUN = re.compile(r"(?:\s*\S+){1,%d}\s*|\s+" % RUN_WORDS)

RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def paragraphs(text: str) -> list[str]:
    """Pieces of the text; joined they give it back."""
    pieces = []
    for line in _PIECE.findall(text):
        if len(line) <= 2 * RUN_WORDS:
            if line:
                pieces.append(line)
        else:
            pieces += _RUN.findall(line)
    return pieces


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S32, _S29 = np.uint64(32), np.uint64(29)
_CHECK_SEED = np.uint64(0x5BF03635)


def _mix(v: np.ndarray) -> np.ndarray:
    v = v * _M1
    v ^= v >> _S32
    v *= _M2
    v ^= v >> _S29
    return v


def _check(digests: np.ndarray) -> np.ndarray:
    return _mix(digests ^ _CHECK_SEED)


@lru_cache(maxsize=64)
def _layout(cells: int) -> tuple[np.ndarray, np.uint64, np.ndarray]:
    """Hash seeds, cells and first cell of each third of a sketch."""
    third = cells // HASHES
    column = np.arange(HASHES, dtype=np.uint64)[:, None]
    return column + np.uint64(cells * 8 + 1), np.uint64(third), column * np.uint64(third)


def _places(digests: np.ndarray, cells: int) -> np.ndarray:
    """One cell in each third of the sketch for every digest, third by third."""
    seeds, third, first = _layout(cells)
    return (_mix(digests ^ seeds) % third + first).ravel().astype(np.int64)


@dataclass
class Sketch:
    """Counts, digest XORs and check XORs of the cells."""
    count: np.ndarray
    keys: np.ndarray
    checks: np.ndarray

    def __sub__(self, other: Sketch) -> Sketch:
        return Sketch(self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks)

    def hex(self) -> str:
        return (self.count.astype("<i4").tobytes() + self.keys.astype("<u8").tobytes()
                + self.checks.astype("<u8").tobytes()).hex()


class Fingerprint:
    """A text's digests and its sketches of any size."""

    def __init__(self, text: str):
        self.whole = xxhash.xxh3_128_hexdigest(text.encode("utf-8", "surrogatepass"))
        times: dict[str, int] = defaultdict(int)
        digests = []
        for piece in paragraphs(text):
            k = times[piece]
            times[piece] = k + 1
            digest = xxhash.xxh3_64_intdigest(piece.encode("utf-8", "surrogatepass"))
            # The repeat is hashed in, not used as a seed: seeds of short inputs
            # make equal digests of different pieces.
            digests.append(digest if not k else xxhash.xxh3_64_intdigest(
                b"repeat" + digest.to_bytes(8, "little") + k.to_bytes(8, "little")))
        # A digest twice would cancel in every sketch, of any size.
        self.digests = np.unique(np.array(digests, np.uint64))
        self._sketches: dict[int, Sketch] = {}

    def sketch(self, cells: int) -> Sketch:
        made = self._sketches.get(cells)
        if made is None:
            count = np.zeros(cells, np.int64)
            keys, checks = np.zeros(cells, np.uint64), np.zeros(cells, np.uint64)
            place = _places(self.digests, cells)
            count += np.bincount(place, minlength=cells)
            np.bitwise_xor.at(keys, place, np.concatenate((self.digests,) * HASHES))
            np.bitwise_xor.at(checks, place, np.concatenate((_check(self.digests),) * HASHES))
            made = self._sketches[cells] = Sketch(count, keys, checks)
        return made

    def text(self, cells: int = CELLS) -> str:
        """Fixed-length form: digest of the whole text and the smallest sketch."""
        return self.whole + ":" + self.sketch(cells).hex()


def peel(sketch: Sketch) -> tuple[np.ndarray, np.ndarray] | None:
    """Digests only in the first and only in the second version; None if cells are left over."""
    count, keys, checks = sketch.count, sketch.keys, sketch.checks
    # Every digest found empties a cell for good, so no more than cells can be found;
    # each digest counts one in every third.
    if np.abs(count).reshape(HASHES, -1).sum(axis=1).max() > len(count):
        return None
    count, keys, checks = count.copy(), keys.copy(), checks.copy()
    mine, other = [], []
    while True:
        single = np.flatnonzero(np.abs(count) == 1)
        single = single[_check(keys[single]) == checks[single]]
        if not len(single):
            break
        order = single[np.argsort(keys[single])]         # a digest may stand alone in several cells
        found = keys[order]
        new = np.ones(len(found), bool)
        np.not_equal(found[1:], found[:-1], out=new[1:])
        order, found = order[new], found[new]
        sign, known = count[order], checks[order]
        mine.append(found[sign == 1])
        other.append(found[sign == -1])
        place = _places(found, len(count))
        np.subtract.at(count, place, np.concatenate((sign,) * HASHES))
        np.bitwise_xor.at(keys, place, np.concatenate((found,) * HASHES))
        np.bitwise_xor.at(checks, place, np.concatenate((known,) * HASHES))
    if count.any() or keys.any():
        return None
    nothing = np.empty(0, np.uint64)
    return np.concatenate([nothing, *mine]), np.concatenate([nothing, *other])


def difference(a: Fingerprint, b: Fingerprint, cells: int = CELLS):
    """Paragraph digests only in ``a`` and only in ``b``, by growing sketches."""
    if a.whole == b.whole:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    # at least so many digests differ, and a sketch gives no more than it has cells
    while abs(len(a.digests) - len(b.digests)) > cells:
        cells *= GROWTH
    while True:
        found = peel(a.sketch(cells) - b.sketch(cells))
        if found is not None:
            return found
        cells *= GROWTH


def likeness(a: Fingerprint, b: Fingerprint, cells: int = CELLS) -> float:
    """Shared paragraphs over all paragraphs of both; equal texts give 1."""
    if a.whole == b.whole:
        return 1.0
    only_a, only_b = difference(a, b, cells)
    total = len(a.digests) + len(b.digests)
    return 1.0 - (len(only_a) + len(only_b)) / total if total else 1.0


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_neighbours(docs: DataFrame, cells: int = CELLS, range_bytes: int = RANGE_TEXT_BYTES,
                       key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited version, and likeness to it and to the next text.

    Documents are in order of id, then text (null ids last); the last is
    followed by the first, and a single document by itself.  Null texts
    count as empty; two empty texts are equal, an empty and another text
    share nothing.  Repeated rows give repeated rows; other columns are not
    read; an empty table gives an empty result.
    """
    ranges = parts_for(text_bytes(docs, text), range_bytes)
    fields = pa.schema([("_guest", pa.bool_()), ("_key", pa.int64()), ("doc_id", pa.int64()),
                        ("text", pa.string())])
    place = F.coalesce(F.col(key), F.lit(_LAST))
    keys = docs.select(place.cast("double").alias("k"))
    cuts = np.array(sorted(set(keys.approxQuantile(
        "k", [i / ranges for i in range(1, ranges)], 1 / (8 * ranges)))) if ranges > 1 else [])

    def ranged(keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(cuts, keys.astype(np.float64), side="right")

    def least(batches):
        for batch in batches:
            k = batch.column("k").to_numpy()
            r = ranged(k)
            got = np.unique(r)
            yield pa.RecordBatch.from_arrays(
                [pa.array(got, pa.int32()), pa.array([k[r == x].min() for x in got], pa.int64())],
                ["r", "k"])
    # One row for each range: its first id.  Empty ranges have none.
    firsts = {row["r"]: row["k"] for row in docs.select(place.alias("k")).mapInArrow(
        least, "r int, k bigint").groupBy("r").agg(F.min("k").alias("k")).collect()}
    full = sorted(firsts)
    before = {r: full[i - 1] for i, r in enumerate(full)}

    def placed(batches):
        for batch in small_batches(batches, "text"):
            k = batch.column("_key").to_numpy()
            r = ranged(k)
            guest = np.flatnonzero([firsts[x] == y for x, y in zip(r.tolist(), k.tolist(),
                                                                   strict=True)])
            for rows, to, is_guest in (
                    (batch, r, False),
                    (batch.take(pa.array(guest, pa.int64())), [before[x] for x in r[guest]], True)):
                yield np.array(to, np.int32), pa.RecordBatch.from_arrays(
                    [pa.array([is_guest] * rows.num_rows, pa.bool_()), *rows.columns], fields.names)

    def dealt(batches):
        yield from deal_blocks(placed(batches), fields)

    def compared(blocks: pa.Table) -> pa.Table:
        table = blocks_table(blocks.column("_blob"))
        rows = sorted(zip(table.column("_guest").to_pylist(), table.column("_key").to_pylist(),
                          [t or "" for t in table.column("text").to_pylist()],
                          table.column("doc_id").to_pylist(), strict=True),
                      key=lambda row: row[:3])
        own = [row for row in rows if not row[0]]
        after = [row[2] for row in own[1:]] + [rows[len(own)][2]]
        out, mine = [], Fingerprint(own[0][2]) if own else None
        for (_, _, value, doc), following in zip(own, after, strict=True):
            changed = edited(value, following)
            theirs, new = Fingerprint(following), Fingerprint(changed)
            out.append((doc, len(value),
                        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                        mine.text(cells), new.text(cells), likeness(mine, new, cells),
                        likeness(mine, theirs, cells)))
            mine = theirs
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
                 pa.float64()]
        names = [part.split()[0] for part in RESULT.split(", ")]
        return pa.table({n: pa.array(c, k) for n, c, k in
                         zip(names, zip(*out, strict=True), kinds, strict=True)})

    source = docs.select(place.alias("_key"), F.col(key).cast("long").alias("doc_id"),
                         F.col(text).alias("text"))
    return source.mapInArrow(dealt, BLOCKS).groupBy("_part").applyInArrow(compared, RESULT)
