"""Language-model scoring with an Elias-Fano n-gram trie.

Model: word unigrams with one added count, and bigrams and trigrams with
Dirichlet smoothing, each drawn to the order below it::

    p1(z)     = (c(z) + 1) / (N + V + 1)
    p2(z|y)   = c(yz) / (c(y) + M2) + M2 / (c(y) + M2) * p1(z)
    p3(z|xy)  = c(xyz) / (c(xy) + M3) + M3 / (c(xy) + M3) * p2(z|y)

The first terms of p2 and p3 are the trie's quantised payload.  A text is
its words and one end token; before the first word there is a start mark
that is a context only.

Everything that grows with the corpus stays distributed:

1. Texts are dealt once, in compressed blocks, into chunks of bounded size.
2. Chunks send the counts of their distinct words to word shards, which give
   every trained word a number (frequent words small ones) and its count.
3. Chunks send their distinct bigrams and the trigrams that extend them to
   gram shards, with training counts, zero for grams seen held out only.  A
   gram's shard depends on its first word and, for spreading frequent first
   words, on a part of its second.  Each shard adds the counts up, builds its
   trie from the trained grams, and answers for all grams that were sent.
4. Chunks add up the probabilities of their texts' tokens.

A trie level keeps its entries as one monotone sequence: context rank times
the size of the vocabulary plus the word's number.  Sequences and the
pointers from contexts to the ranges of their successors are Elias-Fano
coded in a memory-mapped file without a name, gone with the task.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.words import (BLOCKS, blocks_table, deal_blocks, parts_for,
                              planes, small_batches, text_bytes, unplanes)

M2, M3 = 2000.0, 10.0
CHUNK_TEXT_BYTES = 5 << 20
SHARD_GRAMS = 1_000_000
SHARD_WORDS = 1_000_000
UNKNOWN, START, FIRST_ID = 0, 1, 2
END_WORD = b" end"                              # no word holds a space

_BLOBS = "_chunk int, _part int, _blob binary, _tokens bigint, _types bigint"
RESULT = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


# ---- Elias-Fano sequences and the trie ------------------------------------
_BLOCK = 1 << 16
_SAMPLE = 512


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """The lowest ``bits`` bits of each value, one after the other."""
    shifts = np.arange(bits, dtype=np.uint64)
    parts = [np.packbits(((values[at:at + _BLOCK, None] >> shifts) & np.uint64(1)).astype(np.uint8))
             for at in range(0, len(values), _BLOCK)]   # a block is a whole number of bytes
    return np.concatenate(parts) if parts and bits else np.zeros(0, np.uint8)


class EliasFano:
    """A monotone sequence in about 2 + log2(universe / n) bits an entry."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray,
                 samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) // 8 + 1) * 8 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, _pack(values, low_bits), np.packbits(bits), ones[::_SAMPLE])

    def slice(self, begin: int, end: int) -> np.ndarray:
        """Entries ``begin`` to ``end``."""
        end = min(end, self.n)
        if begin >= end:
            return np.empty(0, np.uint64)
        start = begin - begin % _SAMPLE
        at = int(self.samples[start // _SAMPLE])
        last = -(-end // _SAMPLE)
        stop = int(self.samples[last]) + 1 if last < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(np.asarray(self.high[at // 8:-(-stop // 8)]))
        ones = np.flatnonzero(bits) + at // 8 * 8
        ones = ones[np.searchsorted(ones, at):][begin - start:end - start]
        values = (ones - np.arange(begin, end)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            first, past = begin * self.low_bits, end * self.low_bits
            low = np.unpackbits(np.asarray(self.low[first // 8:-(-past // 8)]))
            low = low[first % 8:][:past - first].reshape(-1, self.low_bits)
            for bit in range(self.low_bits):
                values |= low[:, bit].astype(np.uint64) << np.uint64(bit)
        return values

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.samples]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each of the sorted keys by successor search, -1 where it is absent."""
        found = np.full(len(keys), -1, np.int64)
        done = 0
        for begin in range(0, self.n, _BLOCK):
            if done >= len(keys):
                break
            block = self.slice(begin, begin + _BLOCK)
            to = done + int(np.searchsorted(keys[done:], block[-1], "right"))
            some = keys[done:to]
            successor = np.searchsorted(block, some)
            same = block[successor] == some
            found[done:to][same] = begin + successor[same]
            done = to
        return found


_CODE_STEPS, _CODE_BITS = 1600.0, 40.0


def quantise(p: np.ndarray) -> np.ndarray:
    """16-bit codes, 1600 for each halving; the smallest is 2 ** -40."""
    steps = np.rint((np.log2(np.maximum(p, 2.0 ** -_CODE_BITS)) + _CODE_BITS) * _CODE_STEPS)
    return (1 + steps).astype(np.uint16)


def probability(codes: np.ndarray) -> np.ndarray:
    """Back from codes; 0, an absent gram, gives 0."""
    values = np.exp2((codes.astype(np.float64) - 1) / _CODE_STEPS - _CODE_BITS)
    return np.where(codes == 0, 0.0, values)


class Trie:
    """Three levels: contexts, their successors, and the successors of those pairs.

    Successor levels hold (rank of the parent) * vocabulary + word; the
    pointers give the first successor of each parent.
    """

    def __init__(self, pairs: np.ndarray, pair_p: np.ndarray, triples_of: np.ndarray,
                 triples_word: np.ndarray, triple_p: np.ndarray):
        """``pairs``: sorted first << 32 | second; triples sorted by (rank of pair, word)."""
        first = pairs >> np.uint64(32)
        contexts, rank = np.unique(first, return_inverse=True)
        words = np.concatenate([pairs & np.uint64(0xFFFFFFFF), triples_word, [np.uint64(0)]])
        self.vocabulary = np.uint64(int(words.max()) + 1)
        levels = [
            EliasFano.build(contexts),
            EliasFano.build(np.searchsorted(rank, np.arange(len(contexts) + 1))),
            EliasFano.build(rank.astype(np.uint64) * self.vocabulary
                            + (pairs & np.uint64(0xFFFFFFFF))),
            EliasFano.build(np.searchsorted(triples_of, np.arange(len(pairs) + 1))),
            EliasFano.build(triples_of.astype(np.uint64) * self.vocabulary + triples_word)]
        self.codes = [quantise(pair_p), quantise(triple_p)]
        self._map([a for level in levels for a in level.arrays()] + self.codes, levels)

    def _map(self, arrays: list[np.ndarray], levels: list[EliasFano]) -> None:
        """Write all arrays into one unnamed file and use them from there."""
        with tempfile.TemporaryFile() as file:
            places = []
            for a in arrays:
                file.write(b"\0" * (-file.tell() % 8))
                places.append(file.tell())
                file.write(a.tobytes())
            file.write(b"\0")
            file.flush()
            view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        mapped = [np.frombuffer(view, a.dtype, a.size, at) for a, at in
                  zip(arrays, places, strict=True)]
        self.contexts, self.second_at, self.second, self.third_at, self.third = (
            EliasFano(level.n, level.low_bits, *mapped[3 * i:3 * i + 3])
            for i, level in enumerate(levels))
        self.pair_codes, self.triple_codes = mapped[15:]

    def _successors(self, parents: EliasFano, level: EliasFano, codes: np.ndarray,
                    parent: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and codes of words among the successors of their parents.

        Parents ascend and words ascend within one; a parent of -1 has none.
        """
        rank = np.full(len(parent), -1, np.int64)
        known = (parent >= 0) & (word < self.vocabulary)
        rank[known] = level.find(parent[known].astype(np.uint64) * self.vocabulary + word[known])
        # a successor lies in its parent's range
        for at in range(0, parents.n, _BLOCK):
            bounds = parents.slice(at, at + _BLOCK + 1).astype(np.int64)
            here = np.flatnonzero((rank >= 0) & (parent >= at) & (parent < at + len(bounds) - 1))
            own = parent[here] - at
            rank[here[(rank[here] < bounds[own]) | (rank[here] >= bounds[own + 1])]] = -1
        return rank, np.where(rank >= 0, codes[np.maximum(rank, 0)] if len(codes) else 0, 0)

    def look_up(self, pairs: np.ndarray, triples_of: np.ndarray, triples_word: np.ndarray):
        """Codes of sorted pairs, and of triples given by the place of their pair."""
        context = self.contexts.find(pairs >> np.uint64(32))
        rank, pair_codes = self._successors(self.second_at, self.second, self.pair_codes, context,
                                            pairs & np.uint64(0xFFFFFFFF))
        _, triple_codes = self._successors(self.third_at, self.third, self.triple_codes,
                                           rank[triples_of], triples_word)
        return pair_codes.astype(np.uint16), triple_codes.astype(np.uint16)


# ---- arrays on the wire ----------------------------------------------------
def bundle(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes."""
    head = np.array([len(arrays), *(len(a) * a.itemsize for a in arrays)], "<u4")
    return zstandard.compress(head.tobytes() + b"".join(map(planes, arrays)), 1)


def unbundle(blob: bytes, *dtypes) -> list[np.ndarray]:
    blob = zstandard.decompress(blob)
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    sizes = np.frombuffer(blob, "<u4", n, 4)
    ends = 4 * (n + 1) + np.cumsum(sizes, dtype=np.int64)
    view = memoryview(blob)
    return [unplanes(view[e - s:e], t) for s, e, t in
            zip(sizes.tolist(), ends.tolist(), dtypes, strict=True)]


def _mix(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    v = (v ^ (v >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return v ^ (v >> np.uint64(32))


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = _mix(np.arange(1, 257))                     # a 64-bit value for each byte
_SEGMENT, _SHORT = 1 << 20, 64
_BASE = 0x5851F42D4C957F2D


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


@lru_cache(maxsize=1)
def _segment_powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; made in each worker, not sent to it."""
    n = _SEGMENT + _SHORT
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes from each start to before its end, the same wherever they stand.

    Polynomial hashes from running sums, a segment at a time; words of more
    than 64 bytes are hashed one by one.
    """
    out = np.empty(len(starts), np.uint64)
    long = ends - starts > _SHORT
    short = np.flatnonzero(~long)
    up, down = _segment_powers()
    at = 0
    while at < len(short):
        begin = int(starts[short[at]])
        to = int(np.searchsorted(starts[short], begin + _SEGMENT))
        some = short[at:to]
        stop = int(ends[some[-1]])
        total = np.zeros(stop - begin + 1, np.uint64)
        np.cumsum(_VALUES[data[begin:stop]] * up[:stop - begin], out=total[1:])
        first = starts[some] - begin
        out[some] = (total[ends[some] - begin] - total[first]) * down[first]
        at = to
    out = _mix(out)
    for i in np.flatnonzero(long):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    return out


END_HASH = np.uint64(xxhash.xxh3_64_intdigest(END_WORD))


class ChunkTokens:
    """All tokens of a chunk's texts, one after the other, as places in its distinct words.

    A distinct word is its hash, in order; the end token's is that of a text
    no word can be.
    """

    def __init__(self, table: pa.Table):
        rows = blocks_table(table.column("_blob"))
        self.ids = rows.column("doc_id").to_pylist() if rows else []
        self.held = np.array(rows.column("held").to_pylist() if rows else [], bool)
        hashes, sizes = [], []
        for texts in rows.column("text").chunks if rows else []:
            found, words = self._split(texts)
            # an end token after the words of each text
            own = np.cumsum(words + 1) - 1
            whole = np.full(int(words.sum()) + len(words), END_HASH)
            is_word = np.ones(len(whole), bool)
            is_word[own] = False
            whole[is_word] = found
            hashes.append(whole)
            sizes.append(words + 1)
        size = np.concatenate([np.empty(0, np.int64), *sizes])
        self.ends = np.cumsum(size)
        self.starts = self.ends - size
        self.trained = np.repeat(~self.held, size)
        self.words, self.place = np.unique(np.concatenate([np.empty(0, np.uint64), *hashes]),
                                           return_inverse=True)

    @staticmethod
    def _split(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words of the texts, and how many words each has."""
        if not len(texts):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        begin, end = int(offsets[0]), int(offsets[-1])
        if begin == end:
            return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
        data = _LOWER[np.frombuffer(data, np.uint8)[begin:end]]
        offsets = offsets - begin
        word = ~_SPACES[data]
        inner = offsets[(offsets > 0) & (offsets < end - begin)]
        first, last = word.copy(), word.copy()       # of a word: no word byte before, or a new text
        first[1:] &= ~word[:-1]
        first[inner] = word[inner]
        last[:-1] &= ~word[1:]
        last[inner - 1] = word[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        # a null text's bytes, should it have any, are none of its own
        counts = np.diff(np.searchsorted(starts, offsets))
        if texts.null_count:
            absent = np.asarray(texts.is_null())
            kept = ~np.repeat(absent, counts)
            starts, ends, counts = starts[kept], ends[kept], np.where(absent, 0, counts)
        return word_hashes(data, starts, ends), counts

    def number(self, replies: dict[int, bytes], shards: int) -> None:
        """Ids and counts of the tokens, from the word shards' replies."""
        counts = np.zeros(len(self.words), np.uint64)
        ids = np.zeros(len(self.words), np.uint32)
        shard = (self.words % np.uint64(shards)).astype(np.int64)
        for s in np.unique(shard):
            mine = shard == s
            counts[mine], ids[mine] = unbundle(replies[int(s)], "<u8", "<u4")
        self.word_ids, self.word_counts = ids, counts
        self.counts, self.token = counts[self.place], ids[self.place]

    def grams(self):
        """Distinct (first, second) pairs and the triples that extend them.

        Fills ``pair_of`` and ``triple_of``: for every token the pair that ends
        with it and the triple that ends with it, -1 where a word is unknown.
        Returns pairs, training counts, counts of the first words, and for
        the triples their pair, word and training counts.
        """
        token = self.token.astype(np.uint64)
        n = len(token)
        before = np.full(n, START, np.uint64)
        before[1:] = token[:-1]
        before[self.starts] = START
        known = (token != UNKNOWN) & (before != UNKNOWN)
        at = np.flatnonzero(known)
        pairs, place = np.unique(before[at] << np.uint64(32) | token[at], return_inverse=True)
        self.pair_of = np.full(n, -1, np.int64)
        self.pair_of[at] = place
        pair_count = np.bincount(place, self.trained[at], len(pairs)).astype(np.uint32)
        follows = np.zeros(n, bool)
        follows[1:] = self.pair_of[:-1] >= 0
        follows[self.starts] = False
        at3 = np.flatnonzero(follows & (self.pair_of >= 0))
        keys = self.pair_of[at3 - 1].astype(np.uint64) << np.uint64(32) | token[at3]
        triples, place3 = np.unique(keys, return_inverse=True)
        self.triple_of = np.full(n, -1, np.int64)
        self.triple_of[at3] = place3
        triple_count = np.bincount(place3, self.trained[at3], len(triples)).astype(np.uint32)
        return (pairs, pair_count, (triples >> np.uint64(32)).astype(np.int64),
                triples & np.uint64(0xFFFFFFFF), triple_count)


def gram_shard(pairs: np.ndarray, shards: int) -> np.ndarray:
    """A frequent first word spreads over 32 shards, or a 32nd of many."""
    spread = min(shards, max(32, shards // 32))
    groups = max(1, shards // spread)
    first, second = _mix(pairs >> np.uint64(32)), _mix((pairs & np.uint64(0xFFFFFFFF)) + np.uint64(7))
    return (first % np.uint64(groups) * np.uint64(spread) + second % np.uint64(spread)).astype(np.int64)


def _rows(chunks, parts, blobs, tokens=None, types=None) -> pa.Table:
    n = len(blobs)
    return pa.table({"_chunk": pa.array(chunks, pa.int32()), "_part": pa.array(parts, pa.int32()),
                     "_blob": pa.array(blobs, pa.binary()),
                     "_tokens": pa.array(tokens or [0] * n, pa.int64()),
                     "_types": pa.array(types or [0] * n, pa.int64())})


def count_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A word shard: numbers and counts for each chunk; its totals under chunk -1."""
    shard, shards = key[0].as_py(), table.column("_types")[0].as_py()
    chunk = table.column("_chunk").to_pylist()
    sent = [unbundle(b, "<u8", "<u4") for b in table.column("_blob").to_pylist()]
    words, place = np.unique(np.concatenate([w for w, _ in sent]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([c for _, c in sent]), len(words)).astype(np.uint64)
    order = np.lexsort((words, -counts.astype(np.int64)))
    ids = np.zeros(len(words), np.uint64)
    ids[order] = np.arange(len(words), dtype=np.uint64) * np.uint64(shards) + np.uint64(
        shard + FIRST_ID)
    ids[counts == 0] = UNKNOWN
    if ids.max(initial=0) >= 1 << 32:
        raise OverflowError("more than 2 ** 32 word numbers")
    ids = ids.astype(np.uint32)
    bounds = np.cumsum([0, *(len(w) for w, _ in sent)])
    blobs = [bundle(counts[place[a:b]], ids[place[a:b]])
             for a, b in zip(bounds, bounds[1:], strict=False)]
    n = len(blobs)
    return _rows([*chunk, -1], [shard] * (n + 1), [*blobs, b""],
                 [0] * n + [int(counts.sum())], [0] * n + [int((counts > 0).sum())])


def answer_grams(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A gram shard: counts added up, trie built, codes for every chunk's grams."""
    shard = key[0].as_py()
    chunk = table.column("_chunk").to_pylist()
    sent = []
    for blob in table.column("_blob").to_pylist():
        first, second, times, context, followers, third, times3 = unbundle(
            blob, "<u4", "<u4", "<u4", "<u8", "<u4", "<u4", "<u4")
        keys = np.cumsum(first, dtype=np.uint64) << np.uint64(32) | second
        sent.append((keys, times, context, np.repeat(np.arange(len(keys)), followers), third, times3))
    lengths = np.array([len(s[0]) for s in sent])
    pairs, place = np.unique(np.concatenate([s[0] for s in sent]), return_inverse=True)
    count = np.bincount(place, np.concatenate([s[1] for s in sent]), len(pairs))
    context = np.zeros(len(pairs))
    context[place] = np.concatenate([s[2] for s in sent])
    starts = np.cumsum([0, *lengths])
    own = np.concatenate([place[a:b][s[3]] for s, a, b in
                          zip(sent, starts, starts[1:], strict=False)]).astype(np.uint64)
    triples, place3 = np.unique(own << np.uint64(32) | np.concatenate([s[4] for s in sent]),
                                return_inverse=True)
    count3 = np.bincount(place3, np.concatenate([s[5] for s in sent]), len(triples))
    of, word = (triples >> np.uint64(32)).astype(np.int64), triples & np.uint64(0xFFFFFFFF)
    trained, trained3 = count > 0, count3 > 0
    rank = np.cumsum(trained) - 1
    trie = Trie(pairs[trained], (count / (context + M2))[trained], rank[of[trained3]],
                word[trained3], (count3 / (count[of] + M3))[trained3])
    pair_codes, triple_codes = trie.look_up(pairs, of, word)
    starts3 = np.cumsum([0, *(len(s[4]) for s in sent)])
    return _rows(chunk, [-1 - shard] * len(chunk), [
        bundle(pair_codes[place[a:b]], triple_codes[place3[c:d]])
        for a, b, c, d in zip(starts, starts[1:], starts3, starts3[1:], strict=False)])


def score_texts(docs: DataFrame, held_out: Column, chunk_bytes: int = CHUNK_TEXT_BYTES,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every text by a model of the texts that are not held out.

    Columns: doc_id, held_out, n_tokens (words and one end), n_known (tokens
    seen in training), train_tokens, base_score (log10 by added-one
    unigrams) and score (log10 by the model).  Null and empty texts are one
    end token; rows with a null key are scored like others; repeated rows
    count, and are returned, as often as they are there.  Without training
    texts all counts are zero.  Other columns are not read.
    """
    size = text_bytes(docs, text)
    chunks = parts_for(size, chunk_bytes)
    word_shards = parts_for(size // 20, SHARD_WORDS)
    gram_shards = parts_for(size // 4, SHARD_GRAMS)
    fields = pa.schema([("doc_id", pa.int64()), ("held", pa.bool_()), ("text", pa.string())])

    def blocks(batches: Iterator[pa.RecordBatch]):
        yield from deal_blocks(((b.column("_to").to_numpy(), b.select(fields.names))
                                for b in small_batches(batches, "text")), fields)

    def words_of(part: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tokens = ChunkTokens(table)
        count = np.bincount(tokens.place, tokens.trained, len(tokens.words)).astype(np.uint32)
        shard = (tokens.words % np.uint64(word_shards)).astype(np.int64)
        found = np.unique(shard)
        return _rows([part[0].as_py()] * len(found), found, [
            bundle(tokens.words[shard == s], count[shard == s]) for s in found],
            types=[word_shards] * len(found))

    def grams_of(part: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        tokens = ChunkTokens(table)
        tokens.number(_told(replies), word_shards)
        pairs, count, of, word, count3 = tokens.grams()
        first_count = _context_counts(tokens, pairs)
        out = []
        for s, mine, mine3, place in _by_shard(pairs, of, gram_shards):
            first = pairs[mine] >> np.uint64(32)
            out.append((int(s), bundle(
                np.diff(first, prepend=np.uint64(0)).astype(np.uint32),
                pairs[mine].astype(np.uint32), count[mine], first_count[mine],
                np.bincount(place[of[mine3]], minlength=len(mine)).astype(np.uint32),
                word[mine3].astype(np.uint32), count3[mine3])))
        return _rows([part[0].as_py()] * len(out), [s for s, _ in out], [b for _, b in out])

    def scored(part: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        tokens = ChunkTokens(table)
        told = _told(replies)
        tokens.number({s: b for s, b in told.items() if s >= 0}, word_shards)
        pairs, _, of, _, _ = tokens.grams()
        pair_p, triple_p = np.zeros(len(pairs)), np.zeros(len(of))
        for s, mine, mine3, _ in _by_shard(pairs, of, gram_shards):
            codes, codes3 = unbundle(told[-1 - int(s)], "<u2", "<u2")
            pair_p[mine], triple_p[mine3] = probability(codes), probability(codes3)
        totals = replies.slice(0, 1)
        n_train, types = totals.column("_n")[0].as_py(), totals.column("_v")[0].as_py()
        count = tokens.counts.astype(np.float64)
        base = (count + 1) / (n_train + types + 1)
        first = _context_counts(tokens, pairs).astype(np.float64)
        pair, triple = tokens.pair_of, tokens.triple_of
        # of a token's context: how often the word, and the pair, before it was trained
        before = np.zeros(len(count))
        before[1:] = count[:-1]
        before[tokens.starts] = count[tokens.ends - 1]      # texts start as often as they end
        p = _smoothed(np.where(pair >= 0, pair_p[pair] if len(pairs) else 0, 0), before, M2, base)
        pair_count = np.rint(pair_p * (first + M2))
        context = np.zeros(len(count))
        if len(pairs):
            context[1:] = np.where(pair[:-1] >= 0, pair_count[pair[:-1]], 0)
        context[tokens.starts] = 0
        p = _smoothed(np.where(triple >= 0, triple_p[triple] if len(of) else 0, 0), context, M3, p)
        n = tokens.ends - tokens.starts

        def summed(values):
            return np.add.reduceat(values, tokens.starts) if len(n) else values
        return pa.table({
            "doc_id": pa.array(tokens.ids, pa.int64()), "held_out": pa.array(tokens.held),
            "n_tokens": n, "n_known": summed((count > 0).astype(np.int64)),
            "train_tokens": np.full(len(n), n_train, np.int64),
            "base_score": summed(np.log10(base)), "score": summed(np.log10(p))})

    source = docs.select(
        F.col(key).cast("long").alias("doc_id"), held_out.alias("held"), F.col(text).alias("text"),
        F.pmod(F.xxhash64(key, F.octet_length(text)), F.lit(chunks)).cast("int").alias("_to"))
    by_chunk = source.mapInArrow(blocks, BLOCKS).groupBy("_part")
    numbered = (by_chunk.applyInArrow(words_of, _BLOBS)
                .groupBy("_part").applyInArrow(count_words, _BLOBS))
    totals = numbered.where("_chunk = -1").agg(F.sum("_tokens").alias("_n"), F.sum("_types").alias("_v"))
    replies = numbered.where("_chunk >= 0")
    answers = (by_chunk.cogroup(replies.groupBy("_chunk")).applyInArrow(grams_of, _BLOBS)
               .groupBy("_part").applyInArrow(answer_grams, _BLOBS))
    told = replies.union(answers).select(
        "_chunk", "_part", "_blob", totals.select("_n").scalar().alias("_n"),
        totals.select("_v").scalar().alias("_v"))
    return by_chunk.cogroup(told.groupBy("_chunk")).applyInArrow(scored, RESULT)


def _told(replies: pa.Table) -> dict[int, bytes]:
    return dict(zip(replies.column("_part").to_pylist(), replies.column("_blob").to_pylist(),
                    strict=True))


def _by_shard(pairs: np.ndarray, of: np.ndarray, shards: int):
    """For each shard: its pairs, the triples that extend them, and each pair's place there."""
    shard = gram_shard(pairs, shards)
    place = np.zeros(len(pairs), np.int64)
    order, order3 = np.argsort(shard, kind="stable"), np.argsort(shard[of], kind="stable")
    found = np.unique(shard)
    bounds = np.searchsorted(shard[order], [*found, shards])
    bounds3 = np.searchsorted(shard[of][order3], [*found, shards])
    for i, s in enumerate(found):
        mine, mine3 = order[bounds[i]:bounds[i + 1]], order3[bounds3[i]:bounds3[i + 1]]
        place[mine] = np.arange(len(mine))
        yield s, mine, mine3, place


def _context_counts(tokens: ChunkTokens, pairs: np.ndarray) -> np.ndarray:
    """Training count of each pair's first word; the start mark counts as the end token does."""
    order = np.argsort(tokens.word_ids)
    ids = tokens.word_ids[order]
    first = pairs >> np.uint64(32)
    start = first == START
    place = np.searchsorted(ids, first)
    place[start] = 0
    counts = (tokens.word_counts[order][np.minimum(place, len(ids) - 1)] if len(ids)
              else np.zeros(len(first), np.uint64))
    ends = tokens.counts[tokens.ends[:1] - 1]
    counts[start] = ends[0] if len(ends) else 0
    return counts


def _smoothed(seen: np.ndarray, context: np.ndarray, weight: float, lower: np.ndarray) -> np.ndarray:
    return seen + weight / (context + weight) * lower
