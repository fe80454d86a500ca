"""Benchmark decontamination by a suffix automaton of all test items.

The normalised words of the items make one generalised suffix automaton.  A
training text is streamed through it: after every word the automaton's state
and a length say how many of the last words stand together in some item.
Where that length reaches the window, or a whole item shorter than a window
ends, the words are hit; neighbouring hits make a span.  Spans that exceed a
limit of words, or all spans of a text that exceeds a limit of coverage, can
be cut out of it.

Items are dealt into shards of at most ``shard_words`` words (a longer item
in overlapping pieces), a shard's automaton is built by one task and its flat
arrays, bounded by that number, are broadcast.  The texts pass through one
shard after the other in narrow steps; beyond the first shard the texts'
hits so far are stored between passes, so that no more than one automaton is
held at a time.
"""

from __future__ import annotations

import pickle
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.suffixes import SuffixAutomaton
from parley.llm.words import parts_for, small_batches, stage

WINDOW = 10
SHARD_WORDS = 500_000
MAX_COVERAGE = 0.5

# Every ASCII character but letters and digits ends a word; A-Z become a-z.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or bytes([c]).isalnum() else 32
               for c in range(256))

_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("longest", pa.int64())])
_SPAN_TYPE = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "stop", "longest")])
RESULTS = ("n_words", "spans", "items")


def normal_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class ItemAutomaton:
    """Generalised suffix automaton of items, with the items behind each window.

    ``anchor``: for a state of ``window`` words or more, the state of its
    last ``window`` words.  ``whole``: the longest whole short item that ends
    the strings of a state or of its links (0: none).  ``owners``: for such
    states, a number in ``sets``, the distinct groups of item ids.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window, self.numbers, auto = window, {}, SuffixAutomaton()
        number, short, numbered = self.numbers, set(), []
        for item, words in items:
            ids = [number.setdefault(w, len(number)) for w in words]
            last = auto.add(ids)[-1]
            if len(ids) < window:
                short.add(last)
            numbered.append((item, ids))
        self.length, self.link = auto.length, auto.link
        self.word, self.to, self.more = auto.word, auto.to, auto.more
        n = len(self.length)
        self.anchor, self.whole = array("i", bytes(4 * n)), array("i", bytes(4 * n))
        for v in auto.by_length():
            up = self.link[v]
            if self.length[v] >= window:
                self.anchor[v] = v if self.length[up] < window else self.anchor[up]
            self.whole[v] = v if v in short else self.whole[up]
        found: dict[int, set[str | None]] = {}
        for item, ids in numbered:
            state = 0
            for k, c in enumerate(ids, 1):
                state = auto.step(state, c)
                if k >= window:
                    found.setdefault(self.anchor[state], set()).add(item)
            if len(ids) < window:
                found.setdefault(state, set()).add(item)
        index: dict[frozenset, int] = {}
        self.owners = {v: index.setdefault(frozenset(i for i in ids if i is not None), len(index))
                       for v, ids in found.items()}
        self.sets = list(index)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, int]], set[str]]:
        """Hits as (from, to, longest match) by their end, and the ids of the items met."""
        get = self.numbers.get
        length, link, first, to, more = self.length, self.link, self.word, self.to, self.more
        anchor, whole, window = self.anchor, self.whole, self.window
        state = matched = 0
        hits, met = [], set()
        for i, word in enumerate(words, 1):
            c = get(word)
            if c is None:
                state = matched = 0
                continue
            while True:
                if first[state] == c:
                    state, matched = to[state], matched + 1
                    break
                arcs = more.get(state)
                if arcs is not None and c in arcs:
                    state, matched = arcs[c], matched + 1
                    break
                if not state:
                    break
                state = link[state]
                matched = length[state]
            if matched >= window:
                met.add(anchor[state])
                hits.append((i - window, i, matched))
            if whole[state]:
                ends = whole[state if matched == length[state] else link[state]]
                if ends:
                    hits.append((i - length[ends], i, length[ends]))
                while ends:
                    met.add(ends)
                    ends = whole[link[ends]]
        items: set[str] = set()
        for s in {self.owners[v] for v in met}:
            items |= self.sets[s]
        return hits, items


def merged_spans(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Overlapping and touching spans as one, with the greatest of their longest matches."""
    out: list[list[int]] = []
    for start, stop, longest in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1], out[-1][2] = max(out[-1][1], stop), max(out[-1][2], longest)
        else:
            out.append([start, stop, longest])
    return [tuple(s) for s in out]


def item_pieces(benchmark: DataFrame, window: int, shard_words: int, key: str, text: str) -> DataFrame:
    """(item, words): the distinct items' normalised words, long items in pieces.

    Pieces overlap by ``window`` - 1 words, so every window is in one.
    """
    longest = max(shard_words, 2 * window)

    def run(batches):
        for batch in small_batches(batches, "text"):
            items, pieces = [], []
            for item, value in zip(batch.column("item").to_pylist(),
                                   batch.column("text").to_pylist(), strict=True):
                words = normal_words(value)
                for at in range(0, max(1, len(words) - window + 1), longest - window + 1):
                    piece = words[at:at + longest]
                    if piece:
                        items.append(item)
                        pieces.append(b" ".join(piece))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(pieces, pa.binary()),
                 pa.array([p.count(b" ") + 1 for p in pieces], pa.int64())],
                ["item", "words", "n"])
    return (benchmark.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
            .distinct().mapInArrow(run, "item string, words binary, n bigint"))


def automata(benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
             key: str = "item_id", text: str = "text") -> DataFrame:
    """(shard, automaton): the pickled parts of an :class:`ItemAutomaton` for each shard of the items."""
    pieces = stage(item_pieces(benchmark, window, shard_words // 2, key, text))
    total = pieces.agg(F.sum("n")).first()[0] or 0
    shards = parts_for(2 * total, shard_words) if total > shard_words else 1

    def build(part: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("item").to_pylist(), table.column("words").to_pylist(),
                          strict=True), key=lambda r: (r[0] is None, r[0] or "", r[1]))
        made = ItemAutomaton([(item, words.split(b" ")) for item, words in rows], window)
        return pa.table({"shard": pa.array([part[0].as_py()], pa.int32()),
                         "automaton": pa.array([pickle.dumps(vars(made))], pa.binary())})
    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64("item", "words"), F.lit(shards)).cast("int"))
    return dealt.groupBy("_shard").applyInArrow(build, "shard int, automaton binary")


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  shard_words: int = SHARD_WORDS, text: str = "text",
                  item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """All rows with their columns, plus n_words, spans and items.

    ``spans`` are the hit words as structs (start, stop, longest): from word
    ``start`` to before ``stop``, with the longest match in there.  A word is
    hit inside any occurrence of ``window`` consecutive words of an item, or
    of all words of an item that has fewer, but some.  ``items`` are the ids,
    as strings and sorted, of the items with an occurrence; a null id gives
    hits and no entry, rows of one id are one item.  Null and empty texts
    have no words on either side; an empty benchmark gives no hits.  Repeated
    documents and null document ids are rows like others.  Input columns with
    the names of the results are replaced.
    """
    given = [c for c in docs.columns if c not in RESULTS]
    schema = T.StructType([*(docs.schema[c] for c in given),
                           T.StructField("n_words", T.LongType()),
                           T.StructField("spans", T.ArrayType(_SPAN_TYPE)),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    sc = docs.sparkSession.sparkContext
    built = stage(automata(benchmark, window, shard_words, item_key, item_text))
    shards = sorted(r["shard"] for r in built.select("shard").collect()) or [None]
    found = docs.select(*given, F.lit(0).cast("long").alias("n_words"),
                        F.array().cast(T.ArrayType(_SPAN_TYPE)).alias("spans"),
                        F.array().cast("array<string>").alias("items"))
    for k, shard in enumerate(shards):
        # one shard's automaton, of at most ``shard_words`` words
        blob = None if shard is None else built.where(F.col("shard") == shard).first()["automaton"]
        found = (stage(found) if k else found).mapInArrow(
            _scanner(sc.broadcast(blob), given, text), schema)
    return found


def _scanner(shard, given: list[str], text: str):
    def run(batches):
        automaton = ItemAutomaton([], 1)
        if shard.value is not None:
            vars(automaton).update(pickle.loads(shard.value))
        for batch in small_batches(batches, text):
            n_words, spans, items = [], [], []
            for value, before, met in zip(*(batch.column(c).to_pylist() for c in
                                            (text, "spans", "items")), strict=True):
                words = normal_words(value)
                hits, ids = automaton.scan(words)
                n_words.append(len(words))
                old = [(s["start"], s["stop"], s["longest"]) for s in before]
                spans.append([dict(zip(("start", "stop", "longest"), s, strict=True))
                              for s in merged_spans(old + hits)])
                items.append(sorted(ids.union(met)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in given), pa.array(n_words, pa.int64()),
                 pa.array(spans, pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))],
                [*given, *RESULTS])
    return run


def cut_words(value: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from each span's first word to its last."""
    raw = value.encode("utf-8", "surrogatepass")
    word = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edges = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    kept, at = [], 0
    for start, stop in spans:
        kept.append(raw[at:starts[start]])
        at = int(stops[stop - 1])
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_words: int = WINDOW - 1, max_coverage: float = MAX_COVERAGE,
                  text: str = "text", **options) -> DataFrame:
    """:func:`find_overlaps` plus ``n_removed`` (words) and ``clean_text``.

    Spans of more than ``max_words`` words are cut out of the text; where
    hit words are more than ``max_coverage`` of a text's words, all its spans
    are.  The rest of the text stays as it is; a null text stays null.
    """
    found = find_overlaps(docs, benchmark, window, text=text, **options)
    given = [c for c in found.columns if c not in ("n_removed", "clean_text")]
    schema = T.StructType([*(found.schema[c] for c in given),
                           T.StructField("n_removed", T.LongType()),
                           T.StructField("clean_text", T.StringType())])

    def run(batches):
        for batch in small_batches(batches, text):
            removed, clean = [], []
            for value, n, spans in zip(*(batch.column(c).to_pylist() for c in
                                         (text, "n_words", "spans")), strict=True):
                spans = [(s["start"], s["stop"]) for s in spans]
                if sum(b - a for a, b in spans) <= max_coverage * n:
                    spans = [(a, b) for a, b in spans if b - a > max_words]
                removed.append(sum(b - a for a, b in spans))
                clean.append(cut_words(value, spans) if spans else value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(removed, pa.int64()), pa.array(clean, pa.string())],
                [*given, "n_removed", "clean_text"])
    return found.select(*given).mapInArrow(run, schema)
