"""Periodic runs of words by a suffix automaton and link-tree access.

A run is a longest stretch of consecutive words of smallest period q, here
with length at least ``min_length`` and ``min_exponent`` times q.

For every appended word the *access* operation of a link-cut tree walks from
the state of the prefix to the root of the automaton's link tree, and
recolours the path with the word's place.  What it recolours falls into
segments of one former colour.  A segment of colour e whose deepest string
has length L says that the last L words also ended at place e, and no longer
ones did: at distance p = now - e, L >= p is a square, and the words from
e-L+1 to now have smallest period p and cannot begin earlier.  The same
begin and period come again while the run goes on, so the last place of each
is the whole run.

The automaton is finished before its tree is accessed, so the tree is fixed
and needs no link or cut: a preferred path is kept as a stack of segments
on each heavy path of the tree instead of in splay trees.  An access changes
O(log n) segments, amortised, and takes O(log n) heavy paths.

The automaton gets only stretches that can hold a run: in a run every word
lies in a group of ``min_length * (1 - 1/min_exponent)`` consecutive words
that comes again in the run, so words outside all repeated groups of the
text end a stretch.  Groups are compared by a hash, and a chance hit only
makes a stretch longer.  A row is one task's work, whatever the others hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.suffixes import SuffixAutomaton
from parley.llm.words import ascii_words, small_batches

MIN_LENGTH = 24
MIN_EXPONENT = 3
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULTS = ("n_words", "runs", "kept_text")

Run = tuple[int, int, int]


def heavy_heads(automaton: SuffixAutomaton) -> list[int]:
    """For each state, the top of its heavy path in the link tree."""
    link, order = automaton.link, automaton.by_length()
    n = len(link)
    size, heavy, head = [1] * n, [0] * n, list(range(n))
    for v in reversed(order):
        size[link[v]] += size[v]
    for v in order:
        p = link[v]
        if not heavy[p] or size[v] > size[heavy[p]]:
            heavy[p] = v
    for v in order:
        if link[v] and heavy[link[v]] == v:      # the root is on no path
            head[v] = head[link[v]]
    return head


def automaton_runs(words: list[int], min_length: int, min_exponent: int) -> list[Run]:
    """(start, length, period) of all runs of a sequence of word numbers."""
    automaton = SuffixAutomaton()
    prefixes = automaton.add(words)
    head = heavy_heads(automaton)
    length, link = automaton.length, automaton.link
    segments: dict[int, list[tuple[int, int]]] = {}   # by heavy path; (deepest length, place)
    ends: dict[tuple[int, int], int] = {}

    for now, state in enumerate(prefixes):
        last = -1
        while state:
            top, deep = head[state], length[state]
            path = segments.get(top)
            if path is None:
                segments[top] = [(deep, now)]
            else:
                met = []
                while path and path[-1][0] <= deep:
                    met.append(path.pop())
                if path and not (met and met[-1][0] == deep):     # covers a part of this one
                    met.append((deep, path[-1][1]))
                path.append((deep, now))
                for common, place in reversed(met):
                    if place == last:             # one segment over two heavy paths
                        continue
                    last, period = place, now - place
                    whole = common + period
                    if whole >= min_length and whole >= min_exponent * period:
                        ends[place - common + 1, period] = now + 1
            state = link[top]
    return sorted((start, end - start, period) for (start, period), end in ends.items())


def _group_hashes(numbers: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive numbers, doubled up from shorter groups."""
    h = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    one = h ^ (h >> np.uint64(29))
    whole, have, power, width = None, 0, one, 1
    base = np.uint64(0x5851F42D4C957F2D)
    with np.errstate(over="ignore"):
        up = base
        while size >> (width.bit_length() - 1):
            if size & width:
                if whole is None:
                    whole, have = power, width
                else:                      # groups of ``have`` followed by groups of ``width``
                    n = len(numbers) - have - width + 1
                    whole = whole[:n] * up + power[have:have + n]
                    have += width
            n = len(numbers) - 2 * width + 1
            if 2 * width > size or n <= 0:
                break
            power = power[:n] * up + power[width:width + n]
            up, width = up * up, 2 * width
    return whole ^ (whole >> np.uint64(32))


def stretches(numbers: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """(from, to) of the stretches that hold all runs."""
    group = max(1, min_length - -(-min_length // min_exponent))
    n = len(numbers) - group + 1
    if len(numbers) < min_length or n < 2:
        return []
    hashes = _group_hashes(numbers, group)
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return []
    edges = np.zeros(len(numbers) + 1, np.int64)
    again = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    edges[again] += 1
    edges[again + group] -= 1
    inside = np.concatenate([[False], np.cumsum(edges[:-1]) > 0, [False]])
    bounds = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
    return [(int(a), int(b)) for a, b in bounds if b - a >= min_length]


def text_runs(words: list[bytes], min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """(start, length, period) of all runs of a text, by start, then period."""
    if len(words) < min_length:
        return []
    index: dict[bytes, int] = {}
    numbers = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    found: list[Run] = []
    for a, b in stretches(numbers, min_length, min_exponent):
        found += [(a + s, n, p) for s, n, p in
                  automaton_runs(numbers[a:b].tolist(), min_length, min_exponent)]
    return found


def without_repeats(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words outside of what a run repeats after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
              text: str = "text") -> DataFrame:
    """All rows with their columns, plus n_words, runs and kept_text.

    ``runs`` are structs (start, length, period) by start, then period;
    ``kept_text`` joins the words that no run repeats by one space.  Words
    are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Null and empty texts have no
    words and no runs.  Every row is judged by itself, so null ids, repeated
    rows and an empty table need no rule.  Input columns with the names of
    the results are replaced.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has at least two periods and two words")
    given = [c for c in docs.columns if c not in RESULTS]

    def run(batches):
        for batch in batches:
            for part in small_batches([batch], text):
                n_words, runs, kept = [], [], []
                for value in part.column(text).to_pylist():
                    words = ascii_words(value, lower=False)
                    found = text_runs(words, min_length, min_exponent)
                    n_words.append(len(words))
                    runs.append(found)
                    kept.append(b" ".join(without_repeats(words, found)
                                          ).decode("utf-8", "surrogatepass"))
                runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found]
                        for found in runs]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n_words, pa.int64()), pa.array(runs, pa.list_(_RUN)),
                     pa.array(kept, pa.string())], [*given, *RESULTS])
    kinds = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType([*(docs.schema[c] for c in given),
                           T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(kinds)),
                           T.StructField("kept_text", T.StringType())])
    return docs.select(*given).mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run of greatest length/period; ties: smallest start, then period.  Null for none."""
    def better(best: Column, run: Column) -> Column:
        ours, theirs = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (ours > theirs), run).otherwise(best)
    # the runs come by start, then period, so the first of equal ones stays
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, 0), better)


def echo_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents, a tenth of them with a tail that repeats some words over and over.

    With h the crc32 of the decimal id and g = h div 10: where h mod 10 is 0
    and the text has n > 0 words, each word from a = g mod n on becomes word
    a + (i - a) mod p with p = 1 + (n - a) div (3 + g mod 8).  Other rows,
    and those of a null id, stay as they are.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    n, g = F.size("_words").cast("long"), F.floor(h / 10).cast("long")
    a = F.when(n > 0, g % n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % F.lit(8))).cast("long")

    def echoed(i: Column) -> Column:
        at = F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
        return F.get("_words", at.cast("int"))
    tail = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), echoed), " ")
    plain = [c for c in docs.columns if c != text]
    return (docs.select(*plain, text, F.when(h % 10 == 0, words).alias("_words"))
            .withColumns({"_a": a, "_p": p})
            .select(*plain, F.when(n > 0, tail).otherwise(F.col(text)).alias(text)))
