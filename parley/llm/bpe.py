"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens.  It starts as one state that loops on every
byte symbol, and each merge ``(u, v) -> uv`` is built in as a gadget, in
merge order:

* a new label ``uv`` appears on every state that can read ``u``, and leads
  where ``v`` leads at that time;
* the state that ``u`` leads to is split off without its arc ``v``: once
  the merge exists, ``u`` followed by ``v`` is no longer a tokenization.

What a label leads to depends on the label alone, so a state is named by the
token read last.  A state keeps the arcs missing from the state it was split
from at that time: ``uv`` lacks what ``v`` lacked.  A label is missing where
its first part was missing when it was made.  The missing arcs of one
gadget are therefore a product of two ranges once the tokens are numbered in
preorder: states by their last parts, labels by their first parts, children
with the latest merge first.  The compiled table holds these ranges, one
pair for each merge; a transition is looked up there once and then kept.

Encoding a word follows the only path through the automaton whose labels
spell the word, trying the longest label first and leaving dead ends behind.
Decoding emits the labels of the ids.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from parley.llm.presplit import Presplitter, WordCache, byte_alphabet
from parley.llm.words import small_batches

ENCODED = "doc_id bigint, ids binary, decoded string"
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _preorder(children: dict[int, list[int]], roots: list[int], size: int):
    """Preorder numbers and subtree ends; children are given latest first."""
    first, end = [0] * size, [0] * size
    at = 0
    for root in roots:
        stack = [(root, False)]
        while stack:
            node, done = stack.pop()
            if done:
                end[node] = at
                continue
            first[node] = at
            at += 1
            stack.append((node, True))
            stack.extend((c, False) for c in reversed(children.get(node, ())))
    return first, end


class TokenAutomaton:
    """The compiled automaton: labels, gadget ranges and transitions."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)
        bpe = model["model"]
        self.suffix = bpe["end_of_word_suffix"] or ""
        self.id_of: dict[str, int] = bpe["vocab"]
        added = {t["id"]: t["content"] for t in model["added_tokens"]}
        self.added = {text: i for i, text in added.items()}
        size = max(max(self.id_of.values()), *added) + 1
        self.label = [""] * size
        for text, i in [*self.id_of.items(), *self.added.items()]:
            self.label[i] = text
        alphabet = byte_alphabet()
        self._symbol = [alphabet[b] for b in range(256)]
        self.longest = max(map(len, self.id_of))
        self._build([tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                     for m in bpe["merges"]], size)
        self._known: dict[int, bool] = {}

    def _build(self, merges: list[tuple[str, str]], size: int) -> None:
        """Add the gadget of every merge, in order."""
        ids = self.id_of
        born = [-1] * size                       # the merge that made the token
        by_first: dict[int, list[int]] = {}      # tokens made from it as first part
        by_last: dict[int, list[int]] = {}
        gadgets = []
        for k, (a, b) in enumerate(merges):
            u, v, uv = ids[a], ids[b], ids[a + b]
            if born[uv] < 0:
                born[uv] = k
                by_first.setdefault(u, []).append(uv)
                by_last.setdefault(v, []).append(uv)
            gadgets.append((u, v, k))
        for tree in (by_first, by_last):
            for made in tree.values():
                made.reverse()                   # latest merge first
        roots = [i for i in ids.values() if born[i] < 0]
        self._label_at, label_end = _preorder(by_first, roots, size)
        self._state_at, state_end = _preorder(by_last, roots, size)

        def reach(tree, first, end, node, k):
            """End of the range: the node and what was made from it after merge k.

            The gadget's own token counts with ``a a -> aa`` labels.
            """
            stop = first[node] + 1
            for child in tree.get(node, ()):
                if born[child] < k:
                    break
                stop = end[child]
            return stop

        # (u, v) of a gadget -> where its range of states and of labels ends
        self._gadget = {
            u << 20 | v: (reach(by_last, self._state_at, state_end, u, k + 1),
                          reach(by_first, self._label_at, label_end, v, k if u == v else k + 1))
            for u, v, k in gadgets}
        self._last_parts = self._chains(by_last, size)
        self._first_parts = self._chains(by_first, size)

    @staticmethod
    def _chains(made: dict[int, list[int]], size: int) -> list[tuple[int, ...]]:
        """For each token: itself, its part, that one's part, down to a byte."""
        part = [-1] * size
        for node, tokens in made.items():
            for token in tokens:
                part[token] = node
        chains = []
        for token in range(size):
            chain = [token]
            while part[chain[-1]] >= 0:
                chain.append(part[chain[-1]])
            chains.append(tuple(chain))
        return chains

    def step(self, state: int, label: int) -> bool:
        """Whether the state has an arc with this label.

        A gadget whose ranges hold both numbers starts at one of the parts
        that the state ends with and one that the label begins with.
        """
        key = state << 20 | label
        known = self._known.get(key)
        if known is None:
            at, target, known = self._state_at[state], self._label_at[label], True
            gadget, firsts = self._gadget, self._first_parts[label]
            for u in self._last_parts[state]:
                for v in firsts:
                    ends = gadget.get(u << 20 | v)
                    if ends is not None and at < ends[0] and target < ends[1]:
                        known = False
            if len(self._known) >= 1_000_000:
                self._known.clear()
            self._known[key] = known
        return known

    def encode_word(self, word: str) -> bytes:
        """Ids of one pre-split word, little-endian unsigned 32-bit."""
        if word in self.added:
            return array("I", [self.added[word]]).tobytes()
        symbol = self._symbol
        spelled = "".join([symbol[b] for b in word.encode("utf-8")])
        n, spelled = len(spelled), spelled + self.suffix
        ids, known, longest = self.id_of.get, self._known.get, self.longest
        path: list[int] = []
        begins: list[int] = []
        dead: set[tuple[int, int]] = set()
        state, at, to = -1, 0, min(n, longest)      # -1: the start reads every label
        while at < n:
            label = ids(spelled[at:to] if to < n else spelled[at:])
            if label is not None and (state < 0 or (
                    open_ if (open_ := known(state << 20 | label)) is not None
                    else self.step(state, label))) and (to, label) not in dead:
                path.append(label)
                begins.append(at)
                state, at, to = label, to, min(n, to + longest)
                continue
            to -= 1
            while to == at:                         # no arc spells on from here
                dead.add((at, state))
                path.pop()
                to = at - 1
                at = begins.pop()
                state = path[-1] if path else -1
        return array("I", path).tobytes()

    def decode(self, ids: bytes) -> str:
        """The labels of the ids, joined as the vocabulary's decoder joins them."""
        return " ".join(map(self.label.__getitem__, array("I", ids)))


@lru_cache(maxsize=2)
def _codec(vocabulary: str):
    """One compiled automaton and word cache for each Python worker."""
    split = Presplitter(vocabulary)
    automaton = TokenAutomaton(vocabulary)
    return split, automaton, WordCache(automaton.encode_word)


def _coded(batches: Iterator[pa.RecordBatch], vocabulary: str, key: str, text: str):
    split, automaton, cache = _codec(vocabulary)
    for batch in small_batches(batches, text):
        keys, ids, decoded = batch.column(key).to_pylist(), [], []
        for value in batch.column(text).to_pylist():
            coded = b"".join([cache[w] for w in split(value)])
            ids.append(coded)
            decoded.append(automaton.decode(coded))
        yield keys, ids, decoded


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids and decoded text of every document, one row per input row.

    ``ids`` are little-endian unsigned 32-bit integers.  Null and empty
    texts give no ids and an empty text; repeated rows give repeated rows;
    an empty table an empty result; other columns are not read.
    """
    def run(batches):
        for keys, ids, decoded in _coded(batches, vocabulary, key, text):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])
    return docs.select(key, text).mapInArrow(run, ENCODED)


def digests(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token counts and SHA-256 digests of what :func:`encode` returns."""
    def run(batches):
        for keys, ids, decoded in _coded(batches, vocabulary, key, text):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(key, text).mapInArrow(run, DIGESTS)
