import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import ngrams
from parley.llm.words import ascii_words, crc_mod


def test_elias_fano_slices_and_finds():
    rnd = np.random.default_rng(4)
    for n, top in ((1, 10), (1000, 1001), (5000, 10 ** 12), (70_000, 10 ** 7), (3000, 50)):
        values = np.sort(rnd.integers(0, top, n).astype(np.uint64))
        ef = ngrams.EliasFano.build(values)
        for a, b in ((0, n), (n // 3, n // 2 + 1), (n - 1, n + 5), (n, n)):
            assert (ef.slice(a, b) == values[a:b]).all()
        unique = np.unique(values)
        ef = ngrams.EliasFano.build(unique)
        keys = np.unique(np.concatenate([unique[::3], rnd.integers(0, top, 200).astype(np.uint64)]))
        at = np.searchsorted(unique, keys)
        there = unique[np.minimum(at, len(unique) - 1)] == keys
        assert (ef.find(keys) == np.where(there, at, -1)).all()
    bits = 8 * sum(a.nbytes for a in ngrams.EliasFano.build(
        np.sort(rnd.integers(0, 10 ** 9, 100_000).astype(np.uint64))).arrays())
    assert bits / 100_000 < math.log2(10 ** 9 / 1e5) + 3.2


def test_codes_are_fine_and_zero_is_absent():
    p = np.array([1.0, 0.5, 1e-9, 3.7e-5])
    assert np.allclose(ngrams.probability(ngrams.quantise(p)), p, rtol=3e-4)
    assert ngrams.probability(np.zeros(1, np.uint16))[0] == 0


class Model:
    """The same model by plain dictionaries."""

    def __init__(self, docs):
        self.c1, self.c2, self.c3 = Counter(), Counter(), Counter()
        for words in docs:
            line = [b" start", *words]
            self.c1.update(words)
            self.c2.update(zip(line, line[1:], strict=False))
            self.c3.update(zip(line, line[1:], line[2:], strict=False))
        self.of1, self.of2 = Counter(), Counter()
        for (a, _), n in self.c2.items():
            self.of1[a] += n
        for (a, b, _), n in self.c3.items():
            self.of2[a, b] += n
        self.n, self.v = sum(self.c1.values()), len(self.c1)

    def base(self, w):
        return (self.c1[w] + 1) / (self.n + self.v + 1)

    def p(self, line, i):
        p = (self.c2[line[i - 1], line[i]] + ngrams.M2 * self.base(line[i])) / (
            self.of1[line[i - 1]] + ngrams.M2)
        if i >= 2:
            of = tuple(line[i - 2:i])
            p = (self.c3[(*of, line[i])] + ngrams.M3 * p) / (self.of2[of] + ngrams.M3)
        return p


@pytest.mark.parametrize("chunk_bytes", [8 << 20, 2000])
def test_scores_against_dictionaries(edge_docs, no_docs, chunk_bytes, monkeypatch):
    if chunk_bytes < 8 << 20:
        monkeypatch.setattr(ngrams, "SHARD_GRAMS", 9000)
        monkeypatch.setattr(ngrams, "SHARD_WORDS", 3000)
    docs = [(r["doc_id"], ascii_words(r["text"]) + [ngrams.END_WORD])
            for r in edge_docs.select("doc_id", "text").collect()]
    held = {k: zlib.crc32(b"" if k is None else str(k).encode()) % 7 == 2 for k, _ in docs}
    model = Model([w for k, w in docs if not held[k]])
    expected = {}
    for k, words in docs:
        line = [b" start", *words]
        expected.setdefault(str(k), []).append((
            len(words), sum(model.c1[w] > 0 for w in words),
            sum(math.log10(model.base(w)) for w in words),
            sum(math.log10(model.p(line, i)) for i in range(1, len(line)))))
    found = {}
    for r in ngrams.score_texts(edge_docs, crc_mod("doc_id", 7) == 2, chunk_bytes).collect():
        assert r["held_out"] == held[r["doc_id"]] and r["train_tokens"] == model.n
        found.setdefault(str(r["doc_id"]), []).append(
            (r["n_tokens"], r["n_known"], r["base_score"], r["score"]))
    assert set(found) == set(expected)
    for k in expected:
        for got, want in zip(sorted(found[k]), sorted(expected[k]), strict=True):
            assert got[:2] == want[:2]
            assert got[2] == pytest.approx(want[2], rel=1e-9)
            assert got[3] == pytest.approx(want[3], abs=2e-4 * want[0])
    assert ngrams.score_texts(no_docs, F.lit(False)).count() == 0


def test_probabilities_of_a_context_add_up():
    model = Model([ascii_words(t) + [b" end"] for t in ("a b a c", "b a c c a", "a b")])
    words = [*model.c1, b"never seen"]
    for context in ([b" start", b"a"], [b"a", b"b"], [b"c", b"never"]):
        assert sum(model.p([*context, w], 2) for w in words) == pytest.approx(1.0)


def test_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = ngrams.score_texts(docs, F.lit(True)).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in rows] == [
        (3, 0, 0, 0.0), (1, 0, 0, 0.0)]
