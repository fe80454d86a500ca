"""Induced sentiment words against plain-Python propagation."""

import collections
import random
import re

import pytest

from parley.operators import polarity, topics

SEEDS = {"good": 1, "bad": -1}


def brute_words(text):
    return re.sub(r"[ \t\n\r]+", " ", re.sub(r"[^a-z \t\n\r]+", " . ", (text or "").lower())).strip().split(" ")


def content(w, heavy):
    return w in SEEDS or (len(w) >= topics.MIN_LETTERS and w not in heavy and w not in polarity.CONTRAST_TERMS)


def brute_lexicon(texts, heavy):
    graph = collections.Counter()
    for text in texts:
        ws = brute_words(text)
        for i, a in enumerate(ws):
            for j in range(i + 1, min(len(ws), i + polarity.WINDOW + 1)):
                b, between = ws[j], ws[i + 1:j]
                if content(a, heavy) and content(b, heavy) and a != b and "." not in between:
                    graph[frozenset((a, b))] += -1 if set(between) & set(polarity.CONTRAST_TERMS) else 1
    labels = {t: (p, 0) for t, p in SEEDS.items()}
    for number in range(1, polarity.MAX_ROUNDS + 1):
        pull = collections.Counter()
        for pair, weight in graph.items():
            for u, v in (tuple(pair), tuple(pair)[::-1]):
                if u in labels and v not in labels:
                    pull[v] += weight * labels[u][0]
        new = {v: (1 if s > 0 else -1, number) for v, s in pull.items() if s}
        if not new:
            break
        labels |= new
    return labels


def _induce(spark, texts, heavy=(), parts=3):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id long, text string").repartition(parts)
    lexicon = polarity.induce(polarity.word_graph(df, list(heavy), "text", SEEDS), SEEDS)
    return df, lexicon


def test_equals_brute_force_for_any_partitioning(spark):
    rng = random.Random(11)
    vocabulary = ["good", "bad", "but", "the", "of", "slow", "kind", "router", "late", "warm", "noise", "clear", "aaa",
                  ". ", "!", "however", "dull"]
    texts = [None, "", "?"] + [" ".join(rng.choices(vocabulary, k=rng.randint(1, 12))) for _ in range(40)]
    expected = brute_lexicon(texts, {"the"})
    for parts in (1, 5):
        df, lexicon = _induce(spark, texts, ["the"], parts)
        assert {r.term: (r.polarity, r.round) for r in lexicon.collect()} == expected
    rows = polarity.score_texts(df, lexicon, ["the"], ("id",), "text", SEEDS).collect()
    assert len(rows) == len(texts)
    for r in rows:
        labelled = [expected[w] for w in brute_words(texts[r.id]) if content(w, {"the"}) and w in expected]
        assert r.positive == sum(polarity.STRENGTH // (n + 1) for p, n in labelled if p > 0)
        assert r.negative == sum(polarity.STRENGTH // (n + 1) for p, n in labelled if p < 0)


def test_contrast_turns_the_sign_and_chains_end(spark):
    texts = ["good cosy", "cosy lounge", "lounge carpet. carpet velvet", "bad noisy", "good but grumpy", "alone words"]
    _, lexicon = _induce(spark, texts)
    got = {r.term: (r.polarity, r.round) for r in lexicon.collect()}
    assert got == {"good": (1, 0), "bad": (-1, 0), "cosy": (1, 1), "noisy": (-1, 1), "grumpy": (-1, 1),
                   "lounge": (1, 2), "carpet": (1, 3), "velvet": (1, 4)}


def test_repeated_and_null_keys_and_no_rows(spark):
    df = spark.createDataFrame([(None, "good good"), (None, "bad"), ((1 << 53) + 1, "good"), ((1 << 53) + 3, None)],
                               "positive long, text string")          # a key named like a result of the sums
    lexicon = polarity.induce(polarity.word_graph(df, [], "text", SEEDS), SEEDS)
    out = polarity.score_texts(df.withColumnRenamed("positive", "id"), lexicon, [], ("id",), "text", SEEDS)
    got = {r.id: (r.positive, r.negative, r.sentiment) for r in out.collect()}
    s = polarity.STRENGTH
    assert got == {None: (2 * s, s, "positive"), (1 << 53) + 1: (s, 0, "positive"), (1 << 53) + 3: (0, 0, "neutral")}
    none = df.limit(0).withColumnRenamed("positive", "id")
    assert polarity.score_texts(none, lexicon, [], ("id",), "text", SEEDS).count() == 0
    assert polarity.induce(polarity.word_graph(none, [], "text", SEEDS), SEEDS).count() == len(SEEDS)


@pytest.fixture
def few_rows(spark):
    """Batches of two rows, so that short texts make several chunks."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    yield
    spark.conf.set(name, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunks_add_up_and_pairs_are_not_brought_together(spark, few_rows):
    rng = random.Random(3)
    words = ["good", "bad", "but", "slow", "kind", "router", "late", "warm", "noise", ". "]
    texts = [" ".join(rng.choices(words, k=rng.randint(2, 9))) for _ in range(24)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id long, text string").coalesce(1)
    graph = polarity.word_graph(df, [], "text", SEEDS, chunk_bytes=1)
    assert "Exchange" not in plan(graph)
    chunks = graph.collect()
    assert len(chunks) > 8 and len({c.chunk for c in chunks}) == len(chunks)
    found = {(r.a, r.b): r.weight for r in polarity.edges(graph).collect()}
    whole = polarity.word_graph(df, [], "text", SEEDS)
    assert whole.count() == 1
    assert found == {(r.a, r.b): r.weight for r in polarity.edges(whole).collect()}
    assert found and all(a < b and n for (a, b), n in found.items())
    got = {r.term: (r.polarity, r.round) for r in polarity.induce(graph, SEEDS).collect()}
    assert got == brute_lexicon(texts, set())


def test_a_word_of_a_chunk_meets_the_lexicon_once(spark, few_rows):
    df = spark.createDataFrame([(i, "good kind router") for i in range(40)] + [(99, None)],
                               "id long, text string").coalesce(1)
    lexicon = spark.createDataFrame([("good", 1, 0), ("kind", 1, 1), ("router", -1, 1)],
                                    "term string, polarity int, round int")
    s = polarity.STRENGTH
    for size in (1, 1 << 20):
        out = polarity.score_texts(df, lexicon, [], ("id",), "text", SEEDS, size)
        assert {(r.id, r.positive, r.negative) for r in out.collect()} == {
            *((i, s + s // 2, s // 2) for i in range(40)), (99, 0, 0)}
    assert "CoGroups" in plan(out)          # of chunks; rows of texts and words are not joined
