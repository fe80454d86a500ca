"""Heavy terms and topics against plain-Python counts."""

import collections
import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.operators import topics

WORDS = ["the", "router", "meter", "refund", "of", "plan", "invoice", ".", "line"]


def brute_topics(text: str, heavy: set[str], n: int) -> str:
    tokens = text.split(" ")
    good = [len(w) >= topics.MIN_LETTERS and w not in heavy for w in tokens]
    found = collections.Counter()
    for size in (1, 2, 3):
        for i in range(len(tokens) - size + 1):
            if all(good[i:i + size]):
                found[tuple(tokens[i:i + size])] += 1
    found = {p: c for p, c in found.items() if len(p) == 1 or c > 1}

    def inside(a, b):
        return len(a) < len(b) and any(b[i:i + len(a)] == a for i in range(len(b) - len(a) + 1))

    def score(p):
        longer = [c for q, c in found.items() if inside(p, q)]
        m = max(1, len(longer))
        return topics.LENGTH_WEIGHTS[len(p) - 1] * (found[p] * m - sum(longer)) // m

    best = sorted(found, key=lambda p: (-score(p), " ".join(p)))[:n]
    return ", ".join(" ".join(p) for p in best)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=25).map(" ".join), max_size=5), st.integers(1, 5))
def test_topics_equal_brute_force(texts, n):
    heavy = frozenset({"the", "of"})
    got = topics.best_phrases(pd.Series(texts, dtype=object), heavy, n)
    assert got.tolist() == [brute_topics(t, heavy, n) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=60), max_size=8), st.integers(1, 12))
def test_merged_summaries_keep_every_frequent_word(parts, counters):
    merged = pd.Series(dtype="int64")
    total = collections.Counter(w for part in parts for w in part)
    for part in parts:
        one = topics.shrink(pd.Series(collections.Counter(part), dtype="int64"), counters)
        merged = topics.shrink(merged.add(one, fill_value=0).astype("int64"), counters)
    n = sum(total.values())
    assert len(merged) <= counters
    for w, c in total.items():
        assert c - merged.get(w, 0) <= n / (counters + 1) and merged.get(w, 0) <= c


def _heavy(df, **kw):
    return {r.term: r.n_docs for r in topics.heavy_terms(df, "text", **kw).collect()}


def test_heavy_terms_exact_for_any_partitioning_and_counters(spark):
    rng = random.Random(3)
    rows = [(None,), ("",)] + [("The " + " ".join(rng.choices([f"w{chr(97 + i % 26)}{chr(97 + i // 26)}"
                                                             for i in range(300)], k=30)) + ", the END.",)
                               for _ in range(198)]
    rows += [("same Same text",)] * 100                       # copies count as texts
    truth = collections.Counter()
    for (text,) in rows:
        truth.update({w.strip(".,").lower() for w in (text or "").split()})
    expected = {w: c for w, c in truth.items() if w and c * 100 > 10 * len(rows)}
    assert {"the", "end", "same", "text"} <= set(expected)
    df = spark.createDataFrame(rows, "text string")
    for parts, counters in ((1, 4096), (7, 4096), (70, 5)):   # 5 counters: grown to what the texts need
        assert _heavy(df.repartition(parts), counters=counters) == expected


def test_empty_and_null_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "?!")], "doc_id long, text string")
    assert _heavy(df) == {} and _heavy(df.limit(0)) == {}
    out = topics.with_topics(df.selectExpr("*", "'old' AS main_topics"), [], "text").collect()
    assert [r.main_topics for r in out] == ["", "", ""]


def test_function_words_are_no_topics(spark):
    texts = [f"the line and the {w} plan with the {w} plan, and the rest." for w in
             ["router", "meter", "invoice", "refund", "tariff", "agent", "cable", "modem", "signal", "letter", "bonus"]]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    heavy = [r.term for r in topics.heavy_terms(df, "text").collect()]
    assert {"the", "and", "with", "plan"} <= set(heavy) and "router" not in heavy
    out = [r.main_topics for r in topics.with_topics(df, heavy, "text").collect()]
    assert out[0] == "router" and not any("the" in o.split() for o in out)


def test_very_long_text():
    text = " ".join(["router plan"] * 50_000 + ["the"] * 50_000)
    # Both three-word phrases occur 49,999 times, and nothing lies around them.
    assert topics.best_phrases(pd.Series([text]), frozenset({"the"}), 2)[0] == "plan router plan, router plan router"
