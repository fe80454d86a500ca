"""Sentence centrality against a version that loops over sentences and words."""

import math
import random
import re

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.operators import central

WORDS = ["tariff", "meter", "refund", "invoice", "agent", "router", "plan", "x"]


def brute(lines: list[str], k: int):
    """Positions and leading weight of one text, from the definition."""
    full = 1 << central.SCALE_BITS
    sets = [set(filter(None, line.split(" "))) for line in lines]
    n = len(sets)
    holders = {w: sum(w in s for s in sets) for s in sets for w in s}
    weight = {w: int(math.log2(n // h) + 1 + 1e-12) ** 2 for w, h in holders.items()}
    unit = [math.floor(full / math.sqrt(sum(weight[w] for w in s))) if s else 0 for s in sets]
    x = [full] * n
    for _ in range(central.ROUNDS):
        z = [unit[i] * sum(weight[w] * (sum(unit[j] * x[j] for j in range(n) if j != i and w in sets[j]) // full)
                           for w in sets[i]) for i in range(n)]
        top = max(max(z), 1)
        x = [(15 * full + 85 * math.floor(v / top * full)) // 100 for v in z]
    if not any(sets):
        return [0], x[0]
    left = [i for i in range(n) if sets[i]]
    picked = []
    while left and len(picked) < k:
        best = min(left, key=lambda i: (-x[i], i))
        picked.append(best)
        left = [i for i in left if i != best
                and 2 * len(sets[i] & sets[best]) <= min(len(sets[i]), len(sets[best]))]
    return sorted(picked), x[picked[0]]


line = st.lists(st.sampled_from(WORDS), max_size=6).map(" ".join)
text = st.one_of(st.none(), st.lists(line, min_size=1, max_size=8).map("\n".join))


@settings(max_examples=150, deadline=None)
@given(st.lists(text, max_size=6), st.integers(1, 4))
def test_equals_brute_force(texts, k):
    got = central.pick_central(pd.Series(texts, dtype=object), k)
    for value, positions, weight in zip(texts, got["positions"], got["lead_weight"], strict=True):
        if value is None:
            assert positions is None and pd.isna(weight)
        else:
            assert (positions, weight) == brute(value.split("\n"), k)


def test_batches_and_order_change_nothing():
    rng = random.Random(5)
    texts = ["\n".join(" ".join(rng.choices(WORDS, k=rng.randint(1, 9))) for _ in range(rng.randint(1, 30)))
             for _ in range(40)]
    whole = central.pick_central(pd.Series(texts), 3)
    for i, one in enumerate(texts):
        alone = central.pick_central(pd.Series([one]), 3)
        assert alone["positions"][0] == whole["positions"][i]
        assert alone["lead_weight"][0] == whole["lead_weight"][i]


def test_long_sentence_does_not_win_by_length():
    lines = ["invoice refund", "refund invoice tariff", "invoice refund meter",
             " ".join(f"word{chr(97 + i)}" for i in range(20)) + " invoice"]
    assert 3 not in central.pick_central(pd.Series(["\n".join(lines)]), 1)["positions"][0]


def test_repeated_sentence_is_not_picked_twice():
    lines = ["invoice refund meter"] * 4 + ["tariff plan invoice", "router agent"]
    picked = central.pick_central(pd.Series(["\n".join(lines)]), 3)["positions"][0]
    assert picked[0] == 0 and not {1, 2, 3} & set(picked) and len(picked) > 1


def test_summary_column(spark):
    rows = [(1, None), (2, ""), (3, "..."), (4, "Hm? Oh."), (5, "One invoice here. Nothing. The invoice here was late."),
            (5, "One invoice here. Nothing. The invoice here was late."),
            (6, "The invoice was wrong. " * 3000 + "Router plan offline.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'old' AS summary", "7 AS _sents")
    out = central.with_central_summary(df, "text").collect()
    got = {r.doc_id: r.summary for r in out}
    assert len(out) == len(rows) and got[1] is None and got[2] is None and got[3] is None and got[4] == "Hm?"
    assert re.match(r"One invoice here\.|The invoice", got[5])
    assert got[6] == "The invoice was wrong. Router plan offline."
    empty = central.with_central_summary(df.limit(0), "text")
    assert empty.count() == 0 and "lead_weight" in empty.columns
