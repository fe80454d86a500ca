"""The unsafe-term automaton against a naive search over words."""

import random
import unicodedata

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.operators import evaluate, unsafe

TERMS = ("idiot", "idiots", "shut up", "up", "go to hell", "to hell", "moron", "hell")
PIECES = ["idiot", "Idiots", "shut", "up", "SHUT", "go", "to", "hell", "m0r0n", "MÓRON", "idi​ot", "1diot",
          "іdiot", "idiot7", "idiot$$$", "77", "straße", "!", ". ", "\n", "--", " ", " ", " ", "x", "5hut", "\x00",
          "İdiot", "日本", "ó", "𝐦oron"]


def naive_words(text: str) -> list[str]:
    out, word, pending = [], "", ""
    for char in text + " ":
        if char in unsafe.INVISIBLE or ord(char) >= 0x300 and unicodedata.category(char).startswith("M"):
            continue
        if char.isalpha():
            base = unicodedata.normalize("NFKD", char)[0].lower()[:1]
            base = unsafe.LOOKALIKE_LETTERS.get(base, base)
            word += pending + (base if "a" <= base <= "z" else "?")
            pending = ""
        elif char in unsafe.LOOKALIKE_SIGNS:
            pending += unsafe.LOOKALIKE_SIGNS[char]
        else:
            out.append(word)
            word = pending = ""
    return [w for w in out if w]


def naive(text: str, terms=TERMS):
    # Signs at the end of a word are no letters; pending ones before a break are dropped above.
    words = naive_words(text)
    hits = [t for t in terms for i in range(len(words)) if words[i:i + len(t.split())] == t.split()]
    return len(hits), ", ".join(sorted(set(hits)))


text = st.one_of(st.none(), st.lists(st.sampled_from(PIECES), max_size=40).map("".join))


@settings(max_examples=300, deadline=None)
@given(st.lists(text, max_size=6))
def test_equals_naive_search(texts):
    got = unsafe.Automaton(TERMS).scan(pd.Series(texts, dtype=object))
    for t, n, terms in zip(texts, got["n_hits"], got["terms"], strict=True):
        if t is None:
            assert pd.isna(n) and terms is None
        else:
            assert (n, terms) == naive(t)


def test_long_texts_cross_lanes():
    rng = random.Random(1)
    texts = ["".join(rng.choices(PIECES, k=rng.choice([0, 5, 20_000]))) for _ in range(12)]
    got = unsafe.Automaton(TERMS).scan(pd.Series(texts))
    assert list(zip(got["n_hits"], got["terms"])) == [naive(t) for t in texts]


def test_no_phrase_across_texts_and_whole_words():
    got = unsafe.Automaton(TERMS).scan(pd.Series(["shut", "up", "shutup upper", "shut, (up)"]))
    assert got["terms"].tolist() == ["", "up", "", "shut up, up"]


def test_column_and_scorer(spark):
    df = spark.createDataFrame([("a", "1", "You 1D10T!"), ("a", "1", "You 1D10T!"), ("b", "2", ""), ("c", "3", None),
                                ("d", "4", "A calm summary.")],
                               "parent_folder string, filename string, summary string")
    df = df.selectExpr("*", "'calm' AS main_topics", "0 AS n_hits", "0 AS _unsafe_x")
    found = unsafe.with_unsafe_terms(df, "summary")
    assert sorted((r.parent_folder, r.n_hits, r.terms) for r in found.collect() if r.summary is not None) == [
        ("a", 1, "idiot"), ("a", 1, "idiot"), ("b", 0, ""), ("d", 0, "")]
    scores = {r.parent_folder: r.score for r in evaluate.score(found, unsafe_col="n_hits").collect()
              if r.scorer == "safety"}
    assert scores == {"a": 0.0, "b": 1.0, "c": 1.0, "d": 1.0}
    assert unsafe.with_unsafe_terms(df.limit(0), "summary").count() == 0
