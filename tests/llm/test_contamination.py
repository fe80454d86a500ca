import random
import re

import pytest

from parley.llm import contamination
from parley.llm.contamination import ItemAutomaton, find_overlaps, merged_spans, normal_words


def _plain_words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def _brute(text, items, window):
    """(hit word numbers, items) by comparing every window of every item at every place."""
    words, hit, met = _plain_words(text), set(), set()
    for item, item_text in items:
        given = _plain_words(item_text)
        n = min(window, len(given))
        if not n:
            continue
        for piece in {tuple(given[i:i + n]) for i in range(len(given) - n + 1)}:
            for at in range(len(words) - n + 1):
                if tuple(words[at:at + n]) == piece:
                    hit.update(range(at, at + n))
                    met.add(item)
    return hit, met


def _check(rows, items, window):
    for row in rows:
        hit, met = _brute(row["text"], items, window)
        assert {i for s in row["spans"] for i in range(s["start"], s["stop"])} == hit
        assert row["items"] == sorted(str(i) for i in met if i is not None)
        assert row["n_words"] == len(_plain_words(row["text"]))


def test_words():
    for text in ("A-b c9_d\x00e é'Ü\x7fx ÀZ", "", "...", " a b", "日本 x"):
        assert [w.decode() for w in normal_words(text)] == _plain_words(text)
    assert normal_words(None) == []


@pytest.mark.parametrize("window", [1, 2, 3, 4])
def test_automaton_equals_brute_force(window):
    rnd = random.Random(window)

    def text(most):
        return " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, most)))
    for _ in range(250):
        items = [(str(i % 4), text(7)) for i in range(rnd.randint(1, 6))]
        automaton = ItemAutomaton([(k, normal_words(t)) for k, t in items if t], window)
        doc = text(40) + " z " + text(10)
        hits, met = automaton.scan(normal_words(doc))
        want, who = _brute(doc, items, window)
        assert {i for a, b, _ in hits for i in range(a, b)} == want and met == who
        words, rest = doc.split(), [t.split() for _, t in items]
        for start, stop, longest in merged_spans(hits):
            best = max(n for e in range(start + 1, stop + 1) for n in range(1, e + 1)
                       if any(words[e - n:e] == r[i:i + n] for r in rest for i in range(len(r))))
            assert longest <= best
            if window == 1:
                assert longest == best


@pytest.mark.parametrize("shard_words", [500_000, 60])
def test_overlaps_of_tables(spark, shard_words):
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(30)]

    def prose(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, prose(rnd.choice([3, 8, 25, 90]))) for i in range(12)]
    items += [(3, prose(20)), (None, prose(15)), (20, None), (21, ""), (22, "?!"), (23, items[0][1]),
              (0, items[0][1])]
    docs = [(i, prose(20) + " " + (items[i % 12][1] or "") + ", " + prose(8)) for i in range(30)]
    docs += [(None, items[3][1]), (1, docs[1][1]), (50, None), (51, ""), (52, "!"),
             (53, items[12][1].upper().replace(" ", "\n--")), (54, (items[4][1] + " ") * 400)]
    table = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id bigint, text string, items string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = find_overlaps(table, bench, window=6, shard_words=shard_words).collect()
    assert len(rows) == len(docs)
    _check(rows, items, 6)
    assert sum(bool(r["spans"]) for r in rows) > 10


def test_cut_texts(spark):
    long = " ".join(f"b{i}" for i in range(14))
    bench = spark.createDataFrame([("q", long), ("s", "tiny one")], "item_id string, text string")
    filler = " ".join(f"f{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, f"{filler}. B0, {long[3:].upper()}! end"), (2, f"a {long}"), (3, f"{filler}: Tiny one."),
         (4, None), (5, "clean")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["clean_text"], r["n_removed"]) for r in
           contamination.decontaminate(docs, bench).collect()}
    assert got[1] == (f"{filler}. ! end", 14)       # longer than the limit of words
    assert got[2] == ("a ", 14)
    assert got[3] == (f"{filler}: Tiny one.", 0)     # short, and little of the text
    assert got[4] == (None, 0) and got[5] == ("clean", 0)
    strict = contamination.decontaminate(docs, bench, max_coverage=0.01).where("doc_id = 3").first()
    assert strict["clean_text"] == f"{filler}: ."


def test_edge_tables(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "the lazy dog and runs into the deep green forest where old"),
                                   (None, "one"), (2, None)], "item_id int, text string")
    rows = find_overlaps(edge_docs, bench).collect()
    assert len(rows) == edge_docs.count()
    _check(rows, [(1, "the lazy dog and runs into the deep green forest where old"), (None, "one")], 10)
    assert any(r["text"] == "one" and r["spans"] and not r["items"] for r in rows)
    assert find_overlaps(no_docs, bench).collect() == []
    nothing = find_overlaps(edge_docs, bench.where("item_id = 9")).collect()
    assert len(nothing) == len(rows) and not any(r["spans"] or r["items"] for r in nothing)
