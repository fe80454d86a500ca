import hashlib
import random
import re
import zlib

import pytest

from parley.llm import queries, runs
from parley.llm.words import ascii_words

SMALL = "/root/testdata/sf0.001"


def _period(words):
    border, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def _brute(words, min_length=24, min_exponent=3):
    """All maximal stretches of equal words at each distance, kept if that is their smallest period."""
    found = []
    for p in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(min_length, min_exponent * p) \
                    and _period(words[i:j + p]) == p:
                found.append((i, j + p - i, p))
            i = j + 1
    return sorted(found)


@pytest.mark.parametrize("limits", [(24, 3), (7, 3), (4, 2), (2, 2), (12, 5)])
def test_equals_brute_force(limits):
    rnd = random.Random(sum(limits))
    total = 0
    for _ in range(700):
        letters, words = rnd.choice([1, 2, 3, 6]), []
        for _ in range(rnd.randint(0, 9)):
            words += [rnd.randrange(letters) for _ in range(rnd.randint(1, 9))] * rnd.choice([1, 1, 2, 4])
        words = [b"w%d" % w for w in words]
        want = _brute(words, *limits)
        assert runs.text_runs(words, *limits) == want
        total += len(want)
    assert total > 100


def test_long_runs_and_stretches():
    rnd = random.Random(4)
    block = [b"x%d" % rnd.randrange(900) for _ in range(700)]
    noise = [b"n%d" % i for i in range(5000)]
    words = noise[:2000] + block * 5 + block[:33] + noise[2000:] + [b"a"] * 30
    assert runs.text_runs(words) == [(2000, 3533, 700), (len(words) - 30, 30, 1)]
    kept = runs.without_repeats(words, runs.text_runs(words))
    assert kept == noise[:2000] + block + noise[2000:] + [b"a"]


def test_the_query_equals_plain_python(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    seen = 0
    for doc, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + i % p] for i in range(n - a)]
        found = _brute(words)
        drop = {i for s, length, q in found for i in range(s + q, s + length)}
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        row = got[doc]
        assert row["n_runs"] == len(found)
        assert (row["start"], row["length"], row["period"]) == (best or (None, None, None))
        assert row["exponent_milli"] == (best and 1000 * best[1] // best[2])
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        kept = " ".join(w for i, w in enumerate(words) if i not in drop)
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        seen += len(found)
    assert seen > 5


def test_strongest_breaks_ties_exactly(spark):
    rows = spark.createDataFrame(
        [(1, [(0, 30, 10), (5, 24, 8), (9, 29, 9)]), (2, [(3, 24, 8), (5, 30, 10)]), (3, []),
         (4, [(7, 10**12 + 1, 10**6), (8, 10**12 + 2, 10**6)])],
        "k int, runs array<struct<start bigint, length bigint, period bigint>>")
    got = {r["k"]: r["best"] for r in rows.select("k", runs.strongest(rows["runs"]).alias("best")).collect()}
    assert tuple(got[1]) == (9, 29, 9) and tuple(got[2]) == (3, 24, 8) and got[3] is None
    assert got[4]["start"] == 8


def test_edge_rows(spark, edge_docs, no_docs):
    clash = edge_docs.withColumnRenamed("_chunk", "runs").withColumnRenamed("fp", "n_words")
    rows = runs.find_runs(clash).collect()
    assert len(rows) == edge_docs.count() and clash.columns[:2] == ["doc_id", "text"]
    by_text = {r["text"]: r for r in rows}
    for text, row in by_text.items():
        words = ascii_words(text, lower=False)
        assert row["n_words"] == len(words)
        if len(words) < 5000:
            assert [tuple(r) for r in row["runs"]] == _brute(words)
    assert by_text[None]["runs"] == [] and by_text[None]["kept_text"] == ""
    assert runs.find_runs(no_docs).collect() == []
    echoed = {r["doc_id"] for r in runs.echo_tails(edge_docs).join(
        edge_docs.select("text"), "text", "left_anti").collect()}
    assert None not in echoed
    with pytest.raises(ValueError):
        runs.find_runs(edge_docs, min_exponent=1)
