import random
from itertools import combinations

import numpy as np
import pytest

from parley.llm import components, simhash, substring
from parley.llm.words import ascii_words


def _brute_fp(text):
    import xxhash
    words = ascii_words(text)
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def _brute_components(fps, ids, most):
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= most:
            parent[top(i)] = top(j)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(top(i), []).append(ids[i])
    return [min((k for k in groups[top(i)] if k is not None), default=None)
            for i in range(len(fps))]


def test_edge_documents_against_brute_force(edge_docs, no_docs):
    rows = edge_docs.select("doc_id", "text").collect()
    fps = [_brute_fp(r["text"]) for r in rows]
    ids = [r["doc_id"] for r in rows]
    expected = sorted(zip(map(str, ids), [f"{f:016x}" for f in fps],
                          map(str, _brute_components(fps, ids, 4)), strict=True))
    found = sorted((str(r["doc_id"]), f"{r['fp'] & (2**64 - 1):016x}", str(r["component_id"]))
                   for r in simhash.near_duplicates(edge_docs).collect())
    assert found == expected
    assert simhash.near_duplicates(no_docs).count() == 0


def test_keep_one_keeps_one_row_of_each_group(edge_docs, no_docs):
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    # an id with texts in two groups has a row in each
    groups = {r["group"]: r["component_id"] for r in simhash.near_duplicates(edge_docs).collect()}
    named = [r["doc_id"] for r in kept.collect() if r["doc_id"] is not None]
    assert sorted(named) == sorted(c for c in groups.values() if c is not None)
    assert [r["text"][:8] for r in kept.collect() if r["doc_id"] is None] == ["nameless"]
    assert simhash.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("distance, group_variants", [(4, 2_000_000), (4, 3000), (3, 50_000), (2, 500)])
def test_random_fingerprints_lose_no_link(spark, distance, group_variants):
    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(30)}
    for f in list(fps):
        for k in (1, 2, distance, distance + 1, 6):
            fps.add(f ^ sum(1 << b for b in rnd.sample(range(64), k)))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    edges = simhash.links(table, distance, group_variants)
    parent = {r["a"]: r["b"] for r in components.roots(edges).collect()}
    expected = _brute_components(fps, signed, distance)
    assert [parent.get(s, s) for s in signed] == expected


def test_hot_prefix_is_split_without_loss():
    rnd = np.random.default_rng(1)
    fps = np.unique(np.uint64(0xABCD << 48) | rnd.integers(0, 1 << 20, 300).astype(np.uint64))
    whole = simhash.group_links(fps.view(np.int64), 0xAB, 8, 2, 4)
    label = {int(f): int(f) for f in fps.view(np.int64)}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x
    for part in range(5):
        for a, b in zip(*simhash.group_links(fps.view(np.int64), 0xAB, 8, 2, 4, part, 5), strict=True):
            label[top(int(a))] = top(int(b))
    split = {}
    for f in label:
        split.setdefault(top(f), set()).add(f)
    joined = {}
    for f in label:
        joined.setdefault(dict(zip(*map(np.ndarray.tolist, whole), strict=True)).get(f, f), set()).add(f)
    assert sorted(map(sorted, split.values())) == sorted(map(sorted, joined.values()))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1000, 999)], "a bigint, b bigint")
    found = {r["a"]: r["b"] for r in components.roots(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 301)}, 1000: 999}


def _brute_removed(rows, window):
    """rows in order; returns kept words of each."""
    seen, out = set(), []
    for text in rows:
        words = ascii_words(text, lower=False)
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                gone[i:i + window] = [True] * window
            seen.add(w)
        out.append((len(words), sum(gone), b" ".join(
            w for w, g in zip(words, gone, strict=True) if not g).decode()))
    return out


@pytest.mark.parametrize("chunk_bytes, window", [(8 << 20, 20), (2000, 20), (3000, 3)])
def test_repeats_against_brute_force(edge_docs, no_docs, chunk_bytes, window):
    rows = sorted((r for r in edge_docs.select("doc_id", "text").collect()),
                  key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""))
    expected = sorted((str(r["doc_id"]), *x) for r, x in
                      zip(rows, _brute_removed([r["text"] for r in rows], window), strict=True))
    cleaned = substring.remove_repeats(edge_docs, window, chunk_bytes)
    assert cleaned.columns == [*edge_docs.columns, "n_words", "n_removed", "kept_text"]
    found = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_text"])
                   for r in cleaned.collect())
    assert found == expected
    assert substring.remove_repeats(no_docs).count() == 0


def test_sketch_codes_round_trip():
    rnd = np.random.default_rng(2)
    for chunks in (3, 5000):
        sketch = substring.Sketch(200_000, chunks)
        cells = np.sort(sketch.cells(rnd.integers(0, 1 << 62, 500).astype(np.uint64), 0))
        bounds = sketch.bounds(cells)
        for s in np.flatnonzero(np.diff(bounds)):
            part = cells[bounds[s]:bounds[s + 1]]
            low = sketch.decode(sketch.code(part))
            assert (low == (part & np.uint64((1 << sketch.low) - 1)).astype(np.int64)).all()
