import numpy as np
import pytest

from parley.llm import hnsw


def _brute(ids, vectors, query, k):
    dims = [i for i, v in enumerate(vectors) if len(v) == len(vectors[query])]
    scored = sorted((-float(np.dot(vectors[i], vectors[query])), ids[i]) for i in dims if i != query)
    return scored[:k]


@pytest.fixture(scope="module")
def points():
    rnd = np.random.default_rng(11)
    vectors = rnd.normal(size=(1500, 24)) * rnd.uniform(0.5, 2, (1500, 1))
    vectors[700:1000] = vectors[700]              # a large group of copies
    return vectors


@pytest.mark.parametrize("shard_vectors", [8192, 200])
def test_recall_scores_and_ties(spark, points, shard_vectors):
    table = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(points)],
                                  "vec_id bigint, embedding array<double>, rank string")
    rows = hnsw.nearest(table, table.where("vec_id % 20 = 0"), 20, 64, shard_vectors).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(found) == set(range(0, 1500, 20))
    hits = 0
    for q, got in found.items():
        best = _brute(list(range(1500)), points, q, 20)
        assert sorted(got) == list(range(1, 21)) and q not in {v for v, _ in got.values()}
        for v, s in got.values():
            assert s == pytest.approx(float(np.dot(points[v], points[q])), rel=1e-12)
        order = [(-got[r][1], got[r][0]) for r in range(1, 21)]
        assert order == sorted(order)
        hits += len({v for _, v in best} & {v for v, _ in got.values()})
    assert hits / (20 * len(found)) >= 0.95


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (None, [1.0, 1.0]), (8, [2.0, -1.0]), (8, [2.0, -1.0]),
            (9, [1.0, 0.0]), (20, [1.0, 2.0, 3.0]), (40, [-1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {}
    for r in hnsw.nearest(table, table.where("vec_id % 20 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {q: sorted(v) for q, v in got.items()} == {
        0: [(1, 8, 2.0), (2, 9, 1.0), (3, 1, 0.5), (4, 40, -1.0)],
        40: [(1, 1, -0.5), (2, 0, -1.0), (3, 9, -1.0), (4, 8, -2.0)]}
    empty = table.where("false")
    assert hnsw.nearest(empty, empty).count() == 0


def test_every_node_is_reached():
    rnd = np.random.default_rng(1)
    vectors = rnd.normal(size=(900, 8))
    flat = hnsw._augmented(vectors)
    layers = hnsw.build(flat, np.arange(900))
    members = [set(m.tolist()) for m, _ in layers]
    assert members[-1] == set(range(900)) and all(a <= b for a, b in zip(members, members[1:], strict=False))
    own = np.column_stack([vectors, np.zeros(900)]).astype(np.float32)
    best = np.argsort(-(vectors @ vectors.T), axis=1)[:, :5]
    found = hnsw.search(layers, flat, own, 64)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(best.tolist(), found.tolist(), strict=True)]) > 0.97


@pytest.mark.parametrize("sigma", [0.0, 0.25, 0.5, 1.0, 1.5])
def test_recall_of_unequal_lengths(spark, sigma):
    rnd = np.random.default_rng(int(sigma * 100))
    vectors = rnd.normal(size=(4000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors *= rnd.lognormal(0, sigma, (4000, 1))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                                  "vec_id bigint, embedding array<double>")
    rows = hnsw.nearest(table, table.where("vec_id % 40 = 0"), 20, shard_vectors=2048).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    scores = vectors[::40] @ vectors.T
    hits = 0
    for q, row in zip(range(0, 4000, 40), scores):
        row[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-row)[:20].tolist()))
    assert hits >= 0.9 * 20 * 100
