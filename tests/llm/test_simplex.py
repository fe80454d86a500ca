import hashlib
import math
import random

import numpy as np
import pytest

from parley.llm import queries, simplex


def _brute(rows, clusters=16, rounds=3, dimensions=64, scale=64):
    """Exact integers all through, every centroid compared."""
    kept = [(k, [math.floor(scale * v) if abs(v) < 2**53 else int(v) * scale for v in x])
            for k, x in rows if x is not None and len(x) == dimensions
            and all(v is not None and math.isfinite(v) for v in x)]
    order = sorted(kept, key=lambda r: hashlib.sha256(
        b"1:" + str("" if r[0] is None else r[0]).encode()).hexdigest())
    centroids = [x for _, x in order[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))
                for _, x in kept]
    for _ in range(rounds):
        near = assign()
        for n in range(len(centroids)):
            mine = [x for (_, x), (_, m) in zip(kept, near) if m == n]
            if mine:
                centroids[n] = [sum(v) // len(mine) for v in zip(*mine)]
    return [(k, n, d) for (k, _), (d, n) in zip(kept, assign())], centroids


def _table(spark, rows):
    return spark.createDataFrame([(k, x, "c") for k, x in rows],
                                 "vec_id bigint, embedding array<double>, cluster string")


@pytest.mark.parametrize("pivots", [1, 2, 12])
def test_equals_brute_force(spark, pivots):
    rnd = np.random.default_rng(pivots)
    centres = rnd.normal(size=(6, 64)) * 2
    x = centres[rnd.integers(0, 6, 400)] + rnd.normal(size=(400, 64)) * 0.4
    x[50:200] = x[50]                                  # a large group of copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(7, rows[3][1]), (None, rows[9][1]), (400, None), (401, [1.0] * 63), (402, []),
             (403, [float("nan")] + [0.0] * 63), (404, [None] + [0.0] * 63),
             (405, [float("inf")] * 64), (406, [0.0] * 64)]
    found, centroids = simplex.cluster_vectors(_table(spark, rows), pivots=pivots)
    want, last = _brute(rows)
    assert sorted(map(repr, ((r["vec_id"], r["cluster"], r["distance"]) for r in found.collect()))
                  ) == sorted(map(repr, want))
    assert centroids == last


def test_bounds_hold_and_leave_centroids_out(spark):
    rnd = np.random.default_rng(5)
    centres = rnd.integers(-900, 900, (16, 64))
    x = centres[rnd.integers(0, 16, 500)] + rnd.integers(-60, 60, (500, 64))
    space = simplex.Simplex(centres.tolist())
    apexes, own = space.apexes(x), space.apexes(centres)
    mask = space.candidates(apexes, own)
    exact = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert mask[np.arange(500), exact.argmin(axis=1)].all()
    assert mask.sum() < 0.2 * mask.size                # most comparisons are saved
    (a, ha), (c, hc) = apexes, own
    flat = ((a[:, None] - c[None]) ** 2).sum(axis=2)
    assert (flat + (ha[:, None] - hc) ** 2 <= exact * (1 + 1e-9) + 1e-3).all()
    assert (flat + (ha[:, None] + hc) ** 2 >= exact * (1 - 1e-9) - 1e-3).all()


def test_large_components_and_few_vectors(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([1e9, -3e15, 2.0 ** 60, 0.5]) * rnd.random() for _ in range(64)])
            for i in range(24)] + [(100 + i, [rnd.random()] * 64) for i in range(20)]
    found, centroids = simplex.cluster_vectors(_table(spark, rows))
    want, last = _brute(rows)
    assert centroids == last
    got = {r["vec_id"]: (r["cluster"], r["distance"]) for r in found.collect()}
    assert got == {k: (n, d if d < 1 << 63 else None) for k, n, d in want}
    assert any(d is None for _, d in got.values())
    whole = simplex.with_inertia(found, centroids).collect()
    assert len(whole) == len(rows) and all(r["inertia"] is None for r in whole)
    few = rows[-3:]
    found, centroids = simplex.cluster_vectors(_table(spark, few))
    assert len(centroids) == 3 and {r["distance"] for r in found.collect()} == {0}


def test_empty_and_unusable(spark):
    for rows in ([], [(1, None), (2, [0.0] * 5)]):
        found, centroids = simplex.cluster_vectors(_table(spark, rows))
        assert centroids == [] and found.collect() == []
        assert simplex.with_inertia(found, centroids).collect() == []


def test_query_sums(spark):
    rows = queries.QUERIES["op13_simplex_clusters"](spark, "/root/testdata/sf0.001").collect()
    total, by_cluster = 0, {}
    for r in rows:
        total += r["distance"]
        by_cluster[r["cluster"]] = by_cluster.get(r["cluster"], 0) + r["distance"]
    assert all(r["inertia"] == total and r["cluster_inertia"] == by_cluster[r["cluster"]] for r in rows)
