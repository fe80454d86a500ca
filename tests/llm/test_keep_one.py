import random

import numpy as np
import pytest

from parley.llm import simhash

A = " ".join(f"alpha{i}" for i in range(60))
B = " ".join(f"beta{i}" for i in range(60))


def _kept(spark, rows, columns="doc_id bigint, text string, _id string"):
    return simhash.keep_one(spark.createDataFrame([(*r, "x") for r in rows], columns)).collect()


def test_no_text_is_lost(spark):
    got = {(r["doc_id"], r["text"]) for r in _kept(spark, [(1, A), (1, B), (2, B)])}
    assert got == {(1, A), (1, B)}
    rows = _kept(spark, [(5, A), (4, A), (4, A), (None, A), (None, B), (None, B), (7, None), (8, "")])
    assert sorted(((r["doc_id"], r["text"]) for r in rows), key=repr) == sorted(
        [(4, A), (None, B), (7, None)], key=repr)
    large = 2**53 + 1
    rows = _kept(spark, [(large, A), (large + 1, B), (None, A)])
    assert {r["doc_id"] for r in rows} == {large, large + 1}
    assert _kept(spark, []) == []


def _components(fps, distance):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if v == old else v for v in label]
    return {frozenset(fps[k] for k in range(len(fps)) if label[k] == v) for v in label}


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_dense_groups_lose_no_link(distance):
    rnd = random.Random(distance)
    for _ in range(40):
        bits = [rnd.randrange(64) for _ in range(7)]
        fps = sorted({sum((rnd.random() < 0.5) << b for b in set(bits)) for _ in range(20)})
        near = {}
        radius = (distance + 1) // 2
        prefix = 3
        for group in range(1 << prefix):
            mine = [f for f in fps if bin((f >> 61) ^ group).count("1") <= radius]
            if mine:
                a, b = simhash.group_links(np.array(mine, np.uint64).view(np.int64), group, prefix,
                                           radius, distance)
                for x, y in zip(a.view(np.uint64).tolist(), b.view(np.uint64).tolist()):
                    near.setdefault(x, set()).add(y)
                    near.setdefault(y, set()).add(x)
        found = set()
        for f in fps:
            seen, todo = {f}, [f]
            while todo:
                for n in near.get(todo.pop(), ()):
                    if n not in seen:
                        seen.add(n)
                        todo.append(n)
            found.add(frozenset(seen))
        assert found == _components(fps, distance)
