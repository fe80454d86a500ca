"""Approximate nearest neighbours: a navigable small-world graph for each shard.

Vectors are dealt into shards of bounded size by a hash of their id.  Each
shard is one hierarchical graph in flat arrays: for every layer the member
nodes and an (members, degree) array of neighbours.  Layers are built from
the top; a layer's nodes are inserted in batches that search the graph built
so far in lockstep, choose diverse neighbours, and link back.  The index is
a table with one row for each shard.

Largest inner product is made a nearest-neighbour problem by one more
component, which gives all vectors of a shard the same length; queries have
zero there.  Equal vectors of a shard are one node with their smallest ids,
so copies neither crowd out other neighbours nor cut the graph.  Queries go
to all shards in blocks; the shards' results are merged by exact scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.words import parts_for
from parley.session import ensure_checkpoint_dir

SHARD_VECTORS = 8192
QUERY_BLOCK = 1024
NEIGHBOURS = 16            # of the upper layers; the lowest has twice as many
BUILD_EF, SEARCH_EF = 64, 64     # the search width is the least one, see ``tuned_ef``
SAMPLE_QUERIES, SAMPLE_RECALL = 64, 0.97

_INDEX = "dim int, shard int, ef int, nodes int, ids binary, owners binary, vectors binary, layers array<binary>"


def _beam(graph: np.ndarray, points: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int):
    """Best ``ef`` nodes of every query by inner product, best first, all queries in lockstep.

    ``graph`` holds neighbours of each node, -1 for none; ``entry`` is
    (queries, starts).  Missing results have node -1 and score -inf.
    """
    n_queries, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((n_queries, len(points)), bool)
    nodes = np.full((n_queries, ef), -1, np.int64)
    scores = np.full((n_queries, ef), -np.inf, np.float32)
    opened = np.ones((n_queries, ef), bool)
    starts = entry.shape[1]
    nodes[:, :starts] = entry
    scores[:, :starts] = np.einsum("qd,qkd->qk", queries, points[entry])
    opened[:, :starts] = False
    seen[rows, entry] = True
    active = np.arange(n_queries)
    while len(active):
        waiting = np.where(opened[active], -np.inf, scores[active])
        best = waiting.argmax(1)
        going = waiting[np.arange(len(active)), best] > -np.inf
        active, best = active[going], best[going]
        if not len(active):
            break
        opened[active, best] = True
        found = graph[nodes[active, best]]
        at = active[:, None]
        new = (found >= 0) & ~seen[at, found]
        row, column = np.nonzero(new)
        seen[active[row], found[row, column]] = True
        near = np.einsum("qd,qkd->qk", queries[active], points[np.where(new, found, 0)])
        near[~new] = -np.inf
        all_nodes = np.concatenate([nodes[active], np.where(new, found, -1)], 1)
        all_scores = np.concatenate([scores[active], near], 1)
        all_opened = np.concatenate([opened[active], ~new], 1)
        top = np.argpartition(all_scores, -ef, axis=1)[:, -ef:]
        nodes[active] = np.take_along_axis(all_nodes, top, 1)
        scores[active] = np.take_along_axis(all_scores, top, 1)
        opened[active] = np.take_along_axis(all_opened, top, 1)
    order = np.argsort(-scores, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(scores, order, 1)


def _diverse(nodes: np.ndarray, scores: np.ndarray, points: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` of each row's candidates (best first; -1 for none).

    A candidate is taken if it is nearer to the row's own point than to any
    taken before; what is left over fills the free places, best first.
    """
    valid = nodes >= 0
    vectors = points[np.where(valid, nodes, 0)]
    between = vectors @ vectors.transpose(0, 2, 1)
    taken = np.zeros(nodes.shape, bool)
    for j in range(nodes.shape[1]):
        blocked = (taken & (between[:, j, :] > scores[:, j, None])).any(1)
        taken[:, j] = valid[:, j] & ~blocked & (taken.sum(1) < degree)
    rank = np.where(taken, 0, np.where(valid, 1, 2))
    order = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    chosen = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(nodes, order, 1), -1)
    short = degree - chosen.shape[1]
    return np.pad(chosen, ((0, 0), (0, short)), constant_values=-1) if short > 0 else chosen


def _link_back(graph: np.ndarray, points: np.ndarray, new: np.ndarray) -> None:
    """Add each new node to the lists of its neighbours, choosing anew where a list is full."""
    degree = graph.shape[1]
    source = np.repeat(new, degree)
    target = graph[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    to, first, count = np.unique(target, return_index=True, return_counts=True)
    for at in range(0, len(to), 512):
        t, f, c = to[at:at + 512], first[at:at + 512], count[at:at + 512]
        width = int(c.max())
        place = f[:, None] + np.arange(width)
        more = np.where(np.arange(width) < c[:, None], source[np.minimum(place, len(source) - 1)], -1)
        more[(more[:, :, None] == graph[t][:, None, :]).any(2)] = -1
        nodes = np.concatenate([graph[t], more], 1)
        scores = np.einsum("td,tkd->tk", points[t], points[np.where(nodes >= 0, nodes, 0)])
        scores[nodes < 0] = -np.inf
        order = np.argsort(-scores, axis=1, kind="stable")
        graph[t] = _diverse(np.take_along_axis(nodes, order, 1),
                            np.take_along_axis(scores, order, 1), points, degree)


def _levels(ids: np.ndarray) -> np.ndarray:
    """Top layer of each node: geometric, from a hash of its id."""
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    uniform = ((h >> np.uint64(11)).astype(np.float64) + 1) / 2.0 ** 53
    return np.minimum(6, (-np.log(uniform) / np.log(NEIGHBOURS)).astype(int))


def build(points: np.ndarray, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from the top: (members, neighbours as node numbers)."""
    n = len(points)
    levels = _levels(ids)
    levels[np.argmax(levels)] += 1              # one entry node above all
    layers: list[tuple[np.ndarray, np.ndarray]] = []
    whole = np.full((n, 0), -1)
    inserted = np.flatnonzero(levels == levels.max())
    for level in range(int(levels.max()), -1, -1):
        degree = 2 * NEIGHBOURS if level == 0 else NEIGHBOURS
        graph = np.full((n, degree), -1, np.int64)
        graph[:, :whole.shape[1]] = whole        # the layer above is a first version of this one
        if layers:
            above = set(layers[-1][0].tolist())
            todo = np.array([x for x in np.flatnonzero(levels >= level) if x not in above], np.int64)
        else:
            todo = np.empty(0, np.int64)
        at = 0
        while at < len(todo):
            batch = todo[at:at + max(16, min(QUERY_BLOCK, len(inserted)))]
            at += len(batch)
            mine = points[batch]
            entry = descend(layers, points, mine)
            nodes, scores = _beam(graph, points, mine, entry, BUILD_EF)
            own = mine @ mine.T                  # the batch's nodes see each other too
            np.fill_diagonal(own, -np.inf)
            near = np.argsort(-own, axis=1)[:, :NEIGHBOURS]
            fellow = np.where(np.isfinite(np.take_along_axis(own, near, 1)), batch[near], -1)
            nodes = np.concatenate([nodes, fellow], 1)
            scores = np.concatenate([scores, np.take_along_axis(own, near, 1)], 1)
            order = np.argsort(-scores, axis=1, kind="stable")[:, :BUILD_EF]
            graph[batch] = _diverse(np.take_along_axis(nodes, order, 1),
                                    np.take_along_axis(scores, order, 1), points, degree)
            _link_back(graph, points, batch)
            inserted = np.concatenate([inserted, batch])
        members = np.flatnonzero(levels >= level)
        layers.append((members, graph[members]))
        whole = graph
    return layers


def _spread(layer: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    graph = np.full((n, layer[1].shape[1]), -1, np.int64)
    graph[layer[0]] = layer[1]
    return graph


def descend(layers, points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Nearest node that greedy search finds through the given layers, for each query."""
    entry = np.zeros((len(queries), 1), np.int64)
    if layers:
        entry[:] = layers[0][0][0]
    for layer in layers[1:]:
        entry = _beam(_spread(layer, len(points)), points, queries, entry, 4)[0][:, :1]
    return entry


def search(layers, points: np.ndarray, queries: np.ndarray, ef: int = SEARCH_EF) -> np.ndarray:
    """Nodes found for each query, best first; -1 for none.

    A shard of no more than ``ef`` nodes is found whole.
    """
    if len(points) <= ef:
        return np.argsort(-(queries @ points.T), axis=1, kind="stable")
    entry = descend(layers[:-1], points, queries)
    return _beam(_spread(layers[-1], len(points)), points, queries, entry, ef)[0]


def _augmented(vectors: np.ndarray) -> np.ndarray:
    square = np.einsum("nd,nd->n", vectors, vectors, dtype=np.float64)
    return np.column_stack([vectors, np.sqrt(np.maximum(square.max() - square, 0))]).astype(np.float32)


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v, dim) of the vectors that take part.

    Null, empty and zero vectors, vectors with null or non-finite
    components, and rows with a null id take no part.  Rows of equal id
    count as one, the smallest vector of them.
    """
    v = F.col("v")
    return (vectors.select(F.col(key).cast("long").alias("vec_id"),
                           F.col(vector).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull())
            .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
            .where(F.exists(v, lambda x: x != 0))
            .groupBy("vec_id").agg(F.min("v").alias("v"))
            .withColumn("dim", F.size("v")))


def index(points: DataFrame, k: int, shard_vectors: int = SHARD_VECTORS) -> DataFrame:
    """One row for each shard of :func:`usable` vectors; every vector is in it.

    Each node keeps the ``k`` + 1 smallest ids of its copies, all that a
    result of ``k`` others can name.
    """
    shards = parts_for(points.count(), shard_vectors)

    def made(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        vectors = np.stack(table.column("v").to_numpy(zero_copy_only=False))
        order = np.argsort(ids)
        ids, vectors = ids[order], vectors[order]
        nodes, node = np.unique(vectors, axis=0, return_inverse=True)
        node = node.ravel()
        order = np.argsort(node, kind="stable")
        starts = np.searchsorted(node[order], np.arange(len(nodes)))
        rank = np.arange(len(node)) - starts[node[order]]
        order = order[rank <= k]
        points = _augmented(nodes)
        layers = build(points, ids[np.unique(node, return_index=True)[1]])
        flat = [a.astype(np.int32).tobytes() for layer in layers for a in layer]
        return pa.table({
            "dim": pa.array([key[0].as_py()], pa.int32()),
            "shard": pa.array([key[1].as_py()], pa.int32()),
            "ef": pa.array([tuned_ef(layers, points, nodes, k)], pa.int32()),
            "nodes": pa.array([len(nodes)], pa.int32()),
            "ids": [ids[order].astype(np.int64).tobytes()],
            "owners": [node[order].astype(np.int32).tobytes()],
            "vectors": [nodes.astype(np.float64).tobytes()],
            "layers": pa.array([flat], pa.list_(pa.binary()))})
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInArrow(made, _INDEX)


def tuned_ef(layers, points: np.ndarray, vectors: np.ndarray, k: int, least: int = SEARCH_EF,
             wanted: float = SAMPLE_RECALL, sample: int = SAMPLE_QUERIES) -> int:
    """The search width, from ``least`` on in doublings, that finds ``wanted`` of the ``k`` + 1
    nearest of sampled vectors of a shard, as an exhaustive search of the shard finds them.

    Where lengths differ much, or neighbours are all far, a graph needs a
    wider search for the same recall.
    """
    n, ef, k = len(vectors), least, min(k + 1, len(vectors))
    chosen = np.random.default_rng(n).choice(n, min(sample, n), replace=False)
    exact = vectors[chosen] @ vectors.T
    worst = np.partition(exact, n - k, axis=1)[:, n - k][:, None]
    asking = np.column_stack([vectors[chosen], np.zeros(len(chosen))]).astype(np.float32)
    while ef < n:
        nodes = search(layers, points, asking, ef)
        scores = np.where(nodes >= 0, np.take_along_axis(exact, np.maximum(nodes, 0), axis=1), -np.inf)
        # rounding may move the last of them a little
        near = (scores >= worst - 1e-9 * np.abs(worst)).sum(axis=1)
        if np.minimum(near, k).mean() >= wanted * k:
            break
        ef *= 2
    return min(ef, max(n, least))


def _load(row: dict):
    n, flat = row["nodes"], [np.frombuffer(b, np.int32).astype(np.int64) for b in row["layers"]]
    layers = [(flat[i], flat[i + 1].reshape(len(flat[i]), -1)) for i in range(0, len(flat), 2)]
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, -1)
    return (layers, vectors, np.frombuffer(row["ids"], np.int64),
            np.frombuffer(row["owners"], np.int32))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, ef: int = SEARCH_EF,
            shard_vectors: int = SHARD_VECTORS, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest vectors of each query by inner product, its own id left out.

    Rows (query_id, rank from 1, vec_id, score); ties go to the smaller
    vec_id; scores are double precision on the given vectors; vectors of
    another length than the query's are no candidates.  A query with fewer
    candidates gets them all, one with none has no rows.  See
    :func:`usable` for what takes part.
    """
    ensure_checkpoint_dir(vectors.sparkSession)
    points = usable(vectors, key, vector).checkpoint()
    graphs = index(points, k, shard_vectors).checkpoint()
    asked = usable(queries, key, vector)
    blocks = parts_for(asked.count(), QUERY_BLOCK)

    def blocked(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return pa.table({
            "dim": pa.array([key[0].as_py()], pa.int32()),
            "query_ids": [table.column("vec_id").to_numpy().tobytes()],
            "queries": [np.stack(table.column("v").to_numpy(zero_copy_only=False)).tobytes()]})
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    asked = asked.withColumn("block", block).groupBy("dim", "block").applyInArrow(
        blocked, "dim int, query_ids binary, queries binary")
    places = graphs.select("dim", "shard").groupBy("dim").agg(F.collect_list("shard").alias("shard"))
    asked = asked.join(places, "dim").withColumn("shard", F.explode("shard"))

    def searched(batches):
        for batch in batches:
            for row in batch.to_pylist():
                layers, given, ids, owners = _load(row)
                own = np.frombuffer(row["query_ids"], np.int64)
                asking = np.frombuffer(row["queries"], np.float64).reshape(len(own), -1)
                flat = np.column_stack([asking, np.zeros(len(asking))]).astype(np.float32)
                found = search(layers, _augmented(given), flat, max(ef, row["ef"]))
                first = np.searchsorted(owners, np.arange(len(given) + 1))
                out = []
                for q, nodes, query in zip(own, found, asking, strict=True):
                    nodes = nodes[nodes >= 0]
                    scores = given[nodes] @ query
                    copies = first[nodes + 1] - first[nodes]
                    where = np.repeat(first[nodes] - np.cumsum(copies) + copies, copies)
                    vec = ids[where + np.arange(len(where))]
                    score = np.repeat(scores, copies)
                    other = vec != q
                    vec, score = vec[other], score[other]
                    best = np.lexsort((vec, -score))[:k]
                    out.append([{"down": -s, "vec_id": v} for s, v in
                                zip(score[best].tolist(), vec[best].tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(out, pa.list_(pa.struct(
                        [("down", pa.float64()), ("vec_id", pa.int64())])))], ["query_id", "found"])
    results = asked.join(graphs, ["dim", "shard"]).mapInArrow(
        searched, "query_id bigint, found array<struct<down:double,vec_id:bigint>>")
    merged = results.groupBy("query_id").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
    return merged.select("query_id", F.posexplode("found").alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"),
        (-F.col("one.down")).alias("score"))
