"""Centroid clustering and nearest neighbours against brute force."""
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlens.llm import hnsw, neighbours, orchard

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])
CLASH = ("cluster", "distance", "rank", "score", "query_id", "dims", "shard", "ids", "place", "key", "kind")


def frame(spark, rows, clash=True):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return df.select("*", *[F.lit(3).alias(c) for c in CLASH]) if clash else df


def vectors(n, dims, seed=0, groups=6):
    rnd = np.random.default_rng(seed)
    mid = rnd.normal(size=(groups, dims))
    v = mid[rnd.integers(groups, size=n)] + rnd.normal(size=(n, dims)) * 0.4
    return [(k, [float(np.float32(x)) for x in row]) for k, row in enumerate(v)]


# -- Orchard -----------------------------------------------------------------
def brute_nearest(points, cents):
    d = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)) for c in cents] for p in points]
    return [(min(range(len(cents)), key=lambda j: (r[j], j)), min(r)) for r in d]


@pytest.mark.parametrize("spread", [2, 300, 1 << 40])
def test_orchard_finds_the_nearest_and_ties_go_to_the_smaller_number(spread):
    rnd = random.Random(spread)
    cents = [[rnd.randint(-spread, spread) for _ in range(3)] for _ in range(30)]
    cents[17] = cents[4]
    points = [[rnd.randint(-spread, spread) for _ in range(3)] for _ in range(400)] + cents
    at, best, _ = orchard.Orchard(cents).nearest(np.array(points, dtype=object if spread > 1 << 30 else np.int64))
    assert list(zip(at.tolist(), [int(x) for x in best])) == brute_nearest(points, cents)


def test_orchard_leaves_far_centroids_out():
    rnd = np.random.default_rng(2)
    cents = (rnd.normal(size=(40, 8)) * 5000).astype(np.int64)
    points = cents[rnd.integers(40, size=3000)] + rnd.integers(-200, 200, size=(3000, 8))
    _, _, computed = orchard.Orchard(cents.tolist()).nearest(points)
    assert computed < 3000 * 40 / 3


def brute_clusters(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    cents = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))][:k]
    for _ in range(rounds):
        near = brute_nearest([v for _, v in kept], cents)
        for c in range(len(cents)):
            mine = [v for (_, v), (a, _) in zip(kept, near) if a == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine)]
    near = brute_nearest([v for _, v in kept], cents)
    per = {c: sum(d for a, d in near if a == c) for c, _ in near}
    return sorted(((i, a, d, per[a], sum(per.values()), hashlib.sha256(",".join(map(str, cents[a])).encode()).hexdigest())
                   for (i, _), (a, d) in zip(kept, near)), key=repr)


def odd(dims):
    inf, nan = float("inf"), float("nan")
    return [(None, [0.5] * dims), (900, None), (901, []), (902, [1.0] * (dims - 1)), (903, [None] + [1.0] * (dims - 1)),
            (904, [inf] + [0.0] * (dims - 1)), (905, [nan] * dims), (906, [0.0] * dims), (907, [-0.0] * dims),
            (900, [0.25] * dims), (908, [0.25] * dims)]


@pytest.mark.parametrize("k", [9, 400])
def test_clusters_equal_brute_force(spark, k):
    rows = vectors(250, 6) + odd(6)
    rows += rows[:5] + [(950 + j, rows[7][1]) for j in range(40)]
    got = orchard.cluster(frame(spark, rows).repartition(5), k=k, dims=6)
    assert got.columns == orchard.OUT.names
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows, k, 5, 6)


def test_clusters_of_huge_components_and_of_nothing(spark):
    rows = [(k, [3e38 if k % 2 else -3e38, float(k)]) for k in range(8)]
    got = {r["vec_id"]: r for r in orchard.cluster(frame(spark, rows), k=2, dims=2, rounds=1).collect()}
    assert len(got) == 8 and {r["inertia"] for r in got.values()} <= {None, *(r["inertia"] for r in got.values())}
    far = orchard.cluster(frame(spark, [(1, [0.0, 0.0]), (2, [1e30, 0.0])]), k=1, dims=2, rounds=0).collect()
    assert {r["distance"] for r in far} == {0, None} and {r["inertia"] for r in far} == {None}
    assert orchard.cluster(frame(spark, odd(6)[1:7]), dims=6).count() == 0
    assert orchard.cluster(frame(spark, []), dims=6).schema == orchard.OUT


# -- graphs ------------------------------------------------------------------
def brute_neighbours(rows, k, mod):
    live = [(n, i, np.array(v, np.float64)) for n, (i, v) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for n, i, v in live:
        if i is None or i % mod:
            continue
        near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j is None, j or 0) for m, j, w in live if m != n and len(w) == len(v))
        out.append((i, [(None if none else j, d) for d, none, j in near[:k]]))
    return out


def recall(got, want):
    lists = {}
    for r in got:
        lists.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for i, near in want:
        mine = sorted(lists.get(i, []), key=lambda x: x[0])
        assert [r for r, _, _ in mine] == list(range(1, len(near) + 1))
        assert [s for _, _, s in mine] == sorted(s for _, _, s in mine)
        known = dict(near)
        for _, j, s in mine:
            assert j not in known or abs(known[j] - s) < 1e-12
        hit += len({j for _, j, _ in mine} & set(known))
        total += len(near)
    return hit / total


@pytest.mark.parametrize("shard_rows", [8192, 150])
def test_recall_of_neighbours_against_brute_force(spark, shard_rows):
    rows = vectors(1500, 24, seed=4) + [(5000 + k, v) for k, v in vectors(90, 5, seed=5)]
    got = neighbours.nearest_rows(frame(spark, rows), query_mod=10, shard_rows=shard_rows).collect()
    assert recall(got, brute_neighbours(rows, 10, 10)) >= 0.98


def test_copies_ties_odd_rows_and_few_candidates_are_exact(spark):
    base = vectors(30, 6, seed=6)
    rows = base + [(100 + k, base[3][1]) for k in range(40)] + odd(6) + [(None, base[4][1]), (2000, base[20][1]), (2000, base[20][1])]
    rows += [(3000, [1.0, 2.0]), (3001, [1.0, 3.0])]
    got = neighbours.nearest_rows(frame(spark, rows), query_mod=10, shard_rows=16).collect()
    want = brute_neighbours(rows, 10, 10)
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got), key=repr) == sorted(
        ((i, n + 1, j, round(d, 9)) for i, near in want for n, (j, d) in enumerate(near)), key=repr)


def test_neighbours_of_nothing(spark):
    assert neighbours.nearest_rows(frame(spark, [])).schema == neighbours.OUT
    assert neighbours.nearest_rows(frame(spark, [(0, [1.0, 0.0])])).count() == 0
    assert neighbours.nearest_rows(frame(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0])])).count() == 0


def test_graph_is_the_same_each_time_and_every_node_can_be_reached():
    v = np.random.default_rng(8).normal(size=(700, 12)).astype(np.float32)
    order, g = hnsw.build(v)
    again = hnsw.build(v)[1]
    assert all((a == b).all() for a, b in zip(g.layers, again.layers)) and sorted(order) == list(range(700))
    assert (g.search(v[order], 8)[:, 0] == np.arange(700)).mean() > 0.99
    for layer, size in zip(g.layers, g.sizes):
        assert layer.max(initial=-1) < size and (layer[:, 0] >= 0).all() | (size == 1)
