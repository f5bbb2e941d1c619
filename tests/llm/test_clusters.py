"""The Shallot search against comparing every vector with every centroid, in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from lifeloom.llm.clusters import Search, clustered, shallot, squared


def by_hand(rows, dimensions, k, rounds):
    kept = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=named)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for r in range(rounds + 1):
        nearest = [min((far(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]
        if r < rounds:
            for n in range(len(centroids)):
                own = [v for (_, v), (_, m) in zip(kept, nearest, strict=True) if m == n]
                if own:
                    centroids[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    inertia = [sum(d for d, m in nearest if m == n) for n in range(len(centroids))]
    for (i, _), (d, n) in zip(kept, nearest, strict=True):
        digest = hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()
        yield i, n, d, inertia[n], sum(inertia), digest


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(12)]
    out = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(middles)]) for i in range(400)]
    out += [(1000 + i, out[3][1]) for i in range(60)]  # one vector very often
    out += [(2000 + i, [rng.choice((0.0, 1.0)) for _ in range(64)]) for i in range(60)]  # many ties
    out += [(3000, None), (3001, [1.0] * 63), (3002, [None] + [1.0] * 63), (3003, [math.nan] * 64), (3004, [math.inf] * 64)]
    return out + [(None, out[0][1]), (7, out[1][1]), (7, out[9][1]), (3005, [-1e3] * 64), (3006, [])]


def result(df):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=str)


@pytest.mark.parametrize("kind", ["double", "float"])
def test_clusters_equal_those_of_all_comparisons(spark, rows, kind):
    data = rows
    if kind == "float":
        data = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 1) for i, v in data], f"vec_id long, embedding array<{kind}>, cluster int").repartition(3)
    assert result(clustered(df)) == sorted(by_hand(data, 64, 40, 5), key=str)


def test_few_vectors_and_none(spark, rows):
    for some in (rows[:1], rows[:3], [rows[0]] * 5, []):
        df = spark.createDataFrame(some, "vec_id long, embedding array<double>")
        assert result(clustered(df)) == sorted(by_hand(some, 64, 40, 5), key=str)


def test_other_parameters_and_huge_components(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-4e5, 4e5) for _ in range(3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "name long, v array<double>")
    state, centroids = shallot(df, "name", "v", k=7, rounds=3, dimensions=3)
    want = {i: (n, d) for i, n, d, *_ in by_hand(rows, 3, 7, 3)}
    assert {r.id: (r.cluster, r.distance) for r in state.collect()} == want and centroids.shape == (7, 3)
    beyond = spark.createDataFrame([(1, [1e300, -1e300, 0.0]), (2, [0.0] * 3)], "name long, v array<double>")
    assert shallot(beyond, "name", "v", k=2, rounds=1, dimensions=3)[0].count() == 2


def test_the_search_compares_less_than_everything():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-500, 500, (40, 16))
    x = centroids[rng.integers(0, 40, 3000)] + rng.integers(-40, 40, (3000, 16))
    best, second, d1, d2, made = Search(centroids, None).find(x, np.zeros(3000, np.int64), np.ones(3000, np.int64))
    every = np.stack([squared(x, c) for c in centroids], axis=1)
    order = np.argsort(every, axis=1, kind="stable")
    assert (best == order[:, 0]).all() and (second == order[:, 1]).all()
    assert (d1 == every.min(axis=1)).all() and (d2 == np.sort(every, axis=1)[:, 1]).all()
    again = Search(centroids, None).find(x, best, second)
    assert (again[0] == best).all() and again[4].mean() < 10 < 40
