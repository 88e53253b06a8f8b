"""Clusters against plain Python, bounds against distances, and edge vectors."""

import hashlib

import numpy as np
import pytest

from relayout.llm import simplex


def brute(rows, k=8, rounds=10, dims=64):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    chosen = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    now = [v for _, v in chosen[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(now)) for _, v in kept]

    for _ in range(rounds):
        at = [j for _, j in assign()]
        for j in range(len(now)):
            mine = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            if mine:
                now[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted((-1 if i is None else i, j, d) for (i, _), (d, j) in zip(kept, assign(), strict=True)), now


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 7, 7) for i, v in rows],
                                 "vec_id long, embedding array<double>, cluster int, vec int")


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_python(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 64))
    rows = [(i, centres[i % 5] + rng.normal(size=64) * (0.1 + seed)) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(20)] + [(7, rows[8][1]), (7, rows[9][1]), (None, rows[2][1])]
    rows += [(300, None), (301, []), (302, np.ones(63)), (303, np.full(64, np.nan)), (304, [None] * 64),
             (305, np.append(np.ones(63), np.inf)), (306, np.zeros(64))]
    got, centroids = simplex.cluster(table(spark, rows))
    want, now = brute(rows)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance) for r in got.collect()) == want
    assert centroids.tolist() == now


def test_few_equal_and_no_vectors(spark):
    same = [(i, np.full(64, 0.5)) for i in range(12)]
    got, centroids = simplex.cluster(table(spark, same))
    assert {(r.cluster, r.distance) for r in got.collect()} == {(0, 0)} and len(centroids) == 8
    three = [(i, np.full(64, float(i))) for i in range(3)]
    got, centroids = simplex.cluster(table(spark, three))
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got.collect()) == brute(three)[0] and len(centroids) == 3
    got, centroids = simplex.cluster(table(spark, [(1, None)]))
    assert got.columns == ["vec_id", "cluster", "distance"] and got.count() == 0 and len(centroids) == 0
    out = simplex.cluster(table(spark, [*three, (9, np.append(np.zeros(63), 1e300))]))[0]
    assert {r.vec_id for r in out.collect()} == {0, 1, 2}


@pytest.mark.parametrize("spread", [1, 1000, 100_000_000])
def test_bounds_hold_and_filter(spread):
    rng = np.random.default_rng(1)
    centres = rng.integers(-spread, spread, (8, 64), endpoint=True)
    vectors = centres[rng.integers(0, 8, 2000)] + rng.integers(-spread // 10, spread // 10, (2000, 64), endpoint=True)
    vectors[5:9] = vectors[4]
    shape = simplex.Simplex(vectors[:16])
    apexes, placed = (shape.apexes(simplex.squared(x, shape.pivots)) for x in (vectors, centres))
    lower, upper = simplex.bounds(apexes, placed)
    true = np.sqrt(simplex.squared(vectors, centres).astype(np.float64))
    assert (lower <= true).all() and (true <= upper).all()
    at, best, compared = simplex.nearest(vectors, apexes, centres, placed)
    squares = simplex.squared(vectors, centres)
    assert (at == squares.argmin(1)).all() and (best == squares.min(1)).all()
    assert spread == 1 or compared < 0.5 * 8 * len(vectors)
