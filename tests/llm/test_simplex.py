import hashlib

import numpy as np
import pytest

from brisa.llm import queries, simplex
from tests.parity import compare, duck

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_clusters(ids, vectors, count=16, rounds=3):
    q = [[int(np.floor(np.float64(np.float32(x)) * 64)) for x in v] for v in vectors]
    order = sorted(range(len(q)), key=lambda k: (hashlib.sha256(f"1:{ids[k]}".encode()).hexdigest(), q[k]))
    centers = [q[k] for k in order[:count]]

    def assign():
        out = []
        for v in q:
            squares = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centers]
            out.append((squares.index(min(squares)), min(squares)))
        return out

    for _ in range(rounds):
        found = assign()
        for k in range(len(centers)):
            own = [v for v, (c, _) in zip(q, found, strict=True) if c == k]
            if own:
                centers[k] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = assign()
    whole = sum(d for _, d in found)
    inertia = [sum(d for c, d in found if c == k) for k in range(len(centers))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted((i, c, d, inertia[c], whole, digest[c]) for i, (c, d) in zip(ids, found, strict=True))


def run(df):
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(tuple(r[n] for n in names) for r in simplex.clustered(df).collect())


@pytest.mark.parametrize("kind", ["spread", "crowded", "ties", "line"])
def test_clusters_equal_plain_ones(spark, kind):
    draw = np.random.default_rng(sum(map(ord, kind)))
    if kind == "spread":
        vectors = draw.normal(size=(300, 64)) * 0.3
    elif kind == "crowded":  # most are copies of one vector, or nearly
        vectors = np.repeat(draw.normal(size=(1, 64)), 300, axis=0)
        vectors[:80] += draw.normal(size=(80, 64)) * 0.02
        vectors[250:] = draw.normal(size=(50, 64)) * 3
    elif kind == "ties":  # few values, so that many distances are equal
        vectors = draw.integers(-1, 2, (300, 64)) / 64 * (draw.random((300, 64)) < 0.05)
    else:  # all vectors on one line: no base of eight pivots
        vectors = np.arange(300)[:, None] * np.ones((1, 64)) * 0.05
    vectors = vectors.astype(np.float32).tolist()
    df = spark.createDataFrame([(k, v, 0) for k, v in enumerate(vectors)], SCHEMA)
    assert run(df) == plain_clusters(range(len(vectors)), vectors)


def test_bounds_hold():
    draw = np.random.default_rng(4)
    points = draw.integers(-60, 60, (200, 64))
    centers = draw.integers(-60, 60, (16, 64))
    base = simplex.Simplex(centers)
    assert len(base.pivots) == simplex.PIVOTS
    a, b = base.apexes(points), base.apexes(centers)
    squares = simplex.exact_squares(points, centers)
    along = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    low, high = along + (a[:, None, -1] - b[None, :, -1]) ** 2, along + (a[:, None, -1] + b[None, :, -1]) ** 2
    assert (low <= squares + 1e-6).all() and (high >= squares - 1e-6).all()
    # a pivot's own distances are exact
    pivots = [k for k, c in enumerate(centers.tolist()) if c in base.pivots.tolist()]
    assert np.allclose(low[:, pivots], squares[:, pivots]) and np.allclose(high[:, pivots], squares[:, pivots])


def test_filter_leaves_few_centers():
    draw = np.random.default_rng(6)
    centers = draw.integers(-60, 60, (16, 64))
    points = centers[draw.integers(0, 16, 400)] + draw.integers(-3, 4, (400, 64))
    base = simplex.Simplex(centers)
    asked = []
    squares = np.einsum

    def counted(*a):
        asked.append(len(a[1]))
        return squares(*a)

    apex, over = base.apexes(points), base.apexes(centers)
    np.einsum = counted
    try:
        label, best = simplex.nearest(points, apex, centers, over)
    finally:
        np.einsum = squares
    whole = simplex.exact_squares(points, centers)
    assert (label == whole.argmin(axis=1)).all() and (best == whole.min(axis=1)).all()
    assert sum(asked) < 6 * len(points)  # of sixteen for each


def test_edge_cases(spark):
    good = [0.25] * 64
    odd = [None, [], [0.5] * 63, [0.5] * 65, [None, *good[1:]], [float("nan"), *good[1:]], [float("inf"), *good[1:]]]
    rows = [(k, v, 0) for k, v in enumerate(odd)]
    rows += [(100, good, 0), (100, good, 0), (100, [-0.25] * 64, 0), (None, [0.5] * 64, 0), (101, [3.0e38] * 64, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("q", "apex", "cluster", "draw", "v"):
        df = df.selectExpr("*", f"'other' AS {name}")
    found = simplex.clustered(df).collect()
    ids = [r["vec_id"] for r in found]
    assert sorted(ids, key=str) == [100, 100, 100, 101, None]
    # the row without an id first joins one of two equal centroids, and then has it to itself
    assert {(r["distance"], r["inertia"]) for r in found} == {(0, 0)}
    assert len({r["cluster"] for r in found}) == 4
    assert simplex.clustered(df.where("vec_id < 100")).collect() == []
    assert simplex.clustered(df.where("false")).collect() == []
    assert simplex.clustered(df.where("vec_id is null and embedding is not null")).collect() == []


def test_query_matches_sql(spark, sf):
    df = queries.QUERIES["op13_simplex_clusters"](spark, sf)
    assert compare(df, duck(sf), queries.ORACLES["op13_simplex_clusters"]) == []
