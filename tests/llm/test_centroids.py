"""The threshold walk against all distances, and clustering whatever the partitions."""

from __future__ import annotations

import numpy as np
import pytest

from beaconlake.llm import centroids


@pytest.mark.parametrize("k, dimensions, spread", [(1, 1, 3), (2, 1, 2), (7, 4, 3), (40, 64, 200), (40, 8, 5), (40, 2, 1)])
def test_walk_finds_the_nearest_and_the_smallest_number(k, dimensions, spread):
    rng = np.random.default_rng(k * dimensions)
    vectors = rng.integers(-spread, spread, (2500, dimensions))
    points = rng.integers(-spread, spread, (k, dimensions))
    number, distance = centroids.nearest(vectors, points)
    apart = ((vectors[:, None] - points[None]) ** 2).sum(axis=2)
    assert (number == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_walk_at_the_limits_of_components():
    vectors = np.array([[centroids.LIMIT] * 64, [-centroids.LIMIT] * 64])
    number, distance = centroids.nearest(vectors, np.array([[-centroids.LIMIT] * 64]))
    assert number.tolist() == [0, 0] and distance.tolist() == [64 << 56, 0]


def test_walk_stops_before_all_lists_are_read():
    """Far centroids in one dimension: the frontier passes the best distance and the rest never comes up."""
    block = np.array([[0]])
    points = np.array([[i * 100] for i in range(40)])
    order = np.argsort(points, axis=0, kind="stable")
    seen = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            got = super().__getitem__(key)
            if isinstance(key, np.ndarray) and key.ndim == 1:
                seen.extend(key.tolist())
            return got

    number, best = centroids._walk(block, points.view(Counted), order, np.take_along_axis(points, order, axis=0))
    assert number.tolist() == [0] and best.tolist() == [0] and sorted(set(seen)) == [0, 1]


def test_clusters_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(i % 7, 0.2, 3)]) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    results = []
    for parts in (1, 5):
        found, final = centroids.cluster(vectors.repartition(parts), k=9, rounds=3, dimensions=3)
        results.append((sorted(map(tuple, found.collect())), final.tolist()))
    assert results[0] == results[1]

    points = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    import hashlib

    ids = sorted(points, key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())[:9]
    centres = [points[i] for i in ids]
    for last in (False, False, False, True):
        near = {i: min((sum((a - b) ** 2 for a, b in zip(p, c)), n) for n, c in enumerate(centres)) for i, p in points.items()}
        if not last:
            for n in range(9):
                of = [points[i] for i in points if near[i][1] == n]
                centres[n] = [sum(x) // len(of) for x in zip(*of)] if of else centres[n]
    assert results[0] == (sorted((i, n, d) for i, (d, n) in near.items()), centres)
