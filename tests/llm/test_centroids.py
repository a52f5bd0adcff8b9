from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from oracle import compare, connect

from terrane.llm.centroids import _Step, cluster_vectors
from terrane.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, block long"


def by_hand(rows, clusters, dimensions, rounds, seed):
    """Lloyd's rounds in Python integers: (vec_id, cluster, distance) and the centroids."""
    kept = [
        (key, [math.floor(1024 * x) for x in vector])
        for key, vector in rows
        if vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector)
    ]

    def digest(row):
        return hashlib.sha256(f"{seed}:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]

    centroids = [vector for _, vector in sorted(kept, key=digest)[:clusters]]

    def assigned():
        out = []
        for _, vector in kept:
            squares = [sum((a - b) ** 2 for a, b in zip(vector, c)) for c in centroids]
            out.append((squares.index(min(squares)), min(squares)))
        return out

    for _ in range(rounds):
        owners = assigned()
        for c in range(len(centroids)):
            mine = [vector for (_, vector), (owner, _) in zip(kept, owners) if owner == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine)]
    return Counter((key, *place) for (key, _), place in zip(kept, assigned())), centroids


def table(spark, rows):
    return spark.createDataFrame([(k, v, 1, 2, 3) for k, v in rows], SCHEMA)


ODD = [
    (900, None), (901, []), (902, [1.0]), (903, [1.0, None, 2.0]), (904, [math.nan, 1.0, 2.0]),
    (905, [math.inf, 1.0, 2.0]), (906, [0.0, 0.0, 0.0]), (None, [0.1, 0.2, 0.3]), (906, [0.0, 0.0, 0.0]),
    (907, [1e5, -1e5, 0.0]), (908, [1.0, 2.0, 3.0, 4.0]),
]


@pytest.mark.parametrize(("clusters", "rounds"), [(8, 10), (3, 1), (1, 4), (5, 0)])
def test_rounds_of_random_vectors(spark, clusters, rounds):
    random = np.random.default_rng(clusters)
    centres = random.normal(size=(12, 3))
    points = centres[random.integers(0, 12, 2500)] + 0.2 * random.normal(size=(2500, 3))
    rows = [(k, v) for k, v in enumerate(points.round(2).tolist())] + ODD
    rows += [(3000 + k, rows[5][1]) for k in range(400)]  # one vector many times
    found = cluster_vectors(
        table(spark, rows).repartition(7), clusters=clusters, dimensions=3, rounds=rounds, seed=9
    )
    expected, centroids = by_hand(rows, clusters, 3, rounds, 9)
    assert Counter(map(tuple, found.vectors.collect())) == expected
    assert found.centroids == centroids
    described = found.described().collect()
    total = sum(d * n for (_, _, d), n in expected.items())
    assert {row.inertia for row in described} == {total}
    for row in described:
        assert row.centroid == centroids[row.cluster]
        assert row.cluster_inertia == sum(d * n for (_, c, d), n in expected.items() if c == row.cluster)


def test_ties_empty_clusters_and_negative_floors(spark):
    line = [(k, [float(x)]) for k, x in enumerate([-3, -2, -2, -1, -1, 0, 0, 0, 1, 2, 2, 3] * 4)]
    line += [(100 + k, [x / 1024 / 3]) for k, x in enumerate([-1, -2, -4, -5, 1])]
    for seed in range(6):
        found = cluster_vectors(table(spark, line), clusters=8, dimensions=1, rounds=10, seed=seed)
        expected, centroids = by_hand(line, 8, 1, 10, seed)
        assert (Counter(map(tuple, found.vectors.collect())), found.centroids) == (expected, centroids)


def test_few_and_no_vectors(spark):
    two = [(1, [1.0, 2.0]), (2, [1.0, 2.0])]
    found = cluster_vectors(table(spark, two), dimensions=2)
    assert len(found.centroids) == 2 and found.vectors.count() == 2
    for rows in ([], [(1, None)]):
        none = cluster_vectors(table(spark, rows), dimensions=2)
        assert none.described().count() == 0 and none.centroids == []
    with pytest.raises(ValueError, match="beyond"):
        cluster_vectors(table(spark, [(1, [1e6, 0.0])]), dimensions=2)


def test_settled_vectors_are_not_scanned_again(spark):
    random = np.random.default_rng(0)
    centres = 20 * random.normal(size=(6, 8))
    points = np.concatenate([c + 0.1 * random.normal(size=(700, 8)) for c in centres])
    found = cluster_vectors(table(spark, list(enumerate(points.tolist()))), clusters=6, dimensions=8, rounds=10)
    assert found.scanned[0] == len(points)
    assert sum(found.scanned[1:]) < 0.25 * len(points) * len(found.scanned[1:])


def test_entries_above_the_drift_stay_on_the_heap():
    step = _Step(np.array([[0], [100]]), np.array([0.0, 0.0]))
    heaps = [[], []]
    points = np.array([[10], [49], [90]])
    assert step.rescan(points, np.arange(3), heaps).tolist() == [0, 0, 1]
    assert [len(heap) for heap in heaps] == [2, 1]
    step.drift = np.array([5.0, 5.0])  # gaps are 80, 2 and 80
    assert step.expired(heaps).tolist() == [1]
    step.drift = np.array([80.0, 79.0])
    assert step.expired(heaps).tolist() == [0]


def test_query_on_a_larger_table(spark):
    sf_dir, name = "/root/testdata/sf0.1", "op12_centroid_clustering"
    found = QUERIES[name](spark, sf_dir).toPandas()
    assert compare(found, connect(sf_dir).execute(ORACLES[name]).fetchdf()) is None
