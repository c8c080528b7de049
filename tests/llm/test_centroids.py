"""Clustering with kept products against plain Lloyd rounds."""

import hashlib
import math

import numpy as np
import pytest

from gridmend.llm import centroids

from compare import connect, differences

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, v int, dots int, cluster int, before int"


def brute_force(rows, k, rounds, dim, scale=1024):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cents))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for c in range(len(cents)):
            members = [v for (_, v), o in zip(kept, of) if o == c]
            if members:
                cents[c] = [sum(x) // len(members) for x in zip(*members)]
    done = [(i, *nearest(v)) for i, v in kept]
    inertia = sum(d for _, d, _ in done)
    of_cluster = {c: sum(d for _, d, o in done if o == c) for c in range(len(cents))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, of_cluster[c], inertia, digests[c]) for i, d, c in done), key=str)


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 1, 2, 3, 4, 5) for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in centroids.cluster(table, **options).collect()), key=str)


def test_agrees_with_sql(spark):
    problem, rows = differences(spark, connect(SMALL), SMALL, "op11_centroids")
    assert problem is None and rows > 0


def test_odd_rows_ties_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [-1.0, 0.001]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [1.0]), (8, [nan, 1.0]),
            (9, [1.0, None]), (10, [inf, 0.0]), (None, [0.5, 0.5]), (11, [-0.25, -0.25]), (12, [0.0, 60000.0])]
    for k in (3, 50):
        assert found(spark, rows, k=k, dim=2) == brute_force(rows, k, 10, 2)


def test_moves_over_many_rounds(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=4) + (i % 3)]) for i in range(300)]
    for rounds in (0, 7):
        assert found(spark, rows, k=6, rounds=rounds, dim=4) == brute_force(rows, 6, rounds, 4)


def test_nothing_to_cluster(spark):
    assert found(spark, []) == [] and found(spark, [(1, None), (2, [1.0])]) == []


def test_components_too_large_for_exact_distances_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        found(spark, [(1, [1e9, 0.0])], dim=2)
