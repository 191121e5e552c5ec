import hashlib
import math

import pytest

from hirelens.llm import centroids as ce

SCHEMA = "cluster string, vec_id bigint, embedding array<float>, distance int, v string, id int"


def plain(rows, k, rounds, scale, dims):
    """Rounds over Python whole numbers."""
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    digest = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest())
    means = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(means))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        means = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else c for n, c in enumerate(means)]
    placed = [(i, *near(v)) for i, v in kept]
    inertia = {}
    for _, d, n in placed:
        inertia[n] = inertia.get(n, 0) + d
    return [(i, n, d, inertia[n], sum(inertia.values()), means[n]) for i, d, n in placed]


ROWS = [
    (1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (None, [3.0, 3.0]), (4, [-1.03, -2.07]), (5, [-1.0, -2.0]),
    (6, None), (7, []), (8, [1.0]), (9, [1.0, None]), (10, [float("nan"), 0.0]), (11, [float("-inf"), 0.0]), (12, [2.9, 3.1]), (13, [9.0, 0.0]),
]


@pytest.mark.parametrize("k, rounds", [(1, 1), (2, 0), (3, 3), (5, 2), (50, 2)])
def test_same_as_plain_rounds(spark, k, rounds):
    given = [("x", i, e, 1, "y", 2) for i, e in ROWS]
    made = ce.cluster_table(ce.cluster_vectors(spark.createDataFrame(given, SCHEMA), k=k, rounds=rounds, dims=2, scale=64))
    rows = [(i, [None if x is None else struct_float(x) for x in e] if e is not None else None) for i, e in ROWS]
    key = lambda r: str(r)
    assert made.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert sorted(map(tuple, made.collect()), key=key) == sorted(plain(rows, k, rounds, 64, 2), key=key)


def struct_float(x):
    import numpy as np

    return float(np.float32(x))


@pytest.mark.parametrize("rows", [[], [("x", 1, None, 1, "y", 2)]])
def test_without_vectors(spark, rows):
    made = ce.cluster_table(ce.cluster_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert made.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"] and made.count() == 0


def test_only_null_ids(spark):
    made = ce.cluster_vectors(spark.createDataFrame([(None, [1.0])], "vec_id bigint, embedding array<double>"), dims=1)
    assert made.centroids == [[64]] and made.rows.first().distance == 0


def test_beyond_exact_numbers(spark):
    with pytest.raises(ValueError, match="exact"):
        ce.cluster_vectors(spark.createDataFrame([(1, [1e9])], "vec_id bigint, embedding array<double>"), dims=1)


def test_text_ids_and_no_python_workers(spark):
    made = ce.cluster_vectors(spark.createDataFrame([("a", [1.0]), ("b", [5.0])], "vec_id string, embedding array<double>"), k=2, dims=1)
    assert sorted(r.id for r in made.rows.collect()) == ["a", "b"]
    plan = ce.cluster_table(made)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
