import math

import numpy as np
import pytest

from hirelens.llm import embedding_dedup as ed
from test_simhash import plain_components

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, n string, root int, vector string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", 1, "z") for i, v, label in rows], SCHEMA)


def usable(v, label):
    return label is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def plain(rows, threshold):
    """``{id: (links, component)}`` from all pairs."""
    nodes = {i: (np.array(v, np.float32).astype(float), label) if usable(v, label) else None for i, v, label in rows}

    def linked(a, b):
        if a is None or b is None or a[1] != b[1] or len(a[0]) != len(b[0]):
            return False
        return float(a[0] @ b[0]) / (np.linalg.norm(a[0]) * np.linalg.norm(b[0])) >= threshold

    roots = plain_components(nodes, linked)
    return {i: (sum(j != i and linked(nodes[i], nodes[j]) for j in nodes), roots[i]) for i in nodes}


def clustered(n, size, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(max(1, n // 8), size))
    return [(int(i), (centres[r.integers(len(centres))] + r.normal(size=size) * r.choice([0, 0.1, 0.3])).tolist(),
             int(r.integers(3)) if i % 11 else None) for i in range(n)]


@pytest.mark.parametrize("size,block,threshold", [(64, 2048, 0.93), (64, 13, 0.93), (20, 30, 0.8), (3, 40, 0.99)])
def test_same_as_all_pairs(spark, size, block, threshold):
    rows = clustered(250, size, size + block)
    got = ed.embedding_groups(table(spark, rows), threshold, block=block).collect()
    want = plain(rows, threshold)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want and any(n for n, _ in want.values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_tile_edges_are_a_forest(monkeypatch):
    monkeypatch.setattr(ed, "SUB", 16)
    rows = np.array([v for _, v, _ in clustered(100, 8, 4)])
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    ids = np.arange(100) * 10
    counts, edges = ed.tile_links(ids, None, unit, unit, np.eye(8), 0.9)
    near = unit @ unit.T >= 0.9
    assert counts == {int(ids[i]): int(near[i].sum()) - 1 for i in range(100) if near[i].sum() > 1}
    assert len(edges) < 100 and all(near[a // 10, b // 10] for a, b in edges)
    counts, edges = ed.tile_links(ids[:60], ids[60:], unit[:60], unit[60:], np.eye(8), 0.9)
    assert sum(counts.values()) == 2 * near[:60, 60:].sum()


def test_many_equal_vectors_stay_linear():
    unit = np.tile(np.eye(16)[:1], (1500, 1))
    counts, edges = ed.tile_links(np.arange(1500), None, unit, unit, np.eye(16), 0.93)
    assert set(counts.values()) == {1499} and len(edges) == 1499


def test_odd_rows(spark):
    v, w = [1.0, 2.0, 3.0], [3.0, -2.0, 0.5]
    rows = [(1, v, 0), (2, [2.0, 4.0, 6.0], 0), (3, v, None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0, 0.0], 0),
            (7, [1.0, None, 3.0], 0), (8, [1.0, float("nan"), 3.0], 0), (9, [1.0, float("inf"), 3.0], 0), (10, v, 1),
            (None, v, 0), (11, w, 0), (11, w, 0), (12, v[:2], 0), (13, [1e-30, 2e-30, 3e-30], 0), (14, [1e30, 2e30, 3e30], 0)]
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.embedding_groups(table(spark, rows)).collect()]
    linked = [(i, 3, 1, i == 1) for i in (1, 2, 13, 14)]
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 11, 12)]
    assert sorted(got, key=str) == sorted(linked + alone + [(None, 0, None, False)], key=str)
    empty = ed.embedding_groups(table(spark, rows).limit(0))
    assert empty.columns == ["vec_id", "n_links", "component_id", "kept"] and empty.count() == 0
    with pytest.raises(ValueError):
        ed.embedding_groups(table(spark, rows), threshold=0.0)
