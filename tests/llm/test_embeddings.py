import math

import numpy as np
import pytest

from amberline.llm import embeddings
from tests.llm.test_jaccard import closure

SHAPE = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SHAPE).coalesce(2)


def brute(rows):
    units = {}
    for i, v in rows:
        if v and None not in v and all(map(math.isfinite, v)) and any(v):
            x = np.array(v, np.float32).astype(np.float64)
            units[i] = x / np.sqrt(x @ x)
    links = [(a, b) for a in units for b in units if a < b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.95]
    name = closure([i for i, _ in rows], links)
    return {i: (sum(i in pair for pair in links), name[i], name[i] == i) for i, _ in rows}


def clustered(seed, n, dim, noise):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = [(i, (centres[i % 12 if i % 3 else 0] + noise * rng.normal(size=dim)).tolist()) for i in range(n)]
    return rows + [(n + i, rng.normal(size=dim).tolist()) for i in range(60)]


@pytest.mark.parametrize(("dim", "noise"), [(64, 0.1), (64, 0.15), (48, 0.12), (5, 0.05)])
def test_recall_and_precision(spark, monkeypatch, dim, noise):
    monkeypatch.setattr(embeddings, "BLOCK", 32)
    rows = clustered(dim, 240, dim, noise)
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame(spark, rows)).collect()}
    found, there = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert there > 0 and all(got[i][0] <= want[i][0] for i in want)
    assert found >= 0.98 * there


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0, 0]), (4, [1, None]), (5, [nan, 1]), (6, [inf, 1]), (7, [1, 2]), (8, [1, 2]), (9, [3, 6]), (10, [2, -1]), (11, [1, 2, 0]), (12, [1e-30, 2e-30]), (13, [1])]
    out = embeddings.near_duplicates(frame(spark, [*rows, (None, [1, 2]), (8, [1, 2])]).selectExpr("*", "'x' AS unit", "'x' AS rep", "'x' AS buckets")).collect()
    assert len(out) == len(rows) + 2
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out if r.vec_id is not None}
    want = brute(rows)
    linked = {7, 8, 9, 12}
    assert {i for i in got if got[i][0]} == linked
    assert all(got[i] == (4, 7, i == 7) for i in linked)  # the repeated row counts as one more
    assert all(got[i] == want[i] for i in got if i not in linked)
    assert [(r.n_links, r.component_id, r.kept) for r in out if r.vec_id is None] == [(0, None, None)]


def test_empty(spark):
    assert embeddings.near_duplicates(frame(spark, [])).count() == 0
    assert embeddings.near_duplicates(frame(spark, [(1, None)])).collect()[0].n_links == 0


def test_rotation_keeps_length():
    x = np.random.default_rng(0).normal(size=(3, 64))
    assert np.allclose(np.linalg.norm(embeddings.hadamard(x), axis=1), 8 * np.linalg.norm(x, axis=1))
