"""Exact top-k search against all pairs in plain Python."""

import itertools
import math
import random

import numpy as np
import pytest

from amberline.llm import block_search
from amberline.llm.block_search import Blocks, packed, top_k, unpacked
from tests.llm.helpers import clashing

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50, scale=256.0):
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (query_id, q) in enumerate(whole):
        if query_id is None or query_id % every:
            continue
        scores = [(-sum(x * y for x, y in itertools.zip_longest(q, v, fillvalue=0)), i is None, i or 0, i) for b, (i, v) in enumerate(whole) if a != b]
        out += [(query_id, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def got(frame):
    assert frame.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def exact(rows):
    """Values that survive the way through a float column."""
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("group,chunk", [(4096, 256), (70, 2)])
def test_table_equals_all_pairs(spark, data, monkeypatch, group, chunk):
    monkeypatch.setattr(block_search, "GROUP", group)
    monkeypatch.setattr(block_search, "CHUNK", chunk)
    given = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in given.select("vec_id", "embedding").collect()]
    assert got(top_k(clashing(given))) == brute(rows)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [0.5, -0.25]),
        (50, [0.5, -0.25]),
        (1, [0.5, -0.25]),
        (1, [0.5, -0.25]),
        (2, None),
        (3, [None, 1.0]),
        (4, [nan, 1.0]),
        (100, [inf, 1.0]),
        (5, []),
        (150, []),
        (6, [-0.001]),
        (7, [1.0, 1.0, -1.0]),
        (200, [1.0, 1.0, -1.0]),
        (-50, [0.0, 0.0]),
        (None, [0.5, -0.25]),
        (None, None),
        (200, [1.0, 1.0, -1.0]),
    ]
    for k in (1, 3, 30):
        assert got(top_k(clashing(spark.createDataFrame(rows, VECTORS)), k=k)) == brute(exact(rows), k)
    assert got(top_k(spark.createDataFrame([], VECTORS))) == []
    assert got(top_k(spark.createDataFrame([(50, [1.0])], VECTORS))) == []


def test_large_components_stay_exact(spark):
    rows = [(50 * i, [float(2**40 + 3 * i), float(-(2**39) + i), 1.0 / 256]) for i in range(6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(top_k(frame, scale=1.0 / 2**20)) == brute(rows, scale=1.0 / 2**20)
    wide = brute(rows)
    clipped = [(a, b, s) for a, b, _, s in got(top_k(frame))]
    assert {s for *_, s in clipped} == {2**63 - 1} and min(s for *_, s in wide) > 2**63
    middle = [(50 * i, [float(2**21 + i), float(2**20 - i)]) for i in range(6)]
    frame = spark.createDataFrame(middle, "vec_id long, embedding array<double>")
    assert max(s for *_, s in brute(middle)) > 2**53
    assert got(top_k(frame)) == brute(middle)


def test_copies_by_the_hundred_and_ties(spark):
    chance = random.Random(3)
    rows = [(i, [0.25, 0.5, -0.5, 0.125]) for i in range(400)] + [(i, [chance.choice((-0.5, 0.0, 0.5)) for _ in range(4)]) for i in range(400, 700)]
    chance.shuffle(rows)
    assert got(top_k(spark.createDataFrame(rows, VECTORS))) == brute(rows)


def test_blocks_below_the_kth_score_are_not_scored():
    random_ = np.random.default_rng(5)
    centres = random_.normal(size=(32, 16)) * 60
    matrix = np.floor(np.repeat(centres, 64, 0) + random_.normal(size=(2048, 16)) * 4)
    ids, blocks = np.arange(2048), Blocks(matrix)
    for own in (3, 700, 2047):
        places, scores = blocks.search(matrix[own], blocks.bounds(matrix[own : own + 1])[0], -np.inf, 5, ids, own)
        all_scores = matrix @ matrix[own]
        want = [i for i in np.lexsort((ids, -all_scores)) if i != own][:5]
        assert places.tolist() == want and scores.tolist() == all_scores[want].tolist()
    assert blocks.scored < 0.25 * 3 * 2048


def test_packed_round_trip():
    for top in (3, 40_000, 2.0**40):
        matrix = np.floor(np.random.default_rng(1).uniform(-top, top, (7, 5)))
        assert (unpacked(packed(matrix), 5) == matrix).all()
