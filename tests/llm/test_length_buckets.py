import itertools
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from amberline.llm import length_buckets as packing
from amberline.llm.common import table
from tests.llm.helpers import ODD, clashing, docs


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_optimal(seed):
    rng = np.random.default_rng(seed)
    ends = np.unique(rng.integers(1, 60, 9))
    counts = rng.integers(1, 9, len(ends))
    for buckets in (1, 2, 3, 20):
        got = packing.boundaries(ends, counts, buckets)

        def padded(chosen):
            return sum(min(b for b in chosen if b >= e) * c for e, c in zip(ends, counts, strict=True))

        best = min(padded((*some, ends[-1])) for k in range(min(buckets, len(ends))) for some in itertools.combinations(ends[:-1].tolist(), k))
        assert padded(got) == best and len(got) <= buckets and got == sorted(got)
    assert packing.boundaries(ends[:0], counts[:0], 4) == []


def check(out, budget):
    batches = defaultdict(list)
    for r in out:
        assert r.length <= r.boundary and r.padding == r.boundary - r.length
        batches[r.bucket, r.batch].append(r)
    room = {}
    for (bucket, batch), rows in batches.items():
        assert len({r.boundary for r in rows}) == 1
        room[bucket] = max(1, budget // rows[0].boundary)
        assert sorted(r.place for r in rows) == list(range(len(rows)))
        assert len(rows) <= room[bucket]
    for bucket, n in room.items():
        numbers = sorted(b for k, b in batches if k == bucket)
        assert numbers == list(range(len(numbers)))
        assert all(len(batches[bucket, b]) == n for b in numbers[:-1])


def test_table(spark, data):
    frame = table(spark, data, "documents")
    out = packing.pack(frame, buckets=5, budget=4096).collect()
    lengths = {r.doc_id: len(r.text.split()) + 1 for r in frame.collect()}
    assert {r.doc_id: r.length for r in out} == lengths
    check(out, 4096)
    ends, counts = np.unique(list(lengths.values()), return_counts=True)
    cells = np.array([r.c for r in frame.sparkSession.createDataFrame([(int(e),) for e in ends], "e long").select(packing.cell(F.col("e")).alias("c")).collect()])
    assert (cells >= ends).all() and ((cells - ends) * 512 <= ends).all()
    merged = {int(c): 0 for c in cells}
    for c, n in zip(cells.tolist(), counts.tolist(), strict=True):
        merged[c] += n
    want = packing.boundaries(np.array(sorted(merged)), np.array([merged[c] for c in sorted(merged)]), 5)
    assert sorted({r.boundary for r in out}) == want


def test_odd_rows(spark):
    out = packing.pack(clashing(docs(spark, ODD)), budget=100).collect()
    assert len(out) == len(ODD)
    check(out, 100)
    assert {r.length for r in out if r.doc_id in (1, 2, 3)} == {1}
    assert next(r.length for r in out if r.doc_id == 5) == 60_001
    assert packing.pack(docs(spark, [])).count() == 0


def test_own_length(spark):
    out = packing.pack(docs(spark, [(1, "abc"), (2, "abcdef")]), length=F.col("n_chars")).collect()
    assert {r.doc_id: r.length for r in out} == {1: 3, 2: 6}
