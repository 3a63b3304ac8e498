import re

import numpy as np
import pytest

from amberline.llm import jaccard
from amberline.llm.common import saved
from amberline.llm.graph import components
from tests.llm.helpers import ODD, by_id, clashing, docs


def token_set(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()}


def closure(ids, links):
    name = {i: i for i in ids}
    for _ in ids:
        before = dict(name)
        for a, b in links:
            name[a] = name[b] = min(name[a], name[b])
        if name == before:
            break
    return name


def brute(rows, percent=90, size=3):
    rows = [(i, token_set(t, size)) for i, t in rows if i is not None]
    links = [(a, b) for k, (a, s) in enumerate(rows) for b, t in rows[:k] if s and t and 100 * len(s & t) >= percent * len(s | t)]
    name = closure([i for i, _ in rows], links)
    return {i: (len(s), name[i]) for i, s in rows}


def corpus(seed, n=300):
    """Copies, near copies, one passage and one word pair shared by many texts, and texts of common words only."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choice(words, 25).tolist()
    base = [rng.choice(words, int(rng.integers(9, 120))).tolist() for _ in range(25)]
    out = []
    for i in range(n):
        kind = i % 6
        text = list(base[int(rng.integers(0, len(base)))])
        for _ in range(int(rng.integers(0, 4))):
            text[int(rng.integers(0, len(text)))] = f"x{int(rng.integers(0, 9))}" if kind < 4 else f"y{i}"
        if kind == 4:
            text = passage + text[:30]
        if kind == 5:
            text = ["of", "the"] * int(rng.integers(3, 30)) + text[: int(rng.integers(0, 12))]
        out.append((i, " ".join(text)))
    return out


@pytest.mark.parametrize(("seed", "percent"), [(1, 90), (2, 90), (3, 80)])
@pytest.mark.parametrize("common", [False, True])
def test_against_all_pairs(spark, monkeypatch, seed, percent, common):
    if common:  # most tokens count as frequent, so prefixes are made of combinations
        monkeypatch.setattr(jaccard, "FREQUENT", ((2, 0, 2), (3, 0, 12)))
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_similar(docs(spark, rows), percent).collect()}
    assert got == brute(rows, percent)


@pytest.mark.parametrize("common", [False, True])
def test_five_words_against_all_pairs(spark, monkeypatch, common):
    if common:
        monkeypatch.setattr(jaccard, "FREQUENT", ((2, 0, 2), (3, 0, 12)))
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = corpus(6)
    sets = [(i, token_set(t, 5)) for i, t in rows]
    links = [(a, b) for k, (a, s) in enumerate(sets) for b, t in sets[:k] if 100 * len(s & t) >= 80 * len(s | t)]
    name = closure([i for i, _ in rows], links)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_similar(docs(spark, rows), percent=80, size=5).collect()}
    assert links and got == {i: (len(s), name[i]) for i, s in sets}


def test_signatures_lose_no_pair():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 2000, jaccard.CELLS)
    for percent in (80, 90):
        signer = jaccard.Signer(counts, percent)
        signer.level = rng.integers(1, 4, jaccard.CELLS)
        for _ in range(300):
            n = int(rng.integers(5, 300))
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            b = np.delete(a, rng.choice(len(a), int(rng.integers(0, max(1, len(a) // 8))), replace=False))
            b = np.unique(np.concatenate([b, rng.integers(0, 2**64, int(rng.integers(0, max(1, n // 12))), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if both < len(a) | len(b) and 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
                assert len(np.intersect1d(signer.signatures(a), signer.signatures(b)))


def test_odd_rows(spark):
    out = jaccard.join_similar(clashing(docs(spark, ODD))).collect()
    assert len(out) == len(ODD)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None}
    assert got == brute(ODD)
    assert got[8] == (1, 7)
    assert all(r.component_id is None for r in out if r.doc_id is None)
    assert jaccard.join_similar(docs(spark, [])).count() == 0


def test_hash_of_words_matches_split(spark):
    rows = [(i, t) for i, t in enumerate(["A b\tC", "a B c", "a  b\n\x0bc ", "ab c", "a bc", "É b c", "é b c", "a b", "ab", "b a"])]
    got = by_id(jaccard.join_similar(docs(spark, rows)))
    assert {i: got[i].component_id for i, _ in rows} == {i: v[1] for i, v in brute(rows).items()}


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = closure(nodes, [x for x in links if x[0] != x[1]])
    assert got == want


def test_a_saved_step_leaves_no_shuffle(spark, tmp_path):
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    out = saved(spark.range(10_000).selectExpr("id % 100 AS k", "id").groupBy("k").count(), "counted")
    assert tracker.shuffleStatuses().size() <= before and out.count() == 100


def test_signatures_are_shuffled_once_and_hot_ones_by_key_and_node(spark):
    rows = [(i, [7, 8, 100 + i] if i % 3 else [9, 200 + i // 6], n, i % 50) for i, n in enumerate([20, 21, 22, 40] * 100)]
    signed = saved(spark.createDataFrame([(i, node, n, s) for i, s, n, node in rows], "doc_id long, node long, n_shingles long, signatures array<long>"), "signed")
    found = jaccard.meetings(signed, 90)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [signature") == 1
    assert "Join Inner, (signature" not in plan
    assert "Aggregate [signature" in plan  # the last step against repeated rows, where rows already lie by signature
    assert "Exchange hashpartitioning(signature" in found._jdf.queryExecution().executedPlan().toString()
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(signature") == 1
    plain = sorted(map(tuple, found.collect()))
    assert plain and len(plain) == len(set(plain))
    assert plain == sorted(map(tuple, jaccard.meetings(signed, 90, hot_rows=1).collect()))


def test_hot_signatures_lose_no_link(spark, monkeypatch):
    rows = corpus(5)
    real = jaccard.meetings
    monkeypatch.setattr(jaccard, "meetings", lambda signed, percent: real(signed, percent, hot_rows=1))
    monkeypatch.setattr(jaccard, "PART", 2)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_similar(docs(spark, rows)).collect()} == brute(rows)
