import itertools
import zlib

import numpy as np

from amberline.llm import toxicity
from amberline.llm.common import table
from tests.llm.helpers import ODD, clashing, docs


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    transition = rng.normal(size=(2, 2))
    lengths = np.array([3, 0, 5, 1, 5])
    emission = rng.normal(size=int(lengths.sum()))
    got, at = toxicity.marginals(emission, lengths, transition), 0
    for n in lengths.tolist():
        e, want, norm = emission[at : at + n], np.zeros(n), 0.0
        for path in itertools.product((0, 1), repeat=n) if n else ():
            weight = np.exp(sum(e[i] * y for i, y in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:], strict=False)))
            norm += weight
            want += weight * np.array(path)
        assert np.allclose(got[at : at + n], want / norm if n else want)
        at += n


def test_gradient_matches_differences():
    rng = np.random.default_rng(2)
    e, labels, transition = rng.normal(size=(2, 4)), np.array([[0, 1, 1, 0], [1, 0, 0, 0]]), rng.normal(size=(2, 2))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)

    def likelihood(e, transition):
        total = 0.0
        for row, tags, live in zip(e, labels, mask, strict=True):
            n = int(live.sum())
            score = lambda y: sum(row[i] * y[i] for i in range(n)) + sum(transition[a, b] for a, b in zip(y[:n], y[1:n], strict=False))  # noqa: B023, E731
            total += score(tags) - np.log(sum(np.exp(score(y)) for y in itertools.product((0, 1), repeat=n)))
        return total

    ge, gt = toxicity._chunk_gradient(e, labels, mask, transition)
    for got, base, index in ((ge, e, (0, 1)), (ge, e, (1, 1)), (gt, transition, (0, 1)), (gt, transition, (1, 0))):
        step = np.zeros_like(base)
        step[index] = 1e-5
        up = likelihood(e + step, transition) if base is e else likelihood(e, transition + step)
        down = likelihood(e - step, transition) if base is e else likelihood(e, transition - step)
        assert abs((up - down) / 2e-5 - got[index]) < 1e-4


def test_held_out_accuracy(spark, data):
    big = data.replace("sf0.01", "sf0.1")
    labels = table(spark, big, "labels")
    rows = toxicity.score_documents(table(spark, big, "documents"), labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    hit = sum(r.toxic and r.predicted for r in rows)
    assert hit / sum(r.predicted for r in rows) > 0.8 and hit / sum(r.toxic for r in rows) > 0.75
    assert all(0 <= r.score <= 1 for r in rows)


def labelled(spark):
    words = [a + b + c for a in "stone river cloud window table".split() for b in "garden street morning path".split() for c in ("", "s", "er")]
    rng = np.random.default_rng(3)
    texts = []
    for i in range(400):
        text = list(rng.choice(words, 30))
        if i % 4 == 0:
            text[rng.integers(0, 30)] = str(rng.choice(["blarghoid", "blarghen", "blarghs"]))
        texts.append((i, " ".join(text)))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in texts] + [(None, 1), (3, None)], "doc_id long, toxic int")
    return texts, labels


def test_spans_new_endings_and_odd_rows(spark):
    texts, labels = labelled(spark)
    fresh = "The rivergarden\nBLARGHERS cloudpath."
    rows = texts + [(1000, fresh)] + [(i and i + 2000, t) for i, t in ODD]
    out = toxicity.score_documents(clashing(docs(spark, rows)), labels).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert got[1000].predicted == 1
    assert [fresh[s.start : s.stop] for s in got[1000].spans] == ["BLARGHERS"]
    assert got[2001].score == got[2002].score < 0.3
    assert {r.held_out for r in out if r.doc_id is None} == {False}


def test_without_labels_or_rows(spark):
    texts, labels = labelled(spark)
    same = toxicity.score_documents(docs(spark, texts[:20]), labels.limit(0)).select("score").distinct()
    assert same.count() == 1
    assert toxicity.score_documents(docs(spark, []), labels).count() == 0
