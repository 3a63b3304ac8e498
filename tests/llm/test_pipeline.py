"""The pipeline's stages against plain Python over the same rows."""

import corpus_pipeline as pipeline
from amberline.llm import length_buckets, quality_lines, toxicity
from amberline.llm.common import table
from tests.llm.helpers import ODD, clashing, docs
from tests.llm.test_jaccard import brute
from tests.llm.test_length_buckets import check


def test_run(spark, data):
    given = table(spark, data, "documents")
    judged = {r.doc_id: r for r in quality_lines.clean(given).collect()}
    left = {i: r.clean_text for i, r in judged.items() if r.kept}
    assert 0.7 * len(judged) < len(left) < len(judged)
    model = toxicity.train(given.where(given.doc_id.isin(list(left))).drop("text").join(spark.createDataFrame(list(left.items()), "doc_id long, text string"), "doc_id"), table(spark, data, "labels"))
    score = dict(zip(left, toxicity.Scorer(model).score(list(left.values()))[0], strict=True))
    left = {i: t for i, t in left.items() if score[i] < toxicity.THRESHOLD}
    named = brute(list(left.items()), pipeline.NEAR_PERCENT, pipeline.NEAR_WORDS)
    left = {i: t for i, t in left.items() if named[i][1] == i}
    out = pipeline.run(spark, data).collect()
    got = {r.doc_id: r.length for r in out}
    # A score within rounding of the threshold may fall to either side.
    sure = {i for i in got.keys() ^ left.keys() if abs(score.get(i, 0) - toxicity.THRESHOLD) > 1e-6}
    assert not sure
    assert all(got[i] == len(left[i].split()) + 1 for i in got if i in left)
    check(out, length_buckets.BUDGET)


def test_stages_keep_columns_and_odd_rows(spark, data):
    frame = clashing(docs(spark, [*ODD, (30, "A clean sentence stands here with more than ten words in it."), (31, "A clean sentence stands here with more than ten words in it.")]))
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, frame, data)
        assert out.columns == frame.columns, name
        rows = {r.doc_id: r for r in out.collect()}
        assert 30 in rows and rows[30].row == "given row" and rows[30].kept == "given kept"
    assert pipeline.STAGES[2][1](spark, frame, data).where("doc_id IN (7, 8, 31)").count() == 1
    assert pipeline.STAGES[-1][1](spark, frame, data).count() == frame.count()
    for _, stage in pipeline.STAGES:
        assert stage(spark, frame.limit(0), data).count() == 0


def test_near_copies_of_five_words_go(spark, data):
    words = [f"w{i}" for i in range(54)]
    changed = [*words[:27], "other", *words[28:]]  # similarity 45/55 at five words, 49/55 at three
    apart = [*words[:20], "other", *words[21:40], "another", *words[41:]]  # 40/60 at five words
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(apart))]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(50)} for i, t in rows}
    assert {j for j in (2, 3) if len(sets[1] & sets[j]) >= 0.8 * len(sets[1] | sets[j])} == {2}
    assert {r.doc_id for r in pipeline.near_duplicates(spark, docs(spark, rows), data).collect()} == {1, 3}


def test_a_document_without_failing_lines_keeps_its_text(spark, data):
    given = table(spark, data, "documents")
    out = {r.doc_id: r for r in pipeline.quality(spark, given, data).collect()}
    same = {r.doc_id: r for r in given.collect()}
    clean = {r.doc_id for r in quality_lines.clean(given).where("kept AND n_lines_removed = 0").collect()}
    assert clean and all(out[i] == same[i] for i in clean)
