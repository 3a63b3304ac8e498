import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from amberline.llm.quality_lines import clean
from tests.llm.helpers import ODD, by_id, clashing, docs

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def check(spark, texts):
    got = by_id(clean(docs(spark, list(enumerate(texts)))))
    for i, text in enumerate(texts):
        assert tuple(got[i][f] for f in FIGURES) == brute(text), text


def test_base_figures_of_odd_texts(spark):
    check(spark, [text for _, text in ODD] + ["a b c d e " * 3, "a b c d e f a b c d e", "x\nx\n\nx \nx", "a b c d a b c d a b c d", "#*$%&|<> ok"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab \n\t#é", max_size=120), min_size=1, max_size=20))
def test_base_figures_of_any_texts(spark, texts):
    check(spark, texts)


def test_lines(spark):
    good = "This line holds a sentence that ends as it should."
    other = "Another one, of other words, follows after the menu of this page."
    texts = {
        1: "\n".join([good, "Home | News | Sport | About", other]),
        2: "Home | News | Sport | About | Contact | Jobs | Press | Help | Terms | More\n" * 4 + good,
        3: good + "\nAll rights reserved. Privacy policy.",
        4: "one two three four five six seven eight nine ten eleven twelve",
        5: good + " And one that goes on without an end",
    }
    got = by_id(clean(docs(spark, list(texts.items()))))
    assert got[1].clean_text == good + "\n" + other and got[1].kept and got[1].n_lines_removed == 1
    assert not got[2].kept and got[2].lost > 0.5
    assert got[3].clean_text == good
    assert got[4].lost == 1 and not got[4].kept
    assert got[5].kept and got[5].n_lines_removed == 0


def test_clashing_columns_ids_and_empty(spark):
    rows = [(i, t) for i, t in ODD]
    out = clean(clashing(docs(spark, rows)))
    assert len(set(out.columns)) == len(out.columns)
    assert out.count() == len(rows)
    assert out.where("doc_id IS NULL").count() == 2
    assert {r.row for r in out.collect()} == {"given row"}
    assert clean(docs(spark, [])).count() == 0


def test_native_plan(spark):
    plan = clean(docs(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_end_marks_of_other_scripts(spark):
    texts = ["यह एक साधारण वाक्य है जो बारह शब्दों से बना हुआ है।", "هل هذه جملة عادية من عشر كلمات أو أكثر في هذا النص؟", "no mark in this line of more than ten plain words at all"]
    given_docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: (r.kept, r.lost) for r in clean(given_docs).collect()} == {0: (True, 0.0), 1: (True, 0.0), 2: (False, 1.0)}
