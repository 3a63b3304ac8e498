import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from amberline.llm import licences
from tests.llm.helpers import ODD, by_id, clashing, docs

MACHINE = licences.automaton()


def brute(text):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    places, base = [], set()
    for phrase, label in licences.BASE_PHRASES.items():
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += found
        base |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base))


PIECES = st.lists(st.sampled_from(["MIT", "License", "license", "Apache", "GNU", "General", "Public", "public license", "\n", ".", "-", "é", "licenses", "x1", "\x7f", " ", "İ"]), max_size=40)


@given(PIECES, st.sampled_from([" ", "", ", "]))
def test_base_places(pieces, between):
    text = between.join(pieces)
    assert licences.scan_text(text, MACHINE)[:5] == brute(text)


@pytest.mark.parametrize(
    ("expression", "labels", "score"),
    [
        ("MIT", {"mit"}, 1.0),
        ("MIT OR GPL-2.0-only", {"mit", "gpl"}, 1.0),
        ("MIT AND GPL-2.0-only", {"mit", "gpl"}, 0.4),
        ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl"}, 0.4),
        ("MIT OR Apache-2.0 AND GPL-3.0+", {"mit", "apache", "gpl"}, 1.0),
        ("(MIT OR Apache-2.0) AND GPL-3.0+", {"mit", "apache", "gpl"}, 0.4),
        ("(LGPL-2.1 AND (MIT OR CC-BY-NC-4.0)) or AGPL-3.0", {"lgpl", "mit", "cc-nc", "agpl"}, 0.6),
        ("LicenseRef-Own", {"licenseref-own"}, 0.5),
    ],
)
def test_expressions(expression, labels, score):
    assert licences.evaluate(expression) == (labels, score)


@pytest.mark.parametrize("expression", ["", "MIT OR", "AND MIT", "(MIT", "MIT)", "MIT GPL", "()", "MIT (GPL)"])
def test_malformed(expression):
    assert licences.evaluate(expression) is None


NAMES = ["MIT", "GPL-2.0", "Apache-2.0", "CC-BY-NC-4.0"]
TREES = st.recursive(st.sampled_from(NAMES), lambda t: st.tuples(st.sampled_from(["AND", "OR"]), t, t), max_leaves=8)


def written(tree):
    return tree if isinstance(tree, str) else f"({written(tree[1])} {tree[0]} {written(tree[2])})"


def valued(tree):
    if isinstance(tree, str):
        return licences.FREEDOM[licences.label_of(tree)]
    return (max if tree[0] == "OR" else min)(valued(tree[1]), valued(tree[2]))


@given(TREES)
def test_expressions_match_trees(tree):
    assert licences.evaluate(written(tree))[1] == valued(tree)


@pytest.mark.parametrize(
    ("line", "labels", "score"),
    [
        ("<!-- SPDX-License-Identifier: MIT -->", "mit", 1.0),
        ("<!-- SPDX-License-Identifier: LicenseRef-Own-->", "licenseref-own", 0.5),
        ("/* SPDX-License-Identifier: GPL-2.0-only OR MIT */ int x;", "gpl,mit", 1.0),
        ("The licence has SPDX-License-Identifier: Apache-2.0. This file and others", "apache", 1.0),
        ("SPDX-License-Identifier: GPL-2.0+. And more", "gpl", 0.4),
        ("(SPDX-License-Identifier: MIT) AND so on", "mit", 1.0),
        ("SPDX-License-Identifier: MIT and the rest of it", "mit", 1.0),
        ("SPDX-License-Identifier: MIT and GPL-3.0 in the rest", "gpl,mit", 0.4),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-3.0+ -- see COPYING", "apache,gpl,mit", 0.4),
        ('x = "SPDX-License-Identifier: MIT", y', "mit", 1.0),
        ('SPDX-License-Identifier: "MIT" OR "Zlib"', "mit,zlib", 1.0),
        ("SPDX-License-Identifier: MIT or Zlib", "mit,zlib", 1.0),
        ("SPDX-License-Identifier: MIT (see LICENSE)", "mit", 1.0),
        ("SPDX-License-Identifier: --", "", 0.5),
        ("SPDX-License-Identifier: AND MIT", "", 0.5),
    ],
)
def test_tags_in_comments_and_in_lines(line, labels, score):
    assert licences.scan_text(line, MACHINE)[5:] == (labels, score)


@given(TREES, st.sampled_from(["", " -->", " */", ". This file is free", ", see below", " and other terms apply"]))
def test_expressions_before_other_text(tree, rest):
    assert licences.evaluate(licences.leading(written(tree) + rest)) == licences.evaluate(written(tree))


def test_scan(spark):
    rows = [*ODD, (20, "Released under the MIT License.\n// SPDX-License-Identifier: GPL-2.0-only OR BSD-3-Clause\n"), (21, "SPDX-License-Identifier: (oops"), (22, "Licensed under CC BY-NC 4.0.")]
    out = licences.scan(clashing(docs(spark, rows)))
    assert out.count() == len(rows)
    got = by_id(out)
    for i, text in rows:
        if i is not None:
            assert tuple(got[i])[1:6] == brute(text)
    assert (got[20].base_labels, got[20].labels, got[20].score) == ("mit", "bsd,gpl,mit", 1.0)
    assert (got[21].labels, got[21].score) == ("", 0.5)
    assert (got[22].labels, got[22].score) == ("cc,cc-nc", 0.2)
    assert licences.scan(docs(spark, [])).count() == 0
