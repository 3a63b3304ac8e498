"""Licence scans: Aho-Corasick finds notice phrases and identifier tags; tags' expressions are parsed and evaluated."""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from amberline.llm.common import texts

# Base phrases and their labels; fixed values.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Further notice phrases and their labels.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "creative commons": "cc",
    "licensed under cc by": "cc",
    "cc by nc": "cc-nc",
    "all rights reserved": "reserved",
    "released into the public domain": "public-domain",
    "the unlicense": "public-domain",
}
TAG_WORDS = "spdx license identifier"
#: How freely text under a label may be used, from 0 to 1; a label not listed counts 0.5.
FREEDOM = {"mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "public-domain": 1.0, "cc": 0.8, "mpl": 0.7, "epl": 0.7, "lgpl": 0.6, "gpl": 0.4, "agpl": 0.3, "cc-nc": 0.2, "reserved": 0.0}
#: Beginnings of identifiers and their labels, longer ones first.
FAMILIES = (("cc-by-nc", "cc-nc"), ("cc0", "public-domain"), ("cc-", "cc"), ("unlicense", "public-domain"), ("apache", "apache"), ("mit", "mit"), ("bsd", "bsd"), ("isc", "isc"), ("mpl", "mpl"), ("epl", "epl"), ("lgpl", "lgpl"), ("agpl", "agpl"), ("gpl", "gpl"))
RANK = {"or": 1, "and": 2, "with": 3}

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_TAG = re.compile(r"(?i)spdx-license-identifier:[ \t]*([^\r\n]*)")
_PART = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")


def label_of(identifier: str) -> str:
    low = identifier.lower()
    return next((label for start, label in FAMILIES if low.startswith(start)), low)


def leading(line: str) -> str:
    """The longest beginning of a tag's line that is an expression; it ends at a comment's end, a sentence's end or prose.

    Where prose follows, a plain word after an operator in small letters is prose as well ("MIT and
    other terms"), unless it names a known licence.
    """
    parts, depth, operand, at = [], 0, True, 0
    whole = sure = 0  # parts of the longest expression, and of that without doubtful words
    doubt = prose = False
    for found in _PART.finditer(line):
        part, low = found[0], found[0].lower()
        if parts and line[at : found.start()].strip(" \t\"'`") or (low in RANK or part == ")") == operand or part == ")" and not depth:
            prose = part not in "()"
            break
        at = found.start() + len(part)
        if part in "()":
            depth += 1 if part == "(" else -1
        elif low in RANK:
            operand = True
        else:
            part = part.rstrip(".:-")
            at = found.start() + len(part)  # what was cut off ends the expression
            doubt |= bool(parts) and parts[-1] in RANK and part.isalpha() and label_of(part) not in FREEDOM
            operand = False
        parts.append(part)
        if not operand and not depth:
            whole = len(parts)
            sure = sure if doubt else whole
    return " ".join(parts[: sure if prose else whole])


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard; None if the expression is malformed. ``with`` binds most, then ``and``, then ``or``."""
    out, stack, operand = [], [], True
    for part in _PART.findall(expression):
        low = part.lower()
        if low in RANK:
            if operand:
                return None
            while stack and stack[-1] != "(" and RANK[stack[-1]] >= RANK[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = True
        elif part == "(":
            if not operand:
                return None
            stack.append(part)
        elif part == ")":
            if operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        else:
            if not operand:
                return None
            out.append(part)
            operand = False
    while stack:
        if stack[-1] == "(":
            return None
        out.append(stack.pop())
    return None if operand else out


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """Labels of an expression and its freedom: of an ``or`` the freer side, of an ``and`` the stricter, ``with`` keeps its licence's."""
    postfix = to_postfix(expression)
    if postfix is None:
        return None
    stack: list[tuple[set[str], float]] = []
    for part in postfix:
        if part in RANK:
            (right, b), (left, a) = stack.pop(), stack.pop()
            stack.append((left, a) if part == "with" else (left | right, max(a, b) if part == "or" else min(a, b)))
        else:
            label = label_of(part)
            stack.append(({label}, FREEDOM.get(label, 0.5)))
    return stack[0]


def automaton():
    """Patterns between single spaces, over bytes seen as Latin-1 text."""
    found = ahocorasick.Automaton()
    for phrase in {**BASE_PHRASES, **NOTICE_PHRASES, TAG_WORDS: ""}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan_text(text: str, machine) -> tuple:
    """``n_words, n_base, first_word, last_word, base_labels, labels, score`` of one text."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split(b" ")
    words = [w for w in words if w]
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts, base, labels, tagged = [], set(), set(), False
    for end, phrase in machine.iter(line):
        if phrase in BASE_PHRASES:
            starts.append(end - len(phrase) - 1)
            base.add(BASE_PHRASES[phrase])
        elif phrase == TAG_WORDS:
            tagged = True
        else:
            labels.add(NOTICE_PHRASES[phrase])
    free = [FREEDOM[x] for x in base | labels]
    for expression in _TAG.findall(text) if tagged else ():
        if (value := evaluate(leading(expression))) is not None:
            labels |= value[0]
            free.append(value[1])
    first = line.count(" ", 0, min(starts)) if starts else None
    last = line.count(" ", 0, max(starts)) if starts else None
    return len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), min(free, default=0.5)


def scan(docs: DataFrame) -> DataFrame:
    """Scan every text of ``docs`` (``doc_id, text``).

    ``score`` is the freedom of the strictest licence found, 0.5 without one; see ``FREEDOM``. Of the
    line after a tag the longest beginning that is an expression counts; without any it gives no label. A null text counts as empty: no words, empty
    labels. Null ids and repeated rows pass through; an empty table gives an empty result.
    """
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches):
        machine = automaton()
        for batch in batches:
            rows = [scan_text(text, machine) for text in texts(batch.column(1))]
            found = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(found, kinds, strict=True))], ["doc_id", *names])

    shape = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.select("doc_id", "text").mapInArrow(run, shape)
