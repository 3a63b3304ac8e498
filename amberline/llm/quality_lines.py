"""Line-first cleaning with DataFrame functions only.

Every line is judged by itself: as navigation (separators between few words), as boilerplate
(fixed phrases of notices and menus) or as lacking punctuation (no sentence mark at all). Failing
lines are removed; a document that loses too much of its text is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amberline.llm.common import WHITE

WINDOW = 5
MAX_LOST = 0.5
#: One separator for so many words, or more, is navigation.
WORDS_PER_SEPARATOR = 4
SEPARATORS = "[^|»›•·]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
# Fixed set: marks that end sentences, of Latin, Chinese, Arabic, Indic, Armenian, Ethiopic, Burmese and Khmer script.
SENTENCE_MARK = r"[.!?…。！？｡．؟۔।॥։።፧။។៕][\"'”’»)\]*%&#$!.]*([\x20\x09-\x0D]|$)"
# Fixed phrases of menus, notices and forms, in lower case.
BOILERPLATE = (
    "all rights reserved|privacy policy|terms of (use|service)|cookie policy|use of cookies|accept cookies|"
    "enable javascript|javascript is disabled|sign in to|log in to|create an account|subscribe to our|"
    "click here|read more|skip to (main )?content|back to top|share this|follow us|lorem ipsum"
)


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, however often ``then`` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def repeated_words(words: Column) -> Column:
    """Words in ``WINDOW``-word windows that are found twice or more in the text.

    Window hashes tell texts without any repeat; only others compare the windows themselves.
    """
    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + (k - 1)) for k in range(WINDOW)))),
    )
    windows = F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("i")))

    def covered(ordered: Column) -> Column:
        again = F.filter(
            ordered, lambda x, k: (F.get(ordered, k - 1)["w"] == x["w"]) | (F.get(ordered, k + 1)["w"] == x["w"])
        )
        places = F.array_sort(F.transform(again, lambda x: x["i"]))
        start = F.struct(F.lit(1 - WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    distinct = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when((F.size(words) <= WINDOW) | distinct, F.lit(0).cast("long")).otherwise(let(F.array_sort(windows), covered))


def line_fails(line: Column) -> Column:
    """Whether a line with a word is navigation, boilerplate or without any sentence mark."""
    words = F.size(F.split(F.trim(line), WHITE))
    navigation = F.length(F.regexp_replace(line, SEPARATORS, "")) * WORDS_PER_SEPARATOR >= words
    separated = line.rlike("[|»›•·]")
    boilerplate = F.lower(line).rlike(BOILERPLATE) & (words <= 25)
    return (separated & navigation) | boilerplate | ~line.rlike(SENTENCE_MARK)


def judged(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``) and the figures of each document; see ``clean``."""
    text = F.coalesce("row.text", F.lit(""))
    out = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row")).withColumn("body", text)
    out = out.withColumns(
        {
            "words": F.filter(F.split("body", WHITE), lambda w: w != ""),
            "lines": F.filter(F.split("body", "\n"), lambda x: x.rlike(HAS_WORD)),
            "good": F.filter(F.split("body", "\n"), lambda x: ~x.rlike(HAS_WORD) | ~line_fails(x)),
        }
    )
    figures = F.struct(
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("body", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.array_join("good", "\n").alias("clean_text"),
        (F.size(F.split("body", "\n")) - F.size("good")).cast("long").alias("n_lines_removed"),
    )
    # A generator, as filters on the figures do not pass it: they would compute all again, and the words for each window.
    out = out.select("row", F.inline(F.array(figures)))
    left = F.length(F.regexp_replace("clean_text", WHITE, ""))
    return out.withColumns(
        {
            "lost": F.when(F.col("word_chars") == 0, F.lit(0.0)).otherwise(1 - left / F.col("word_chars")),
            "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        }
    )


def clean(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """Add the base figures, ``clean_text``, ``n_lines_removed``, ``lost`` and ``kept`` to ``docs`` (``doc_id, text``).

    ``lost`` is the share of word characters in removed lines; a document that loses more than
    ``max_lost``, or fails the base figures, is not ``kept``. A null text counts as empty; a text
    without words fails by its length. Lines without a word are neither judged nor removed. Columns
    of ``docs`` that are named like a figure give way to it. Equal rows get equal results; an empty
    table gives an empty result.
    """
    out = judged(docs).withColumn("kept", verdict(max_lost))
    figures = [c for c in out.columns if c != "row"]
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in figures), *figures)


def verdict(max_lost: float = MAX_LOST) -> Column:
    return ~F.col("base_failed") & (F.col("lost") <= max_lost)
