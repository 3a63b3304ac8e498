"""Packing into optimal length buckets.

One pass makes the global histogram of lengths. Dynamic programming over it picks the bucket
boundaries with the least padding. Inside each bucket documents form batches that hold no more
than a budget of tokens once padded to the bucket's boundary.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amberline.llm.common import WHITE, saved

BUCKETS = 16
BUDGET = 65_536
#: Lengths up to EXACT have a histogram cell each, longer ones share cells of 1/512 of their size, so cells are few at any input.
EXACT = 2048
FINE_BITS = 10
SLOTS = 256


def word_count(text: Column) -> Column:
    """Words of a text and the end mark; a null text has only the mark."""
    return (F.size(F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")) + 1).cast("long")


def cell(length: Column) -> Column:
    """The upper end of a length's histogram cell."""
    grain = F.pow(F.lit(2), F.greatest(F.floor(F.log2(F.greatest(length, F.lit(1)))) - FINE_BITS + 1, F.lit(0))).cast("long")
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / grain).cast("long") * grain)


def boundaries(ends: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bucket ends, chosen of ``ends`` (ascending), with the least padded total."""
    n = len(ends)
    if not n:
        return []
    total = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    best = ends * total[1:]  # one bucket for the cells up to each
    cuts = [np.zeros(n, np.int64)]
    for _ in range(min(buckets, n) - 1):
        now, cut = np.empty(n, np.int64), np.empty(n, np.int64)
        before = np.concatenate([[0], best])
        for j in range(n):
            cost = before[: j + 1] + ends[j] * (total[j + 1] - total[: j + 1])
            cut[j] = cost.argmin()
            now[j] = cost[cut[j]]
        best = now
        cuts.append(cut)
    out, j = [], n - 1
    for cut in reversed(cuts):
        if j < 0:
            break
        out.append(int(ends[j]))
        j = int(cut[j]) - 1
    return out[::-1]


def histogram(lengths: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cell ends and counts; the number of cells grows with the logarithm of the longest length only."""
    rows = lengths.groupBy(cell(F.col("length")).alias("end")).agg(F.count("*").alias("n")).collect()
    rows = sorted((r.end, r.n) for r in rows)
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, length: Column | None = None) -> DataFrame:
    """Give every row its bucket, batch and place.

    Returns ``doc_id, length, bucket`` (from 0, by ascending boundary), ``boundary, batch`` (from 0
    within the bucket), ``place`` (from 0 within the batch) and ``padding``. A batch holds
    ``budget // boundary`` rows, at least one: a document longer than the budget is a batch of its
    own. Rows with a null ``doc_id`` are packed like others; equal rows get places of their own.
    An empty table gives an empty result.

    A place in a bucket is counted without gathering the bucket: rows fall into slots by a hash,
    are numbered within (bucket, slot), and add the rows of the slots before, of which there are
    at most ``buckets * SLOTS``.
    """
    measure = word_count(F.col("text")) if length is None else length.cast("long")
    lengths = saved(docs.select("doc_id", measure.alias("length"), F.xxhash64("doc_id", "text").alias("spread")), "lengths")
    ends = boundaries(*histogram(lengths), buckets)
    edges = F.array(*(F.lit(e).cast("long") for e in ends)) if ends else F.array().cast("array<long>")
    at = F.size(F.filter(edges, lambda e: e < F.col("length")))
    rows = lengths.withColumn("bucket", at.cast("int")).withColumn("boundary", F.get(edges, F.col("bucket")))
    rows = rows.withColumn("slot", F.pmod("spread", F.lit(SLOTS)).cast("int"))
    sizes = rows.groupBy("bucket", "slot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("bucket", "slot").orderBy("spread", "doc_id")
    rows = rows.withColumn("rank", F.row_number().over(within) - 1).join(F.broadcast(sizes), ["bucket", "slot"])
    number, room = F.col("rank") + F.col("before"), F.greatest(F.floor(F.lit(budget) / F.col("boundary")), F.lit(1))
    return rows.select(
        "doc_id",
        "length",
        "bucket",
        "boundary",
        F.floor(number / room).cast("long").alias("batch"),
        F.pmod(number, room).cast("long").alias("place"),
        (F.col("boundary") - F.col("length")).alias("padding"),
    )
