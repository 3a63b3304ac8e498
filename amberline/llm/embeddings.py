"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, with multiprobe.

A hash of a vector is the axis (with sign) nearest to it after a pseudo-random rotation, made of
three rounds of random signs and a Walsh-Hadamard transform. A table's bucket is k such hashes.
Every vector goes to its own bucket and, in turn, to those where one hash takes its second-nearest
axis. Pairs that share a bucket are compared in double precision.

k grows with the logarithm of the number of vectors, so that buckets stay small, and the number of
tables grows with k, so that the chance to miss a pair at the threshold stays below ``MISS``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amberline.llm.common import saved
from amberline.llm.graph import components
from amberline.llm.jaccard import forest
from amberline.llm.words import mix

SEED = 20_24
MISS = 0.005
#: Chance that two vectors of cosine 0.95 share one hash, both with a second choice; measured at 64 to 256 dimensions.
MEET = 0.75
BUCKET = 8
BLOCK = 512
CHUNK = 4096


def hadamard(x: np.ndarray) -> np.ndarray:
    n, width, half = *x.shape, 1
    while half < width:
        pairs = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, width)
        half *= 2
    return x


def plan(n: int, width: int) -> tuple[int, int]:
    """Hashes per table and number of tables for n vectors of a padded width."""
    k = max(1, math.ceil(math.log(max(n, 2) / BUCKET) / math.log(2 * width)))
    return k, math.ceil(math.log(MISS) / math.log(1 - MEET**k))


def bucket_keys(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """Buckets of each unit vector, one row each: per table its own one and k probes."""
    n, dim = unit.shape
    width = 1 << max(0, dim - 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :dim] = unit
    signs = np.random.default_rng([SEED, dim])
    out = []
    for table in range(tables):
        first, second = [], []
        for _ in range(k):
            x = padded
            for _ in range(3):
                x = hadamard(x * signs.choice([-1.0, 1.0], width))
            size, at = np.abs(x), np.arange(n)
            a = size.argmax(1)
            first.append(2 * a + (x[at, a] > 0))
            size[at, a] = -1
            b = size.argmax(1)
            second.append(2 * b + (x[at, b] > 0))
        for probe in range(-1, k):
            key = np.full(n, (dim << 20) + table, np.uint64)
            for i in range(k):
                key = mix(key * np.uint64(2 * width + 1) + (second if i == probe else first)[i].astype(np.uint64))
            out.append(key)
    return np.stack(out, 1).view(np.int64)


def units(values: list) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for those without a direction."""
    out = []
    for value in values:
        if not value or None in value:
            out.append(None)
            continue
        x = np.array(value, np.float64)
        top = np.abs(x).max()
        if not np.isfinite(top) or top == 0:
            out.append(None)
            continue
        x = x / top
        out.append(x / np.sqrt(x @ x))
    return out


def _prepared(vectors: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = units(batch.column(1).to_pylist())
            data = [None if x is None else x.tobytes() for x in found]
            keys = [None if x is None else hashlib.blake2b(x, digest_size=16).digest() for x in data]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(data, pa.binary())], ["vec_id", "vector_key", "unit"])

    return vectors.select("vec_id", F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, vector_key binary, unit binary")


def _keyed(classes: DataFrame, k: int, tables: int) -> DataFrame:
    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(low, CHUNK)
                data = batch.column(0).to_pylist()
                keys: list = [None] * len(data)
                for size in set(map(len, data)):
                    rows = [i for i, x in enumerate(data) if len(x) == size]
                    found = bucket_keys(np.stack([np.frombuffer(data[i]) for i in rows]), k, tables)
                    for i, row in zip(rows, found, strict=True):
                        keys[i] = row
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))], ["unit", "vector_key", "rep", "weight", "buckets"])

    return classes.select("unit", "vector_key", "rep", "weight").mapInArrow(run, "unit binary, vector_key binary, rep long, weight long, buckets array<long>")


def _compare(cosine: float):
    """Links within each pair of blocks: per vector the weight of those it links with, and its component there."""
    shape = pa.schema([("vector_key", pa.binary()), ("rep", pa.int64()), ("added", pa.int64()), ("root", pa.int64())])

    def links(place, rows):
        bucket, a, b = place
        keys, reps, weights, data, owns, all_buckets = zip(*rows, strict=True)
        if len(rows) < 2:
            return
        unit = np.stack([np.frombuffer(x) for x in data])
        own, buckets = np.array(owns), np.array(all_buckets)
        linked = unit @ unit.T >= cosine
        np.fill_diagonal(linked, False)
        if a != b:  # pairs within one block are compared elsewhere
            linked &= own[:, None] != own[None, :]
        i, j = np.nonzero(np.triu(linked))
        # A pair counts where its smallest common bucket is this one.
        for low in range(0, len(i), CHUNK):
            x, y = buckets[i[low : low + CHUNK]], buckets[j[low : low + CHUNK]]
            earlier = ((x[:, :, None] == y[:, None, :]) & (x[:, :, None] < bucket)).any((1, 2))
            u, v = i[low : low + CHUNK][earlier], j[low : low + CHUNK][earlier]
            linked[u, v] = linked[v, u] = False
        added, root = linked @ np.array(weights, np.int64), forest(linked)
        for r in np.flatnonzero(added).tolist():
            yield keys[r], reps[r], int(added[r]), reps[root[r]]

    def run(batches):
        now, rows, found = None, [], []
        for batch in batches:
            for bucket, a, b, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, a, b) != now:
                    if now:
                        found += links(now, rows)
                    now, rows = (bucket, a, b), []
                rows.append(row)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found, strict=True), shape, strict=True)], schema=shape)
                found = []
        if now:
            found += links(now, rows)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found, strict=True), shape, strict=True)], schema=shape)

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """Link vectors whose cosine is ``cosine`` or more.

    Returns one row per row of ``vectors`` (``vec_id, embedding``, others are ignored): ``vec_id,
    n_links`` (other rows linked directly), ``component_id`` (smallest id reachable) and ``kept``
    (whether the row is that one). Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do rows with a null id, whose component and ``kept`` are
    null. Vectors of different length never link. Rows with equal vectors are one class that
    counts with its number of rows; repeated rows count as often as they stand there.
    """
    prepared = saved(_prepared(vectors), "vectors")
    usable = prepared.where("vec_id IS NOT NULL AND unit IS NOT NULL")
    classes = usable.groupBy("vector_key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.any_value("unit").alias("unit"))
    size = classes.agg(F.count("*"), F.max(F.length("unit"))).first()
    k, tables = plan(size[0], 1 << max(0, (size[1] or 8) // 8 - 1).bit_length())
    keyed = saved(_keyed(classes, k, tables), "buckets")
    rows = keyed.select("vector_key", F.explode(F.array_distinct("buckets")).alias("bucket"))
    often = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(often, "bucket").withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("vector_key", F.lit(1)), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("vector_key", "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own")
    grouped = rows.join(keyed, "vector_key").select("bucket", "a", "b", "vector_key", "rep", "weight", "unit", "own", "buckets")
    grouped = grouped.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")
    found = saved(grouped.mapInArrow(_compare(cosine), "vector_key binary, rep long, added long, root long"), "vector-links")
    equal = classes.where("weight > 1").select("vector_key", "rep", (F.col("weight") - 1).alias("added"), F.col("rep").alias("root"))
    counts = found.unionByName(equal).groupBy("vector_key").agg(F.sum("added").alias("n_links"))
    links = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    named = classes.select("vector_key", "rep").join(counts, "vector_key", "left").join(links.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("vector_key", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    alone = F.col("vec_id").isNull() | F.col("unit").isNull()
    joined = prepared.where(~alone).select("vec_id", "vector_key").join(named, "vector_key").drop("vector_key")
    result = joined.unionByName(prepared.where(alone).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return result.withColumn("kept", F.col("vec_id") == F.col("component_id"))
