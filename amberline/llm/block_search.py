"""Exact top-k search by inner product: block-at-a-time pruning over document ranges.

Vectors are ordered by length and by where their largest and smallest components stand, so that a
range of them is alike, and cut into groups (what one task holds) of blocks (what is pruned). A
component is a term, its value the term's weight; a block keeps the largest and smallest weight of
each term, and its forward index is the matrix of its vectors. A query's bound for a block is the sum
over its terms of weight times that maximum (minimum, for negative weights). Per group, a query
takes the blocks by falling bound and scores them until the next bound is below its kth score.

A query's first kth score comes from its own group; a group whose own bound is below it is never sent
for. Queries meet the groups' bounds in chunks, and then only the groups that they want.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amberline.llm.common import saved

BLOCK = 64
GROUP = 4096
GROUP_BYTES = 16 << 20
#: Groups whose bounds a batch of queries meets at once.
CHUNK = 256
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)

GROUP_SHAPE = "part int, nth int, width int, ids array<long>, named array<boolean>, vectors binary, high binary, low binary, asked array<int>, kth array<double>"
WANTED_SHAPE = "part int, nth int, asker_part int, asker_nth int, width int, places array<int>, query_ids array<long>, kth array<double>, queries binary"


def packed(matrix: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as hold them all: the first byte names the kind."""
    top = np.abs(matrix).max(initial=0)
    kind = "h" if top < 1 << 15 else "i" if top < 1 << 31 else "d"
    return kind.encode() + matrix.astype(kind).tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    flat = np.frombuffer(data, chr(data[0]), offset=1).astype(np.float64)
    return flat.reshape(-1, width) if width else np.zeros((0, 0))


def _whole(matrix: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in matrix], object).reshape(matrix.shape)


class Blocks:
    """A group's vectors, with the bounds of its blocks."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.scored = matrix, 0
        starts = np.arange(0, len(matrix), BLOCK)
        self.high, self.low = np.maximum.reduceat(matrix, starts), np.minimum.reduceat(matrix, starts)
        self.top = np.abs(matrix).max(initial=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, bounds: np.ndarray | None, kth, k: int, ids: np.ndarray, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best at ``kth`` or above, ties to the smaller id; ``own`` is the query's place."""
        n, step, at = len(self.matrix), 1, 0
        if bounds is None:  # too large for doubles: whole numbers, without pruning
            order, limits = np.arange(-(-n // BLOCK)), None
            matrix, query, step = _whole(self.matrix), _whole(query[None])[0], len(order)
        else:
            order = np.argsort(-bounds, kind="stable")
            limits, matrix = bounds[order], self.matrix
        places, scores = np.empty(0, np.int64), np.empty(0, matrix.dtype)
        while at < len(order) and (limits is None or limits[at] >= kth):
            stop = min(at + step, len(order))
            if limits is not None:
                stop = at + int((limits[at:stop] >= kth).sum())
            rows = (order[at:stop, None] * BLOCK + np.arange(BLOCK)).ravel()
            rows = rows[(rows < n) & (rows != (-1 if own is None else own))]
            found = matrix[rows] @ query
            self.scored += len(rows)
            good = np.flatnonzero(found >= kth)
            places, scores = np.concatenate([places, rows[good]]), np.concatenate([scores, found[good]])
            best = np.lexsort((ids[places], -scores))[:k]
            places, scores = places[best], scores[best]
            if len(best) == k:
                kth = max(kth, scores[-1])
            at, step = stop, 2 * step
        return places, scores


def _grouped(k: int, scale: float):
    """Cut each partition's sorted rows into groups, and search each group for the queries that stand in it."""

    def finish(part, nth, width, ids, named, asks, parts):
        matrix, ids = np.concatenate(parts), np.array(ids)
        blocks, asked = Blocks(matrix), np.flatnonzero(asks)
        safe = blocks.top * blocks.top * width < EXACT
        kth = np.full(len(asked), -np.inf)
        if safe and len(asked):
            bounds = blocks.bounds(matrix[asked])
            for i, place in enumerate(asked.tolist()):
                _, scores = blocks.search(matrix[place], bounds[i], -np.inf, k, ids, place)
                kth[i] = scores[-1] if len(scores) == k else -np.inf
        return part, nth, width, ids.tolist(), named, packed(matrix), matrix.max(0).tobytes(), matrix.min(0).tobytes(), asked.tolist(), kth.tolist()

    def run(batches):
        part, nth = TaskContext.get().partitionId(), 0
        width, ids, named, asks, parts = None, [], [], [], []
        for batch in batches:
            names = batch.column(0)
            lengths = np.diff(batch.column(1).offsets.to_numpy())
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            ask = batch.column(2).fill_null(False).to_pylist()
            valid, numbers = names.is_valid().to_pylist(), names.fill_null(np.iinfo(np.int64).max).to_pylist()
            at = 0
            while at < len(lengths):
                size = int(lengths[at])
                if width is not None and (size != width or len(ids) >= room):
                    yield rows_out([finish(part, nth, width, ids, named, asks, parts)], GROUPS)
                    nth, width = nth + 1, None
                if width is None:
                    width, ids, named, asks, parts = size, [], [], [], []
                    room = max(1, min(GROUP, GROUP_BYTES // (8 * max(1, size))))
                stop = at + 1
                while stop < len(lengths) and lengths[stop] == size and len(ids) + stop - at < room:
                    stop += 1
                parts.append(np.floor(scale * values[ends[at] - size : ends[stop - 1]]).reshape(stop - at, size))
                ids += numbers[at:stop]
                named += valid[at:stop]
                asks += ask[at:stop]
                at = stop
        if width is not None:
            yield rows_out([finish(part, nth, width, ids, named, asks, parts)], GROUPS)

    return run


GROUPS = pa.schema(
    [("part", pa.int32()), ("nth", pa.int32()), ("width", pa.int32()), ("ids", pa.list_(pa.int64())), ("named", pa.list_(pa.bool_())), ("vectors", pa.binary())]
    + [("high", pa.binary()), ("low", pa.binary()), ("asked", pa.list_(pa.int32())), ("kth", pa.list_(pa.float64()))]
)
WANTED = pa.schema(
    [("part", pa.int32()), ("nth", pa.int32()), ("asker_part", pa.int32()), ("asker_nth", pa.int32()), ("width", pa.int32()), ("places", pa.list_(pa.int32()))]
    + [("query_ids", pa.list_(pa.int64())), ("kth", pa.list_(pa.float64())), ("queries", pa.binary())]
)
FOUND = pa.schema([("asker_part", pa.int32()), ("asker_nth", pa.int32()), ("place", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def rows_out(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(shape)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, shape, strict=True)], schema=shape)


def _padded(matrix: np.ndarray, width: int) -> np.ndarray:
    """Missing terms weigh nothing."""
    return matrix[:, :width] if matrix.shape[1] >= width else np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _wanted(batches):
    """Of each batch of queries and chunk of groups: the groups whose bound reaches a query's kth score, and these queries."""
    for batch in batches:
        for asker_part, asker_nth, width, places, ids, kths, data, groups in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            queries, kth = unpacked(data, width) if width else np.zeros((len(places), 0)), np.array(kths)
            limit = np.abs(queries).max(initial=0)
            out = []
            for group in groups:
                high, low = np.frombuffer(group["high"]), np.frombuffer(group["low"])
                common = min(width, group["width"])
                q, high, low = queries[:, :common], high[:common], low[:common]
                want = np.maximum(q, 0) @ high + np.minimum(q, 0) @ low >= kth
                if limit * np.abs([high, low]).max(initial=0) * common >= EXACT:
                    want[:] = True
                at = np.flatnonzero(want)
                if len(at):
                    chosen = packed(queries[at])
                    out.append((group["part"], group["nth"], asker_part, asker_nth, width, [places[i] for i in at], [ids[i] for i in at], kth[at].tolist(), chosen))
            if out:
                yield rows_out(out, WANTED)


def _scored(k: int):
    def run(batches):
        now, blocks = None, None
        for batch in batches:
            for part, nth, asker_part, asker_nth, width, places, query_ids, kths, data, own_width, ids, named, vectors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (part, nth) != now:
                    matrix = unpacked(vectors, own_width) if own_width else np.zeros((len(ids), 0))
                    now, blocks, numbers = (part, nth), Blocks(matrix), np.array(ids)
                queries = _padded(unpacked(data, width) if width else np.zeros((len(places), 0)), own_width)
                safe = np.abs(queries).max(initial=0) * blocks.top * own_width < EXACT
                bounds = blocks.bounds(queries) if safe else None
                out = []
                for i, place in enumerate(places):
                    own = place if (part, nth) == (asker_part, asker_nth) else None
                    at, scores = blocks.search(queries[i], bounds[i] if safe else None, kths[i], k, numbers, own)
                    for j, score in zip(at.tolist(), scores.tolist(), strict=True):
                        out.append((asker_part, asker_nth, place, query_ids[i], ids[j] if named[j] else None, max(-(1 << 63), min((1 << 63) - 1, int(score)))))
                if out:
                    yield rows_out(out, FOUND)

    return run


def top_k(vectors: DataFrame, k: int = 5, queries: str = "vec_id % 50 = 0", scale: float = 256.0) -> DataFrame:
    """The ``k`` rows of highest inner product for each row that the SQL condition ``queries`` on ``vec_id`` names.

    Takes ``vec_id, embedding``, other columns are ignored. A component x counts as ``floor(scale * x)``
    of its double. Returns ``query_id, rank`` (from 1), ``vec_id, score`` (long), ties to the smaller
    ``vec_id``. Candidates are all rows but the query's own: each of several rows with one id has its
    own list and is the others' candidate. A row without an id is a candidate only and comes last of
    its ties. Vectors that are null or hold components that are null, not finite or, scaled, beyond
    doubles take no part; the empty vector does, and missing components of a shorter one count 0.
    Scores are exact; beyond 64 bits they are given as the nearest long and tie there. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("e")).where(
        f"e IS NOT NULL AND forall(e, x -> coalesce(abs(x * {scale}D) < double('infinity'), false))"
    )
    rows = rows.selectExpr("vec_id", "e", f"coalesce({queries}, false) AS asks", "size(e) AS width")
    rows = rows.selectExpr("*", "array_position(e, array_max(e)) AS peak", "array_position(e, array_min(e)) AS dip", "monotonically_increasing_id() AS line")
    order = ("width", "peak", "dip", "vec_id", "line")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("vec_id", "e", "asks")
    groups = saved(rows.mapInArrow(_grouped(k, scale), GROUP_SHAPE), "vector-groups")
    chunks = max(1, -(-groups.count() // CHUNK))
    place = F.pmod(F.xxhash64("part", "nth"), F.lit(chunks)).alias("chunk")
    bounds = groups.select(place, F.struct("part", "nth", "width", "high", "low").alias("group")).groupBy("chunk").agg(F.collect_list("group").alias("groups"))
    asking = groups.where("size(asked) > 0").mapInArrow(_asking, WANTED_SHAPE).drop("part", "nth")
    asking = asking.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    met = asking.join(bounds, "chunk").select("asker_part", "asker_nth", "width", "places", "query_ids", "kth", "queries", "groups")
    wanted = saved(met.mapInArrow(_wanted, WANTED_SHAPE), "wanted-groups")
    payload = groups.select("part", "nth", F.col("width").alias("own_width"), "ids", "named", "vectors")
    joined = wanted.join(payload, ["part", "nth"]).select(*wanted.columns, "own_width", "ids", "named", "vectors")
    found = joined.mapInArrow(_scored(k), "asker_part int, asker_nth int, place int, query_id long, vec_id long, score long")
    best = Window.partitionBy("asker_part", "asker_nth", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _asking(batches):
    """The queries that stand in each group, as one batch of queries."""
    for batch in batches:
        for part, nth, width, ids, _, vectors, _, _, asked, kth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            matrix = unpacked(vectors, width)[asked] if width else np.zeros((len(asked), 0))
            yield rows_out([(part, nth, part, nth, width, asked, [ids[i] for i in asked], kth, packed(matrix))], WANTED)
