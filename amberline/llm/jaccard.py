"""Set-similarity join of documents on word shingles, with token-combination prefixes.

Method: all shingles ("tokens") stand in one global order, rare before frequent. Two sets of
Jaccard similarity t or more differ, seen from a set of n tokens, in at most n - ceil(t n) of its
tokens. So a set's prefix is made long enough that any such loss leaves one signature whole: a
single token of the rare class, or k tokens of the same frequent class. Frequent tokens cost k - 1
tokens per class, by which the prefix is extended. Sets that share no signature can't be similar.
Those that share one and are of like size are compared by small histograms of their tokens, which
bound the difference from below, and those left by their whole sets.

The class of a token comes from how often its cell (of a fixed number of hash cells) occurs over
all documents. That only steers the order: any counts give the same links.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amberline.llm.common import saved
from amberline.llm.graph import components
from amberline.llm.words import mix, set_key, shingle_sets

CELL_BITS = 18
CELLS = 1 << CELL_BITS
ROW_CELLS = 256
BLOCK = 512
#: Rows of about 50 bytes that may be broadcast.
BROADCAST_ROWS = 400_000
#: Signatures of about so many rows (of 20 bytes) are not gathered in a task; found by one document in ``PART``.
HOT_ROWS, PART = 250_000, 64
#: A cell this many times the mean holds frequent tokens, of class k = 2 and k = 3.
FREQUENT = ((2, 4, 16), (3, 32, 128))
#: Tokens meant for one class of k-token combinations.
MEANT = {2: 4, 3: 6}
SALT = np.uint64(0x8EBC6AF09C88C6E3)


def cell_counts(docs: DataFrame, size: int) -> np.ndarray:
    """How many (document, token) pairs fall into each cell, over all documents; of fixed size."""

    def count(batches):
        counts = np.zeros(CELLS, np.int64)
        for batch in batches:
            for tokens in shingle_sets(batch.column(0), size):
                counts += 0 if not len(tokens) else np.bincount(tokens >> np.uint64(64 - CELL_BITS), minlength=CELLS)
        rows = counts.reshape(-1, ROW_CELLS)
        yield pa.RecordBatch.from_pydict({"slot": np.arange(len(rows)), "counts": list(rows)}, pa.schema([("slot", pa.int64()), ("counts", pa.list_(pa.int64()))]))

    def add(slots: pa.Table) -> pa.Table:
        rows = np.asarray(slots.column("counts").combine_chunks().flatten()).reshape(-1, ROW_CELLS)
        return pa.table({"slot": slots.column("slot")[:1], "counts": pa.array([rows.sum(0)], pa.list_(pa.int64()))})

    shape = "slot long, counts array<long>"
    summed = docs.select("text").mapInArrow(count, shape).groupBy("slot").applyInArrow(add, shape)
    counts = np.zeros((CELLS // ROW_CELLS, ROW_CELLS), np.int64)
    for row in summed.toLocalIterator():
        counts[row.slot] = row.counts
    return counts.ravel()


class Signer:
    """Signatures of a token set for one threshold (in percent) and one table of cell counts."""

    def __init__(self, counts: np.ndarray, percent: int):
        self.percent = percent
        self.counts = counts
        self.level = np.ones(CELLS, np.int64)
        for k, times, least in FREQUENT:
            self.level[counts >= max(least, times * counts.mean())] = k

    def may_link(self, n: int) -> bool:
        """Whether a set of n tokens can be similar to a different one."""
        return 100 * n // self.percent > n or -(-self.percent * n // 100) < n

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        n = len(tokens)
        if not n or not self.may_link(n):
            return np.empty(0, np.uint64)
        must = n + 1 - -(-self.percent * n // 100)  # signatures that the prefix needs in the worst case
        cells = tokens >> np.uint64(64 - CELL_BITS)
        order = np.lexsort((tokens, self.counts[cells]))
        tokens, level = tokens[order], self.level[cells[order]]
        if (level[:must] == 1).all():
            return mix(tokens[:must])
        # Classes depend on the set's size, in powers of two; near the next power a set signs for both.
        sizes = {n.bit_length(), (100 * n // self.percent).bit_length()}
        return np.unique(np.concatenate([self._prefix(tokens, level, must, bits) for bits in sizes]))

    def _prefix(self, tokens, level, must, bits):
        spread = mix(tokens ^ SALT)
        kind = np.zeros(len(tokens), np.int64)
        first = 1
        for k, meant in MEANT.items():
            parts = max(1, (1 << bits) // 10 // meant)
            own = level == k
            kind[own] = first + (spread[own] % np.uint64(parts)).astype(np.int64)
            first += parts
        by_kind = np.argsort(kind, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(kind[by_kind]) != 0])
        rank = np.empty(len(tokens), np.int64)
        rank[by_kind] = np.arange(len(tokens)) - np.repeat(starts, np.diff(np.r_[starts, len(tokens)]))
        end = int(np.searchsorted(np.cumsum(rank >= level - 1), must)) + 1
        out = [mix(tokens[:end][level[:end] == 1])]
        groups: dict[int, list] = {}
        for name, k, token in zip(kind[:end].tolist(), level[:end].tolist(), tokens[:end].tolist(), strict=True):
            if k > 1:
                groups.setdefault((name, k), []).append(token)
        for (name, k), members in groups.items():
            if len(members) >= k:
                sets = np.array(list(combinations(sorted(members), k)), np.uint64)
                found = np.full(len(sets), (bits << 8) + k, np.uint64) * SALT
                for column in sets.T:
                    found = mix(found + column)
                out.append(found)
        return np.concatenate(out)


def similar(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets have 100 * intersection >= percent * union."""
    sizes = np.array([len(x) for x in sets])
    _, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = often[place] > 1
    column = np.cumsum(often > 1)[place[shared]] - 1
    owner, both = owner[shared], np.zeros((len(sets), len(sets)))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (low, low + 4096))
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        both += part @ part.T
    return 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)


CAP = 8


def sketch(tokens: np.ndarray) -> bytes:
    """Counts of a set's tokens in hash buckets, a power of two between a quarter and half of its size."""
    if not len(tokens):
        return b""
    bits = max(0, len(tokens).bit_length() - 2)
    places = (tokens >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(tokens), np.int64)
    return np.minimum(np.bincount(places, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def may_be_similar(sketches: list[bytes], sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets may have the similarity, by their sketches; never false for a pair that has it.

    Counts that differ mean tokens that differ, also if they are capped or neighbouring buckets are
    joined, so the sum of differences bounds the sets' difference from below.
    """
    widths, n = np.array([len(x) for x in sketches]), len(sketches)
    out = np.zeros((n, n), bool)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero((widths == width) | (widths == 2 * width))
        if len(rows) < 2:
            continue
        counts = np.stack([np.frombuffer(sketches[i], np.uint8).reshape(width, -1).sum(1, dtype=np.int32) for i in rows])
        counts = np.minimum(counts, CAP)
        common = np.zeros((len(rows), len(rows)), np.float64)
        for least in range(1, int(counts.max()) + 1):
            part = (counts >= least).astype(np.float32)
            common += part @ part.T
        total, size = counts.sum(1), sizes[rows]
        apart = total[:, None] + total[None, :] - 2 * common
        both = size[:, None] + size[None, :]
        fine = (apart * (100 + percent) <= both * (100 - percent)) & (100 * np.minimum(size[:, None], size) >= percent * np.maximum(size[:, None], size))
        out[np.ix_(rows, rows)] |= fine
    np.fill_diagonal(out, False)
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """For each row the first row of its component."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] < 0:
            root[i] = i
            front = np.array([i])
            while len(front):
                front = np.flatnonzero(linked[front].any(0) & (root < 0))
                root[front] = i
    return root


def _verify(percent: int, size: int):
    """Links within each list of texts; the rows of a list follow each other."""
    shape = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(reps, sets):
        if len(reps) > 1:
            for i, r in enumerate(forest(similar(sets, percent)).tolist()):
                if reps[i] != reps[r]:
                    yield reps[i], reps[r]

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], schema=shape)

    def run(batches):
        now, reps, sets, found = None, [], [], []
        for batch in batches:
            columns = (c.to_pylist() for c in batch.columns[:3])
            for name, rep, key, tokens in zip(*columns, shingle_sets(batch.column(3), size), strict=True):
                if set_key(tokens) != key:  # another row of this id
                    continue
                if name != now:
                    found += links(reps, sets)
                    now, reps, sets = name, [], []
                reps.append(rep)
                sets.append(tokens)
            if found:
                yield batch_of(found)
                found = []
        found += links(reps, sets)
        if found:
            yield batch_of(found)

    return run


def _sifted(percent: int):
    """Of each list of sketches, whose rows follow each other, the groups that may hold similar sets, as lists of their own."""

    def groups(name, nodes, sizes, sketches):
        if len(nodes) > 1:
            linked = may_be_similar(sketches, np.array(sizes), percent)
            some = np.flatnonzero(linked.any(0))
            roots = forest(linked)[some]
            names = mix(mix(np.array(nodes, np.int64).view(np.uint64)[roots]) ^ np.int64(name).view(np.uint64)).view(np.int64)
            yield from zip(names.tolist(), (nodes[i] for i in some), strict=True)

    def run(batches):
        now, nodes, sizes, sketches, found = None, [], [], [], []
        for batch in batches:
            for name, node, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != now:
                    found += groups(now, nodes, sizes, sketches)
                    now, nodes, sizes, sketches = name, [], [], []
                nodes.append(node)
                sizes.append(n)
                sketches.append(data)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["list", "node"])
                found = []
        found += groups(now, nodes, sizes, sketches)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["list", "node"])

    return run


def _signed(docs: DataFrame, signer: Signer, size: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, node, sketch, signatures``; ``node`` is a whole number made of ``set_key``."""
    shared = docs.sparkSession.sparkContext.broadcast(signer)

    def run(batches):
        for batch in batches:
            keys, counts, sketches, found = [], [], [], []
            for tokens in shingle_sets(batch.column(1), size):
                keys.append(set_key(tokens))
                counts.append(len(tokens))
                sketches.append(sketch(tokens))
                found.append(shared.value.signatures(tokens).view(np.int64))
            nodes = np.frombuffer(b"".join(keys), np.int64)[::2]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(nodes), pa.array(sketches, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "node", "sketch", "signatures"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_key binary, node long, sketch binary, signatures array<long>")


def _small(rows: DataFrame) -> DataFrame:
    """``rows`` for a join that broadcasts them if they are few; else both sides are shuffled."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def hot_signatures(sign: DataFrame, least: int) -> DataFrame:
    """Signatures of about ``least`` rows or more, by one document of ``PART`` of them; few, as each has so many rows."""
    some = sign.where(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(PART)) == 0)
    return some.groupBy("signature").agg(F.count("*").alias("n")).where(F.col("n") >= max(1, least // PART)).select("signature")


def meetings(signed: DataFrame, percent: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``key, node, low``: each node under each key (a signature and a size band) at which nodes meet, and the key's smallest.

    Rows are shuffled once, by signature, and the ends of each key found where they then are. Signatures of very many
    rows, which one task would get, go by key and node instead, in partial aggregates and a join that adaptive execution
    splits. Which signatures those are only steers the way; both ways give the same rows.
    """
    ends = (F.min("node").alias("low"), F.max("node").alias("high"))
    # The hair that makes bands wider covers rounding.
    band = F.floor(F.log("n_shingles") / (1.0001 * math.log(100 / percent))) if percent < 100 else F.col("n_shingles")
    sign = signed.select("doc_id", "node", band.cast("int").alias("band"), F.explode("signatures").alias("signature"))
    hot = saved(hot_signatures(sign, hot_rows), "hot")
    sign = sign.select("signature", "node", "band")
    each = F.explode(F.array("band", F.col("band") + 1)).alias("band")

    dealt = sign.join(F.broadcast(hot), "signature", "left_anti").repartition("signature").select("signature", "node", each)
    key = Window.partitionBy("signature", "band")
    met = dealt.withColumns({"low": F.min("node").over(key), "high": F.max("node").over(key)}).where("low <> high")
    met = met.select("signature", "band", "node", "low").distinct().select(F.xxhash64("signature", "band").alias("key"), "node", "low")

    dealt = sign.join(F.broadcast(hot), "signature", "left_semi").select("signature", "node", each)
    dealt = saved(dealt.select(F.xxhash64("signature", "band").alias("key"), "node").distinct(), "meetings")
    keys = dealt.groupBy("key").agg(*ends).where("low <> high").select("key", "low")
    return met.unionByName(dealt.join(keys, "key").select("key", "node", "low"))


def candidate_lists(signed: DataFrame, percent: int) -> DataFrame:
    """Lists of nodes to compare: ``list, node``, such that any two that share a signature and are of like size share a list.

    Sets meet under a signature only within neighbouring size bands. Each node has a leader, the
    smallest node that it meets, or that one meets, and so on twice more. Nodes of one leader are
    a list; if many, they are dealt into parts of about ``BLOCK``, and each two parts are a list.
    Nodes of different leaders that meet under some signature share the list of their two parts.
    So a set is sent once to its leader's list and seldom elsewhere, no task gets an unbounded
    group, and no pair is left out.
    """
    rows = saved(meetings(signed, percent), "shared")
    lead = rows.groupBy("node").agg(F.min("low").alias("lead"))
    for _ in range(2):
        lead = saved(lead, "leaders")
        above = lead.select(F.col("node").alias("lead"), F.col("lead").alias("above"))
        lead = lead.join(above, "lead").select("node", F.col("above").alias("lead"))
    lead = saved(lead, "leaders")
    sizes = saved(lead.groupBy("lead").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), "sizes")
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
    homes = saved(lead.join(sizes, "lead").select("node", "lead", part.alias("part"), "parts"), "homes")
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other_part")
    own = homes.select("node", "lead", "part", F.col("lead").alias("other"), each)
    rows = rows.join(_small(homes), "node").select("key", "node", "lead", "part")
    several = rows.groupBy("key").agg(F.min("lead").alias("low"), F.max("lead").alias("high")).where("low <> high").select("key")
    rows = saved(rows.join(several, "key"), "between")
    others = rows.select("key", F.col("lead").alias("other")).distinct()
    meet = rows.join(others, "key").where("lead <> other").select("node", "lead", "part", "other").distinct()
    meet = meet.join(sizes.withColumnRenamed("lead", "other"), "other").select("node", "lead", "part", "other", each)
    ends = F.struct("lead", "part"), F.struct(F.col("other").alias("lead"), F.col("other_part").alias("part"))
    return own.unionByName(meet).select(F.xxhash64(F.least(*ends), F.greatest(*ends)).alias("list"), "node")


def join_similar(docs: DataFrame, percent: int = 90, size: int = 3) -> DataFrame:
    """Connect documents whose sets of ``size``-word shingles have a Jaccard similarity of ``percent`` or more.

    Returns one row per row of ``docs`` (``doc_id, text``, others are ignored): ``doc_id,
    n_shingles, component_id``. A null or empty text has no shingles and links with nothing; a row
    with a null ``doc_id`` links with nothing and has a null component. Repeated rows are equal
    documents. An empty table gives an empty result.

    Documents with equal sets are one class; only the document with its smallest id is compared,
    and its text is read again for that rather than all sets being kept.
    """
    signer = Signer(cell_counts(docs, size), percent)
    signed = saved(_signed(docs, signer, size), "signed")
    single = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    usable = signed.where(~single)
    classes = usable.groupBy("set_key", "node", "n_shingles").agg(F.min("doc_id").alias("rep"), F.any_value("sketch").alias("sketch"))
    classes = saved(classes, "classes")
    lists = _small(saved(candidate_lists(usable, percent), "candidates"))
    lists = classes.join(lists, "node").select("list", "node", "n_shingles", "sketch")
    lists = lists.repartition("list").sortWithinPartitions("list").mapInArrow(_sifted(percent), "list long, node long")
    wanted = saved(lists.distinct().join(classes, "node").select("list", "rep", "set_key"), "lists")
    rows = docs.select(F.col("doc_id").alias("rep"), "text").join(_small(wanted), "rep").select("list", "rep", "set_key", "text")
    grouped = rows.repartition("list").sortWithinPartitions("list")
    links = components(grouped.mapInArrow(_verify(percent, size), "u long, v long"))
    named = classes.select("set_key", "rep").join(links.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("set_key", F.coalesce("component", "rep").alias("component_id"))
    joined = usable.select("doc_id", "n_shingles", "set_key").join(named, "set_key").drop("set_key")
    return joined.unionByName(signed.where(single).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
