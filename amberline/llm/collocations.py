"""Phrase collocations by dynamic itemset counting.

Documents are dealt into shards that are scanned in a cycle, one a step. Words are counted from the first
step on. A longer phrase becomes active after the step in which both of its subphrases (all words but the
last, all but the first) have reached the threshold, so lengths interleave; it is counted in the next
``CYCLE`` steps, which is every shard once, and is then complete. Scans end when nothing is active.

Texts are made words once, and shards hold these as numbers. Counters are slots, each a hash of phrases of
one length: a slot holds at least the count of any phrase in it, so no phrase at the threshold is missed, and
slots shared by several phrases only leave more of them. Tasks send what they add to slots, ranges of slots
are added up in parallel, and a bit a slot goes to the tasks of the next step. One last scan counts the
phrases that are left as they are.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amberline.llm.common import saved, slices, write
from amberline.llm.words import SLICE_BYTES, SPREAD, mix, word_hashes
from amberline.session import remove, scratch_path

#: Shards, and so steps that a phrase is counted for.
CYCLE = 4
LONGEST = 4
#: Bytes of text for which each length has one slot, and the bounds of the number of slots (powers of two).
TEXT_PER_SLOT = 64
LEAST_BITS, MOST_BITS = 12, 27
#: Slots in one row of the counters.
RANGE_BITS = 16
#: Bytes of text whose phrases are counted together in a task.
WINDOW = 4 << 20
#: Rows of a batch that are taken from it at a time.
ROWS = 256
#: The most that a slot counts.
MOST = 255
#: Places in slots, rows of phrases, and bytes of these, that a task keeps before it sends them.
KEPT_PLACES, KEPT_ROWS, KEPT_BYTES = 1 << 22, 1 << 20, 64 << 20
#: Bytes of text that a task scans at least where there is work for all cores: larger tasks send each phrase less often.
TASK_TEXT = 64 << 20
#: Bytes of text for which the last scan has one bucket of phrases.
BUCKET_TEXT = 8 << 20
#: Parts of a language that are ranked before the whole is.
PARTS = 64

_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
#: Small letters, spaces for white space, line feeds for the ends of pieces.
_PLAIN = bytes(32 if kind == 1 else 10 if kind == 2 else c + 32 if 65 <= c <= 90 else c for c, kind in enumerate(_KIND))

WORDS_SHAPE = "shard int, lang string, skip int, volume long, n int, ids binary, fresh binary, own binary, known binary"
WORDS = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("skip", pa.int32()), ("volume", pa.int64()), ("n", pa.int32())] + [(name, pa.binary()) for name in ("ids", "fresh", "own", "known")])
ADDED_SHAPE = "size int, range int, entries int, data binary"
ADDED = pa.schema([("size", pa.int32()), ("range", pa.int32()), ("entries", pa.int32()), ("data", pa.binary())])
COUNTERS_SHAPE = f"{ADDED_SHAPE}, reached binary"
COUNTERS = ADDED.append(pa.field("reached", pa.binary()))
BUCKETS_SHAPE = "bucket int, phrases binary"
BUCKETS = pa.schema([("bucket", pa.int32()), ("phrases", pa.binary())])
COUNTS_SHAPE = "lang string, phrase string, size int, n long"
COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())])


def parts(text: bytes, window: int) -> list[tuple[bytes, int]]:
    """A text in parts of about ``window`` bytes, each with how many of its first words stand in the part before too."""
    out, at, carried = [], 0, b""
    while len(text) - at > window:
        kinds = _KIND[np.frombuffer(text, np.uint8, window, at)]
        ends = np.flatnonzero(kinds == 2)
        spaces = ends if len(ends) else np.flatnonzero(kinds)
        if len(spaces):
            stop = at + int(spaces[-1]) + 1
        else:  # one word is longer than a part
            stop = at + window
            while stop < len(text):
                rest = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8, min(window, len(text) - stop), stop)])
                if len(rest):
                    stop += int(rest[0]) + 1
                    break
                stop = min(len(text), stop + window)
        piece = carried + text[at:stop]
        out.append((piece, carried.count(b" ")))
        # What may go on in the next part: the last words after the last end of a piece.
        tail = max(piece.rfind(c) for c in b".,;:!?\n\x0b\x0c\r") + 1
        carried = b"".join(word + b" " for word in _last_words(piece, tail))
        at = stop
    out.append((carried + text[at:], carried.count(b" ")))
    return out


def _last_words(piece: bytes, tail: int) -> list[bytes]:
    """The last words of a part, found from its end."""
    found, stop = [], len(piece)
    while len(found) < LONGEST - 1 and stop > tail:
        while stop > tail and piece[stop - 1] in b" \t":
            stop -= 1
        start = max(tail - 1, piece.rfind(b" ", tail, stop), piece.rfind(b"\t", tail, stop)) + 1
        if start < stop:
            found.insert(0, piece[start:stop])
        stop = start
    return found


class Words:
    """The words of a stretch of text in one language: the different ones with their hashes, and numbers of these in their order."""

    def __init__(self, lang: str, volume: int, ids: np.ndarray, fresh: np.ndarray, own: np.ndarray, known: pa.Array | None):
        self.lang, self.volume, self.ids, self.fresh, self.own, self.known = lang, volume, ids, fresh, own, known

    @classmethod
    def of(cls, lang: str, text: bytes) -> Words:
        data = np.frombuffer((text + b"\n").translate(_PLAIN), np.uint8)
        stops = data == 10
        apart = stops | (data == 32)
        keep = ~apart
        keep[1:] |= ~apart[:-1]
        plain = data[keep]
        plain[plain == 10] = 32
        ends = np.flatnonzero(plain == 32)
        first = ~apart
        first[1:] &= apart[:-1]
        fresh = np.zeros(len(ends) + 1, bool)  # what begins behind the end of a piece
        fresh[np.searchsorted(np.flatnonzero(first), np.flatnonzero(stops))] = True
        fresh = fresh[:-1]
        # Every word with the space behind it, which no word holds.
        offsets = np.concatenate([[0], ends + 1]).astype(np.int32)
        found = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(plain)]).dictionary_encode()
        known, size = found.dictionary, len(found.dictionary)
        bounds = np.frombuffer(known.buffers()[1], np.int32)[: size + 1].astype(np.int64) if size else np.zeros(1, np.int64)
        known_text = np.frombuffer(known.buffers()[2] or b"", np.uint8)[: bounds[-1]]
        own = np.empty(size, np.uint64)
        for low, high in slices(np.diff(bounds).tolist(), SLICE_BYTES):  # hashing takes 40 bytes and more for each one of text
            part = known_text[bounds[low] : bounds[high]]
            own[low:high] = word_hashes(part, np.array([0, len(part)]))[0]
        return cls(lang, len(text), found.indices.to_numpy().astype(np.uint16 if size <= 1 << 16 else np.uint32), fresh, own, known)

    def packed(self, shard: int, skip: int) -> pa.RecordBatch:
        """A row of ``WORDS``."""
        size = len(self.known)
        known = self.known.buffers()[2][: np.frombuffer(self.known.buffers()[1], np.int32)[size]] if size else b""
        row = [shard, self.lang, skip, self.volume, len(self.ids), self.ids.tobytes(), np.packbits(self.fresh).tobytes(), self.own.tobytes(), bytes(known)]
        return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, WORDS.types, strict=True)], schema=WORDS)

    @classmethod
    def unpacked(cls, lang: str, volume: int, n: int, ids: bytes, fresh: bytes, own: bytes, known: bytes | None = None) -> Words:
        if known is not None:
            bounds = np.concatenate([[0], np.flatnonzero(np.frombuffer(known, np.uint8) == 32) + 1]).astype(np.int32)
            known = pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(known)])
        kind = np.uint16 if len(ids) == 2 * n else np.uint32
        return cls(lang, volume, np.frombuffer(ids, kind), np.unpackbits(np.frombuffer(fresh, np.uint8), count=n).view(bool), np.frombuffer(own, np.uint64), known)

    def chains(self) -> np.ndarray:
        """The hashes of the different words as phrases of one word."""
        seed = np.uint64(int.from_bytes(hashlib.blake2b(self.lang.encode(), digest_size=8).digest(), "little"))
        return mix(self.own ^ seed)

    def longer(self, at: np.ndarray, size: int) -> np.ndarray:
        """Which of the runs of ``size - 1`` words at ``at``, each in one piece, go on to runs of ``size`` words whose other part is among them too."""
        on = np.flatnonzero(at[1:] == at[:-1] + 1)
        return on[~self.fresh[at[on] + 1]] if size == 2 else on

    def lengthened(self, at: np.ndarray, chain: np.ndarray, size: int) -> np.ndarray:
        """The hashes of the runs of ``size`` words at ``at``, from those of one word less."""
        return mix(chain * SPREAD[0] + self.own[self.ids[at + (size - 1)]] * SPREAD[1])

    def counted(self, at: np.ndarray, chain: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the runs of ``size`` words at ``at``, one of each different phrase, by its place in ``at``, and how many there are."""
        order = np.argsort(chain)
        alike = chain[order[1:]] == chain[order[:-1]]
        if not self._equal(at[order], size)[alike].all():  # two phrases of one hash
            order = np.lexsort([self.ids[at + k] for k in range(size)])
            alike = self._equal(at[order], size)
        starts = np.flatnonzero(np.concatenate([[True], ~alike]))
        return order[starts], np.diff(starts, append=len(at))

    def _equal(self, at: np.ndarray, size: int) -> np.ndarray:
        same = np.ones(max(0, len(at) - 1), bool)
        for k in range(size):
            word = self.ids[at + k]
            same &= word[1:] == word[:-1]
        return same

    def texts(self, at: np.ndarray, size: int) -> pa.Array:
        words = [self.known.take(pa.array(self.ids[at + k])) for k in range(size)]
        return pc.binary_slice(pc.binary_join_element_wise(*words, pa.scalar(b"", pa.binary())), 0, -1).view(pa.string())


def _slots(chain: np.ndarray, bits: int) -> np.ndarray:
    return (chain >> np.uint64(64 - bits)).astype(np.int64)


def _holds(reached: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Whether slots have reached the threshold, from a bit each."""
    return ((reached[slots >> 3] << (slots & 7).astype(np.uint8)) & 128) > 0


def active(words: Words, skip: int, longest: int, bits: int, now: dict, before: dict):
    """``size, slots`` of the phrases of two to ``longest - 1`` words that are active in a step.

    ``now`` and ``before`` have the slots that reached the threshold until the last step, and until ``cycle`` steps before that.
    """
    chains = words.chains()
    slots = _slots(chains, bits)
    at = np.flatnonzero(_holds(now[1], slots)[words.ids])
    old, chain = _holds(before[1], slots)[words.ids[at]], chains[words.ids[at]]
    for size in range(2, longest):
        on = words.longer(at, size)
        old = old[on] & old[on + 1]  # complete by now
        at, chain = at[on], chain[on]
        chain = words.lengthened(at, chain, size)
        slots = _slots(chain, bits)
        yield size, slots[~old & (at + size > skip)]
        if size + 1 < longest:
            keep = np.flatnonzero(_holds(now[size], slots))
            at, chain, old = at[keep], chain[keep], old[keep] & _holds(before[size], slots[keep])


def left_over(words: Words, skip: int, longest: int, bits: int, reached: dict):
    """``size, phrases, hashes, n`` of the phrases whose subphrases and own slots reached the threshold."""
    chains = words.chains()
    good = _holds(reached[1], _slots(chains, bits)) if longest > 1 else np.ones(len(chains), bool)
    n = np.bincount(words.ids[skip:], minlength=len(chains))
    found = np.flatnonzero(good & (n > 0))
    if len(found):
        yield 1, pc.binary_slice(words.known.take(pa.array(found)), 0, -1).view(pa.string()), chains[found], n[found]
    at = np.flatnonzero(good[words.ids])
    chain = chains[words.ids[at]]
    for size in range(2, longest + 1):
        on = words.longer(at, size)
        at = at[on]
        chain = words.lengthened(at, chain[on], size)
        if size < longest:
            keep = np.flatnonzero(_holds(reached[size], _slots(chain, bits)))
            at, chain = at[keep], chain[keep]
        behind = np.searchsorted(at, skip - size + 1)
        if behind < len(at):
            first, n = words.counted(at[behind:], chain[behind:], size)
            yield size, words.texts(at[behind:][first], size), chain[behind:][first], n


def _by_window(batches, window: int):
    """Words of one language after another, of about ``window`` bytes of text at a time."""
    pending: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            langs, found = (column.slice(low, ROWS) for column in batch.columns)
            for lang, data in zip(langs.to_pylist(), found.cast(pa.binary()).to_pylist(), strict=True):
                if size and size + len(data) > window:
                    yield from _stretches(pending, window)
                    pending, size = {}, 0
                pending.setdefault(lang, []).append(data)
                size += len(data)
    yield from _stretches(pending, window)


def _stretches(pending: dict[str, list[bytes]], window: int):
    """Short texts together, long ones in parts."""
    for lang, texts in pending.items():
        together = [text for text in texts if len(text) <= window]
        if together:
            yield lang, Words.of(lang, b"\n".join(together)), 0
        for text in texts:
            if len(text) > window:
                for part, skip in parts(text, window):
                    yield lang, Words.of(lang, part), skip


def _worded(cycle: int, window: int):
    """Texts as words, dealt into shards."""

    def run(batches):
        turn = TaskContext.get().partitionId()
        for k, (_, words, skip) in enumerate(_by_window(batches, window)):
            yield words.packed((turn + k + k // cycle) % cycle, skip)  # so that languages that take turns go to all shards

    return run


def _unpacked(batches):
    """The words in rows of ``_worded``, and how many of the first stand in the part before too."""
    for batch in batches:
        for i in range(batch.num_rows):
            lang, skip, *row = (column[i].as_py() for column in batch.columns)
            yield Words.unpacked(lang, *row), skip


def _ranges(size: int, slots: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """What is to be added to sorted slots, by ranges of them."""
    ranges, starts = np.unique(slots >> RANGE_BITS, return_index=True)
    places, n = slots.astype(np.uint16), np.minimum(n, MOST).astype(np.uint8)
    data = []
    for low, high in zip(starts, np.append(starts[1:], len(slots)), strict=True):
        gaps = np.diff(places[low:high], prepend=np.uint16(0))
        data.append(pa.compress(gaps.view(np.uint8).reshape(-1, 2).T.tobytes() + n[low:high].tobytes(), "zstd", asbytes=True))
    entries = np.diff(starts, append=len(slots))
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(size, pa.int32()), len(data)), pa.array(ranges, pa.int32()), pa.array(entries, pa.int32()), pa.array(data, pa.binary())], schema=ADDED)


def _sent(kept: dict[int, list]):
    for size, found in kept.items():
        slots = np.concatenate([slots for slots, _ in found])
        if size == 1:
            order = np.argsort(slots)
            slots, n = slots[order], np.concatenate([n for _, n in found])[order]
        else:
            slots.sort()
        starts = np.flatnonzero(np.diff(slots, prepend=-1))
        if len(starts):
            yield _ranges(size, slots[starts], np.add.reduceat(n, starts) if size == 1 else np.diff(starts, append=len(slots)))


def _step(step: int, cycle: int, longest: int, bits: int, sent, longer: bool):
    """What a task adds to the slots of the phrases active in a step; ``longer`` if some have more than one word."""

    def run(batches):
        kept, places = {}, 0
        for words, skip in _unpacked(batches):
            found = []
            if step < cycle:
                found.append((1, _slots(words.chains(), bits), np.bincount(words.ids[skip:], minlength=len(words.own))))
            if longer:
                found += [(size, slots, None) for size, slots in active(words, skip, longest, bits, *sent.value)]
            for size, slots, n in found:
                kept.setdefault(size, []).append((slots.astype(np.int32), n))
                places += len(slots)
            if places >= KEPT_PLACES:
                yield from _sent(kept)
                kept, places = {}, 0
        yield from _sent(kept)

    return run


def _added(bits: int, least: int):
    """The sums of what tasks add, one row a range, as far as they count, and a bit for each slot at the threshold."""
    width = 1 << min(bits, RANGE_BITS)

    def run(batches):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for (size, low), group in groupby(rows, key=lambda row: row[:2]):
            total = np.zeros(width, np.int32)
            for _, _, entries, data in group:
                if entries < 0:
                    total += np.frombuffer(pa.decompress(data, width, "zstd"), np.uint8)
                else:
                    part = np.frombuffer(pa.decompress(data, 3 * entries, "zstd"), np.uint8)
                    gaps = part[: 2 * entries].reshape(2, entries).T.copy().view(np.uint16)[:, 0]
                    total[np.cumsum(gaps, dtype=np.int64)] += part[2 * entries :]
            enough = total >= least
            row = [size, low, -1, *(pa.compress(x, "zstd", asbytes=True) for x in (np.minimum(total, MOST).astype(np.uint8), np.packbits(enough)))]
            if not enough.any():
                row[-1] = None
            yield pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, COUNTERS.types, strict=True)], schema=COUNTERS)

    return run


def _bucketed(kept: list):
    """Rows of phrases by buckets."""
    if not kept:
        return
    langs, sizes, phrases, counts, buckets = zip(*kept, strict=True)
    bucket = np.concatenate(buckets)
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    lang = pa.concat_arrays([pa.repeat(lang, len(n)) for lang, n in zip(langs, counts, strict=True)])
    size = np.repeat(np.array(sizes, np.int32), [len(n) for n in counts])
    columns = [lang, pa.concat_arrays(phrases), pa.array(size), pa.array(np.concatenate(counts), pa.int64())]
    rows = pa.RecordBatch.from_arrays(columns, schema=COUNTS).take(pa.array(order))
    data = []
    for low, high in zip(starts, np.append(starts[1:], len(order)), strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, COUNTS, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as out:
            out.write_batch(rows.slice(low, high - low))
        data.append(sink.getvalue().to_pybytes())
    yield pa.RecordBatch.from_arrays([pa.array(bucket[order][starts], pa.int32()), pa.array(data, pa.binary())], schema=BUCKETS)


def _left(longest: int, bits: int, buckets: int, sent):
    """A task's counts of the phrases that are left, by buckets of their hashes."""

    def run(batches):
        kept, rows, size_of = [], 0, 0
        for words, skip in _unpacked(batches):
            for size, phrases, chain, n in left_over(words, skip, longest, bits, sent.value):
                kept.append((words.lang, size, phrases, n, ((chain >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)))
                rows, size_of = rows + len(n), size_of + phrases.nbytes
            if rows >= KEPT_ROWS or size_of >= KEPT_BYTES:
                yield from _bucketed(kept)
                kept, rows, size_of = [], 0, 0
        yield from _bucketed(kept)

    return run


def _summed(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by(["lang", "phrase"], use_threads=False).aggregate([("size", "min"), ("n", "sum")])
    return sums.select(["lang", "phrase", "size_min", "n_sum"]).rename_columns(COUNTS.names)


def _at_least(least: int):
    """The phrases of each bucket that occur often enough, as they are."""

    def run(batches):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for _, group in groupby(rows, key=lambda row: row[0]):
            tables, pending, most = [], 0, KEPT_ROWS
            for _, data in group:
                tables.append(pa.ipc.open_stream(data).read_all())
                pending += len(tables[-1])
                if pending > most:
                    tables = [_summed(tables)]
                    pending = len(tables[0])
                    most = max(KEPT_ROWS, 2 * pending)
            sums = _summed(tables)
            yield from sums.filter(pc.greater_equal(sums["n"], least)).cast(COUNTS).to_batches()

    return run


def _count_slots(shards: DataFrame, tasks: int, least: int, longest: int, cycle: int, bits: int) -> dict[int, np.ndarray]:
    """A bit for each slot of each length below ``longest`` that reaches the threshold."""
    spark = shards.sparkSession
    width = 1 << min(bits, RANGE_BITS)
    room = -(-width // 8)
    reached = {size: np.zeros(room << max(0, bits - RANGE_BITS), np.uint8) for size in range(1, longest)}
    past = [reached] * (cycle + 1)  # after each of the last steps
    counters, old, step, last = None, None, 0, -cycle
    while step < cycle or step <= last + cycle:
        used = range(1, longest - 1)  # of which longer ones are counted
        sent = spark.sparkContext.broadcast([{size: known[size] for size in used} for known in (past[-1], past[0])])
        shard = shards.where(F.col("shard") == step % cycle).select("lang", "skip", "volume", "n", "ids", "fresh", "own").coalesce(tasks)
        added = shard.mapInArrow(_step(step, cycle, longest, bits, sent, last >= 0), ADDED_SHAPE)
        if counters is not None:  # words are complete after the first cycle
            added = added.unionByName(counters.drop("reached").where(F.col("size") >= (1 if step < cycle else 2)))
        path = scratch_path(spark, "phrase-counters")
        write(added.repartition("size", "range").sortWithinPartitions("size", "range").mapInArrow(_added(bits, least), COUNTERS_SHAPE), path)
        sent.destroy()
        if old:
            remove(spark, old)
        counters, old = spark.read.schema(COUNTERS_SHAPE).parquet(path), path
        reached = dict(past[-1])
        for size, low, data in counters.where("reached IS NOT NULL").select("size", "range", "reached").collect():  # a bit a slot at most
            if reached[size] is past[-1][size]:
                reached[size] = reached[size].copy()
            reached[size][low * room : (low + 1) * room] = np.frombuffer(pa.decompress(data, room, "zstd"), np.uint8)
        if any((reached[size] != past[-1][size]).any() for size in used):
            last = step
        past = [*past[1:], reached]
        step += 1
    if old:
        remove(spark, old)
    return reached


def count_phrases(documents: DataFrame, least: int = 30, longest: int = LONGEST, cycle: int = CYCLE, bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, n`` of all phrases of up to ``longest`` words that occur ``least`` times or more, and ``lang, n`` of all words.

    Takes ``lang, text``; a null language is ``und``, a null text empty. ``least`` may be 255 at most, the
    range of a counter. ``bits`` fixes the number of slots of a length, which else grows with the text.
    """
    if not 1 <= least <= MOST or cycle < 1:
        raise ValueError("least must be 1 to 255, and a cycle have a step")
    spark = documents.sparkSession
    path = scratch_path(spark, "phrase-shards")
    rows = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    rows.mapInArrow(_worded(cycle, WINDOW), WORDS_SHAPE).write.partitionBy("shard").option("compression", "zstd").parquet(path)
    shards = spark.read.schema(WORDS_SHAPE).parquet(path)
    volume = shards.agg(F.sum("volume")).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, (volume // TEXT_PER_SLOT).bit_length()))
    reached = _count_slots(shards, max(cores, volume // cycle // TASK_TEXT), least, longest, cycle, bits) if longest > 1 else {}
    scanned = shards.select("lang", "skip", "volume", "n", "ids", "fresh", "own", "known").coalesce(max(cores, volume // TASK_TEXT))
    left = scanned.mapInArrow(_left(longest, bits, max(cores, volume // BUCKET_TEXT), spark.sparkContext.broadcast(reached)), BUCKETS_SHAPE)
    counts = saved(left.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_at_least(least), COUNTS_SHAPE), "phrases")
    return counts, shards.groupBy("lang").agg(F.sum(F.col("n") - F.col("skip")).alias("n"))


def _part(start: str, length: str) -> str:
    return f"array_join(slice(words, {start}, {length}), ' ')"


def collocations(documents: DataFrame, least: int = 30, contained_percent: int = 80, first: int = 2000) -> DataFrame:
    """The ``first`` phrases of 2 to 4 words of each language that hold together best.

    Texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, these at spaces and tabs into words, A-Z in lower
    case. A phrase with ``a`` occurrences, cut after k words into parts of ``l`` and ``r`` occurrences, scores
    ``floor(2000000 * a / (l + r))`` at the cut where that is least (ties: least k). Dropped are phrases
    inside a longer one of at least ``least`` occurrences that has ``contained_percent`` of theirs. Returns
    ``lang, rank, phrase, a, l, r, n, score`` (n: words of the language), ranked by score, then a, both
    falling, then phrase. Null languages are ``und``, null and empty texts hold nothing, repeated rows count
    as often as they stand there, other columns are ignored, an empty table gives no rows.
    """
    phrases, totals = count_phrases(documents, least)
    words = phrases.where("size > 1").selectExpr("lang", "phrase", "size", "n AS a", "split(phrase, ' ', -1) AS words")
    cuts = words.selectExpr("lang", "phrase", "a", "words", "size", "explode(sequence(1, size - 1)) AS k")
    cuts = cuts.selectExpr("lang", "phrase", "a", "k", f"{_part('1', 'k')} AS head", f"{_part('k + 1', 'size - k')} AS tail")
    part = phrases.select("lang", "phrase", "n")
    cuts = cuts.join(part.selectExpr("lang", "phrase AS head", "n AS l"), ["lang", "head"]).join(part.selectExpr("lang", "phrase AS tail", "n AS r"), ["lang", "tail"])
    score = "CAST(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS LONG) AS score"
    best = cuts.selectExpr("lang", "phrase", "a", "k", "l", "r", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    inner = words.where("size > 2").selectExpr("lang", "a", "words", "size", "explode(sequence(2, size - 1)) AS length")
    inner = inner.selectExpr("lang", "a", "words", "length", "explode(sequence(1, size - length + 1)) AS start").selectExpr("lang", f"{_part('start', 'length')} AS phrase", "a AS longer")
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    alone = f"longer IS NULL OR CAST(100 AS DECIMAL(3,0)) * CAST(longer AS DECIMAL(19,0)) < CAST({int(contained_percent)} AS DECIMAL(3,0)) * CAST(a AS DECIMAL(19,0))"
    left = best.join(inner, ["lang", "phrase"], "left").where(alone).selectExpr("lang", "phrase", "a", "best.l AS l", "best.r AS r", "best.score AS score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    left = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    left = left.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= first)
    ranked = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
