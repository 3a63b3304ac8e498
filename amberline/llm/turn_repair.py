"""Repair of conversation structure: the cheapest edits to ``s?(ua)+`` by block tables (Four Russians).

A row's fault and role make it one of nine symbols. What the rest of a conversation costs from each of
four states is a vector; less its least entry, only a few dozen vectors occur, as any state reaches any
other's rest with a few edits. For every such vector and every block of ``BLOCK`` symbols a table holds
the vector before the block and what was taken off. A conversation is read backward by lookups, one a
block; then blocks are expanded backward again, symbol by symbol, and traced forward, taking at each
place the ASCII-least edit that is still cheapest. As an edit and a state name the next state, this
gives the least edit string of all cheapest ones.

Conversations are cut into pieces of bounded size along one global order, so a long one is many tasks'
work: each full piece is also one function from vector to vector, and from state to state once its vector
is known, and only these functions meet by conversation.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amberline.llm.common import saved

# What edits cost, and the letters of roles and edits.
KEEP, REROLE, DELETE, INSERT, UNDELETED_TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"s": "system", "u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
END_MARKS = ".!?"
SPACES = " \t\n\x0b\x0c\r"

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: 0 must go; 1 to 4 are system, user, assistant and other rows, 5 to 8 the same truncated.
SYMBOLS = 9
BLOCK = 4
#: Rows, and about as many bytes of text, that a piece of a conversation holds at most.
PIECE = 4096
PIECE_BYTES = 4 << 20
#: State after an output of user or assistant.
GROWN = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}


def _kept(state: int, symbol: int) -> int | None:
    """The state after a row that stays as it is."""
    role = (symbol - 1) % 4
    if role == 0:
        return SYSTEM if state == EMPTY else None
    return (USER, ASSISTANT)[role - 1] if role < 3 and GROWN[state] == (USER, ASSISTANT)[role - 1] else None


def _inserted(plain: list[float]) -> tuple[float, ...]:
    """Costs where rows may be inserted first."""
    user, assistant = min(plain[USER], INSERT + plain[ASSISTANT]), min(plain[ASSISTANT], INSERT + plain[USER])
    return min(plain[EMPTY], INSERT + user), min(plain[SYSTEM], INSERT + user), user, assistant


def _before(after: tuple[float, ...], symbol: int) -> tuple[float, ...]:
    """Costs from each state before a row, given those after it."""
    plain = []
    for state in range(4):
        costs = [DELETE + after[state]]
        if symbol:
            extra = UNDELETED_TRUNCATED if symbol > 4 else 0
            costs.append(REROLE + extra + after[GROWN[state]])
            if (kept := _kept(state, symbol)) is not None:
                costs.append(KEEP + extra + after[kept])
        plain.append(min(costs))
    return _inserted(plain)


class Tables:
    """All normalised vectors, and transitions by blocks of 1 to ``BLOCK`` symbols."""

    def __init__(self):
        infinite = float("inf")
        end = _inserted([0, infinite, infinite, 0])
        self.vectors, steps, known, at = [end], [], {end: 0}, 0
        while at < len(self.vectors):
            row = []
            for symbol in range(SYMBOLS):
                found = _before(self.vectors[at], symbol)
                low = min(found)
                normal = tuple(x - low for x in found)
                if normal not in known:
                    known[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append(known[normal])
            steps.append(row)
            at += 1
        one = np.array(steps, np.int16)
        self.steps = [np.arange(len(one), dtype=np.int16)[:, None], one]
        for _ in range(BLOCK - 1):  # a block's last symbol is taken first
            longer = self.steps[-1][one]
            self.steps.append(longer.transpose(0, 2, 1).reshape(len(one), -1))
        self.traces: dict = {}

    def codes(self, symbols: bytes) -> tuple[list[int], int, int]:
        """The symbols as numbers of whole blocks, and the rest's number and length."""
        values = np.frombuffer(symbols, np.uint8).astype(np.int64)
        rest = len(values) % BLOCK
        power = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
        left = values[len(values) - rest :]
        return (values[: len(values) - rest].reshape(-1, BLOCK) @ power).tolist(), int(left @ power[BLOCK - rest :]), rest

    def back(self, symbols: bytes, vector):
        """The vectors (one, or an array of them) after each block, from the last, and before all of them."""
        blocks, left, rest = self.codes(symbols)
        vectors = [vector]
        if rest:
            vectors.append(self.steps[rest][vector, left])
        whole = self.steps[BLOCK]
        for code in reversed(blocks):
            vectors.append(whole[vectors[-1], code])
        return vectors

    def trace(self, vector: int, length: int, code: int) -> list[tuple[str, str, int]]:
        """For each state before a block: its edits, what becomes of the rows, and the state after it."""
        key = (vector, length, code)
        if key not in self.traces:
            symbols = [code // SYMBOLS**i % SYMBOLS for i in range(length - 1, -1, -1)]
            after = [vector]
            for symbol in reversed(symbols[1:]):
                after.append(int(self.steps[1][after[-1], symbol]))
            found = []
            for state in range(4):
                edits, outs = [], []
                for symbol, rest in zip(symbols, reversed(after), strict=True):
                    state = _edit(self.vectors[rest], symbol, state, edits, outs)
                found.append(("".join(edits), "".join(outs), state))
            self.traces[key] = found
        return self.traces[key]

    def walk(self, symbols: bytes, vector: int, state: int, last: bool = False) -> tuple[str, str, int]:
        """Edits of a piece from a state, given the vector after it; the last piece ends with what must be added."""
        blocks, left, rest = self.codes(symbols)
        after = [int(v) for v in self.back(symbols, vector)[:-1]][::-1]
        parts = [(BLOCK, code) for code in blocks] + ([(rest, left)] if rest else [])
        edits, outs = [], []
        for (length, code), then in zip(parts, after, strict=True):
            edit, out, state = self.trace(then, length, code)[state]
            edits.append(edit)
            outs.append(out)
        while last and state in (SYSTEM, USER):
            state = GROWN[state]
            edits.append("I")
            outs.append("u" if state == USER else "a")
        return "".join(edits), "".join(outs), state


def _edit(after: tuple[float, ...], symbol: int, state: int, edits: list[str], outs: list[str]) -> int:
    """The least cheapest edits of one row and of what is inserted before it; the state after it."""
    costs = _before(after, symbol)
    extra = UNDELETED_TRUNCATED if symbol > 4 else 0
    while True:
        grown, left = GROWN[state], costs[state]
        letter = "u" if grown == USER else "a"
        if DELETE + after[state] == left:
            edits.append("D")
            outs.append("-")
            return state
        if INSERT + costs[grown] == left:
            edits.append("I")
            outs.append(letter)
            state = grown
            continue
        kept = _kept(state, symbol)
        if kept is not None and KEEP + extra + after[kept] == left:
            edits.append("K")
            outs.append("=")
            return kept
        edits.append("R")
        outs.append(letter)
        return grown


@cache
def tables() -> Tables:
    return Tables()


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with rows dropped, emptied, cut short, repeated and given to the user.

    What happens goes by ``crc32("conv_id:turn") % 20``; null values of any of the four count as one space
    there, and null roles and texts become one space.
    """
    kind = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", END_MARKS, "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = rows.where("kind <> 0").withColumn("copy", copies)
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


CUT = pa.schema(
    [("part", pa.int32()), ("nth", pa.int32()), ("conv_id", pa.int64()), ("symbols", pa.binary()), ("jump", pa.binary()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
    + [("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("opening", pa.string()), ("closing", pa.string())]
    + [("least", pa.int64()), ("most", pa.int64()), ("turns", pa.int64())]
)
CUT_SHAPE = (
    "part int, nth int, conv_id long, symbols binary, jump binary, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, "
    "illegal long, opening string, closing string, least long, most long, turns long"
)
FIGURES = ["blank", "duplicate", "truncated", "illegal", "opening", "closing", "least", "most", "turns"]


def _batch(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), shape, strict=True)], schema=shape)


class _Piece:
    def __init__(self, conv_id):
        self.conv_id, self.symbols, self.roles, self.texts, self.size = conv_id, bytearray(), [], [], 0
        self.counts, self.illegal, self.before, self.least, self.most, self.turns = {"blank": 0, "duplicate": 0, "truncated": 0}, 0, None, None, None, 0

    def add(self, turn, role, text, fault):
        if fault:
            self.counts[fault] += 1
        kind = "sua".find(role[:1]) if role else 3
        self.symbols.append(0 if fault in ("blank", "duplicate") else 1 + (kind if kind >= 0 else 3) + 4 * (fault == "truncated"))
        if self.roles and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.most:
            self.least, self.most, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)

    def done(self, part: int, nth: int, full: bool = False) -> tuple:
        jump, symbols = None, bytes(self.symbols)
        if full:
            every = np.arange(len(tables().vectors), dtype=np.int16)
            jump = tables().back(symbols, every)[-1].tobytes()
        ends = self.roles[0][:1], self.before
        return part, nth, self.conv_id, symbols, jump, self.roles, self.texts, *self.counts.values(), self.illegal, *ends, self.least, self.most, self.turns


def _cut(most: int, most_bytes: int):
    """Pieces of the sorted rows; a row behind a mark of its own repeats an earlier one."""

    def run(batches):
        part, nth, piece, marked, out, size = TaskContext.get().partitionId(), 0, None, None, [], 0
        for batch in batches:
            for conv_id, turn, role, line, is_row, text, blank, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not is_row:
                    marked = line
                    continue
                full = piece is not None and (len(piece.roles) >= most or piece.size >= most_bytes)
                if piece is not None and (full or conv_id != piece.conv_id):
                    out.append(piece.done(part, nth, full))
                    size += piece.size
                    nth, piece = nth + 1, None
                    if len(out) >= PIECE or size >= most_bytes:
                        yield _batch(out, CUT)
                        out, size = [], 0
                if piece is None:
                    piece = _Piece(conv_id)
                piece.add(turn, role, text, "blank" if blank else "duplicate" if marked == line else "truncated" if cut else None)
        if piece is not None:
            out.append(piece.done(part, nth))
        if out:
            yield _batch(out, CUT)

    return run


def _backward(batches):
    """From the last piece of each conversation to the first: the vector after each."""
    shape = pa.schema([("part", pa.int32()), ("nth", pa.int32()), ("conv_id", pa.int64()), ("vector", pa.int32()), ("last", pa.bool_())])
    now, vector = object(), 0
    for batch in batches:
        out = []
        for conv_id, part, nth, symbols, jump in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            last = conv_id != now
            now, vector = conv_id, 0 if last else vector
            out.append((part, nth, conv_id, vector, last))
            vector = int(np.frombuffer(jump, np.int16)[vector] if jump else tables().back(symbols, vector)[-1])
        if out:
            yield _batch(out, shape)


def _states(batches):
    """The state after a piece, for each state before it."""
    shape = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("nth", pa.int32()), ("vector", pa.int32()), ("last", pa.bool_()), ("ends", pa.list_(pa.int32()))])
    for batch in batches:
        out = []
        for conv_id, part, nth, vector, last, symbols in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            out.append((conv_id, part, nth, vector, last, [tables().walk(symbols, vector, state)[2] for state in range(4)]))
        if out:
            yield _batch(out, shape)


def _forward(batches):
    """From the first piece of each conversation to the last: the state before each."""
    shape = pa.schema([("part", pa.int32()), ("nth", pa.int32()), ("vector", pa.int32()), ("last", pa.bool_()), ("state", pa.int32())])
    now, state = object(), EMPTY
    for batch in batches:
        out = []
        for conv_id, part, nth, vector, last, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            state = state if conv_id == now else EMPTY
            now = conv_id
            out.append((part, nth, vector, last, state))
            state = ends[state]
        if out:
            yield _batch(out, shape)


PIECES_SHAPE = (
    "conv_id long, part int, nth int, whole boolean, audit string, cost long, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, "
    "illegal long, opening string, closing string, least long, most long, turns long"
)
_PIECES = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("nth", pa.int32()), ("whole", pa.bool_()), ("audit", pa.string()), ("cost", pa.int64())]
    + [CUT.field(name) for name in ("roles", "texts", *FIGURES)]
)
_COSTS = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}


def _edited(batches):
    for batch in batches:
        out = []
        for conv_id, part, nth, whole, vector, last, state, symbols, roles, texts, *figures in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            audit, becomes, _ = tables().walk(symbols, vector, state, last)
            at, cost, new_roles, new_texts = 0, 0, [], []
            for edit, role in zip(audit, becomes, strict=True):
                cost += _COSTS[edit]
                if edit == "I":
                    new_roles.append(ROLES[role])
                    new_texts.append("")
                    continue
                if edit != "D":
                    cost += UNDELETED_TRUNCATED if symbols[at] > 4 else 0
                    new_roles.append(roles[at] if edit == "K" else ROLES[role])
                    new_texts.append(texts[at])
                at += 1
            out.append((conv_id, part, nth, whole, audit, cost, new_roles, new_texts, *figures))
        if out:
            yield _batch(out, _PIECES)


def repair(conversations: DataFrame) -> DataFrame:
    """The cheapest repair of each conversation, in pieces that each hold a bounded part of one.

    Takes rows ``conv_id, turn, role, text``; other columns are ignored, null roles and texts count as one
    space, rows without an id are one conversation. Rows go by turn (nulls first), those of one turn by
    role and then by the MD5 of their text, equal rows behind each other. A row is blank, else a duplicate
    (role and text stand earlier in the conversation), else truncated (its last character that is not
    white space is none of ``.!?``), or without fault.

    Returns per piece ``conv_id, part, nth`` (pieces of a conversation in order), ``whole`` (the only
    one), ``audit`` (its edits), ``cost``, ``roles`` and ``texts`` after repair, and figures of the rows
    before it: ``blank, duplicate, truncated, illegal`` (adjacent role initials that are not su, ua or au),
    ``opening`` and ``closing`` initials, ``least`` and ``most`` turn, ``turns`` (distinct, without null).
    An empty table gives no pieces. Very long conversations take as many pieces as they need.
    """
    spark = conversations.sparkSession
    bare = F.rtrim("text", F.lit(SPACES))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.select("*", F.md5("text").alias("key"), F.monotonically_increasing_id().alias("line"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(*END_MARKS)).alias("cut"))
    rows = saved(rows, "turns")
    slim = rows.select("conv_id", "turn", "role", "key", "line")
    again = slim.groupBy("conv_id", "role", "key").agg(F.min(F.struct("turn", "line")).alias("first"), F.count("*").alias("n")).where("n > 1")
    same = F.col("slim.conv_id").eqNullSafe(F.col("again.conv_id")) & (F.col("slim.role") == F.col("again.role")) & (F.col("slim.key") == F.col("again.key"))
    later = slim.alias("slim").join(again.alias("again"), same).where("slim.line <> again.first.line").select("slim.*")
    marks = later.select("*", F.lit(False).alias("is_row"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("boolean").alias("blank"), F.lit(None).cast("boolean").alias("cut"))
    both = rows.withColumn("is_row", F.lit(True)).unionByName(marks)
    order = ["conv_id", "turn", "role", "key", "line"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartitionByRange(parts, *order).sortWithinPartitions(*order, "is_row")
    cut = saved(both.select("conv_id", "turn", "role", "line", "is_row", "text", "blank", "cut").mapInArrow(_cut(PIECE, PIECE_BYTES), CUT_SHAPE), "conversation-pieces")

    many = cut.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("long_id"))
    several = cut.select("conv_id", "part", "nth", "symbols", "jump").join(many, F.col("conv_id").eqNullSafe(F.col("long_id"))).drop("long_id")
    several = several.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("nth"))
    after = saved(several.mapInArrow(_backward, "part int, nth int, conv_id long, vector int, last boolean"), "piece-vectors")
    known = after.join(cut.select("part", "nth", "symbols"), ["part", "nth"]).select("conv_id", "part", "nth", "vector", "last", "symbols")
    ends = known.mapInArrow(_states, "conv_id long, part int, nth int, vector int, last boolean, ends array<int>")
    ends = ends.repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth")
    starts = saved(ends.mapInArrow(_forward, "part int, nth int, vector int, last boolean, state int"), "piece-states")

    placed = cut.join(starts, ["part", "nth"], "left").select(
        "conv_id",
        "part",
        "nth",
        F.col("vector").isNull().alias("whole"),
        F.coalesce("vector", F.lit(0)).alias("vector"),
        F.coalesce("last", F.lit(True)).alias("last"),
        F.coalesce("state", F.lit(EMPTY)).alias("state"),
        "symbols",
        "roles",
        "texts",
        *FIGURES,
    )
    return placed.mapInArrow(_edited, PIECES_SHAPE)


DIGEST_SHAPE = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_DIGEST = pa.schema(
    [("conv_id", pa.int64())] + [(name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.sums, self.audit, self.hash, self.empty = conv_id, np.zeros(5, np.int64), [], hashlib.sha256(), True
        self.before, self.least, self.most, self.turns = None, None, None, 0

    def add(self, audit, cost, roles, texts, blank, duplicate, truncated, illegal, opening, closing, least, most, turns):
        met = self.before is not None and self.before + opening not in LEGAL
        self.sums += np.array([blank, duplicate, truncated, illegal + met, cost])
        self.before = closing
        if turns:
            self.turns += turns - (least == self.most)
            self.least, self.most = least if self.least is None else self.least, most
        self.audit.append(audit)
        if roles:
            lines = "\n".join(f"{role}:{text}" for role, text in zip(roles, texts, strict=True))
            self.hash.update((lines if self.empty else "\n" + lines).encode())
            self.empty = False

    def done(self) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, *self.sums.tolist(), "".join(self.audit), self.hash.hexdigest()


def _digests(batches):
    now = None
    for batch in batches:
        out = []
        for conv_id, *piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    out.append(now.done())
                now = _Digest(conv_id)
            now.add(*piece)
        if out:
            yield _batch(out, _DIGEST)
    if now is not None:
        yield _batch([now.done()], _DIGEST)


def digests(pieces: DataFrame, conversations: DataFrame) -> DataFrame:
    """Per conversation of ``conversations`` the figures, edits and SHA-256 of the repaired rows.

    Pieces of a long conversation stream through one task in order, as the hash asks for, one piece in memory
    at a time. Conversations without pieces have zeros, no edits and the hash of the empty text.
    """
    given = pieces.select("conv_id", "part", "nth", "whole", "audit", "cost", "roles", "texts", *FIGURES)
    whole = given.where("whole").drop("part", "nth", "whole").mapInArrow(_digests, DIGEST_SHAPE)
    cut = given.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth")
    found = whole.unionByName(cut.drop("part", "nth", "whole").mapInArrow(_digests, DIGEST_SHAPE)).withColumnRenamed("conv_id", "found_id")
    ids = conversations.select("conv_id").distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    zeros = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage the conversations, repair them, and give the digest of each; the pieces are saved between."""
    return digests(saved(repair(damage(conversations)), "repaired"), conversations)
