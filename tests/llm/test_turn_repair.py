"""Structure repair against enumeration of all edits and against plain dynamic programming."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from amberline.llm import turn_repair
from amberline.llm.turn_repair import damage, digests, repair, repair_damaged, tables
from tests.llm.helpers import clashing

ROWS = "conv_id long, turn long, role string, text string"
WORDS = re.compile(r"[^\x20\x09-\x0D]")


def enumerated(symbols):
    """Every edit of every row with up to two inserted rows at each place."""
    best = None
    inserts = ["", "u", "a", "ua", "au"]
    for places in itertools.product(inserts, repeat=len(symbols) + 1):
        for edits in itertools.product("DKua", repeat=len(symbols)):
            cost, audit, out = 0, "", ""
            for i, symbol in enumerate(symbols):
                cost, audit, out = cost + 5 * len(places[i]), audit + "I" * len(places[i]), out + places[i]
                if edits[i] == "D":
                    cost, audit = cost + 2, audit + "D"
                    continue
                if not symbol:
                    break
                cost += (5 if symbol > 4 else 0) + (edits[i] != "K")
                audit, out = audit + ("K" if edits[i] == "K" else "R"), out + ("suao"[(symbol - 1) % 4] if edits[i] == "K" else edits[i])
            else:
                cost, audit, out = cost + 5 * len(places[-1]), audit + "I" * len(places[-1]), out + places[-1]
                if re.fullmatch("(s?(ua)+)?", out) and (best is None or (cost, audit) < best[:2]):
                    best = (cost, audit, out)
    return best


def planned(symbols):
    """The least (cost, edits) by memoised search over places and outputs, one edit at a time."""

    @cache
    def best(i, last, room):
        found = []
        if i == len(symbols):
            if last in ("", "a"):
                found.append((0, "", ""))
        else:
            symbol = symbols[i]
            found.append(add(2, "D", "", best(i + 1, last, 2)))
            if symbol:
                extra = 5 if symbol > 4 else 0
                own = "suao"[(symbol - 1) % 4]
                for letter, edit, cost in ((own, "K", 0), ("u", "R", 1), ("a", "R", 1)):
                    if last + letter in ("s", "u", "su", "ua", "au"):
                        found.append(add(cost + extra, edit, letter, best(i + 1, letter, 2)))
        if room:
            for letter in "ua":
                if last + letter in ("u", "su", "ua", "au"):
                    found.append(add(5, "I", letter, best(i, letter, room - 1)))
        return min((f for f in found if f), default=None)

    def add(cost, edit, letter, rest):
        return rest and (cost + rest[0], edit + rest[1], letter + rest[2])

    return best(0, "", 2)


def outcome(symbols):
    audit, becomes, _ = tables().walk(bytes(symbols), 0, 0, True)
    cost, out, at = 0, "", 0
    for edit, letter in zip(audit, becomes, strict=True):
        cost += {"K": 0, "R": 1, "D": 2, "I": 5}[edit] + (5 if edit in "KR" and symbols[at] > 4 else 0)
        out += "suao"[(symbols[at] - 1) % 4] if edit == "K" else letter if edit in "RI" else ""
        at += edit != "I"
    return cost, audit, out


def test_tables_equal_enumeration():
    chance = random.Random(1)
    cases = [list(c) for n in range(3) for c in itertools.product(range(9), repeat=n)] + [[chance.randrange(9) for _ in range(3)] for _ in range(25)]
    for symbols in cases:
        assert outcome(symbols) == enumerated(symbols) == planned(tuple(symbols)), symbols


def test_tables_equal_dynamic_programming():
    chance = random.Random(2)
    for _ in range(1500):
        symbols = [chance.choice((0, 1, 2, 2, 3, 3, 4, 5, 6, 7, 8)) for _ in range(chance.randrange(23))]
        assert outcome(symbols) == planned(tuple(symbols)), symbols


def as_rows(given):
    """Conversations after damage, as the contract says it."""
    out = {}
    for conv_id, turn, role, text in given:
        rows = out.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            rows += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return out


def expected(conversations):
    result = {}
    for conv_id, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, symbols, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            words = WORDS.findall(text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            kind = "sua".find(role[:1]) if role else -1
            symbols.append(0 if fault in ("blank", "duplicate") else 1 + (kind if kind >= 0 else 3) + 4 * (fault == "truncated"))
        turns = {t for t, *_ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, letters = planned(tuple(symbols))
        lines, at = [], 0
        for edit in audit:
            if edit != "D":
                role = {"s": "system", "u": "user", "a": "assistant"}[letters[len(lines)]]
                lines.append(":".join((role, "")) if edit == "I" else f"{rows[at][1] if edit == 'K' else role}:{rows[at][2]}")
            at += edit != "I"
        result[conv_id] = (conv_id, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(frame):
    assert frame.columns == COLUMNS
    rows = [tuple(r) for r in frame.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r for r in rows}


@pytest.mark.parametrize("piece,size", [(4096, 4 << 20), (3, 4 << 20), (4096, 400)])
def test_table_equals_brute_force(spark, data, monkeypatch, piece, size):
    monkeypatch.setattr(turn_repair, "PIECE", piece)
    monkeypatch.setattr(turn_repair, "PIECE_BYTES", size)
    given = spark.read.parquet(f"{data}/conversations.parquet")
    want = expected(as_rows([tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]))
    assert got(repair_damaged(clashing(given).withColumn("vector", given.turn).withColumn("key", given.text))) == want


def odd_rows():
    chance = random.Random(4)
    rows = [(None, None, None, None), (None, 3, "user", "Yes."), (None, 3, "user", "Yes."), (1, None, "system", None), (1, None, "system", "Be kind."), (2, 5, "", "x.")]
    rows += [(3, t, "user", " \t\n ") for t in range(5)] + [(4, 7, "tool", "Same."), (4, 7, "tool", "Same."), (4, 7, "tool", "Other?")]
    rows += [(5, t % 4, chance.choice(["user", "assistant", "system", "tool", "User", None]), chance.choice(["Ja!", "no", "", "Si. \n", "日本語。", None])) for t in range(60)]
    rows += [(6, 2 * t, ("user", "assistant")[t % 2], f"Turn {t}." if t % 7 else "Turn") for t in range(300)]
    rows += [(7, 1, "user", "Long words. " * 50_000), (7, 2, "assistant", "long " * 50_000)]
    rows += [(8, 1, "user", "copy.")] * 200 + [(9, t, "user", "copy.") for t in range(200)]
    return rows


@pytest.mark.parametrize("piece", [4096, 5])
def test_odd_rows(spark, monkeypatch, piece):
    monkeypatch.setattr(turn_repair, "PIECE", piece)
    rows = odd_rows()
    frame = spark.createDataFrame(rows, ROWS)
    want = expected(as_rows(rows))
    assert {r[0] for r in rows} == set(want)
    assert got(repair_damaged(clashing(frame))) == want
    plain = {}
    for conv_id, turn, role, text in rows:
        plain.setdefault(conv_id, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got(digests(repair(clashing(frame)), frame)) == expected(plain)


def test_repaired_rows_stand_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "PIECE", 4)
    rows = [(1, t, "user", f"Line {t}.") for t in range(10)]
    pieces = sorted(repair(spark.createDataFrame(rows, ROWS)).collect(), key=lambda r: (r.part, r.nth))
    assert len(pieces) >= 3 and not any(p.whole for p in pieces) and max(len(p.roles) for p in pieces) <= 4
    roles = [role for p in pieces for role in p.roles]
    assert roles == ["user", "assistant"] * 5 and sum(p.cost for p in pieces) == 5
    assert [text for p in pieces for text in p.texts] == [f"Line {t}." for t in range(10)]


def test_damage_and_empty_table(spark):
    rows = odd_rows()
    changed = {}
    for r in damage(spark.createDataFrame(rows, ROWS)).collect():
        changed.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    order = lambda found: {k: sorted(v, key=repr) for k, v in found.items() if v}
    assert order(changed) == order(as_rows(rows))
    empty = spark.createDataFrame([], ROWS)
    assert repair(empty).collect() == [] and repair_damaged(empty).collect() == []
