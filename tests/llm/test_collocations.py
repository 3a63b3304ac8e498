"""Phrase mining against counting everything in plain Python."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from amberline.llm import collocations
from amberline.llm.collocations import count_phrases, parts
from tests.llm.helpers import ODD, clashing, docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows, longest=4):
    found = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                found["und" if lang is None else lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return found


def brute(rows, least=30, first=2000):
    out = []
    for lang, f in counts(rows).items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        good = {k: v for k, v in f.items() if len(k) > 1 and v >= least}
        inside = Counter()
        for k, v in good.items():
            for size in range(2, len(k)):
                for i in range(len(k) - size + 1):
                    inside[k[i : i + size]] = max(inside[k[i : i + size]], v)
        ranked = []
        for k, a in good.items():
            score, _, left, right = min((2_000_000 * a // (f[k[:i]] + f[k[i:]]), i, f[k[:i]], f[k[i:]]) for i in range(1, len(k)))
            if not 100 * inside[k] >= 80 * a:
                ranked.append((-score, -a, " ".join(k).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in frame.collect())


def pairs(frame):
    return [(r.lang, r.text) for r in frame.select("lang", "text").collect()]


def test_table_equals_brute_force(spark, data):
    given = spark.read.parquet(f"{data}/documents.parquet")
    want = brute(pairs(given))
    assert len(want) > 200
    assert got(collocations.collocations(clashing(given))) == want
    assert got(collocations.collocations(given, least=6, first=50)) == brute(pairs(given), 6, 50)


@pytest.mark.parametrize("bits,window,cycle", [(12, 700, 4), (20, 8 << 20, 1), (6, 3000, 7)])
def test_counts_whatever_slots_windows_and_cycle(spark, data, monkeypatch, bits, window, cycle):
    monkeypatch.setattr(collocations, "WINDOW", window)
    given = spark.read.parquet(f"{data}/documents.parquet").where("doc_id < 300")
    phrases, totals = count_phrases(given, 30, cycle=cycle, bits=bits)
    want = counts(pairs(given))
    assert {(r.lang, tuple(r.phrase.split(" ")), r.size, r.n) for r in phrases.collect()} == {(lang, k, len(k), n) for lang, f in want.items() for k, n in f.items() if n >= 30}
    assert {r.lang: r.n for r in totals.collect()} == {lang: sum(n for k, n in f.items() if len(k) == 1) for lang, f in want.items()}


def odd():
    chance = random.Random(6)
    words = ["New", "york", "city", "hall", "a", "b", "x\x1cy", "é", "日本", " ", "\x85", "or "]
    rows = [(i, "".join(chance.choice(words) + chance.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]) for _ in range(60))) for i in range(100, 200)]
    rows += [(200, "the end of the end of " * 40_000), (201, "x" * 100_000 + " tail end"), (202, "same words " * 20), (202, "same words " * 20)]
    return rows


def test_odd_rows(spark):
    frame = docs(spark, [*ODD, *odd()])
    mixed = frame.selectExpr("doc_id", "text", "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN 'und' WHEN doc_id % 5 = 2 THEN '' ELSE lang END AS lang")
    want = brute(pairs(mixed))
    assert {w[0] for w in want} == {"und", ""}
    assert got(collocations.collocations(clashing(mixed))) == want
    assert got(collocations.collocations(clashing(mixed), least=2, first=7)) == brute(pairs(mixed), 2, 7)
    assert got(collocations.collocations(frame.limit(0))) == []
    assert got(collocations.collocations(docs(spark, [(1, None), (2, " .\n")]))) == []


def test_one_phrase_in_every_document(spark):
    rows = [(i, "a very common pair " * 30 + f"w{i}") for i in range(400)]
    assert got(collocations.collocations(docs(spark, rows))) == brute([("en", t) for _, t in rows])


def test_parts_hold_every_phrase_once():
    chance = random.Random(7)
    for window in (10, 37, 200):
        for _ in range(60):
            text = "".join(chance.choice(["ab", "c", "defghijklmnop", " ", " ", "\t", ". ", "\n"]) for _ in range(chance.randrange(300)))
            found = Counter()
            for part, skip in parts(text.encode(), window):
                seen = counts([("en", part.decode())])["en"]
                head = counts([("en", " ".join(part.decode().split(" ")[:skip]))])["en"] if skip else Counter()
                found.update(seen)
                found.subtract(head)
            assert +found == counts([("en", text)])["en"]


def test_least_must_fit_a_counter(spark):
    with pytest.raises(ValueError):
        count_phrases(docs(spark, []), least=256)


def test_memory_of_a_scan_is_bounded_by_its_window():
    """Many different words, which take the most to hash, of a batch much larger than a window."""
    texts = [" ".join(f"w{i}x{k}" for k in range(40_000)) for i in range(40)]
    batch = pa.record_batch({"lang": ["en"] * len(texts), "text": texts})
    tracemalloc.start()
    for _, words, _ in collocations._by_window([batch], collocations.WINDOW):
        assert len(words.known)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20


def test_scans_end_when_every_length_is_complete(spark, data, monkeypatch):
    """Slots that lengths share would start phrases anew, and texts be scanned again and again."""
    steps, step = [], collocations._step
    monkeypatch.setattr(collocations, "_step", lambda *args: steps.append(args[0]) or step(*args))
    given = spark.read.parquet(f"{data}/documents.parquet").where("doc_id < 300")
    phrases, _ = count_phrases(given, 30, bits=12)
    assert {(r.lang, r.phrase, r.n) for r in phrases.collect()} == {(lang, " ".join(k), n) for lang, f in counts(pairs(given)).items() for k, n in f.items() if n >= 30}
    assert len(steps) <= collocations.CYCLE * (collocations.LONGEST - 1)


def test_what_tasks_send_is_added_up_by_ranges():
    chance, bits = np.random.default_rng(5), 18
    found = [(size, chance.integers(0, 1 << bits, 5000).astype(np.int32)) for size in (1, 2, 2, 3)] + [(2, np.full(400, 7, np.int32))]
    sent = pa.Table.from_batches([b for size, slots in found for b in collocations._sent({size: [(slots, np.ones(len(slots), np.int64))]})])
    rows = list(collocations._added(bits, 2)(sent.sort_by([("size", "ascending"), ("range", "ascending")]).to_batches()))
    # and once more, with the sums in place of what was sent
    again = pa.Table.from_batches(rows).drop_columns("reached").to_batches()
    for batches in (rows, list(collocations._added(bits, 2)(again))):
        assert sum(b.num_rows for b in batches) == 3 * 4
        for row in pa.Table.from_batches(batches).to_pylist():
            slots = np.concatenate([s for size, s in found if size == row["size"]])
            want = np.bincount(slots[slots >> 16 == row["range"]] & 65535, minlength=65536)
            assert (np.frombuffer(pa.decompress(row["data"], 65536, "zstd"), np.uint8) == np.minimum(want, 255)).all()
            if (want >= 2).any():
                assert (np.unpackbits(np.frombuffer(pa.decompress(row["reached"], 8192, "zstd"), np.uint8)) == (want >= 2)).all()


def test_phrases_of_one_hash_are_counted_apart():
    words = collocations.Words.of("en", b"a b a c a b a c b")
    at = np.arange(8)
    for chain in (np.zeros(8, np.uint64), np.array([1, 2, 3, 2, 1, 2, 3, 4], np.uint64)):  # of "b a" and "c a" one
        first, n = words.counted(at, chain, 2)
        assert dict(zip(words.texts(at[first], 2).to_pylist(), n.tolist(), strict=True)) == {"a b": 2, "b a": 2, "a c": 2, "c a": 1, "c b": 1}


def test_words_come_back_as_they_were_packed():
    for text in (b"", b" .", "Ein Satz, é\x1c z; ein".encode(), b" ".join(b"w%d" % i for i in range(70_000))):
        words = collocations.Words.of("de", text)
        back, skip = next(collocations._unpacked([words.packed(1, 3).drop_columns("shard")]))
        assert (back.lang, back.volume, skip) == ("de", len(text), 3)
        assert all((getattr(back, name) == getattr(words, name)).all() for name in ("ids", "fresh", "own"))
        assert back.known.to_pylist() == words.known.to_pylist()
