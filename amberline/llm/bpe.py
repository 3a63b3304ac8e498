"""Byte-level BPE as a finite-state transducer, made deterministic as texts need it.

The transducer's states are sets of hypotheses (bytes of an unfinished token, token before it,
tokens not yet sure). A token ends a hypothesis if merging it with the token before gives exactly
these two; a sequence is the one that the merges give if each neighbouring pair is such. Reading a
byte extends or drops hypotheses; what all of them agree on is emitted at once, so output lags by
no more than the longest token. A state's step for a byte is worked out when first met and kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from amberline.llm.common import slices, texts

STATES = 300_000
PIECES = 500_000
PAIRS = 500_000
NEVER = 1 << 60
DECODE = 4096
SLICE_BYTES = 8 << 20
BYTES = [bytes((i,)) for i in range(256)]
#: The tokenizers' white space is Unicode's.
WHITE_SPACE = r"\p{White_Space}"
#: Characters for which the classes of Python's own, faster expressions are not those of the pattern, or might not be.
_UNLIKE = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]")


@lru_cache(2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: token for token, i in ranks.items()}
        # For every beginning of a token: twice its id (0: no token) and 1 if a longer token begins so.
        self.nodes = {token: 2 * (i + 1) for token, i in ranks.items()}
        for token in ranks:
            for k in range(1, len(token)):
                self.nodes[token[:k]] = self.nodes.get(token[:k], 0) | 1
        self.pairs: dict[int, bool] = {}
        self.edges: tuple[dict, dict] = {}, {}
        self._reset()

    def _reset(self) -> None:
        start = ((b"", -1, ()),)
        self.states, self.numbers, self.steps = [start], {start: 0}, {}

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges turn the joined bytes of two tokens into these two; left -1: of the right one alone into it."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        """The merges go by ascending rank, as a merge needs its parts first. So until something crosses the
        border, it lies between the last part of the left token and the first of the right one, which grow by
        their own merges; what counts is whether a merge of the two comes before both of theirs."""
        ends = self._edge(left, 1) if left >= 0 else None, self._edge(right, 0)
        if not ends[1] or left >= 0 and not ends[0]:
            return False  # a token that its own merges don't give
        i = j = 0
        while left >= 0:
            (part, mine), (other, its) = ends[0][i], ends[1][j]
            rank = self.ranks.get(part + other)
            if rank is not None and rank < mine and rank <= its:
                return False
            if mine == its == NEVER:
                break
            if mine <= its:
                i += 1
            else:
                j += 1
        return True

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The first (side 0) or last (1) part of a token from a byte on, as its merges make it grow, each with the rank of its next merge."""
        known = self.edges[side].get(token)
        if known is None:
            known = [(self.tokens[token], NEVER)]
            while known and len(known[-1][0]) > 1:
                whole = known[-1][0]
                parts = self._halves(whole)
                known = [*known, (parts[side], self.ranks[whole])] if parts else []
            known.reverse()
            self.edges[side][token] = known
        return known

    def _halves(self, token: bytes) -> list[bytes]:
        """The two parts of a token's last merge; none if its merges end otherwise."""
        parts, limit, rank = [BYTES[b] for b in token], self.ranks[token], self.ranks.get
        while len(parts) > 2:
            best = min((r, i) for i in range(len(parts) - 1) if (r := rank(parts[i] + parts[i + 1], limit)) is not None)
            if best[0] >= limit:
                return []
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def _grow(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Work out a step: the next state, and the tokens that are sure by now."""
        found = []  # in the order of the hypotheses' beginnings, so equal sets are equal tuples
        done, node, fits, more = None, self.nodes.get, self.fits, BYTES[byte]
        for part, last, waiting in self.states[state]:
            longer = part + more
            kind = node(longer)
            if kind:
                if kind & 1:
                    found.append((longer, last, waiting))
                if done is None and kind > 1 and fits(last, kind // 2 - 1):
                    token = kind // 2 - 1
                    done = (b"", token, (*waiting, token))
        found.append(done)
        first, sure = found[0][2], 0
        if first:  # what the least and the greatest begin with, all do
            waits = [waiting for _, _, waiting in found]
            least, greatest = min(waits), max(waits)
            if least is greatest:
                sure = len(least)
            else:
                for x, y in zip(least, greatest, strict=False):
                    if x != y:
                        break
                    sure += 1
            if sure:
                found = [(part, last, waiting[sure:]) for part, last, waiting in found]
        following = tuple(found)
        number = self.numbers.get(following)
        if number is None:
            number = self.numbers[following] = len(self.states)
            self.states.append(following)
        step = self.steps[state << 8 | byte] = number, first[:sure]
        return step

    def encode_sorted(self, pieces: Iterable[bytes]) -> Iterator[tuple[int, ...]]:
        """Ids of pieces of text, each from where it parts from the piece before."""
        path, sizes, out, before = [0], [0], [], b""
        for piece in pieces:
            whole = self.ranks.get(piece)
            if whole is not None:  # also where the merges do not lead there
                yield (whole,)
                continue
            if len(self.states) > STATES:
                self._reset()
                path, sizes, out, before = [0], [0], [], b""
            same = 0
            for x, y in zip(before, piece, strict=False):
                if x != y:
                    break
                same += 1
            del path[same + 1 :], sizes[same + 1 :], out[sizes[same] :]
            state, known = path[same], self.steps.get
            for byte in piece[same:]:
                step = known(state << 8 | byte)
                if step is None:
                    step = self._grow(state, byte)
                state, emitted = step
                if emitted:
                    out += emitted
                path.append(state)
                sizes.append(len(out))
            before = piece
            yield (*out, *self.states[state][-1][2])  # and the hypothesis whose last token ends here


class Encoder:
    """Whole texts: pieces by the pattern, each through the transducer; a bounded cache keeps what common pieces gave."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.machine = Transducer(ranks)
        # The same classes, for texts of like characters only.
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
        self.plain = re.compile(plain) if r"\p" not in plain else None
        self.pieces = regex.compile(pattern.replace(r"\s", WHITE_SPACE).replace(r"\S", r"\P{White_Space}"))
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def encode(self, batch: list[str]) -> Iterator[list[int]]:
        """Ids of each text of a batch of bounded size."""
        split = [(self.plain if self.plain and not _UNLIKE.search(text) else self.pieces).findall(text) for text in batch]
        if len(self.known) > PIECES:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        fresh = []
        for piece in set().union(*split):
            if piece not in known:
                if piece in older:
                    known[piece] = older[piece]
                else:
                    fresh.append((piece.encode(), piece))
        fresh.sort()
        for (_, piece), ids in zip(fresh, self.machine.encode_sorted(data for data, _ in fresh), strict=True):
            known[piece] = ids
        for pieces in split:
            yield list(chain.from_iterable(map(known.__getitem__, pieces)))


@lru_cache(1)
def encoder_of(ranks_path: str, pattern: str) -> Encoder:
    """A worker's encoder: its caches, bounded as they are, serve all tasks that the worker runs."""
    return Encoder(load_ranks(ranks_path), pattern)


class Utf8Stream:
    """Incremental UTF-8: takes bytes as they come, gives back whole characters and keeps an unfinished one."""

    def __init__(self) -> None:
        self.kept = b""

    @staticmethod
    def state(data: bytes) -> int:
        """Continuation bytes that are still missing after ``data``, one character's beginning; 0: none, or not UTF-8."""
        lead = data[0]
        need = 1 if 0xC2 <= lead <= 0xDF else 2 if 0xE0 <= lead <= 0xEF else 3 if 0xF0 <= lead <= 0xF4 else 0
        low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
        for byte in data[1:]:
            if not need or not low <= byte <= high:
                return 0
            need, low, high = need - 1, 0x80, 0xBF
        return need

    def feed(self, data: bytes) -> bytes:
        data = self.kept + data
        self.kept = b""
        for back in range(1, min(3, len(data)) + 1):
            if data[-back] >= 0xC0:
                if self.state(data[-back:]):
                    self.kept = data[-back:]
                    return data[:-back]
                break
            if data[-back] < 0x80:
                break
        return data

    def close(self) -> bytes:
        kept, self.kept = self.kept, b""
        return kept


def decode_stream(ids: list[int], tokens: dict[int, bytes]) -> Iterator[bytes]:
    """The bytes of a token stream in parts that end between characters; bytes that are no UTF-8 pass unchanged."""
    stream = Utf8Stream()
    for low in range(0, len(ids), DECODE):
        yield stream.feed(b"".join(map(tokens.__getitem__, ids[low : low + DECODE])))
    yield stream.close()


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode every text of ``docs`` (``doc_id, text``) and decode the ids again.

    Returns ``doc_id, n_tokens, ids_sha256`` (of decimal ids joined by commas), ``decoded_sha256``
    and, if asked for, ``ids``. A null or empty text has no tokens. Null ids and repeated rows pass
    through; an empty table gives an empty result. One narrow stage; caches are bounded.
    """
    kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
    names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]

    def run(batches):
        encoder = encoder_of(ranks_path, pattern)
        tokens = encoder.machine.tokens
        decimal = [str(i) for i in range(max(tokens, default=0) + 1)].__getitem__
        for batch in batches:
            rows, whole = [], texts(batch.column(1))
            for low, high in slices([len(text) for text in whole], SLICE_BYTES):
                for ids in encoder.encode(whole[low:high]):
                    decoded = hashlib.sha256()
                    for part in decode_stream(ids, tokens):
                        decoded.update(part)
                    listed = ",".join(map(decimal, ids)).encode()
                    rows.append((len(ids), hashlib.sha256(listed).hexdigest(), decoded.hexdigest(), ids if with_ids else None))
            found = zip(*rows, strict=True) if rows else [[]] * 4
            columns = [pa.array(c, t) for c, t in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns][: 5 if with_ids else 4], ["doc_id", *names][: 5 if with_ids else 4])

    shape = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, shape)
