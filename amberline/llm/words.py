"""Sets of hashed word shingles, computed over whole Arrow buffers.

A word is ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z. Its hash is a polynomial of its bytes
modulo 2**64, a shingle's hash mixes those of its words; equal texts have equal hashes in every
process, and two different shingles agree with a chance of about 2**-60.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from amberline.llm.common import slices

SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPREAD = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_powers = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 2 * SLICE_BYTES), base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if len(known) <= 8 * SLICE_BYTES:
            _powers[int(base)] = known
    return known[:n]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts that lie behind each other in ``data``, and each text's first word."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    breaks = np.zeros(n + 1, bool)
    breaks[bounds] = True
    begins, ends = ~white, ~white
    begins[1:] &= white[:-1] | breaks[1:-1]
    ends[:-1] &= white[1:] | breaks[1:-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), dtype=np.uint64, out=total[1:])
    hashes = (total[end] - total[begin]) * powers(INVERSE, n)[begin]
    return mix(hashes + (end - begin).astype(np.uint64)), np.searchsorted(begin, bounds)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``size`` are one shingle, none are none."""
    column = pa.array(column).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for start, stop in slices(np.diff(offsets).tolist(), SLICE_BYTES):
        bounds = offsets[start : stop + 1]
        hashes, first = word_hashes(data[bounds[0] : bounds[-1]], bounds - bounds[0])
        shingles = hashes
        for k in range(1, size):
            if len(hashes) > k:
                shingles = mix(shingles[: len(hashes) - k] * SPREAD[0] + hashes[k:] * SPREAD[1])
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= size:
                yield np.unique(shingles[a : b - size + 1])
            elif b > a:
                short = np.full(1, b - a, np.uint64)
                for k in range(a, b):
                    short = mix(short * SPREAD[0] + hashes[k : k + 1] * SPREAD[1])
                yield short
            else:
                yield np.empty(0, np.uint64)


def set_key(values: np.ndarray) -> bytes:
    """Sixteen bytes that name a set."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
