"""Numpy kernels over Arrow string columns, shared by the text operators.

A column is cut into *chunks* of whole texts of about ``CHUNK`` bytes (a longer
text is a chunk of its own), so working memory does not follow the Arrow batch
size.  Everything below works on a chunk: its UTF-8 bytes and the byte offsets
of its texts.  Nulls are empty texts.

``anchored_runs`` is the winnowing rule: every window of ``k + w - 1``
consecutive units (words or bytes) of one text is *owned* by the k-gram of
smallest hash in it (the rightmost on ties).  The choice depends on the window's
content only, so equal windows have the same anchor at the same place in them.
Consecutive windows with one owner form a run.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_POW: list[np.ndarray] = []

# Byte classes.  Bytes of non-ASCII characters belong to words in both.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[ord("0"):ord("9") + 1] = ALNUM[ord("a"):ord("z") + 1] = ALNUM[128:] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[ord("A"):ord("Z") + 1] += 32


class Chunk(NamedTuple):
    first: int            # row of the first text in the column
    data: np.ndarray      # uint8
    offs: np.ndarray      # int64, one more than texts


class Runs(NamedTuple):
    hash: np.ndarray      # uint64, hash of the owning k-gram
    anchor: np.ndarray    # unit index of the owner
    first: np.ndarray     # unit index of the first owned window
    last: np.ndarray      # unit index of the last owned window
    text: np.ndarray      # text index in the chunk


def chunks(col: pa.Array, budget: int = CHUNK) -> Iterator[Chunk]:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, values = col.buffers()
    n = len(col)
    if not n:
        return
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + budget, "right")) - 1)
        yield Chunk(i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        i = j


def words(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per text the index of its first word (one more than texts)."""
    mask = is_word[data]
    full = offs[:-1] < offs[1:]
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    at = offs[:-1][full]
    begins[at] |= mask[at]
    at = offs[1:][full] - 1
    ends[at] |= mask[at]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offs)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _POW or len(_POW[0]) < n:
        size = max(n, CHUNK + 4096)
        steps = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, U64)
            p[0] = 1
            steps.append(np.cumprod(p, dtype=U64))
        _POW[:] = steps
    return _POW[0][:n], _POW[1][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, is_word: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes that does not depend on where the word stands."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = _powers(len(data))
    val = (data.astype(U64) + U64(1)) * up
    val[~is_word[data]] = 0
    return mix(np.add.reduceat(val, starts) * down[starts])


def gram_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k units from each position; the last k - 1 positions have none and hold 0."""
    n = len(units)
    out = np.zeros(n, U64)
    if n < k:
        return out
    m = n - k + 1
    acc, factor = np.zeros(m, U64), 1
    for j in range(k):
        acc += units[j:j + m] * U64(factor)
        factor = factor * _BASE % (1 << 64)
    out[:m] = mix(acc) | U64(1)
    return out


def byte_gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    n = len(data)
    out = np.zeros(n, U64)
    if n < k:
        return out
    up, down = _powers(n)
    total = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up, out=total[1:])
    out[:n - k + 1] = mix((total[k:] - total[:-k]) * down[:n - k + 1]) | U64(1)
    return out


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    cur, span = a, 1
    while span * 2 <= w:
        cur = np.minimum(cur[:-span], cur[span:])
        span *= 2
    return cur if span == w else np.minimum(cur[:len(a) - w + 1], cur[w - span:w - span + len(a) - w + 1])


_LOW = (1 << 31) - 1


def anchored_runs(grams: np.ndarray, bounds: np.ndarray, k: int, w: int) -> Runs:
    """Runs of windows of ``k + w - 1`` units inside the texts that ``bounds`` delimits, by owner."""
    none = np.zeros(0, np.int64)
    n, length = len(grams), k + w - 1
    if n < length:
        return Runs(none.astype(U64), none, none, none, none)
    order = ((grams >> U64(32)).astype(np.int64) << 31) | (_LOW - np.arange(n, dtype=np.int64))
    owner = _LOW - (sliding_min(order[:n - k + 1], w) & _LOW)
    step = np.zeros(n + 1, np.int32)
    long = bounds[1:] - bounds[:-1] >= length
    np.add.at(step, bounds[:-1][long], 1)
    np.add.at(step, bounds[1:][long] - length + 1, -1)
    inside = np.flatnonzero(np.cumsum(step)[:len(owner)])
    if not len(inside):
        return Runs(none.astype(U64), none, none, none, none)
    own = owner[inside]
    text = np.searchsorted(bounds, inside, "right") - 1
    new = np.ones(len(inside), bool)
    new[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(inside)) - 1
    return Runs(grams[own[at]], own[at], inside[at], inside[end], text[at])


def merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals; touching intervals become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(new)
    return s[at], e[np.append(at[1:], len(s)) - 1]
