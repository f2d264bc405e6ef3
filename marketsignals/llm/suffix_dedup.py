"""Suffix-array dedup: remove every byte under a window that already occurred earlier, keep the first.

Earlier means a smaller doc_id, or the same doc_id and an earlier start.  The
contexts of ``anchors`` bring equal windows together in shards.  A shard gets its
suffix order (ranks of prefixes of doubling length, each suffix up to the end of
its context); for every suffix the nearest ones before and after it in that order
with a smaller text position are the candidates for its longest earlier match,
and the longer of the two common prefixes is its longest previous factor.  Where
the factor has the window's length, the window is a later copy.

Defined results: a null or empty text has no bytes; rows with a null doc_id come
behind all doc_ids below 2**62, by a hash of their text; rows that repeat a doc_id with the same text are one document; windows
never cross texts; other columns are ignored.  A cut can fall inside a
character: ``kept`` is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import Spec, cover, repeated_units
from .shared import text_key

WINDOW = 100
ANCHOR = 20
SHARD_BYTES = 1_000_000
NULLS = 1 << 62         # order of rows with a null doc_id, plus 62 bits of their text's hash
FIRST = 7               # bytes of the shortest ranked prefixes
PIECES = 4              # longest ranked prefixes that a suffix is compared by


def previous_smaller(a: np.ndarray) -> np.ndarray:
    """For each index the nearest index before it with a smaller value, else -1.

    All entries jump at once: between an entry's candidate and itself all values
    are larger, so a candidate that is too large hands over its own candidate.
    """
    n = len(a)
    at = np.arange(n, dtype=np.int64) - 1
    open_ = np.flatnonzero((at >= 0) & (a[np.maximum(at, 0)] > a))
    while len(open_):
        at[open_] = at[at[open_]]
        at_open = at[open_]
        open_ = open_[(at_open >= 0) & (a[np.maximum(at_open, 0)] > a[open_])]
    return at


def prefix_ranks(data: np.ndarray, left: np.ndarray, longest: int) -> list[tuple[int, np.ndarray]]:
    """(length, rank of that prefix) of every suffix, for doubling lengths of which ``PIECES`` make up ``longest``.

    ``left`` is how many bytes a suffix has; where it has fewer than the prefix, its end sorts first.
    """
    n = len(data)
    at = np.arange(n)
    key = np.zeros(n, np.int64)
    for i in range(FIRST):
        there = np.minimum(at + i, n - 1)
        key = key << 9 | np.where(i < left, data[there].astype(np.int64) + 1, 0)
    size, out = FIRST, []
    while True:
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        out.append((size, rank))
        if size * PIECES >= longest:
            return out
        key = rank * (n + 1) + np.where(size < left, rank[np.minimum(at + size, n - 1)] + 1, 0)
        size *= 2


def common_prefix(data: np.ndarray, left: np.ndarray, ranks: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes i and j (pairwise)."""
    i, j, most = i.copy(), j.copy(), np.minimum(left[i], left[j])
    found = np.zeros(len(i), np.int64)
    top = ranks[-1]
    for size, rank in [top] * (PIECES - 1) + ranks[::-1]:
        same = (found + size <= most) & (rank[np.minimum(i, len(data) - 1)] == rank[np.minimum(j, len(data) - 1)])
        found += size * same
        i += size * same
        j += size * same
    for _ in range(FIRST - 1):
        same = found < most
        same[same] = data[i[same]] == data[j[same]]
        found += same
        i += same
        j += same
    return found


def longest_previous_factor(data: np.ndarray, left: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each start (they are in text order) the length of the longest match with an earlier one."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ranks = prefix_ranks(data, left, int(left.max()))
    size, rank = ranks[-1]
    pieces = [np.where(i * size < left[starts], rank[np.minimum(starts + i * size, len(data) - 1)] + 1, 0) for i in range(PIECES)]
    order = np.lexsort(pieces[::-1])
    n = len(order)
    before = previous_smaller(order)
    after = n - 1 - previous_smaller(order[::-1])[::-1]
    factor = np.zeros(n, np.int64)
    for near in (before, after):
        has = np.flatnonzero((near >= 0) & (near < n))
        length = common_prefix(data, left, ranks, starts[order[has]], starts[order[near[has]]])
        factor[order[has]] = np.maximum(factor[order[has]], length)
    return factor


def solve(texts: list[bytes], _counts, docs: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
    """For each context the intervals under windows with an earlier copy among the contexts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    left = np.repeat(begin + sizes, sizes) - np.arange(len(data))
    full = np.maximum(0, sizes - window + 1)
    owner = np.repeat(np.arange(len(texts)), full)
    rel = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
    place = np.lexsort((offsets[owner] + rel, docs[owner]))      # windows in text order
    owner, rel = owner[place], rel[place]
    copy = longest_previous_factor(data, left, begin[owner] + rel) >= window
    owner, rel = owner[copy], rel[copy]
    by = np.lexsort((rel, owner))
    owner, rel = owner[by], rel[by]
    at = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [cover(rel[a:b], rel[a:b] + window) for a, b in zip(at[:-1], at[1:])]


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                 anchor: int = ANCHOR, most: int = 8192) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, spans (byte intervals removed, end exclusive) and kept (binary)."""
    if not 1 <= anchor <= window:
        raise ValueError("the anchor must fit into the window")
    id_type = docs.select(doc_id).schema[0].dataType.simpleString()
    behind = F.shiftrightunsigned(text_key(text)[0], 2) + F.lit(NULLS)
    order = F.coalesce(F.col(doc_id).cast("long"), behind).alias("ord")
    work = docs.select(F.col(doc_id).alias("doc_id"), *text_key(text), order, F.col(text).alias("text"))
    spec = Spec("byte", anchor, window - anchor + 1, first=True, most=most)
    spans = repeated_units(work, spec, lambda t, n, d, o: solve(t, n, d, o, window), SHARD_BYTES)
    joined = work.join(spans, ["k1", "k2", "ord"], "left").select("doc_id", "text", "s", "e")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, s, e in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                raw = (t or "").encode()
                s, e = cover(s, e)
                lo, hi = np.append(0, e), np.append(s, len(raw))
                out.append((len(raw), int((e - s).sum()), list(zip(s.tolist(), e.tolist())),
                            b"".join(raw[x:y] for x, y in zip(lo.tolist(), hi.tolist()))))
            pairs = pa.array([[{"start": x, "end": y} for x, y in r[2]] for r in out],
                             pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                 pa.array([len(r[2]) for r in out], pa.int64()), pairs, pa.array([r[3] for r in out], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return joined.mapInArrow(remove, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, "
                                     "spans array<struct<start:int,end:int>>, kept binary")


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                     F.sha2("kept", 256).alias("kept_sha256"))
