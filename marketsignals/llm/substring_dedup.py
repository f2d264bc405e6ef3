"""Substring dedup with suffix automata: remove every word window that occurs more than once.

The reference shards are the candidate contexts of ``anchors``: windows with
equal word sequences always meet in the shard of their anchor.  A shard of
bounded size becomes one suffix automaton over words, whose states carry how
often their strings occur in the corpus (copies count, though each text is in
the shard once).  Contexts are then streamed through the automaton; the
matching statistic at a word is the length of the longest string that ends
there and occurs ``least`` times or more, and statistics of at least the window
length give the spans to remove.

The named method broadcasts the automata of all shards to all documents.  That
is quadratic here, where the corpus is its own reference, and its automata have
no size bound; so each shard meets only the documents that share an anchor with
it, in the task that builds it.  What is broadcast is a bitmap of fixed size.

Defined results: a null or empty text has no words; repeated rows count as
occurrences of each other; windows never cross texts; columns other than the
two named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import Spec, cover, repeated_units
from .shared import text_key
from .textkit import NON_SPACE, chunks, words

WINDOW = 35
ANCHOR = 8
SHARD_BYTES = 400_000   # text of one automaton; about 300 bytes of memory a word


class SuffixAutomaton:
    """Suffix automaton of several weighted token sequences."""

    def __init__(self, sequences: Sequence[Sequence], weights: Sequence[int]):
        nxt: list[dict] = [{}]
        link, length, count = [-1], [0], [0]
        for seq, weight in zip(sequences, weights):
            last = 0
            for tok in seq:
                q = nxt[last].get(tok)
                if q is None:
                    cur = len(nxt)
                    nxt.append({})
                    length.append(length[last] + 1)
                    link.append(0)
                    count.append(0)
                    p = last
                    while p != -1 and tok not in nxt[p]:
                        nxt[p][tok] = cur
                        p = link[p]
                    if p != -1:
                        q = nxt[p][tok]
                        if length[p] + 1 != length[q]:
                            q = self._clone(nxt, link, length, count, p, q, tok)
                        link[cur] = q
                    last = cur
                else:
                    if length[last] + 1 != length[q]:
                        q = self._clone(nxt, link, length, count, last, q, tok)
                    last = q
                count[last] += weight
        for state in np.argsort(np.array(length), kind="stable")[:0:-1].tolist():
            count[link[state]] += count[state]
        self.next, self.link, self.length, self.count = nxt, link, length, count

    @staticmethod
    def _clone(nxt, link, length, count, p, q, tok) -> int:
        """A state for the shorter strings of q, those that end at p's transition."""
        new = len(nxt)
        nxt.append(nxt[q].copy())
        length.append(length[p] + 1)
        link.append(link[q])
        count.append(0)
        while p != -1 and nxt[p].get(tok) == q:
            nxt[p][tok] = new
            p = link[p]
        link[q] = new
        return new

    def frequent(self, least: int) -> list[int]:
        """Per state the longest suffix of its strings that occurs ``least`` times."""
        best = [0] * len(self.link)
        for state in np.argsort(np.array(self.length), kind="stable")[1:].tolist():
            best[state] = self.length[state] if self.count[state] >= least else best[self.link[state]]
        return best

    def matching_statistics(self, tokens: Sequence, best: Sequence[int]) -> list[int]:
        """Per token the length of the longest frequent string of the automaton that ends there."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        out = []
        for tok in tokens:
            while state and tok not in nxt[state]:
                state = link[state]
                size = length[state]
            state = nxt[state].get(tok, 0)
            size = size + 1 if state else 0
            top = best[state]
            out.append(size if size < top else top)
        return out


def solve(texts: list[bytes], counts: np.ndarray, _docs, _offsets, window: int = WINDOW):
    """For each context the intervals of words under windows that occur twice or more in the corpus."""
    ids: dict[bytes, int] = {}
    seqs = [[ids.setdefault(x, len(ids)) for x in t.split(b" ")] for t in texts]
    automaton = SuffixAutomaton(seqs, counts.tolist())
    best = automaton.frequent(2)
    out = []
    for seq in seqs:
        ends = np.flatnonzero(np.array(automaton.matching_statistics(seq, best)) >= window) + 1
        out.append(cover(ends - window, ends))
    return out


def repeated_spans(docs: DataFrame, text: str = "text", window: int = WINDOW, anchor: int = ANCHOR,
                   most: int = 8192) -> DataFrame:
    """k1, k2 (``shared.text_key`` of the text) and the word intervals ``s``, ``e`` to remove."""
    if not 1 <= anchor <= window:
        raise ValueError("the anchor must fit into the window")
    work = docs.select(*text_key(text), F.lit(0).cast("long").alias("ord"), F.col(text).alias("text"))
    spec = Spec("word", anchor, window - anchor + 1, first=False, most=most)
    return repeated_units(work, spec, lambda t, n, d, o: solve(t, n, d, o, window), SHARD_BYTES)


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                    anchor: int = ANCHOR, most: int = 8192) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, spans (word intervals removed, end exclusive) and kept_text."""
    spans = repeated_spans(docs, text, window, anchor, most)
    id_type = docs.select(doc_id).schema[0].dataType.simpleString()
    work = docs.select(F.col(doc_id).alias("doc_id"), *text_key(text), F.col(text).alias("text"))
    joined = work.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "s", "e")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s_col, e_col = batch.column(2), batch.column(3)
            for part in chunks(batch.column(1)):
                starts, ends, bounds = words(part.data, part.offs, NON_SPACE)
                raw = part.data.tobytes()
                n = len(bounds) - 1
                removed, spans, kept = [], [], []
                for i in range(n):
                    a, b = starts[bounds[i]:bounds[i + 1]], ends[bounds[i]:bounds[i + 1]]
                    s, e = cover(s_col[part.first + i].as_py(), e_col[part.first + i].as_py())
                    removed.append(int((e - s).sum()))
                    spans.append(list(zip(s.tolist(), e.tolist())))
                    # kept stretches between the removed ones; whitespace runs become one space
                    lo, hi = np.append(0, e), np.append(s, len(a))
                    kept.append(b" ".join(b" ".join(raw[a[x]:b[y - 1]].split()) for x, y in zip(lo, hi) if x < y)
                                .decode())
                pairs = pa.array([[{"start": x, "end": y} for x, y in one] for one in spans],
                                 pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, n), pa.array(np.diff(bounds).astype(np.int64)),
                     pa.array(removed, pa.int64()), pairs, pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    return joined.mapInArrow(remove, f"doc_id {id_type}, n_words long, n_removed long, "
                                     "spans array<struct<start:int,end:int>>, kept_text string")


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
