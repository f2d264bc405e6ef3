"""Cross-tokenizer alignment with inverted pair bitmaps.

Every text is cut by two tokenizers, A (a byte-level BPE file) and B (a
sentencepiece model).  Byte offsets at which tokens of both end cut the tokens
into groups; two tokens are linked where their byte ranges overlap.  Between two
neighbouring ends of either tokenizer lies exactly one link, so the links of a
text are the sorted union of both lists of ends.

Documents get a place (block, slot), blocks holding up to ``SLOTS`` documents.
For each id pair and block the documents that hold it linked are one compressed
bitmap: sorted 16-bit slots, or ``SLOTS`` bits where that is shorter.  Bits of
(multiplicity - 1) are further bitmaps of the same form, the multiplicity planes.
All bitmaps of one A id in a block and plane are one row.

1. one pass over the texts writes documents and bitmaps;
2. popcounts are added per pair over blocks, which hold different documents, so
   this is the popcount of the OR: documents from the presence plane, links from
   all planes; the highest count of an A id covers at most the ids of B;
3. postings return scores: bitmaps are expanded beside the counts of their
   pairs, and each document sums what its links got.  Counts are broadcast for one
   range of A ids after the other, at most ``ROUND_PAIRS`` pairs at a time.

Defined results: a null or empty text, and one whose tokens of A or B do not
give space + text back, has no tokens; rows that repeat are counted and
returned each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize
from .textkit import chunks

VOCAB_DIR = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLOTS = 4096
BLOCK_LINKS = 4_000_000        # links held before a block is written
ROUND_PAIRS = 2_000_000        # pairs of one broadcast: 32 MB
WORDS = SLOTS // 16            # a bitmap in 16-bit units; longer slot lists become bitmaps
PRESENT = -1                   # the plane that says which documents hold a pair


class Codec:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, vocab_dir: str, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{vocab_dir}/{a_file}")
        self.a.encode_special_tokens = True
        self.plain = self.a.normalizer is None
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{vocab_dir}/{b_file}")
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]     # bytes that stand for themselves
        other = [x for x in range(256) if x not in set(plain)]
        byte_of = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(other)}
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # Decimal ids followed by one of three separators, as rows of bytes.
        ids = max(len(self.a_bytes), len(self.b_bytes))
        texts = [f"{i}{sep}".encode() for sep in ",|;" for i in range(ids)]
        self.ids, wide = ids, max(map(len, texts))
        self.glyph_size = np.array([len(x) for x in texts])
        self.glyphs = np.frombuffer(b"".join(x.ljust(wide) for x in texts), np.uint8).reshape(-1, wide)

    def whole(self, ids: list[int], raw: bytes) -> bool:
        """Whether tokens of A give their bytes back; only a normalizer could change bytes and keep their number."""
        if self.plain:
            return int(self.a_size[ids].sum()) == len(raw)
        return b"".join(map(self.a_bytes.__getitem__, ids)) == raw

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Token ids of each text by A and by B; none where the bytes do not come back."""
        got_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        got_b = [self.b.encode(text) for text in texts]        # a list would go through a pool of threads
        for i, text in enumerate(texts):
            raw = b" " + text.encode()
            if not text or b"".join(map(self.b_bytes.__getitem__, got_b[i])) != raw or not self.whole(got_a[i], raw):
                got_a[i] = got_b[i] = []
        return got_a, got_b


def align(codec: Codec, got_a: list, got_b: list, texts: bool = False):
    """Groups and links of the texts of a chunk.

    Returns per text n_a, n_b, n_groups, the groups (as text, or its SHA-256),
    and for all links the text's index and the ids of A and B.
    """
    n_a = np.array([len(x) for x in got_a], np.int64)
    n_b = np.array([len(x) for x in got_b], np.int64)
    a = np.fromiter(chain.from_iterable(got_a), np.int32, int(n_a.sum()))
    b = np.fromiter(chain.from_iterable(got_b), np.int32, int(n_b.sum()))
    end_a, end_b = np.cumsum(codec.a_size[a]), np.cumsum(codec.b_size[b])
    last = np.append(0, end_a)[np.cumsum(n_a)]                 # where each text ends
    is_a, is_b = np.zeros(last[-1] + 1, bool), np.zeros(last[-1] + 1, bool)     # by byte offset
    is_a[end_a], is_b[end_b] = True, True
    both = is_a & is_b
    ends = np.flatnonzero(is_a | is_b)
    link_a, link_b = (ids[np.cumsum(mark[ends]) - mark[ends]] for ids, mark in ((a, is_a), (b, is_b)))
    group = np.cumsum(both) - both                             # groups that end before an offset
    n_groups = np.diff((group + both)[last], prepend=0)
    # Each group's tokens of A, then those of B: a token's place is its own index and the others before it.
    cut_a, cut_b = both[end_a], both[end_b]
    upto_a, upto_b = np.flatnonzero(cut_a) + 1, np.append(0, np.flatnonzero(cut_b) + 1)
    code = np.empty(len(a) + len(b), np.int32)
    code[np.arange(len(a)) + upto_b[group[end_a]]] = a + codec.ids * cut_a
    code[np.arange(len(b)) + upto_a[group[end_b]]] = b + 2 * codec.ids * cut_b
    size = codec.glyph_size[code]
    flat = codec.glyphs[code][np.arange(codec.glyphs.shape[1]) < size[:, None]].tobytes()
    cut = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(n_a + n_b))].tolist()
    groups = [flat[x:max(x, y - 1)] for x, y in zip(cut[:-1], cut[1:])]
    groups = [g.decode() if texts else hashlib.sha256(g).hexdigest() if g else "" for g in groups]
    return n_a, n_b, n_groups, groups, np.searchsorted(last, ends), link_a, link_b


def pack(slots: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated ascending slot lists of ``n`` entries each as bitmaps: 16-bit units, and how many each has."""
    size = np.where(n > WORDS, WORDS, n)
    out = np.zeros(int(size.sum()), np.uint16)
    at, begin = np.cumsum(size) - size, np.cumsum(n) - n
    short = np.repeat(n <= WORDS, n)
    out[(np.repeat(at - begin, n) + np.arange(len(slots)))[short]] = slots[short]
    for i in np.flatnonzero(n > WORDS):
        bits = np.zeros(SLOTS, bool)
        bits[slots[begin[i]:begin[i] + n[i]]] = True
        out[at[i]:at[i] + WORDS] = np.packbits(bits).view(np.uint16)
    return out, size


def unpack(units: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the bitmap and slot for every document in the bitmaps."""
    size = np.where(n > WORDS, WORDS, n)
    at = np.cumsum(size) - size
    short, full = np.flatnonzero(n <= WORDS), np.flatnonzero(n > WORDS)
    m = n[short]
    inner = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
    entry, slot = [np.repeat(short, m)], [units[np.repeat(at[short], m) + inner].astype(np.int64)]
    for some in np.array_split(full, len(full) // 256 + 1):
        if len(some):
            bits = np.unpackbits(units[at[some][:, None] + np.arange(WORDS)].view(np.uint8), axis=1)
            row, col = np.nonzero(bits)
            entry.append(some[row])
            slot.append(col)
    return np.concatenate(entry), np.concatenate(slot)


_POSTING = "a int, plane int, bs array<int>, ns array<int>, bits binary"


def _rows(keys: np.ndarray) -> list[pa.Array]:
    """Ascending links (a << 36 | b << 12 | slot) of one plane as Arrow columns a, bs, ns and bits."""
    pair = keys >> 12
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    n = np.diff(np.append(first, len(keys)))
    units, size = pack((keys & (SLOTS - 1)).astype(np.uint16), n)
    pair = pair[first]
    a = pair >> 24
    row = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    cut = np.append(row, len(a)).astype(np.int32)
    ends = (np.append(0, np.cumsum(size))[cut] * 2).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x.astype(np.int32))) for x in (pair & 0xFFFFFF, n)]
    bits = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(units.tobytes())])
    return [pa.array(a[row].astype(np.int32)), *lists, bits]


def planes(keys: np.ndarray) -> Iterator[tuple[int, list[pa.Array]]]:
    """The presence plane of a block's links, then the planes of (multiplicity - 1)."""
    keys, times = np.unique(keys, return_counts=True)
    if len(keys):
        yield PRESENT, _rows(keys)
    rest, plane = times - 1, 0
    while rest.any():
        now = keys[rest & 1 == 1]
        if len(now):
            yield plane, _rows(now)
        keys, rest, plane = keys[rest > 1], rest[rest > 1] >> 1, plane + 1


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocab_dir: str = VOCAB_DIR, a_file: str = A_FILE,
            b_file: str = B_FILE, group_texts: bool = False, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """Documents (block, slot, doc_id, n_a, n_b, n_groups, n_links, groups) and bitmaps (block, a, plane, bs, ns, bits).

    ``groups`` is the text a1,a2|b1;a3|b2,b3 with ``group_texts``, else its SHA-256.
    """
    if not 1 <= slots <= SLOTS:
        raise ValueError(f"a block has 1 to {SLOTS} slots")
    doc_type = docs.select(doc_id).schema[0].dataType.simpleString()
    schema = f"block long, slot int, doc_id {doc_type}, n_a long, n_b long, n_groups long, n_links long, groups string, {_POSTING}"
    names = ["block", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "a", "plane", "bs", "ns", "bits"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocab_dir, a_file, b_file)
        task = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        held, links, used, number, blank = [], 0, 0, 0, []

        def batch_of(n, values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([values[c] if c in values else pa.nulls(n, blank[i])
                                               for i, c in enumerate(names)], names)

        def flush() -> Iterator[pa.RecordBatch]:
            for plane, (a, bs, ns, bits) in planes(np.concatenate(held)) if held else ():
                n = len(a)
                yield batch_of(n, {"block": pa.array(np.full(n, task + number)), "a": a, "bs": bs, "ns": ns, "bits": bits,
                                   "plane": pa.array(np.full(n, plane, np.int32))})
            held.clear()

        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            blank = [pa.int64(), pa.int32(), ids.type, *[pa.int64()] * 4, pa.string(), pa.int32(), pa.int32(),
                     pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
            for part in chunks(column):
                done, n = 0, len(part.offs) - 1
                while done < n:
                    if used == slots or links >= BLOCK_LINKS:
                        yield from flush()
                        links, used, number = 0, 0, number + 1
                    m = min(n - done, slots - used)
                    texts = [t or "" for t in column.slice(part.first + done, m).to_pylist()]
                    n_a, n_b, n_groups, groups, doc, a, b = align(codec, *codec.encode(texts), group_texts)
                    held.append(a.astype(np.int64) << 36 | b.astype(np.int64) << 12 | doc + used)
                    links += len(a)
                    yield batch_of(m, {
                        "block": pa.array(np.full(m, task + number)), "slot": pa.array(np.arange(used, used + m, dtype=np.int32)),
                        "doc_id": ids.slice(part.first + done, m), "n_a": pa.array(n_a), "n_b": pa.array(n_b),
                        "n_groups": pa.array(n_groups), "n_links": pa.array(n_a + n_b - n_groups), "groups": pa.array(groups)})
                    used, done = used + m, done + m
        yield from flush()

    both = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(emit, schema)
    both = materialize(both.withColumn("posting", F.col("a").isNotNull()), "aligned", by="posting")
    return both.where("not posting").select(*names[:8]), both.where("posting").select("block", *names[8:])


def pair_counts(postings: DataFrame) -> DataFrame:
    """Per linked id pair: a, b, docs, links, and whether docs is the highest of its a (ties included)."""
    each = postings.select("a", "plane", F.inline(F.arrays_zip("bs", "ns")))
    times = F.expr("shiftleft(1L, greatest(plane, 0))")
    sums = each.groupBy("a", F.col("bs").alias("b")).agg(
        F.coalesce(F.sum(F.when(F.col("plane") == PRESENT, F.col("ns").cast("long"))), F.lit(0)).alias("docs"),
        F.sum(F.col("ns") * times).alias("links"))
    top = F.max("docs").over(Window.partitionBy("a"))       # an A id has at most as many pairs as B has ids
    return sums.withColumn("best", F.col("docs") == top)


def _rounds(counts: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of A ids with at most ``most`` pairs each (one A id at least)."""
    out, held = [], 0
    for a, n in sorted(tuple(r) for r in counts.groupBy("a").count().collect()):   # at most the ids of A
        if not out or held + n > most:
            out.append((a, a))
            held = 0
        out[-1] = (out[-1][0], a)
        held += n
    return out


def _scored(postings: DataFrame, counts: DataFrame, span: tuple[int, int]) -> DataFrame:
    """What the documents' links with A ids of a range add: (block, slot, n_best, count_sum)."""
    spark = postings.sparkSession
    within = F.col("a").between(*span)
    table = counts.where(within).select((F.shiftleft(F.col("a").cast("long"), 24) + F.col("b")).alias("pair"), "docs", "best").toArrow()
    order = np.argsort(pair := table["pair"].to_numpy())
    shared = spark.sparkContext.broadcast((pair[order], table["docs"].to_numpy()[order], table["best"].to_numpy()[order]))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = shared.value
        for batch in batches:
            if not len(batch):
                continue
            block, a, plane = (batch.column(i).to_numpy() for i in range(3))
            bs, ns, bits = (batch.column(i) for i in range(3, 6))
            per = bs.value_lengths().to_numpy()
            pair = (np.repeat(a.astype(np.int64), per) << 24) + bs.flatten().to_numpy()
            at = np.searchsorted(known, pair)
            weight = np.repeat(np.left_shift(1, np.maximum(plane, 0).astype(np.int64)), per)
            units = np.frombuffer(b"".join(bits.to_pylist()), np.uint16)
            blocks, where = np.unique(block, return_inverse=True)
            entry, slot = unpack(units, ns.flatten().to_numpy().astype(np.int64))
            cell = np.repeat(where, per)[entry] * SLOTS + slot
            score = np.bincount(cell, (weight * docs[at])[entry])
            hits = np.bincount(cell, (weight * best[at])[entry])
            cell = np.flatnonzero(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks[cell // SLOTS]), pa.array((cell % SLOTS).astype(np.int32)),
                 pa.array(hits[cell].astype(np.int64)), pa.array(score[cell].astype(np.int64))],
                ["block", "slot", "n_best", "count_sum"])

    rows = postings.where(within).select("block", "a", "plane", "bs", "ns", "bits")
    out = materialize(rows.mapInArrow(emit, "block long, slot int, n_best long, count_sum long")
                      .groupBy("block", "slot").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "scores")
    shared.destroy()
    return out


def alignment(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocab_dir: str = VOCAB_DIR, a_file: str = A_FILE,
              b_file: str = B_FILE, group_texts: bool = False, slots: int = SLOTS, round_pairs: int = ROUND_PAIRS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups."""
    found, postings = aligned(docs, doc_id, text, vocab_dir, a_file, b_file, group_texts, slots)
    counts = materialize(pair_counts(postings), "pairs")
    scores = [_scored(postings, counts, span) for span in _rounds(counts, round_pairs)]
    if not scores:
        zero = F.lit(0).cast("long")
        return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero.alias("n_best"), zero.alias("count_sum"), "groups")
    total = scores[0]
    for more in scores[1:]:
        total = total.unionByName(more)
    if len(scores) > 1:
        total = total.groupBy("block", "slot").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = F.lit(0).cast("long")
    return found.join(total, ["block", "slot"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups")


def op13(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return alignment(docs).withColumnRenamed("groups", "groups_sha256")
