"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is a ring of four 16-bit segments.  If two fingerprints
differ in at most 3 bits, there is a segment from which the differences summed
over the next 1, 2, 3 and 4 segments stay within 0, 0.75 x 2, 0.75 x 3 and 3
bits, in whole bits 0, 1, 2 and 3 (the strong form of the pigeonring
principle).  Candidates therefore agree in one segment and differ in at most one
bit of the next; that segment has two halves, one of which is equal.  So each
distinct fingerprint is listed under 8 keys of 24 bits, and only fingerprints
under one key are compared, chain by chain, before the full distance counts.

Equal fingerprints are one row from the start.  A key with many fingerprints is
dealt to pairs of blocks of bounded size.  A block reports a spanning forest of
its links instead of all pairs, which keeps every component whole; components
are then found by star rounds (``components``).

Defined results: a null or empty text has fingerprint 0 and is linked like any
other; rows with a null doc_id have a fingerprint and count as links, and a
component of such rows only has a null id; repeated rows get one result each;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .shared import materialize, named, text_key
from .textkit import ASCII_LOWER, NON_SPACE, chunks, words

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCK = 2048            # fingerprints of one block; a comparison holds two blocks
SEGMENT = 16
SLICE = 1 << 16         # shingles of one text that are held as bits at a time


def _bits(hashes: list[int]) -> np.ndarray:
    """One row of 64 bits a hash, lowest first."""
    return np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(col: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """SimHash of every text (uint64): majority vote of the XXH64 of its word shingles, repeats included."""
    out = np.zeros(len(col), np.uint64)
    digest = xxhash.xxh64_intdigest
    for part in chunks(col):
        starts, ends, bounds = words(part.data, part.offs, NON_SPACE)
        lowered = ASCII_LOWER[part.data].tobytes()
        hashes: list[int] = []
        first, docs = [], []
        for i in range(len(bounds) - 1):
            n = int(bounds[i + 1] - bounds[i])
            if not n:
                continue
            a, b = starts[bounds[i]:bounds[i + 1]], ends[bounds[i]:bounds[i + 1]]
            joined = b" ".join(lowered[a[0]:b[-1]].split())
            end = np.cumsum(b - a + 1) - 1
            begin = end - (b - a)
            m = min(shingle, n)
            begin, end = begin[:n - m + 1], end[m - 1:]
            if len(begin) > SLICE:      # a long text votes slice by slice
                votes = np.zeros(64, np.int64)
                for at in range(0, len(begin), SLICE):
                    cut = zip(begin[at:at + SLICE].tolist(), end[at:at + SLICE].tolist())
                    votes += _bits([digest(joined[x:y], seed) for x, y in cut]).sum(axis=0, dtype=np.int64)
                out[part.first + i] = np.packbits(votes * 2 > len(begin), bitorder="little").view("<u8")[0]
                continue
            first.append(len(hashes))
            docs.append(part.first + i)
            hashes += [digest(joined[x:y], seed) for x, y in zip(begin.tolist(), end.tolist())]
        if not docs:
            continue
        votes = np.add.reduceat(_bits(hashes), first, axis=0, dtype=np.int32)
        count = np.diff(np.append(first, len(hashes)))
        out[docs] = np.packbits(votes * 2 > count[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def forest(prints: np.ndarray, segment: int, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Index pairs that connect what the chain from ``segment`` links; one pair fewer than members per component."""
    turn = np.uint64(SEGMENT * segment)
    ring = prints if not segment else (prints >> turn) | (prints << (np.uint64(64) - turn))
    chain = [(np.uint64((1 << (SEGMENT * n)) - 1), distance * n // 4) for n in (1, 2, 3, 4)]
    left, out = np.arange(len(prints)), []
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            u = todo.pop()
            diff = ring[left] ^ ring[u]
            near = np.arange(len(left))
            for mask, most in chain:
                ok = np.bitwise_count(diff & mask) <= most
                near, diff = near[ok], diff[ok]
                if not len(near):
                    break
            else:
                found = left[near].tolist()
                out += [(u, v) for v in found]
                todo += found
                left = np.delete(left, near)
    return out


def _blocks(distinct: DataFrame, block: int) -> DataFrame:
    """(key, x, y, fp): the fingerprints of each key with two or more, large keys as pairs of blocks."""
    keys = []
    for i in range(4):
        j = (i + 1) % 4
        seg = F.shiftrightunsigned("fp", SEGMENT * i).bitwiseAND(F.lit(0xFFFF))
        for half in range(2):
            part = F.shiftrightunsigned("fp", SEGMENT * j + 8 * half).bitwiseAND(F.lit(0xFF))
            keys.append((F.lit((i * 2 + half) << 24) + seg * 256 + part).cast("long"))
    listed = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    size = listed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    size = size.select("key", F.ceil(F.col("n") / block).cast("int").alias("cells"))
    own = F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int")
    dealt = listed.join(size, "key").select("key", "fp", "cells", own.alias("own"))
    other = F.when(F.col("cells") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("cells") - 1), lambda c: c != F.col("own")))
    dealt = dealt.select("key", "fp", "own", F.explode(other).alias("other"))
    return dealt.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "fp")


def links(distinct: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """(a, b): enough links of the distinct fingerprints ``fp`` to connect each component."""
    if not 0 <= distance <= 3:
        raise ValueError("four segments serve distances up to 3")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), np.int64)
        for batch in batches:
            rows = np.stack([np.asarray(c).astype(np.int64) for c in batch.columns], axis=1)
            rows = np.concatenate([held, rows])
            cut = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            whole, held = (rows[:cut[-1]], rows[cut[-1]:]) if len(cut) else (rows[:0], rows)
            if len(whole):
                yield pairs(whole, cut[:-1])
        if len(held):
            yield pairs(held, np.zeros(0, np.int64))

    def pairs(rows: np.ndarray, cut: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(rows)]):
            if hi - lo > 1:
                fp = rows[lo:hi, 3]
                got = forest(fp.view(np.uint64), int(rows[lo, 0] >> 25), distance)
                a += fp[[u for u, _ in got]].tolist()
                b += fp[[v for _, v in got]].tolist()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (_blocks(distinct, block).repartition(n, "key", "x", "y").sortWithinPartitions("key", "x", "y")
            .mapInArrow(compare, "a long, b long"))


def simhash_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """(doc_id, fp, k1, k2) of every row; k1, k2 are the text's key."""
    @F.arrow_udf("long")
    def simhash(col: pa.Array) -> pa.Array:
        return pa.array(fingerprints(col, shingle, seed).view(np.int64))

    return docs.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text)).alias("fp"), *text_key(text))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, fp (long), component_id (the smallest doc_id reachable over links), root (a fingerprint that
    names the component, also where its ids are null), k1 and k2 (the text's key)."""
    rows = materialize(simhash_rows(docs, doc_id, text, shingle, seed), "prints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = connected_components(links(distinct.select("fp"), distance, block)).withColumnRenamed("node", "fp")
    classes = distinct.join(found, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialize(classes.join(least, "root").select("fp", "root", "component_id"), "components")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id", "root", "k1", "k2")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component one row with its smallest doc_id."""
    found = near_duplicates(docs, doc_id, text, **options).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Rows that repeat the smallest id with different texts: the one with the smallest text key.
    best = found.groupBy("root").agg(F.min(F.struct("k1", "k2", "doc_id")).alias("b"))
    best = best.select(F.col("b.k1").alias("b1"), F.col("b.k2").alias("b2"), F.col("b.doc_id").alias("b_id"))
    rows = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row"), F.col(doc_id).alias("id"), *text_key(text))
    rows = rows.join(best, (rows.k1 == best.b1) & (rows.k2 == best.b2) & rows.id.eqNullSafe(best.b_id), "left_semi")
    # Rows that repeat id and text: one of them, by a hash of the whole row.
    order = Window.partitionBy("k1", "k2", "id").orderBy(F.xxhash64("row"))
    return rows.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("row.*")


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                        "component_id")
