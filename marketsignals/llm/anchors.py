"""Repeated windows of a corpus, found through anchored contexts.

Both substring operators ask which windows of L consecutive units (words or
bytes) occur more than once.  Every window is owned by its k-gram of smallest
hash (``textkit.anchored_runs``); the windows that one k-gram owns, with the
units they cover, are a *context* of at most 2 w + k units.  Two equal windows
have equal anchors, so only contexts with one anchor hash have to meet:

1. anchor hashes are counted; a fixed-size bitmap keeps those seen twice;
2. contexts whose anchor passes are written down as (text, offset, hashes);
3. equal contexts collapse to one row with a count and a first place, before
   and after the shuffle, so thousands of copies are one row;
4. an anchor with one context only needs no text: all its windows repeat;
5. for the others, one text per distinct context goes to a solver, which gets
   whole anchor groups in shards of bounded size;
6. an anchor with over ``most`` distinct contexts is not given to one task: its
   contexts are cut into single windows, which group by their own content.

The result says, for each distinct context, which units of it repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, hash_bitmap, in_bitmap, materialize
from .textkit import (NON_SPACE, U64, _powers, anchored_runs, byte_gram_hashes, chunks, gram_hashes, merge, mix,
                      word_hashes, words)

PLACE = 1 << 32   # places in a corpus: order of the text * PLACE + offset


class Spec(NamedTuple):
    unit: str         # "word" or "byte"
    k: int            # units of an anchor
    w: int            # anchors of a window
    first: bool       # keep the first occurrence of a window?
    most: int = 8192  # distinct contexts of an anchor that one solver call may get

    @property
    def length(self) -> int:
        return self.k + self.w - 1


# A solver gets texts, counts and places of contexts and returns the intervals of each that repeat.
Solver = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]


def contexts(docs: DataFrame, spec: Spec, wanted=None, text: bool = False) -> DataFrame:
    """All contexts of ``docs`` (k1, k2, ord, text) with an anchor in the bitmap ``wanted`` (a broadcast; None: any)."""
    named = "k1 long, k2 long, ord long, off int, len int, h long, c long"
    schema = "h long" if wanted is None else named + (", ctx binary" if text else "")
    slim = wanted is None

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if slim else wanted.value
        length = spec.length
        for batch in batches:
            keys = None if slim else [np.asarray(batch.column(i)) for i in range(3)]
            for part in chunks(batch.column(batch.schema.get_field_index("text"))):
                if spec.unit == "word":
                    starts, ends, bounds = words(part.data, part.offs, NON_SPACE)
                    units = word_hashes(part.data, starts, NON_SPACE)
                    grams = gram_hashes(units, spec.k)
                else:
                    bounds, units = part.offs, None
                    grams = byte_gram_hashes(part.data, spec.k)
                runs = anchored_runs(grams, bounds, spec.k, spec.w)
                owners = mix(runs.hash)        # as minima they would fill a small part of the bitmap only
                if slim:
                    if len(owners):
                        yield pa.RecordBatch.from_arrays([pa.array(owners.view(np.int64))], ["h"])
                    continue
                keep = in_bitmap(bitmap, owners)
                if not keep.any():
                    continue
                h, lo, last, doc = owners[keep], runs.first[keep], runs.last[keep], runs.text[keep]
                hi = last + length
                if units is None:
                    units = part.data.astype(U64) + U64(1)
                up, down = _powers(len(units) + 1)
                total = np.zeros(len(units) + 1, U64)
                np.cumsum(units * up[:-1], out=total[1:])
                c = mix((total[hi] - total[lo]) * down[lo] ^ (hi - lo).astype(U64))
                row = part.first + doc
                cols = [k[row] for k in keys] + [(lo - bounds[doc]).astype(np.int32), (hi - lo).astype(np.int32),
                                                 h.view(np.int64), c.view(np.int64)]
                arrays = [pa.array(x) for x in cols]
                if text:
                    raw = part.data.tobytes()
                    if spec.unit == "word":
                        a, b = starts[lo], ends[hi - 1]
                        arrays.append(pa.array([b" ".join(raw[x:y].split()) for x, y in zip(a, b)], pa.binary()))
                    else:
                        arrays.append(pa.array([raw[x:y] for x, y in zip(lo, hi)], pa.binary()))
                names = ["k1", "k2", "ord", "off", "len", "h", "c", "ctx"]
                yield pa.RecordBatch.from_arrays(arrays, names[:len(arrays)])

    cols = ["text"] if slim else ["k1", "k2", "ord", "text"]
    return docs.select(*cols).mapInArrow(emit, schema)


def _place():
    return F.col("ord").cast("decimal(20,0)") * F.lit(PLACE).cast("decimal(10,0)") + F.col("off").cast("decimal(10,0)")


def _split_place():
    """The two longs of a place; offsets are below half of PLACE, so the rounded quotient has the right floor."""
    big = F.lit(PLACE).cast("decimal(10,0)")
    doc = F.floor(F.col("place") / big).cast("decimal(20,0)")
    return doc.cast("long").alias("fd"), (F.col("place") - doc * big).cast("long").alias("fo")


def _solve(found: DataFrame, spec: Spec, solver: Solver, shard: int) -> DataFrame:
    """Intervals of each distinct context; whole anchor groups meet in one solver call of about ``shard`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def flush():
            h, c, ctx, n, fd, fo = zip(*held)
            spans = solver(list(ctx), np.array(n, np.int64), np.array(fd, np.int64), np.array(fo, np.int64))
            rows = [(a, b, s.tolist(), e.tolist()) for a, b, (s, e) in zip(h, c, spans) if len(s)]
            held.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                                  pa.array([r[1] for r in rows], pa.int64()),
                                                  pa.array([r[2] for r in rows], pa.list_(pa.int32())),
                                                  pa.array([r[3] for r in rows], pa.list_(pa.int32()))],
                                                 ["h", "c", "s", "e"])

        for batch in batches:
            for row in zip(*(col.to_pylist() for col in batch.columns)):
                if size >= shard and row[0] != last:
                    yield from flush()
                    size = 0
                held.append(row)
                last = row[0]
                size += len(row[2])
        if held:
            yield from flush()

    rows = found.select("h", "c", "ctx", "n", *_split_place())
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(n, "h").sortWithinPartitions("h")
            .mapInArrow(run, "h long, c long, s array<int>, e array<int>"))


def _by_window(found: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame]:
    """The exact way for anchors with very many contexts: each window by itself, grouped by its whole content.

    The table of windows, and the intervals."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = spec.length
        for batch in batches:
            cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            at, rel, win = [], [], []
            for i, ctx in enumerate(cols["ctx"].to_pylist()):
                if spec.unit == "word":
                    parts = ctx.split(b" ")
                    got = [b" ".join(parts[j:j + length]) for j in range(len(parts) - length + 1)]
                else:
                    got = [ctx[j:j + length] for j in range(len(ctx) - length + 1)]
                at += [i] * len(got)
                rel += range(len(got))
                win += got
            take = pa.array(at, pa.int64())
            place = cols["fo"].to_numpy()[at] + np.array(rel, np.int64)
            yield pa.RecordBatch.from_arrays(
                [cols["h"].take(take), cols["c"].take(take), cols["n"].take(take), cols["fd"].take(take),
                 pa.array(place, pa.int64()), pa.array(rel, pa.int32()), pa.array(win, pa.binary())],
                ["h", "c", "n", "ord", "off", "rel", "win"])

    cut_rows = found.select("h", "c", "ctx", "n", *_split_place()).mapInArrow(
        cut, "h long, c long, n long, ord long, off long, rel int, win binary")
    cut_rows = materialize(cut_rows.withColumn("place", _place())
                           .withColumn("x", F.xxhash64("win")).withColumn("y", F.xxhash64(F.lit(7), "win"))
                           .select("h", "c", "n", "rel", "x", "y", "place"), "windows")
    seen = cut_rows.groupBy("x", "y").agg(F.sum("n").alias("total"), F.min("place").alias("least"))
    hit = cut_rows.join(seen, ["x", "y"]).where(
        F.col("place") > F.col("least") if spec.first else F.col("total") >= 2)
    return cut_rows, (hit.groupBy("h", "c").agg(F.sort_array(F.collect_set("rel")).alias("s"))
                      .select("h", "c", "s", F.transform("s", lambda r: r + F.lit(spec.length)).alias("e")))


def repeated_units(docs: DataFrame, spec: Spec, solver: Solver, shard: int) -> DataFrame:
    """Per text (k1, k2; with ``spec.first`` also ord) the arrays ``s``, ``e`` of repeated intervals, by unit.

    ``docs`` has k1, k2, ord and text.  Intervals may overlap.  Texts without
    repeated windows have no row.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    often = contexts(docs, spec).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    seen = sc.broadcast(hash_bitmap(spark, often, "h"))
    occ = materialize(contexts(docs, spec, seen), "contexts")
    seen.destroy()

    distinct = materialize(occ.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min("len").alias("len"),
                                                     *([F.min(_place()).alias("place")] if spec.first else [])), "distinct")
    groups = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("t"),
                                       F.min("c").alias("c"), F.min("len").alias("len"))
    mixed = materialize(groups.where("m >= 2").select("h", "m"), "mixed")
    seen = sc.broadcast(hash_bitmap(spark, mixed, "h"))
    texts = contexts(docs, spec, seen, text=True)
    texts = materialize(texts.groupBy("h", "c", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias("place")),
                        "texts")
    seen.destroy()
    hot = materialize(mixed.where(F.col("m") > spec.most).select("h"), "hot")
    used = [distinct, mixed, hot, texts]
    if hot.limit(1).count():
        windows, rest = _by_window(texts.join(hot, "h", "left_semi"), spec)
        solved = _solve(texts.join(hot, "h", "left_anti"), spec, solver, shard).unionByName(rest)
        used.append(windows)
    else:
        solved = _solve(texts, spec, solver, shard)

    if spec.first:
        # Later occurrences of a context go whole; its first one loses what an earlier context has.
        what = materialize(distinct.withColumnRenamed("place", "least").join(solved, ["h", "c"], "left")
                           .where("n >= 2 or s is not null").select("h", "c", "least", "s", "e"), "decided")
        later = _place() > F.col("least")
        spans = (occ.join(what, ["h", "c"]).where(later | F.col("s").isNotNull())
                 .select("k1", "k2", "ord", "off", F.when(later, F.array(F.lit(0))).otherwise(F.col("s")).alias("s"),
                         F.when(later, F.array("len")).otherwise(F.col("e")).alias("e")))
        keys = ["k1", "k2", "ord"]
    else:
        alone = groups.where("m = 1 and t >= 2").select("h", "c", F.array(F.lit(0)).alias("s"), F.array("len").alias("e"))
        what = materialize(alone.unionByName(solved), "decided")
        spans = occ.join(what, ["h", "c"]).select("k1", "k2", "off", "s", "e")
        keys = ["k1", "k2"]
    discard(*used)
    parts = spans.select(*keys, F.transform("s", lambda x: x + F.col("off")).alias("s"),
                         F.transform("e", lambda x: x + F.col("off")).alias("e"))
    return parts.groupBy(*keys).agg(F.collect_set(F.struct("s", "e")).alias("parts")).select(
        *keys, F.flatten("parts.s").alias("s"), F.flatten("parts.e").alias("e"))


def cover(starts, ends) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals from two lists that may be None."""
    if starts is None or not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return merge(np.asarray(starts, np.int64), np.asarray(ends, np.int64))
