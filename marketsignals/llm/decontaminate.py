"""Benchmark decontamination by winnowing.

Windows of ``window`` words are fingerprinted by their 5-gram of smallest hash
(``textkit.anchored_runs``): every shared window has a shared fingerprint, so
every shared span of that many words is found.  Items with fewer words are one
window each and are their own fingerprint.  Document fingerprints that pass a
fixed-size bitmap of the benchmark's are extended to the windows that hold them,
which join the benchmark's by fingerprint and, word by word, by content; joined
windows that meet are one hit.

Equal benchmark windows are one row with the list of their items, so a document
window joins one row at most, however many items share a phrase.  The benchmark's
side is broadcast if its measured size is below ``BROADCAST_BYTES``; beyond it the
join shuffles both sides.

Defined results: null and empty texts have no words; an item without words has
no window; an item with a null id is listed as the empty string; rows that
repeat are reported each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import hash_bitmap, in_bitmap, materialize, text_key
from .textkit import ALNUM, ASCII_LOWER, U64, anchored_runs, chunks, gram_hashes, mix, word_hashes, words

WINDOW = 10
GRAM = 5
BROADCAST_BYTES = 32 << 20

_RUNS = "runs array<struct<h:long,size:int,s:int,words:binary>>"


def _fingerprints(rows: DataFrame, sizes: list[int], window: int, wanted=None) -> DataFrame:
    """Rows (.., text) as (.., n_words, runs): the windows of each size that hold a winnowed fingerprint."""
    carried = rows.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    kind = pa.list_(pa.struct([("h", pa.int64()), ("size", pa.int32()), ("s", pa.int32()), ("words", pa.binary())]))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if wanted is None else wanted.value
        for batch in batches:
            for part in chunks(batch.column(len(carried))):
                data = ASCII_LOWER[part.data]
                starts, ends, bounds = words(data, part.offs, ALNUM)
                units = word_hashes(data, starts, ALNUM)
                raw, out = data.tobytes(), [[] for _ in range(len(bounds) - 1)]
                for size in sizes:
                    k = GRAM if size == window else size
                    runs = anchored_runs(gram_hashes(units, k), bounds, k, size - k + 1)
                    h = mix(runs.hash + U64(size))
                    for i in np.flatnonzero(in_bitmap(bitmap, h)) if bitmap is not None else range(len(h)):
                        doc, key = runs.text[i], int(h[i].view(np.int64))
                        for lo in range(runs.first[i], runs.last[i] + 1):
                            held = b" ".join(raw[starts[j]:ends[j]] for j in range(lo, lo + size))
                            out[doc].append({"h": key, "size": size, "s": int(lo - bounds[doc]), "words": held})
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(part.first, n) for c in range(len(carried))]
                    + [pa.array(np.diff(bounds).astype(np.int64)), pa.array(out, kind)],
                    [*carried, "n_words", "runs"])

    return rows.mapInArrow(emit, f"{schema}, n_words long, {_RUNS}")


def hit_windows(cand: DataFrame, grams: DataFrame) -> DataFrame:
    """Document windows (rid, h, size, s, words) that the benchmark holds, as (rid, s, e, items): one row each at most."""
    held = grams.agg(F.sum(F.length("b_words") + 24 * F.size("b_items") + 64)).first()[0] or 0
    joined = cand.join(F.broadcast(grams) if held <= BROADCAST_BYTES else grams,
                       [cand.h == grams.b_h, cand.size == grams.b_size, cand.words == grams.b_words])
    return joined.select("rid", "s", (F.col("s") + F.col("size")).alias("e"), F.col("b_items").alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, hits (word intervals), n_items, items, contaminated, k1, k2."""
    if window < GRAM:
        raise ValueError(f"windows have at least {GRAM} words")
    spark = docs.sparkSession
    sc = spark.sparkContext
    bench = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                             F.col(item_text).alias("text"))
    # At most ``window`` different sizes: the window and the lengths of shorter items.
    short = _fingerprints(bench, [], window).where(f"n_words between 1 and {window - 1}")
    sizes = [window, *sorted(int(r[0]) for r in short.select("n_words").distinct().collect())]
    grams = _fingerprints(bench, sizes, window).select("item", "n_words", F.explode("runs").alias("r"))
    grams = grams.where(f"r.size = least(n_words, {window})").groupBy("r.h", "r.size", "r.words").agg(
        F.collect_set("item").alias("items"))
    grams = materialize(grams.select(*(F.col(c).alias(f"b_{c}") for c in ("h", "size", "words", "items"))), "bench")

    wanted = sc.broadcast(hash_bitmap(spark, grams.select("b_h"), "b_h"))
    work = docs.select(F.col(doc_id).alias("doc_id"), *text_key(text), F.col(text).alias("text"))
    base = materialize(_fingerprints(work, sizes, window, wanted)
                       .withColumn("rid", F.monotonically_increasing_id()), "doc_prints")
    wanted.destroy()
    cand = base.where(F.size("runs") > 0).select("rid", F.inline("runs"))
    hits = hit_windows(cand, grams).groupBy("rid").agg(
        F.sort_array(F.collect_set(F.struct("s", "e"))).alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    merged = F.aggregate("found", F.expr("cast(array() as array<struct<s:int,e:int>>)"), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["e"] >= x["s"]),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                 F.array(F.struct(F.try_element_at(acc, F.lit(-1))["s"].alias("s"),
                                  F.greatest(F.try_element_at(acc, F.lit(-1))["e"], x["e"]).alias("e")))))
        .otherwise(F.concat(acc, F.array(x))))
    hits = hits.select("rid", merged.alias("hits"), "items")
    none = "cast(array() as array<struct<s:int,e:int>>)"
    out = base.drop("runs").join(hits, "rid", "left").withColumns({
        "hits": F.coalesce("hits", F.expr(none)), "items": F.coalesce("items", F.expr("cast(array() as array<string>)"))})
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + (x["e"] - x["s"]))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), "hits", F.size("items").cast("long").alias("n_items"),
                      "items", (n_hit > 0).alias("contaminated"), "k1", "k2")


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, bench).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated")
