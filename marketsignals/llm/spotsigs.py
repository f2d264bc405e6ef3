"""Document fingerprints: SpotSigs.

A signature is an anchor, one of the corpus' most common words, and the chain of
the ``CHAIN`` next content words (words that are no anchors) after it, every
``STEP``-th counted.  A text's fingerprint is the sorted set of its signatures'
64-bit hashes, 16 hex digits each.  Anchors are the ``ANCHORS`` words that most
documents have, counted over the whole corpus, so no language is built in.  A
text without a complete chain has its word sequences of chain length as
signatures, a shorter one its whole sequence.

Likeness is the Jaccard similarity of two sets.  Sets of sizes a <= b reach at
most a / b, which prunes a comparison at once (``jaccard``) and in a join
(``near_pairs``): sets are put into classes of size such that likeness ``least``
needs equal or neighbouring classes, and pairs must meet in one of the rarest
signatures that no like pair can miss.

For neighbours in an order (``with_next``) texts are shuffled once: a slim sample
gives splitters, and the first row of each shard goes to the shard before as well.

Defined results: words are runs of ASCII letters and digits (A-Z lower-cased)
and of non-ASCII characters; a null or empty text, and one without words, has the
empty set, and two empty sets are alike (1); documents follow doc_id
descending, null last, those with one doc_id by a hash of their text; a
single document is its own next; repeated rows are neighbours; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .shared import materialize, text_key, thinned
from .textkit import ALNUM, ASCII_LOWER, CHUNK, U64, chunks, mix, word_hashes, words

ANCHORS = 256
CHAIN = 2
STEP = 1
LIKE = 0.8
SAMPLE = 64       # sampled rows for each shard
LAST = (1 << 63) - 1


def common_words(docs: DataFrame, text: str = "text", anchors: int = ANCHORS) -> np.ndarray:
    """Sorted hashes of the words that most documents have (ties by hash)."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch.column(0)):
                data = ASCII_LOWER[part.data]
                starts, _, bounds = words(data, part.offs, ALNUM)
                h = word_hashes(data, starts, ALNUM)
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                once = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])) if len(h) else np.zeros(0, bool)
                h, n = np.unique(h[once], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    counts = docs.select(text).mapInArrow(emit, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(anchors).collect()
    return np.sort(np.array([r["h"] for r in top], np.int64).view(U64))


def signatures(col: pa.Array, anchors: np.ndarray, chain: int = CHAIN, step: int = STEP) -> list[np.ndarray]:
    """The sorted distinct signatures (uint64) of each text."""
    out: list[np.ndarray] = []
    for part in chunks(col):
        data = ASCII_LOWER[part.data]
        starts, _, bounds = words(data, part.offs, ALNUM)
        h = word_hashes(data, starts, ALNUM)
        at = np.searchsorted(anchors, h)
        common = (anchors[np.minimum(at, len(anchors) - 1)] == h) if len(anchors) else np.zeros(len(h), bool)
        spots, content = np.flatnonzero(common), np.flatnonzero(~common)
        doc = np.searchsorted(bounds, spots, "right") - 1
        begin = np.searchsorted(content, spots)                     # first content word after the anchor
        end = np.searchsorted(content, bounds[doc + 1]) if len(spots) else begin
        full = begin + chain * step <= end
        spots, begin, doc = spots[full], begin[full], doc[full]
        sig = h[spots]
        for i in range(1, chain + 1):
            sig = mix(sig + h[content[begin + i * step - 1]] * U64(2 * i + 1))
        order = np.lexsort((sig, doc))
        sig, doc = sig[order], doc[order]
        new = np.append(True, (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])) if len(sig) else np.zeros(0, bool)
        sig, doc = sig[new], doc[new]
        cut = np.searchsorted(doc, np.arange(len(bounds)))
        for i in range(len(bounds) - 1):
            own = sig[cut[i]:cut[i + 1]]
            if not len(own) and bounds[i] < bounds[i + 1]:
                own = _sequences(h[bounds[i]:bounds[i + 1]], chain)
            out.append(own)
    return out


def _sequences(h: np.ndarray, chain: int) -> np.ndarray:
    n = min(chain, len(h))
    sig = np.zeros(len(h) - n + 1, U64)
    for i in range(n):
        sig = mix(sig + h[i:len(h) - n + 1 + i] * U64(2 * i + 1))
    return np.unique(sig)


def fingerprint(sig: np.ndarray) -> str:
    return sig.astype(">u8").tobytes().hex()


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float | None:
    """Likeness of two sets; None, without comparing them, if their sizes keep it below ``least``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large:
        return None
    both = len(np.intersect1d(a, b, assume_unique=True)) if small else 0
    found = both / (small + large - both)
    return found if found >= least else None


def sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", anchors: int = ANCHORS, chain: int = CHAIN,
         step: int = STEP) -> DataFrame:
    """doc_id and sigs (array of signature hashes) of each row."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(common_words(docs, text, anchors))     # ``anchors`` numbers
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [s.view(np.int64) for s in signatures(batch.column(1), known.value, chain, step)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.int64()))], ["doc_id", "sigs"])

    return docs.select(F.col(doc_id).alias("doc_id"), text).mapInArrow(emit, f"doc_id {kind}, sigs array<long>")


def size_class(n, least: float):
    """Sets of sizes a <= b with a / b >= least are in one class or in neighbouring ones."""
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / F.log(F.lit(1 / least)) + F.lit(1e-9)).cast("int")


def near_pairs(found: DataFrame, least: float = LIKE) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets (doc_id, class_id) and like classes (a, b, likeness), a < b; empty sets have no partner.

    ``found`` has doc_id and sigs.  A class is named by the smallest doc_id in it; rows with a null doc_id
    have their class, but a class of only such rows has no name and no pairs.
    """
    rows = found.select("doc_id", "sigs", F.xxhash64("sigs").alias("k1"), F.xxhash64(F.lit(7), "sigs").alias("k2"))
    names = materialize(rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("class_id")), "classes")
    members = rows.join(names, ["k1", "k2"])
    reps = materialize(members.where("doc_id = class_id and size(sigs) > 0").select("class_id", "sigs")
                       .dropDuplicates(["class_id"]), "sets")
    seen = reps.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    ranked = reps.select("class_id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig")).join(seen, "sig")
    # A like partner shares at least one of a set's n - ceil(least * n) + 1 rarest signatures.
    need = (F.col("n") - F.ceil(F.col("n") * F.lit(least) - F.lit(1e-9)) + 1).cast("int")
    prefix = ranked.groupBy("class_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("by"))
    prefix = materialize(prefix.select("class_id", "n", F.explode(F.slice("by", F.lit(1), need)).alias("p"))
                         .select("class_id", "n", "p.sig", size_class(F.col("n"), least).alias("size")), "prefixes")
    a = prefix.select(F.col("class_id").alias("a"), F.col("n").alias("n_a"), "sig",
                      F.explode(F.array("size", F.col("size") + 1)).alias("size"))
    b = prefix.select(F.col("class_id").alias("b"), F.col("n").alias("n_b"), "sig", "size")
    meet = a.join(b, ["sig", "size"]).where((F.col("n_a") < F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    meet = meet.where(F.col("n_a") >= F.col("n_b") * F.lit(least) - F.lit(1e-9)).select("a", "b").distinct()
    both = (meet.join(reps.select(F.col("class_id").alias("a"), F.col("sigs").alias("s_a")), "a")
            .join(reps.select(F.col("class_id").alias("b"), F.col("sigs").alias("s_b")), "b"))
    shared = F.size(F.array_intersect("s_a", "s_b"))
    both = both.withColumn("likeness", shared / (F.size("s_a") + F.size("s_b") - shared)).where(F.col("likeness") >= F.lit(least))
    return members.select("doc_id", "class_id"), both.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")


def _splitters(rows: DataFrame, shards: int) -> list[tuple]:
    """Places (o, k1) that cut the rows (o, k1, n) into shards of like text; from a sample of bounded size."""
    drawn = thinned(rows, ["o", "k1"], SAMPLE * shards).groupBy("o", "k1").agg(F.sum("n").alias("n")).collect()
    keys = sorted((r["o"], r["k1"], r["n"]) for r in drawn)
    upto = np.cumsum([k[2] + 64 for k in keys])
    at = [int(np.searchsorted(upto, upto[-1] * i / shards)) for i in range(1, shards)] if keys else []
    return sorted({keys[i][:2] for i in at})


def with_next(docs: DataFrame, doc_id: str, text: str, use, schema: str) -> DataFrame:
    """``use(ids, texts, following)`` over runs of documents in descending doc_id.

    ``texts`` has one text for each id; ``following`` is the text of the document after the run (after the last
    document: the first).  ``use`` returns a record batch.
    """
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.bitwise_not(F.col(doc_id).cast("long")), F.lit(LAST)).alias("o")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), order, *text_key(text))
    slim = materialize(docs.select(order, *text_key(text), F.coalesce(F.length(text), F.lit(0)).alias("n")), "places")
    splitters = _splitters(slim.select("o", "k1", "n"), shards)

    @F.pandas_udf("long")
    def shard(o, k1):
        return o.combine(k1, lambda x, y: bisect_right(splitters, (x, y)))

    # The first place of each shard also goes to the shard before (that of the first shard to the last): one row a shard.
    heads = (slim.withColumn("shard", shard("o", "k1")).groupBy("shard")
             .agg(F.min(F.struct("o", "k1", "k2")).alias("p")).orderBy("shard").collect())
    to = [(*h["p"], heads[i - 1]["shard"]) for i, h in enumerate(heads)]
    guests = spark.createDataFrame(to, "o long, k1 long, k2 long, to long")
    placed = rows.withColumn("shard", shard("o", "k1")).join(F.broadcast(guests), ["o", "k1", "k2"], "left")
    here = F.struct(F.col("shard"), F.lit(False).alias("guest"))
    there = F.when(F.col("to").isNotNull(), F.array(here, F.struct(F.col("to").alias("shard"), F.lit(True).alias("guest"))))
    placed = placed.withColumn("at", F.explode(F.coalesce(there, F.array(here)))).select("doc_id", "text", "o", "k1", "k2", "at.shard", "at.guest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        size, now, ended = 0, None, False
        for batch in batches:
            for d, t, s, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "shard", "guest"))):
                t = t or ""
                if s != now:
                    now, ended = s, False
                if guest:
                    if not ended:                      # equal heads come more than once
                        ended = True
                        yield use(ids, texts, t)
                        ids, texts, size = [], [], 0
                    continue
                if size >= CHUNK:
                    yield use(ids, texts, t)
                    ids, texts, size = [], [], 0
                ids.append(d)
                texts.append(t)
                size += len(t)

    return (placed.repartition(shards, "shard").sortWithinPartitions("shard", "guest", "o", "k1", "k2")
            .mapInArrow(run, schema))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", anchors: int = ANCHORS,
                        chain: int = CHAIN, step: int = STEP) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text has its last third replaced by the beginning of the next document.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(common_words(docs, text, anchors))     # ``anchors`` numbers
    kind = docs.select(doc_id).schema[0].dataType
    arrow_kind = to_arrow_type(kind)

    def use(ids: list, texts: list[str], following: str) -> pa.RecordBatch:
        n = len(texts)
        after = texts[1:] + [following]
        edited = [t[:len(t) - len(t) // 3] + x[:len(t) // 3] for t, x in zip(texts, after)]
        sigs = signatures(pa.array([*texts, following, *edited], pa.large_string()), known.value, chain, step)
        own, new = sigs[:n + 1], sigs[n + 1:]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, arrow_kind), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
             pa.array(map(fingerprint, own[:n]), pa.string()), pa.array(map(fingerprint, new), pa.string()),
             pa.array([jaccard(a, b) for a, b in zip(own, new)], pa.float64()),
             pa.array([jaccard(a, b) for a, b in zip(own[:-1], own[1:])], pa.float64())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next(docs, doc_id, text, use,
                     f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
                     "edited_fingerprint string, near_edited double, near_next double")


def op12(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
