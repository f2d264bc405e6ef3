"""Conversation prefix trie, built with a splitter skeleton.

Conversations are paths of turns; a node stands for all that start with the same
turns.  Sorted by path, the members of a node are neighbours, so:

1. equal paths collapse to one row with counts, before the shuffle;
2. splitter paths from a sample cut the order into shards; the trie of the
   splitter paths, the skeleton, is broadcast.  A node whose members lie in
   several shards has a splitter among them, so it is in the skeleton;
3. each sorted shard is read once with a stack of open nodes and finishes every
   node outside the skeleton; of skeleton nodes it gives partial aggregates;
4. partial aggregates are reduced per skeleton node, and the skeleton, whose size
   follows from the number of shards, is rolled up from its leaves;
5. nodes then pass their smallest member down in preorder, shard by shard.

A conversation may hold a third of all rows, so paths are cut into segments of
``SEGMENT`` turns: nodes of depth b * SEGMENT + 1 to (b + 1) * SEGMENT form tries
under the hash of all turns before.  What later segments add to a node (leaves,
saved tokens, children of a segment's last node) is credited to the smallest
member of each later node and goes back along that member's segments.

Turns are told apart by 128-bit hashes of role and text.

Defined results: turns follow turn (null first), those with one number by a hash
of role and text; rows that repeat are turns of their own; a null role or text is
empty; rows with a null conv_id belong to no conversation; other columns are
ignored; an empty table has no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import assign_ids
from .shared import SPACE_RUN, materialize, thinned

SEGMENT = 64      # turns of a path row
HEAD = 3          # most turns a conversation takes from its base
SAMPLE = 32       # sampled paths for each shard
IDS = 4096        # conversation ids joined in one string


def _words(text: Column) -> Column:
    trimmed = F.regexp_replace(text, f"^{SPACE_RUN}|{SPACE_RUN}$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE_RUN))).cast("long")


def slim_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """Turns without their text: conv, pos (order over all rows), x, y (hashes of role and text) and w (words)."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), F.xxhash64(r, t).alias("x"),
        F.xxhash64(F.lit(7), r, t).alias("y"), _words(t).alias("w"))
    return materialize(assign_ids(rows, ["conv", "turn", "x", "y"], base=-1, id_col="pos").drop("turn"), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv, n) and their turns (conv, d, x, y, w) after taking over the base's first turns.

    Conversation c takes the first h turns of conversation c - c % 20 for its own first h, h = crc32(c) % 4.
    """
    own = turns.groupBy("conv").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("own"))
    base = turns.where("conv % 20 = 0").join(own, "conv").where(F.col("pos") - F.col("first") < HEAD)
    base = base.groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "x", "y", "w"))).alias("heads"))      # HEAD turns at most
    h = (F.crc32(F.col("conv").cast("string")) % (HEAD + 1)).cast("int")
    convs = own.withColumns({"h": h, "base": F.col("conv") - F.col("conv") % 20}).join(base, "base", "left")
    convs = convs.withColumn("heads", F.coalesce(F.slice("heads", F.lit(1), F.col("h")), F.slice("heads", 1, 0), F.expr(
        "cast(array() as array<struct<pos:bigint,x:bigint,y:bigint,w:bigint>>)")))
    convs = convs.withColumn("n", (F.size("heads") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long"))
    convs = materialize(convs.select("conv", "first", "h", "heads", "n"), "convs")
    taken = convs.select("conv", F.posexplode("heads").alias("i", "t")).select(
        "conv", (F.col("i") + 1).cast("long").alias("d"), "t.x", "t.y", "t.w")
    kept = turns.join(convs, "conv").where(F.col("pos") - F.col("first") >= F.col("h")).select(
        "conv", (F.col("pos") - F.col("first") - F.col("h") + F.size("heads") + 1).alias("d"), "x", "y", "w")
    return convs.select("conv", "n"), taken.unionByName(kept)


def segments(convs: DataFrame, turns: DataFrame, length: int) -> DataFrame:
    """One row per conversation and segment it reaches: conv, seg, n, key (longs: seg, hash before, turns), q1, q2 (hash after).

    A conversation that ends where a segment ends has an empty row in the next one.
    """
    reach = convs.select("conv", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"n div {length}"))).alias("seg"))
    parts = turns.withColumn("seg", F.expr(f"(d - 1) div {length}")).groupBy("conv", "seg").agg(
        F.bit_xor(F.xxhash64("d", "x", "y")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(7), "d", "x", "y")).alias("s2"),
        F.sort_array(F.collect_list(F.struct("d", "x", "y", "w"))).alias("units"))      # ``length`` turns at most
    rows = reach.join(parts, ["conv", "seg"], "left")
    zero, none = F.lit(0).cast("long"), F.expr("cast(array() as array<bigint>)")
    upto = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"q1": F.coalesce(F.bit_xor("s1").over(upto), zero), "q2": F.coalesce(F.bit_xor("s2").over(upto), zero)})
    p = [F.col(q).bitwiseXOR(F.coalesce(F.col(s), zero)) for q, s in (("q1", "s1"), ("q2", "s2"))]
    path = F.coalesce(F.flatten(F.transform("units", lambda u: F.array(u["x"], u["y"], u["w"]))), none)
    return rows.select("conv", "seg", "n", F.concat(F.array("seg", *p), path).alias("key"), "q1", "q2")


class Skeleton:
    """The trie of the splitter paths; a node is known by its number."""

    def __init__(self, splitters: list[tuple]):
        self.splitters = splitters
        self.step: dict[tuple, int] = {}          # (node above or -1, unit) -> node
        self.above: list[int] = []
        self.place: list[tuple[int, int, int]] = []   # segment, depth in it, words of the last turn
        for key in splitters:
            node = -1
            for depth, unit in enumerate(units(key)):
                if (node, unit) not in self.step:
                    self.step[node, unit] = len(self.above)
                    self.above.append(node)
                    self.place.append((key[0], depth, unit[2] if depth else 0))
                node = self.step[node, unit]

    def shard(self, key: tuple) -> int:
        return bisect_right(self.splitters, key)


def units(key) -> list[tuple]:
    """The segment's root, then its turns."""
    return [tuple(key[i:i + 3]) for i in range(0, len(key), 3)]


def skeleton_of(paths: DataFrame, shards: int) -> Skeleton:
    """Splitters from a sample of ``SAMPLE`` paths a shard (by hash, so that reruns agree); results do not depend on them."""
    drawn = thinned(paths.select("key"), ["key"], SAMPLE * shards).distinct().collect()
    keys = sorted({tuple(r["key"]) for r in drawn})
    return Skeleton(sorted({keys[len(keys) * i // shards] for i in range(1, shards)}) if keys else [])


_NODE = ["shard", "pre", "skel", "above", "seg", "depth", "conv", "n", "children", "leaves", "saved", "ends", "more", "w", "q1", "q2"]


def _scan(paths: DataFrame, skeleton) -> DataFrame:
    """All nodes outside the skeleton, finished, and shares of those in it, from paths sorted by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = skeleton.value.step
        out: list[list] = []
        stack: list[dict] = []
        path: list[tuple] = []
        shard = pre = None

        def close(keep: int) -> None:
            while len(stack) > keep:
                node = stack.pop()
                path.pop()
                up = stack[-1] if stack else None
                if node["skel"] < 0:
                    node["leaves"] += node["children"] == 0 and node["more"] == 0
                    node["saved"] += (node["n"] - 1) * node["w"]
                    if up:
                        up["children"] += 1
                        up["leaves"] += node["leaves"]
                        up["saved"] += node["saved"]
                if up:
                    up["n"] += node["n"]
                    up["conv"] = min(up["conv"], node["conv"])
                out.append([node[c] for c in _NODE])

        def batch() -> pa.RecordBatch:
            cols = [pa.array(c, pa.int64()) for c in zip(*out)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, _NODE)

        for rows in batches:
            for row in rows.to_pylist():
                if row["shard"] != shard:
                    close(0)
                    shard, pre = row["shard"], 0
                new = units(row["key"])
                same = 0
                while same < min(len(path), len(new)) and path[same] == new[same]:
                    same += 1
                close(same)
                for depth in range(same, len(new)):
                    up = stack[-1]["skel"] if stack else -1
                    skel = step.get((up, new[depth]), -1) if up >= 0 or not depth else -1
                    stack.append({"shard": shard, "pre": pre, "skel": skel, "above": up, "seg": new[0][0], "depth": depth,
                                  "conv": row["conv"], "n": 0, "children": 0, "leaves": 0, "saved": 0, "ends": 0, "more": 0,
                                  "w": new[depth][2] if depth else 0, "q1": None, "q2": None})
                    path.append(new[depth])
                    pre += 1
                top = stack[-1]
                top["conv"] = min(top["conv"], row["conv"])
                for c in ("n", "ends", "more", "children", "leaves", "saved"):
                    top[c] += row[c]
                top["q1"], top["q2"] = row["q1"], row["q2"]
                if len(out) >= 10_000:
                    yield batch()
        close(0)
        if out:
            yield batch()

    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (paths.repartition(n, "shard").sortWithinPartitions("shard", "key")
            .mapInArrow(run, ", ".join(f"{c} long" for c in _NODE)))


def _finish(skeleton: Skeleton, shares: list) -> list[dict]:
    """Skeleton nodes from their reduced shares, rolled up from the leaves."""
    nodes = {r["skel"]: r.asDict() for r in shares}
    for i in range(len(skeleton.above) - 1, -1, -1):          # nodes are numbered after those above
        node, up = nodes[i], nodes.get(skeleton.above[i])
        node["seg"], node["depth"], node["w"] = skeleton.place[i]
        node["leaves"] += node["children"] == 0 and node["more"] == 0
        node["own"] = (node["n"] - 1) * node["w"]
        node["saved"] += node["own"]
        if up:
            up["children"] += 1
            up["leaves"] += node["leaves"]
            up["saved"] += node["saved"]
    for i, node in nodes.items():
        node["parent"] = nodes[skeleton.above[i]]["conv"] if skeleton.above[i] >= 0 else None
    return list(nodes.values())


_OUT = ["seg", "depth", "conv", "parent", "n", "children", "leaves", "saved", "ends", "more", "w", "q1", "q2"]
_OUT_TYPE = ", ".join(f"{c} long" for c in _OUT)


def _with_parents(nodes: DataFrame, skeleton, least) -> DataFrame:
    """Preorder pass: a node's parent is the last one read with one depth less, or a skeleton node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = least.value
        open_: list[int | None] = []
        for rows in batches:
            cols = {c: rows.column(c) for c in rows.schema.names}
            parents = []
            for depth, conv, above in zip(*(cols[c].to_pylist() for c in ("depth", "conv", "above"))):
                if above >= 0:
                    parents.append(known[above])
                else:
                    parents.append(open_[depth - 1] if depth else None)
                del open_[depth:]
                open_ += [None] * (depth - len(open_)) + [conv]
            cols["parent"] = pa.array(parents, pa.int64())
            yield pa.RecordBatch.from_arrays([cols[c] for c in _OUT], _OUT)

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return nodes.repartition(n, "shard").sortWithinPartitions("shard", "pre").mapInArrow(run, _OUT_TYPE)


def trie(rows: DataFrame) -> DataFrame:
    """Nodes (seg, depth in it, conv, parent, n, children, leaves, saved, ends, more, w, q1, q2) of segment rows.

    ``rows`` has conv, key, q1, q2 and the sums n, ends, more, children, leaves and saved for the key's last node.
    The roots of later segments repeat the last nodes of the segments before; they are left out.
    """
    spark = rows.sparkSession
    sums = ("n", "ends", "more", "children", "leaves", "saved")
    paths = materialize(rows.groupBy("key", "q1", "q2").agg(F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in sums]),
                        "paths")
    skeleton = skeleton_of(paths, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = spark.sparkContext.broadcast(skeleton)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = shared.value.shard
        for batch in batches:
            at = pa.array([shard(tuple(k)) for k in batch.column("key").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, at], [*batch.schema.names, "shard"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in paths.schema)
    nodes = materialize(_scan(paths.mapInArrow(place, f"{schema}, shard long"), shared), "nodes")
    shares = nodes.where("skel >= 0").groupBy("skel").agg(
        F.min("conv").alias("conv"), F.max("q1").alias("q1"), F.max("q2").alias("q2"), *[F.sum(c).alias(c) for c in sums])
    top = _finish(skeleton, shares.collect())      # as many rows as the splitters have nodes
    least = spark.sparkContext.broadcast({node["skel"]: node["conv"] for node in top})
    rest = _with_parents(nodes.where("skel < 0"), shared, least)
    bones = spark.createDataFrame([tuple(node[c] for c in _OUT) for node in top], _OUT_TYPE)
    return rest.unionByName(bones).where("depth > 0 or seg = 0")


def ends_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids (conv) that share (n, q1, q2), comma-joined; a hot end is read in sorted strings of ids."""
    node = ["n", "q1", "q2"]
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, ids, out = None, 0, [], []

        def flush():
            if ids:
                out.append((*now, first, ",".join(ids)))
                ids.clear()

        for batch in batches:
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*node, "conv"))):
                if key != now or len(ids) == IDS:
                    flush()
                    now, first = key, conv
                ids.append(str(conv))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*node, "first", "ids"])
                out.clear()
        flush()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*node, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, out = None, None, []
        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*node, "ids"))):
                if key != now:
                    if sha:
                        out.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*node, "sha"])
                out.clear()
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, sha.hexdigest())], [*node, "sha"])

    strings = (ends.select(*node, "conv").repartitionByRange(parts, *node, "conv").sortWithinPartitions(*node, "conv")
               .mapInArrow(join, "n long, q1 long, q2 long, first long, ids string"))
    return (strings.repartition(parts, *node).sortWithinPartitions(*node, "first")
            .mapInArrow(digest, "n long, q1 long, q2 long, sha string"))


def prefix_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                length: int = SEGMENT) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    if length < 1:
        raise ValueError("a segment has one turn at least")
    convs, moved = rebuilt(slim_turns(turns, conv_id, turn, role, text))
    rows = segments(convs, moved, length)
    last = F.col("n") - F.col("seg") * length         # turns from this segment's root on; the row of an earlier end has none
    before_root = (last == 0) & (F.col("seg") > 0)
    rows = materialize(rows.withColumn("ends", ((last < length) & ~before_root | (last == length)).cast("long"))
                       .withColumn("more", (last > length).cast("long")), "segments")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    plain = ("conv", "key", "q1", "q2", one.alias("n"), "ends", "more")
    # Credits of later segments, by the smallest member of each node there.
    later = trie(rows.where("seg > 0").select(*plain, *[zero.alias(c) for c in ("children", "leaves", "saved")]))
    credit = later.groupBy("conv", "seg").agg(
        F.sum(F.when(F.col("depth") == 1, 1).otherwise(0)).alias("children"),
        F.sum(F.when((F.col("children") == 0) & (F.col("more") == 0), 1).otherwise(0)).alias("leaves"),
        F.sum((F.col("n") - 1) * F.col("w")).alias("saved"))
    after = Window.partitionBy("conv").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    next_ = Window.partitionBy("conv").orderBy(F.desc("seg"))
    many, few = rows.where(F.col("n") >= length), rows.where(F.col("n") < length)
    many = many.join(credit, ["conv", "seg"], "left").select(
        *plain, F.coalesce(F.lag("children").over(next_), zero).alias("children"),
        *[F.coalesce(F.sum(c).over(after), zero).alias(c) for c in ("leaves", "saved")])
    few = few.select(*plain, *[zero.alias(c) for c in ("children", "leaves", "saved")])
    nodes = trie(few.unionByName(many)).withColumn("depth", F.col("seg") * length + F.col("depth"))
    done = ends_hashes(rows.where("ends = 1").select("conv", "n", "q1", "q2"))
    done = done.select(F.col("n").alias("at"), F.col("q1").alias("e1"), F.col("q2").alias("e2"), "sha")
    met = (F.col("ends") > 0) & (F.col("depth") == F.col("at")) & (F.col("q1") == F.col("e1")) & (F.col("q2") == F.col("e2"))
    return nodes.join(done, met, "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op11(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP11_SQL = f"""
WITH RECURSIVE o AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT c, 0 AS j, 4294967295::BIGINT AS v, c::VARCHAR AS s FROM (SELECT DISTINCT c FROM o)
  UNION ALL
  SELECT c, j + 1, list_reduce(list_prepend(xor(v, ascii(s[j + 1])::BIGINT), [x::BIGINT FOR x IN range(8)]),
         lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), s
  FROM crc WHERE j < length(s)),
k AS (SELECT c, xor(v, 4294967295) % 4 AS h FROM crc WHERE j = length(s)),
r AS (
  SELECT k.c, o.i, o.role, o.text FROM k JOIN o ON o.c = k.c - k.c % 20 AND o.i < k.h
  UNION ALL SELECT k.c, o.i, o.role, o.text FROM k JOIN o ON o.c = k.c AND o.i >= k.h),
n AS (
  SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY i) AS d,
         list(sha256(role || chr(31) || text)) OVER (PARTITION BY c ORDER BY i) AS p FROM r),
m AS (
  SELECT c, d, p, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) AS w,
         d = max(d) OVER (PARTITION BY c) AS ended FROM n
  UNION ALL SELECT k.c, 0, []::VARCHAR[], 0, NOT EXISTS (SELECT 1 FROM n WHERE n.c = k.c) FROM k),
v AS (
  SELECT d, p, min(c) AS c, count(*) AS n, any_value(w) AS w,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ended), '')) AS e FROM m GROUP BY d, p),
u AS (SELECT v.*, up.c AS parent, (SELECT count(*) FROM v ch WHERE ch.d = v.d + 1 AND ch.p[1:v.d] = v.p) AS kids
      FROM v LEFT JOIN v up ON up.d = v.d - 1 AND v.p[1:v.d - 1] = up.p),
s AS (
  SELECT a.d AS d, a.p AS p, sum((b.n - 1) * b.w) AS saved, count(*) FILTER (b.kids = 0) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS above FROM u) b JOIN v a ON a.d = b.above AND a.p = b.p[1:b.above] GROUP BY a.d, a.p)
SELECT u.c::BIGINT AS conv_id, u.d::BIGINT AS depth, u.parent::BIGINT AS parent_conv_id, u.n::BIGINT AS n_convs,
       u.kids::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, u.e AS ends_sha256
FROM u JOIN s ON s.d = u.d AND s.p = u.p
"""
