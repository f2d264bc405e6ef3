"""Operator 11: conversation prefix trie."""

import pytest

from marketsignals.llm import prefix_trie
from marketsignals.llm.queries import QUERIES

from . import brute
from .conftest import SF, passage, same

OP11 = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
# Long shared starts, copies, conversations that end inside others, gaps, nulls, repeated rows, odd ids.
TURNS = ([(c, i, "user" if i % 2 else "bot", f"same start {i}") for c in (0, 1, 2, 3, 40, 41) for i in range(9)]
         + [(c, i, "user", f"own {c} {i}") for c in (1, 41) for i in range(9, 15)]
         + [(5, i, "user", "copy of one  text\tand more") for i in range(6)] + [(6, i, "user", "copy of one  text\tand more") for i in range(6)]
         + [(7, None, "user", "first"), (7, 0, "bot", None), (7, 0, None, "x"), (7, 3, "bot", "x"), (7, 3, "bot", "x")]
         + [(8, 1, "user", "one")] + [(20, 0, "", ""), (20, 1, None, None), (21, 0, "user", "a")]
         + [(None, 0, "user", "nobody"), (-7, 0, "user", "b c"), (-7, 1, "user", passage(1, 5000)), (-20, 0, "user", "b c")]
         + [(c, 0, "user", "common first turn") for c in range(100, 160)] + [(c, 1, "bot", f"{c % 3}") for c in range(100, 160)])


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", [2]) for r in rows],
                                 "conv_id long, turn long, role string, text string, n int, key string, x array<int>")


@pytest.mark.parametrize("length", [1, 2, 3, 64])
def test_edges(spark, length):
    same(prefix_trie.prefix_trie(table(spark, TURNS), length=length), brute.trie(TURNS), *OP11)


def test_many_and_few_shards(spark):
    want = brute.trie(TURNS)
    for n in ("1", "40"):
        other = spark.newSession()
        other.conf.set("spark.sql.shuffle.partitions", n)
        same(prefix_trie.prefix_trie(table(other, TURNS), length=4), want, *OP11)


def test_skeleton_holds_every_node_of_two_shards():
    keys = [(0, 0, 0, *[v for u in path for v in (u, u, 1)]) for path in ([], [1], [1, 2], [1, 2, 3], [1, 4], [5], [5, 6])]
    skeleton = prefix_trie.Skeleton([keys[3], keys[5]])
    shards = {}
    for key in sorted(keys):
        for i in range(3, len(key) + 1, 3):
            shards.setdefault(key[:i], set()).add(skeleton.shard(key))
    for prefix, at in shards.items():
        node = -1
        for unit in prefix_trie.units(prefix):
            node = skeleton.step.get((node, unit), -2)
        assert len(at) == 1 or node >= 0


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(QUERIES["op11_prefix_trie"](spark, SF), brute.trie(rows), *OP11)


def test_empty(spark, empty_dir):
    assert QUERIES["op11_prefix_trie"](spark, empty_dir).count() == 0
