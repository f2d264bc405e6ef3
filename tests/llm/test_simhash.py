"""Operator 1: SimHash near-dedup."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketsignals.llm import simhash
from marketsignals.llm.components import connected_components
from marketsignals.llm.queries import QUERIES

from . import brute
from .conftest import EDGE, SF, same

OP1 = ("doc_id", "fingerprint", "component_id")


def test_edges(spark, edge_dir):
    same(QUERIES["op1_simhash_dedup"](spark, edge_dir), brute.simhash(EDGE), *OP1)


def test_whole_table(spark, sf_rows):
    same(QUERIES["op1_simhash_dedup"](spark, SF), brute.simhash(sf_rows), *OP1)


def test_empty(spark, empty_dir):
    assert QUERIES["op1_simhash_dedup"](spark, empty_dir).count() == 0


def test_spark_hash_is_the_same():
    """A short and a long text, and one that votes slice by slice."""
    import pyarrow as pa

    texts = ["a b", "A  B", "x " * 500 + "y", None, ""]
    assert simhash.fingerprints(pa.array(texts)).tolist() == [brute.fingerprint(t) for t in texts]
    keep = simhash.SLICE
    try:
        simhash.SLICE = 7
        assert simhash.fingerprints(pa.array(texts)).tolist() == [brute.fingerprint(t) for t in texts]
    finally:
        simhash.SLICE = keep


@pytest.mark.parametrize("block", [2, 2048])
def test_links_connect_like_all_pairs(spark, block):
    """Dense clouds of fingerprints around few centres, in blocks of two and whole."""
    rng = random.Random(1)
    prints = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in range(60)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = connected_components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), block=block))
    groups = {}
    for r in found.collect():
        groups.setdefault(r.root, set()).add(r.node)
    root = {p: p for p in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in signed:
        for b in signed:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    want = {}
    for p in signed:
        want.setdefault(find(p), set()).add(p)
    assert groups == {k: v for k, v in want.items() if len(v) > 1}


def test_forest_has_one_link_fewer_than_members():
    prints = np.array([0, 1, 3, 7, 15, 1 << 40], np.uint64)
    assert len(simhash.forest(prints, 2)) >= 4
    assert len(simhash.forest(np.zeros(0, np.uint64), 0)) == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(50)] + [(7, 7)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(51)}


def test_keep_one(spark, edge):
    rows = simhash.keep_one(edge)
    assert rows.columns == edge.columns
    kept = [r.doc_id for r in rows.collect()]
    want = {c for _, _, c in brute.simhash(EDGE)}
    assert sorted(kept, key=str) == sorted(want, key=str)
    nulls = edge.where(F.col("doc_id").isNull())
    assert simhash.keep_one(nulls).count() == 1
