"""Operators 3 and 9: repeated windows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketsignals.llm import substring_dedup, suffix_dedup
from marketsignals.llm.queries import QUERIES
from marketsignals.llm.substring_dedup import SuffixAutomaton
from marketsignals.llm.suffix_dedup import longest_previous_factor, previous_smaller

from . import brute
from .conftest import EDGE, SF, passage, same

OP3 = ("doc_id", "n_words", "n_removed", "kept_sha256")
OP9 = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_edges(spark, edge_dir):
    same(QUERIES["op3_substring_dedup"](spark, edge_dir), brute.substring(EDGE), *OP3)
    same(QUERIES["op9_suffix_dedup"](spark, edge_dir), brute.suffix(EDGE), *OP9)


def test_whole_table(spark, sf_rows):
    same(QUERIES["op3_substring_dedup"](spark, SF), brute.substring(sf_rows), *OP3)
    same(QUERIES["op9_suffix_dedup"](spark, SF), brute.suffix(sf_rows), *OP9)


def test_anchors_with_many_contexts(spark, sf_rows):
    """With at most two contexts a group, most windows take the way for hot anchors."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    three = substring_dedup.substring_dedup(docs, most=2).withColumn("kept_sha256", F.sha2("kept_text", 256))
    same(three, brute.substring(sf_rows), *OP3)
    nine = suffix_dedup.suffix_dedup(docs, most=2).withColumn("kept_sha256", F.sha2("kept", 256))
    same(nine, brute.suffix(sf_rows), *OP9)


def test_spans_are_what_goes(spark, edge):
    row = suffix_dedup.suffix_dedup(edge).where("doc_id = 2").first()
    assert [(s.start, s.end) for s in row.spans] == [(0, row.n_bytes)] and row.kept == b""
    row = substring_dedup.substring_dedup(edge).where("doc_id = 13").first()
    assert [(s.start, s.end) for s in row.spans] == [(0, 35)] and row.kept_text == ""


def test_empty(spark, empty_dir):
    assert QUERIES["op3_substring_dedup"](spark, empty_dir).count() == 0
    assert QUERIES["op9_suffix_dedup"](spark, empty_dir).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_automaton(seed):
    rng = random.Random(seed)
    seqs = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(6)]
    weights = [rng.randrange(1, 3) for _ in seqs]
    automaton = SuffixAutomaton(seqs, weights)
    text = [rng.randrange(4) for _ in range(40)]

    def count(sub):
        return sum(w * sum(s[i:i + len(sub)] == sub for i in range(len(s) - len(sub) + 1)) for s, w in zip(seqs, weights))

    for least in (1, 2, 4):
        want = [max(n for n in range(i + 2) if n == 0 or count(text[i + 1 - n:i + 1]) >= least) for i in range(len(text))]
        assert automaton.matching_statistics(text, automaton.frequent(least)) == want


@pytest.mark.parametrize("seed", range(6))
def test_longest_previous_factor(seed):
    rng = random.Random(seed)
    a = np.array(rng.sample(range(50), 50))
    assert previous_smaller(a).tolist() == [max((j for j in range(i) if a[j] < a[i]), default=-1) for i in range(50)]
    # Contexts of a few letters; suffixes end with their context.
    texts = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randrange(1, 40))) for _ in range(9)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    left = np.concatenate([np.arange(len(t), 0, -1) for t in texts])
    starts = np.array(rng.sample(range(len(data)), len(data) * 2 // 3))       # any text order
    suffix = [data[i:i + left[i]].tobytes() for i in starts]

    def common(x, y):
        return next((n for n, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))

    want = [max((common(s, t) for t in suffix[:i]), default=0) for i, s in enumerate(suffix)]
    assert longest_previous_factor(data, left, starts).tolist() == want


def test_suffix_order_alone_does_not_tell_the_first():
    """Equal windows stand in the order of what follows them, so the smaller text positions decide."""
    window, one, two = bytes(range(100)), b"zzz", b"aaa"
    spans = suffix_dedup.solve([window + one, window + two], None, np.array([1, 2]), np.array([0, 0]))
    assert [len(s) for s, _ in spans] == [0, 1]
    spans = suffix_dedup.solve([window + one, window + two], None, np.array([2, 1]), np.array([0, 0]))
    assert [len(s) for s, _ in spans] == [1, 0]


def test_rows_without_an_id_keep_one_copy(spark):
    shared = passage(9, 60)[:150]
    docs = spark.createDataFrame([(None, shared + "one"), (None, shared + "two")], "doc_id long, text string")
    got = sorted(r.n_removed for r in suffix_dedup.suffix_dedup(docs).collect())
    assert got == [0, 150]
