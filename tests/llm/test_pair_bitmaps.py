"""Operator 13: cross-tokenizer alignment."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketsignals.llm import pair_bitmaps
from marketsignals.llm.queries import QUERIES

from . import brute
from .conftest import SF, same

OP13 = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [(100, "<|endoftext|> and <s> are </s> text"), (101, "tab\tnew\nline  two spaces  "), (102, " leading"), (103, "▁ piece mark"),
       (104, "emoji 👍🏽 é é 日本語"), (105, "aaaa " * 3000), (106, "\x00\x01"), (107, "🤷" * 900), (107, "🤷" * 900)]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, a int, block string")


def test_edges(spark, edge_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text").collect()] + ODD
    want = brute.alignment(rows)
    assert sum(r[1] for r in want) > 10_000 and any(r[1] == 0 for r in want)
    got = pair_bitmaps.alignment(table(spark, rows)).withColumnRenamed("groups", "groups_sha256")
    same(got, want, *OP13)


def test_small_blocks_and_many_rounds(spark, sf_rows, monkeypatch):
    monkeypatch.setattr(pair_bitmaps, "BLOCK_LINKS", 3000)
    got = pair_bitmaps.alignment(table(spark, sf_rows[:60] + ODD), slots=7, round_pairs=9000)
    same(got.withColumnRenamed("groups", "groups_sha256"), brute.alignment(sf_rows[:60] + ODD), *OP13)


def test_whole_table(spark, sf_rows):
    same(QUERIES["op13_pair_bitmaps"](spark, SF), brute.alignment(sf_rows), *OP13)


def test_pair_counts(spark, sf_rows):
    _, postings = pair_bitmaps.aligned(table(spark, sf_rows[:80] + ODD))
    got = {(r.a, r.b): (r.docs, r.links) for r in pair_bitmaps.pair_counts(postings).collect()}
    assert got == brute.pair_counts(sf_rows[:80] + ODD)


def test_group_texts(spark):
    rows = pair_bitmaps.alignment(table(spark, [(1, "hello world"), (2, "")]), group_texts=True).collect()
    texts = {r.doc_id: r.groups for r in rows}
    assert texts[2] == "" and texts[1] == brute.groups_of("hello world")


def test_empty(spark, empty_dir):
    assert QUERIES["op13_pair_bitmaps"](spark, empty_dir).count() == 0


@given(st.lists(st.sets(st.integers(0, pair_bitmaps.SLOTS - 1), min_size=1, max_size=600), max_size=6))
@settings(max_examples=60, deadline=None)
def test_bitmaps_come_back(lists):
    n = np.array([len(s) for s in lists], np.int64)
    slots = np.array([x for s in lists for x in sorted(s)], np.uint16)
    units, size = pair_bitmaps.pack(slots, n)
    assert len(units) == size.sum() and (size <= pair_bitmaps.WORDS).all()
    entry, slot = pair_bitmaps.unpack(units, n)
    assert sorted(zip(entry.tolist(), slot.tolist())) == [(i, x) for i, s in enumerate(lists) for x in sorted(s)]


@pytest.mark.parametrize("times", [1, 2, 3, 4, 5, 8, 9])
def test_planes_hold_multiplicity(times):
    found = 0
    for plane, (a, bs, ns, bits) in pair_bitmaps.planes(np.full(times, 5 << 36 | 6 << 12 | 7, np.int64)):
        assert (a.to_pylist(), bs.to_pylist(), ns.to_pylist()) == ([5], [[6]], [[1]])
        found += 1 if plane == pair_bitmaps.PRESENT else 1 << plane
    assert found == times
