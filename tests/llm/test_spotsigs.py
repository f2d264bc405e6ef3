"""Operator 12: SpotSigs fingerprints."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketsignals.llm import spotsigs
from marketsignals.llm.queries import QUERIES

from . import brute
from .conftest import SF, passage, same

OP12 = ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")


def unique_ids(rows):
    """Neighbours among rows of one doc_id follow a hash; brute force needs an order it can name."""
    seen = set()
    return [r for r in rows if r[0] is not None and not (r[0] in seen or seen.add(r[0]))]


def test_edges(spark, edge_dir):
    rows = unique_ids([tuple(r) for r in spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text").collect()])
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, shard int, guest string")
    got = spotsigs.edited_fingerprints(docs)
    same(got, brute.spotsigs(rows), *OP12)
    by_text = {}
    for r in got.collect():
        by_text.setdefault(dict(rows)[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_nulls_and_repeated_rows_give_a_row_each(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    got = spotsigs.edited_fingerprints(docs)
    assert sorted(map(repr, (r.doc_id for r in got.collect()))) == sorted(map(repr, (r.doc_id for r in docs.collect())))


def test_whole_table(spark, sf_rows):
    got = QUERIES["op12_spotsigs"](spark, SF)
    same(got, brute.spotsigs(sf_rows), *OP12)
    rows = got.collect()
    long = [r for r in rows if r.n_chars > 600]
    assert np.median([r.near_edited for r in long]) > 0.35 and np.median([r.near_next for r in long]) < 0.05


def test_one_document_is_its_own_next(spark):
    r = spotsigs.edited_fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert (r.n_chars, r.edited_sha256, r.near_next) == (6, brute.sha("abcdab"), 1.0)


def test_empty(spark, empty_dir):
    assert QUERIES["op12_spotsigs"](spark, empty_dir).count() == 0


def test_chains_follow_anchors():
    def hashes(*texts):
        return [spotsigs.word_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0]), spotsigs.ALNUM)[0] for t in texts]

    anchors = np.sort(np.array(hashes("the", "of"), np.uint64))
    one, two, three, four = spotsigs.signatures(pa.array(["The cat of sat mat", "the cat sat, mat", "cat sat", "of the"]), anchors)
    assert len(one) == 2 and len(two) == 1 and len(three) == 1 and len(four) == 1
    assert two[0] in one and three[0] not in one          # chains skip anchors; texts without a chain keep their own kind


@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)), st.sampled_from([0.0, 0.5, 0.8]))
@settings(max_examples=200, deadline=None)
def test_jaccard(a, b, least):
    want = len(a & b) / len(a | b) if a | b else 1.0
    got = spotsigs.jaccard(np.array(sorted(a), np.uint64), np.array(sorted(b), np.uint64), least)
    assert got == (want if want >= least else None)


def test_near_pairs_equal_brute_force(spark, sf_rows):
    rows = sf_rows + [(10_000 + d, (t or "") + " and one tail more") for d, t in sf_rows[:60]] + [(None, "x y"), (20_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = spotsigs.sets(docs)
    by = {r.doc_id: frozenset(r.sigs) for r in found.collect() if r.doc_id is not None}
    members, pairs = spotsigs.near_pairs(found)
    classes = {r.doc_id: r.class_id for r in members.collect() if r.doc_id is not None}
    least = {}
    for d, s in by.items():
        least[s] = min(d, least.get(s, d))
    assert classes == {d: least[s] for d, s in by.items()}
    reps = sorted((d, s) for s, d in least.items() if s)
    want = {(x, y) for i, (x, s) in enumerate(reps) for y, t in reps[i + 1:] if len(s & t) >= 0.8 * len(s | t)}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want


@pytest.mark.parametrize("least", [0.5, 0.8, 0.95])
def test_like_sizes_are_in_neighbouring_classes(spark, least):
    rows = spark.range(1, 400).select("id", spotsigs.size_class(spotsigs.F.col("id"), least).alias("c")).collect()
    c = {r.id: r.c for r in rows}
    assert all(c[b] - c[a] <= 1 for a in c for b in c if a <= b and a >= least * b)


def test_passage_is_found_in_long_text(spark):
    docs = spark.createDataFrame([(2, passage(1, 900)), (1, passage(2, 900))], "doc_id long, text string")
    for r in spotsigs.edited_fingerprints(docs).collect():
        assert 0.2 < r.near_edited < 0.9 and r.near_next < 0.2
