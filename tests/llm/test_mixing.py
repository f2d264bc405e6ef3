"""Operator 4: mixing sources to target weights."""

import math
from collections import Counter

from pyspark.sql import functions as F

from marketsignals.llm import mixing
from marketsignals.llm.queries import QUERIES

from . import brute
from .conftest import SF


def check(out, rows):
    """rows: (doc_id, text, source)."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(brute.words(text))
    want = brute.targets(sizes)
    assert len(out) == len(rows)
    for r in out:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12)
        rate = want[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert r.taken in {r.size * math.floor(rate + 1e-9), r.size * math.ceil(rate - 1e-9)} and r.taken <= 3 * r.size


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    out = mixing.mix_sources(docs).collect()
    check(out, rows)
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.mix_sources(docs.repartition(5)).collect()), key=str)


def test_edges(spark, edge):
    rows = [tuple(r) for r in edge.select("doc_id", "text", "source").collect()]
    check(mixing.mix_sources(edge).collect(), rows)


def test_taken_words_come_near_the_target(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "repeat('w ', int(1 + id % 50)) as text",
                                        "concat('s', int(sqrt(id % 400) / 2)) as source")
    out = mixing.mix_sources(docs).groupBy("source").agg({"taken": "sum", "target": "max", "source_size": "max"}).collect()
    big = [r for r in out if r["max(source_size)"] > 10_000]
    assert big and all(abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.15 for r in big)


def test_a_source_misses_its_target_by_less_than_a_document(spark):
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"),
                 spark.range(3000).selectExpr("id as doc_id", "repeat('w ', int(1 + pow(id % 97, 2))) as text",
                                              "if(id % 3 = 0, 'hot', concat('s', id % 40)) as source")):
        out = mixing.mix_sources(docs).groupBy("source").agg(
            F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("longest")).collect()
        assert all(abs(r.taken - r.target) < r.longest + 1e-6 for r in out)


def test_draws_against_a_plain_walk(spark, edge):
    docs = edge.unionByName(spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "doc_id", "text", "lang", "source", "n_chars", "1 as k1", "'' as h", "array(1) as size", "'' as row"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert sorted(((r.doc_id, r.source, r.size, r.copies) for r in mixing.mix_sources(docs).collect()), key=repr) == sorted(
        brute.mixed(rows), key=repr)


def test_draws_spread_evenly(spark):
    """Over seeds each document gets its extra copy about as often as the fraction says."""
    docs = spark.createDataFrame([(i, "w " * (10 + i), "b" if i else "a") for i in range(8)], "doc_id long, text string, source string")
    seen = Counter()
    for seed in range(4):
        for r in mixing.mix_sources(docs, seed=seed).collect():
            seen[r.doc_id] += r.copies
    assert len({seen[i] for i in range(1, 8)}) > 1 and all(0 < seen[i] < 12 for i in range(1, 8))


def test_mixed_documents_are_the_copies(spark, edge):
    copies = {(r.doc_id, r.source, r.size): r.copies for r in mixing.mix_sources(edge).collect()}
    out = mixing.mixed_documents(edge)
    assert out.columns == [*edge.columns, "copy"]
    n = Counter((r.doc_id, r.source, len(brute.words(r.text))) for r in out.collect())
    rows = Counter((r.doc_id, r.source, len(brute.words(r.text))) for r in edge.collect())
    assert n == Counter({k: rows[k] * copies[k] for k in rows if copies[k]})


def test_empty(spark, empty_dir):
    assert QUERIES["op4_source_mixing"](spark, empty_dir).count() == 0
