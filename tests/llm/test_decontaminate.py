"""Operator 2: benchmark decontamination."""

import random

from marketsignals.llm import decontaminate
from marketsignals.llm.queries import QUERIES

from . import brute
from .conftest import EDGE, SF, same

OP2 = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def items(spark, path):
    return [tuple(r) for r in spark.read.parquet(f"{path}/benchmark.parquet").select("item_id", "text").collect()]


def test_edges(spark, edge_dir):
    query = QUERIES["op2_benchmark_decontamination"]
    same(query(spark, edge_dir), brute.decontaminate(EDGE, items(spark, edge_dir)), *OP2)


def test_whole_table(spark, sf_rows):
    same(QUERIES["op2_benchmark_decontamination"](spark, SF), brute.decontaminate(sf_rows, items(spark, SF)), *OP2)


def test_empty(spark, empty_dir, edge_dir):
    assert QUERIES["op2_benchmark_decontamination"](spark, empty_dir).count() == 0
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    out = decontaminate.decontaminate(docs, spark.read.parquet(f"{empty_dir}/benchmark.parquet"))
    assert out.count() == len(EDGE) and out.where("contaminated or n_items > 0").count() == 0


def test_every_span_of_window_length_is_found(spark, monkeypatch):
    """Random texts over few words, so that windows overlap in all ways; also without a broadcast."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    rng = random.Random(3)
    bench = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 25)))) for i in range(40)]
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    out = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"),
                                      spark.createDataFrame(bench, "item_id long, text string"))
    want = {r[0]: r[2:4] for r in brute.decontaminate(rows, bench)}
    assert {r.doc_id: (r.n_hit, r.n_items) for r in out.collect()} == want


def test_a_phrase_of_many_items_joins_once(spark, monkeypatch):
    """1,000 items around one phrase: a document window joins one row, not one an item."""
    joined = []

    def counted(cand, grams, real=decontaminate.hit_windows):
        out = real(cand, grams)
        joined.append((out.count(), cand.count()))
        return out

    monkeypatch.setattr(decontaminate, "hit_windows", counted)
    phrase = " ".join(f"p{i}" for i in range(12))
    bench = [(i, f"a{i} b{i} c{i} {phrase} d{i} e{i} f{i}") for i in range(1000)]
    rows = [(i, f"x{i} y{i} {phrase} z{i}") for i in range(50)] + [(50, f"c7 {phrase} d7"), (51, " ".join(f"p{i}" for i in range(9)))]
    out = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"),
                                      spark.createDataFrame(bench, "item_id long, text string"))
    want = {r[0]: r[2:4] for r in brute.decontaminate(rows, bench)}
    assert {r.doc_id: (r.n_hit, r.n_items) for r in out.collect()} == want
    assert joined and joined[0][0] <= joined[0][1] <= 51 * 18
