"""Operators 7 and 8: quality classifier and quality rules."""

import numpy as np
import pyarrow as pa

from marketsignals.llm import quality_model, quality_rules
from marketsignals.llm.queries import QUERIES
from marketsignals.llm.textkit import chunks

from . import brute
from .conftest import EDGE, SF, same

OP8 = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_rules_whole_table(spark, sf_rows):
    same(QUERIES["op8_quality_rules"](spark, SF), [(d, *brute.quality(t)) for d, t in sf_rows], *OP8)


def test_rules_edges(spark, edge_dir, edge):
    same(QUERIES["op8_quality_rules"](spark, edge_dir), [(d, *brute.quality(t)) for d, t in EDGE], *OP8)
    clash = edge.withColumnRenamed("n_chars", "N_Words").withColumnRenamed("k1", "fail_bits")
    out = quality_rules.ledger(clash)
    assert len(out.columns) == len(set(out.columns)) and "lang" in out.columns
    assert out.where("n_words = 0").count() == sum(not brute.words(t) for _, t in EDGE)


def test_policies_and_ablations(spark):
    texts = ["word " * 4, " ".join(f"w{i}" for i in range(20)), " ".join(f"w{i}$$$" for i in range(20)),
             " ".join(f"WORD{'X' * i}" for i in range(20)), "$$$ $$$"]
    rows = quality_rules.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    passed = {v: [r.doc_id for r in rows.where(quality_rules.passes(v)).orderBy("doc_id").collect()] for v in quality_rules.POLICIES}
    assert passed == {"base": [1, 2, 3], "v1": [1], "v2": [1]}
    found = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablations(rows, "v1").collect()}
    assert found == {"few_words": (2, 1), "repeated_words": (0, 0), "symbols": (2, 1), "capitals": (1, 1)}
    assert quality_rules.ablations(rows.limit(0)).count() == 0


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = QUERIES["op7_quality_classifier"](spark, sf).collect()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == brute.crc_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    test = [(r.score, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    bad, good = ([s for s, y in test if y == k] for k in (0, 1))
    auc = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    assert auc > 0.97
    assert np.mean([s >= 0.3 for s in good]) > 0.98 and np.mean([s < 0.3 for s in bad]) > 0.8


def test_classifier_edges(spark, edge, empty_dir):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (14, 0, 0), (None, 1, 0), (21, None, 0), (11, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    weights = quality_model.train(edge, labels)
    assert len(weights) == (1 << quality_model.BITS) + 1 and np.isfinite(weights).all()
    assert (weights == quality_model.train(edge.repartition(7), labels)).all()
    scores = {r.doc_id: r.score for r in quality_model.score(edge, weights).collect()}
    bias = 1 / (1 + np.exp(-weights[-1]))
    assert np.isclose(scores[4], bias) and np.isclose(scores[5], bias)
    none = quality_model.train(edge, labels.limit(0))
    assert {r.score for r in quality_model.score(edge, none).collect()} == {0.5}
    assert QUERIES["op7_quality_classifier"](spark, empty_dir).count() == 0
    assert QUERIES["op8_quality_rules"](spark, empty_dir).count() == 0


def test_features_do_not_depend_on_the_neighbours():
    texts = ["The THE!! 42 a a", "", "b", "The THE!! 42 a a"]

    def of(rows):
        part = next(iter(chunks(pa.array(rows))))
        bucket, doc, _ = quality_model.features(part.data, part.offs)
        return [sorted(bucket[doc == i].tolist()) for i in range(len(rows))]

    together = of(texts)
    assert together[0] == together[3] == of(texts[:1])[0] and together[1] == [] and len(together[0]) == 5 + 5 + 3 * 4
