"""The pipeline, stage by stage and as a whole, against brute force."""

from collections import Counter

import pytest

import corpus_pipeline
from marketsignals.llm import quality_rules, secrets

from . import brute
from .conftest import SF


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def keep_one(rows):
    best = {}
    prints = brute.simhash([(r["doc_id"], r["text"]) for r in rows])
    for r, (_, _, c) in zip(rows, prints):
        if r["doc_id"] == c:
            best.setdefault(c, r)
    return list(best.values())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = rows_of(docs)
    bits = {r.doc_id: r.fail_bits for r in quality_rules.ledger(docs).collect()}
    quality = [r for r in rows if not brute.quality(r["text"])[-1] and not bits[r["doc_id"]]]
    near = keep_one(quality)
    hit = {x[0] for x in brute.decontaminate([(r["doc_id"], r["text"]) for r in near], bench) if x[-1]}
    clean = [r for r in near if r["doc_id"] not in hit]
    assert len(rows) > len(quality) > len(near) > len(clean) > 0

    want = [quality, near, clean]
    at = docs
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want):
        at = stage(spark, at, SF)
        assert at.columns == docs.columns
        assert sorted(rows_of(at), key=lambda r: r["doc_id"]) == sorted(expected, key=lambda r: r["doc_id"]), name
        at = spark.createDataFrame(at.collect(), at.schema)
    masked = {r["doc_id"]: r for r in rows_of(corpus_pipeline.STAGES[3][1](spark, at, SF))}
    assert set(masked) == {r["doc_id"] for r in clean}
    spans = {r.doc_id: r.spans for r in secrets.secret_spans(at).collect()}
    for r in clean:
        new = masked[r["doc_id"]]
        assert (new["text"] == r["text"]) == (not spans[r["doc_id"]]) and new["n_chars"] == len(new["text"])
        assert not brute.base_spans(new["text"])

    out = rows_of(corpus_pipeline.run(spark, SF))
    got = Counter(r["doc_id"] for r in out)
    assert set(got) <= set(masked) and max(got.values()) <= 3
    assert all(r["text"] == masked[r["doc_id"]]["text"] for r in out)
    sizes = Counter()
    for r in masked.values():
        sizes[r["source"]] += len(brute.words(r["text"]))
    target = brute.targets(sizes)
    for doc_id, n in got.items():
        rate = target[masked[doc_id]["source"]] / sizes[masked[doc_id]["source"]]
        assert int(rate) <= n <= int(rate) + 1


@pytest.mark.parametrize("which", ["edge_dir", "empty_dir"])
def test_odd_tables(spark, request, which):
    path = request.getfixturevalue(which)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert corpus_pipeline.run(spark, path).columns == [*docs.columns, "copy"]


def test_odd_column_names(spark, edge, edge_dir, tmp_path):
    docs = edge.select("*", edge.k1.alias("a.b"), edge.k1.alias("c`d"), edge.k1.alias("Copy"))
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, edge_dir)
        assert docs.columns == names
    out = corpus_pipeline.STAGES[-1][1](spark, docs, edge_dir)
    out.write.parquet(str(tmp_path / "out"))
    assert out.columns == [c for c in names if c != "Copy"] + ["copy"]
