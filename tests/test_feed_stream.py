"""The daily run from landed feed files."""

import os

import pytest

from marketsignals.schemas import STORED_SIGNAL
from marketsignals.session import scratch_path
from marketsignals.sources.feeds import FEED_ORDER
from marketsignals.streaming.incremental import RunConfig, start_from_feeds

SOURCES = ["beta", "alpha"]


def _land(root, source, name, links):
    folder = os.path.join(root, f"source={source}")
    os.makedirs(folder, exist_ok=True)
    text = "The producer raises kraftliner prices by {}% from next month, as it told its customers on Monday."
    body = "".join(f"<item><title>{link} &amp; more</title><description>{text.format(5 + i)}</description><link>{link}</link>"
                   "<author>x</author></item>" for i, link in enumerate(links))
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(f'<?xml version="1.0"?><rss version="2.0"><channel><title>c</title>{body}</channel></rss>')


def _run(spark, root, feeds, cfg, **kw):
    query = start_from_feeds(spark, feeds, cfg, f"{root}/checkpoint", **kw)
    query.awaitTermination()
    return cfg.store(spark)


@pytest.fixture()
def run(spark, tmp_path):
    root = scratch_path(spark, "feeds")
    spark.createDataFrame([("http://none/", "<p>x</p>")], "url string, html string").write.parquet(f"{root}/pages")
    return root, str(tmp_path), RunConfig(root=f"{root}/tables", order_cols=FEED_ORDER, sources=SOURCES, pages=f"{root}/pages",
                                          run_date="2026-01-05")


def test_entries_are_read_in_document_order_and_once(spark, run):
    root, feeds, cfg = run
    _land(feeds, "alpha", "0001.xml", [f"http://a/{i}" for i in range(12)])
    _land(feeds, "beta", "0001.xml", [f"http://b/{i}" for i in range(3)])
    _land(feeds, "beta", "0002.xml", ["http://b/late"])
    _land(feeds, "unregistered", "0001.xml", ["http://u/0"])
    _land(feeds, "alpha", "0002.xml", [])
    store = _run(spark, root, feeds, cfg)
    asked = store.read("responses").orderBy(*FEED_ORDER).collect()
    assert [r.source_url for r in asked] == [f"http://b/{i}" for i in range(3)] + ["http://b/late"] + [
        f"http://a/{i}" for i in range(12)]
    usage = store.read("token_usage").count()
    assert usage == 16
    # a later day: only the new file is read
    _land(feeds, "alpha", "0003.xml", ["http://a/new"])
    store = _run(spark, root, feeds, cfg)
    assert [r.source_url for r in store.read("responses", batch_id=1).collect()] == ["http://a/new"]
    stored = store.read("price_signals", STORED_SIGNAL).orderBy("id").collect()
    assert [r.id for r in stored] == list(range(1, len(stored) + 1)) and stored


def test_batches_of_single_files(spark, run):
    root, feeds, cfg = run
    for i in range(3):
        _land(feeds, "alpha", f"000{i}.xml", [f"http://a/{i}/{j}" for j in range(2)])
    store = _run(spark, root, feeds, cfg, files_per_batch=1)
    assert sorted(r.source_url for r in store.read("responses").collect()) == [f"http://a/{i}/{j}" for i in range(3) for j in range(2)]
    assert {c["batch_id"] for c in store.commits("responses")} == {0, 1, 2}


def test_pages_are_asked_for(spark, run):
    root, feeds, _ = run
    with pytest.raises(ValueError):
        start_from_feeds(spark, feeds, RunConfig(root=root, order_cols=FEED_ORDER), f"{root}/checkpoint")
