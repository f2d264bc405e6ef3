import os
import tempfile

from marketsignals.operators.items import first_n_per_source
from marketsignals.sources.feeds import scan_feeds

ITEM = "<item>{}</item>"


def _feed(path, source, items):
    d = os.path.join(path, f"source={source}")
    os.makedirs(d, exist_ok=True)
    body = "".join(ITEM.format(i) for i in items)
    with open(os.path.join(d, "part-00000.xml"), "w", encoding="utf-8") as f:
        f.write(f'<?xml version="1.0"?><rss version="2.0"><channel><title>c</title>{body}</channel></rss>')


def test_f7_rss_scan(spark):
    root = tempfile.mkdtemp(prefix="ms-f7-")
    _feed(root, "full", ["<title>A &amp; B</title><link>http://x/1</link><description>d</description>"
                         "<pubDate>Mon, 01 Jan 2026</pubDate>", "<title>only title</title>"])
    _feed(root, "many", [f"<title>t{i}</title>" for i in range(8)])
    _feed(root, "empty", [])
    rows = scan_feeds(spark, root).collect()
    full = sorted((r.pos, r.title, r.summary, r.link, r.published) for r in rows if r.source == "full")
    assert full == [(0, "A & B", "d", "http://x/1", "Mon, 01 Jan 2026"), (1, "only title", "", "", "")]
    assert not [r for r in rows if r.source == "empty"]
    first = first_n_per_source(scan_feeds(spark, root), 5).collect()
    assert sorted(r.title for r in first if r.source == "many") == [f"t{i}" for i in range(5)]
