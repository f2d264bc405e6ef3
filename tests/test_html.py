"""Page text against the standard library's HTML parser."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from marketsignals import constants as K
from marketsignals.functions.text import html_to_text

CASES = {
    "<nav>a<nav>b</nav>c</nav>keep": "keep",
    '<p title="a>b">q': "q",
    "&eacute b &eacute; &notit; &#65 x &amp;lt;": "é b é &notit; A x &lt;",
    'a<script>if (a<b) "</p>"</script>b': "a\nb",
    "<footer>x</footer>y</footer>z<header/>w": "y\nz\nw",
    "<!-- <nav> -->t<style>s</style >u<navy>v</navy>": "t\nu\nv",
    '<p title="abc>t</p>u': "t\nu",
    "x<script>never closed <p>": "x",
    "a < b and c > d": "a < b and c > d",
    "<nav>unclosed <p>q": "",
    "<P>é<br/>f</P>": "é\nf",
    "<NAV class='x>y'>n</Nav >m": "m",
    "<header>a<footer>b</header>c</footer>d": "d",
    "": "",
}


class Text(HTMLParser):
    """Stripped text nodes outside the removed elements."""

    def __init__(self):
        super().__init__()
        self.depth, self.nodes, self.now = 0, [], ""

    def cut(self):
        self.nodes += [self.now.strip()] * bool(self.now.strip())
        self.now = ""

    def handle_starttag(self, tag, attrs):
        self.cut()
        self.depth += tag in K.REMOVED_ELEMENTS

    def handle_startendtag(self, tag, attrs):
        self.cut()

    def handle_endtag(self, tag):
        self.cut()
        self.depth = max(0, self.depth - (tag in K.REMOVED_ELEMENTS))

    def handle_comment(self, data):
        self.cut()

    def handle_data(self, data):
        self.now += "" if self.depth else data


def parsed(html):
    parser = Text()
    parser.feed(html)
    parser.close()
    parser.cut()
    return "\n".join(parser.nodes)


def page(rng, depth=0):
    """Nested elements, quoted attributes, comments, raw text, references, stray end tags."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        kind = rng.randrange(9)
        name = rng.choice(["p", "div", "nav", "NAV", "footer", "header", "section", "navy", "b"])
        attr = rng.choice(["", " class='a>b'", ' title="x > y" id=q', " data-x", " a='\"'"])
        if kind < 4 and depth < 5:
            out.append(f"<{name}{attr}>{page(rng, depth + 1)}</{name}{rng.choice(['', ' '])}>")
        elif kind == 4:
            out.append(rng.choice(["<!-- <nav> -->", "<!---->", "<br>", "<br/>", "<header/>", "<nav />"]))
        elif kind == 5:
            out.append(rng.choice(["<script>if (a < b) { '</p><nav>' }</script>", "<style>p > a {}</STYLE>", "<script src='>'></script >"]))
        elif kind == 6:
            out.append(rng.choice(["</p>", "</nav>", "</footer>"]))
        else:
            out.append(rng.choice(["word ", "a &amp; b", "&eacute;t&eacute;", "&#65;&#x42;", " ", "1 < 2", "x > y", "Zażółć 👍"]))
    return "".join(out)


def texts(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i long, html string").repartition(8)
    return [r.t for r in df.select("i", html_to_text(F.col("html")).alias("t")).orderBy("i").collect()]


def test_cases(spark):
    assert dict(zip(CASES, texts(spark, list(CASES)))) == CASES


@pytest.mark.parametrize("seed", range(3))
def test_generated_nesting(spark, seed):
    rng = random.Random(seed)
    pages = [page(rng) for _ in range(300)]
    wrong = [(p, g, parsed(p)) for p, g in zip(pages, texts(spark, pages)) if g != parsed(p)]
    assert wrong == []


def test_landed_pages(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    assert texts(spark, pages) == [parsed(p) for p in pages]
