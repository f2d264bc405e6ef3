"""String and HTML rules as Catalyst expressions (no Python per row).

The regular expressions are written so the same text runs on Java regex
(Spark) and RE2 (the DuckDB oracle): no back-references, no look-around.
"""

from __future__ import annotations

import json
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K

# FIXED VALUES — the characters ``str.strip()`` removes (str.isspace).
WS = (r"[\t\n\x0B\x0C\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# Named character references with a semicolon, from the standard library's table.
_NAMED = json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";")})
# Names that count without a semicolon too, where no letter or digit follows.
_LEGACY = json.dumps({k: v for k, v in html5.items() if not k.endswith(";")})
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31})(;|[^A-Za-z0-9;]|$)"

# What stands in a tag after its name: quoted values may hold '>'.
_INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
# A tag; where a quote is never closed, its quotes mean nothing.
TAG = rf"""</?[A-Za-z]{_INSIDE}>|<[!?/]?[A-Za-z][^>]*>|<x>"""
COMMENT = r"(?s)<!--.*?-->"
# A removed element or comment still separates the text around it.
BREAK = "<x>"
# Elements whose content is no markup; unclosed, they reach to the end.
RAW_ELEMENTS = ("script", "style")


# The same set as literal characters, for ``trim(BOTH ... FROM ...)``.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
            + "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(col: Column) -> Column:
    """``str.strip()``: a character-set trim (no regex scan of the body)."""
    return F.trim(col, F.lit(WS_CHARS))


def is_blank(col: Column) -> Column:
    """Nothing left after ``strip()`` (NULL stays NULL)."""
    return F.length(strip_ws(col)) == 0


def unescape(col: Column) -> Column:
    """Decode named and numeric character references, each once: ``&amp;lt;``
    stays ``&lt;``.  Without a semicolon the names of old count, and numbers;
    unknown references stay as written."""
    named, legacy = (F.from_json(F.lit(table), "map<string,string>") for table in (_NAMED, _LEGACY))

    def code_point(n: Column) -> Column:
        valid = (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise("\ufffd")

    def decoded(piece: Column) -> Column:
        ref, closed = F.regexp_extract(piece, _REFERENCE, 1), F.regexp_extract(piece, _REFERENCE, 2) == ";"
        value = (F.when(ref.rlike("^#[xX]"), code_point(F.conv(F.substr(ref, F.lit(3)), 16, 10).cast("int")))
                 .when(ref.startswith("#"), code_point(F.substr(ref, F.lit(2)).cast("int")))
                 .otherwise(F.element_at(F.when(closed, named).otherwise(legacy), ref)))
        rest = F.substr(piece, F.length(ref) + F.when(closed, 2).otherwise(1))
        return F.when((ref == "") | value.isNull(), F.concat(F.lit("&"), piece)).otherwise(F.concat(value, rest))

    pieces = F.split(col, "&")
    whole = F.concat(F.element_at(pieces, 1), F.array_join(F.transform(F.slice(pieces, 2, 1 << 30), decoded), ""))
    return F.when(F.contains(col, F.lit("&")), whole).otherwise(col)


def strings_of(html: Column) -> Column:
    """Text nodes of an HTML fragment, decoded and stripped, empties dropped."""
    parts = F.split(html, rf"(?is){TAG}")
    parts = F.transform(parts, lambda s: strip_ws(unescape(s)))
    return F.filter(parts, lambda s: s != "")


def without_raw(html: Column, removed: list[str]) -> Column:
    """Comments and removed raw-text elements become breaks, read from left to right past whole tags."""
    raw = [t for t in RAW_ELEMENTS if t in removed]
    names = "|".join([*raw, "!--"])
    tag = rf"""</?(?!(?:{names}))[A-Za-z]{_INSIDE}>"""
    gone = [r"<!--.*?(?:-->|\z)", *[rf"<{t}(?:[\s/]{_INSIDE})?>.*?(?:</{t}[^>]*>|\z)" for t in raw]]
    return F.regexp_replace(html, rf"(?is)({tag})|{'|'.join(gone)}", f"$1{BREAK}")


def kept_segments(body: Column, removed: list[str]) -> Column:
    """The text segments between tags that lie in no removed element.

    The page's removed-element tags are folded with a depth: an element nested
    in another of the removed ones ends only itself, an end tag without a start
    is ignored, a self-closed one is empty, and an unclosed one reaches to the end.
    """
    tags, parts = F.regexp_extract_all(body, F.lit(rf"(?is){TAG}"), 0), F.split(body, rf"(?is){TAG}")
    name = rf"(?is)^<(/?)(?:{'|'.join(removed)})(?:[\s/]{_INSIDE})?>$"

    def mark(tag: Column, at: Column) -> Column:
        change = F.when(~tag.rlike(name) | tag.endswith("/>"), 0).when(tag.startswith("</"), -1).otherwise(1)
        return F.struct(at.alias("at"), change.alias("change"))

    marks = F.filter(F.transform(tags, mark), lambda m: m["change"] != 0)
    ranges = "cast(array() as array<struct<first:int,n:int>>)"
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("first"), F.expr(ranges).alias("kept"))

    def step(acc: Column, m: Column) -> Column:
        depth = F.greatest(acc["depth"] + m["change"], F.lit(0))
        opens = (acc["depth"] == 0) & (m["change"] == 1)
        closes = (acc["depth"] == 1) & (m["change"] == -1)
        span = F.array(F.struct(acc["first"].alias("first"), (m["at"] - acc["first"] + 1).alias("n")))
        return F.struct(depth.alias("depth"), F.when(closes, m["at"] + 1).otherwise(acc["first"]).alias("first"),
                        F.when(opens, F.concat(acc["kept"], span)).otherwise(acc["kept"]).alias("kept"))

    def finish(acc: Column) -> Column:
        rest = F.array(F.struct(acc["first"].alias("first"), (F.size(parts) - acc["first"]).alias("n")))
        return F.when(acc["depth"] == 0, F.concat(acc["kept"], rest)).otherwise(acc["kept"])

    kept = F.aggregate(marks, start, step, finish)
    return F.flatten(F.transform(kept, lambda r: F.slice(parts, r["first"] + 1, r["n"])))


def html_to_text(html: Column, removed: list[str] = K.REMOVED_ELEMENTS,
                 max_chars: int | None = None) -> Column:
    """Drop comments and the ``removed`` elements with their content,
    then join the remaining text nodes with newlines.  ``max_chars`` keeps
    the first characters (code points) for callers that ask for it."""
    body = without_raw(html, removed)
    nodes = F.element_at(F.transform(F.array(body), lambda b: kept_segments(b, removed)), 1)
    text = F.array_join(F.filter(F.transform(nodes, lambda s: strip_ws(unescape(s))), lambda s: s != ""), "\n")
    return F.substring(text, 1, max_chars) if max_chars else text


# An anchor element: its attributes (quoted values may hold '>') and its content.
ANCHOR = r"""(?is)<a(\s(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>(.*?)</a\s*>"""
# href as an attribute of its own, double-quoted, single-quoted or bare.
HREF = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def anchors(html: Column, href_substring: str = K.LISTING_HREF_SUBSTRING,
            min_title_chars: int = K.LISTING_MIN_TITLE_CHARS) -> Column:
    """O05 (per page): ARRAY<STRUCT<href, title>> of the anchors outside
    comments whose href contains ``href_substring`` and whose text (stripped
    strings joined without separator) has at least ``min_title_chars``
    characters, in document order.  Computed inside the row: no shuffle, no
    window."""
    body = F.regexp_replace(html, COMMENT, BREAK)
    attributes = F.regexp_extract_all(body, F.lit(ANCHOR), 1)
    inner = F.regexp_extract_all(body, F.lit(ANCHOR), 2)
    pairs = F.filter(F.arrays_zip(attributes.alias("attr"), inner.alias("inner")), lambda p: p["attr"].rlike(HREF))
    items = F.transform(pairs, lambda p: F.struct(
        unescape(F.concat(*[F.regexp_extract(p["attr"], HREF, g) for g in (1, 2, 3)])).alias("href"),
        F.array_join(strings_of(p["inner"]), "").alias("title")))
    return F.filter(items, lambda a: F.contains(a["href"], F.lit(href_substring))
                    & (F.length(a["title"]) >= min_title_chars))


def absolute_url(href: Column, base: str = K.LISTING_BASE_URL) -> Column:
    """Hrefs starting with ``http`` as they are, anything else appended
    to the literal base (no RFC 3986 resolution)."""
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(base), href))


def contains_any(text: Column, keywords: list[str] = K.PRICE_KEYWORDS) -> Column:
    """Lower-cased text contains any keyword (substring match)."""
    low = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(k)) for k in keywords], F.lit(False))


def assemble(title: Column, body: Column) -> Column:
    """Title, blank line, body."""
    return F.concat(title, F.lit("\n\n"), body)
