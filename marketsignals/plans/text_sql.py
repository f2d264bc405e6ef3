"""DuckDB renderings of the text rules, with patterns of their own (RE2)."""

from __future__ import annotations

from .. import constants as K

# What the landed pages contain; '&amp;' last, so that it is decoded once.
ENTITIES = [("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&copy;", "©"), ("&middot;", "·"), ("&mdash;", "—"), ("&ndash;", "–"), ("&hellip;", "…"), ("&eacute;", "é"),
            ("&amp;", "&")]
SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
COMMENT = "(?s)<!--.*?-->"
ANCHOR = '(?is)<a\\s(?:[^>]*?\\s)?href="([^"]*)"[^>]*>(.*?)</a\\s*>'


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def unescape(x: str) -> str:
    for a, b in ENTITIES:
        x = f"replace({x}, {lit(a)}, {lit(b)})"
    return x


def strip(x: str) -> str:
    return f"trim({x}, {lit(SPACE)})"


def strings_of(x: str, var: str = "s") -> str:
    parts = f"regexp_split_to_array({x}, {lit("<[^>]+>")})"
    return (f"list_filter(list_transform({parts}, lambda {var}: {strip(unescape(var))}), "
            f"lambda {var}: {var} <> '')")


def html_to_text(x: str, max_chars: int | None = None) -> str:
    body = f"regexp_replace({x}, {lit(COMMENT)}, {lit('<x>')}, 'g')"
    for tag in K.REMOVED_ELEMENTS:
        body = f"regexp_replace({body}, {lit(f'(?is)<{tag}(?:\\s[^>]*)?>.*?</{tag}\\s*>')}, {lit('<x>')}, 'g')"
    text = f"array_to_string({strings_of(body)}, chr(10))"
    return f"substring({text}, 1, {max_chars})" if max_chars else text


def blank(x: str) -> str:
    return f"length({strip(x)}) = 0"


def anchors_cte(name: str, source_sql: str, href_substring: str, min_title: int) -> str:
    """One row per kept anchor: (source, page_id, pos, title, href)."""
    return f"""{name}_raw as (
  select {source_sql} as source, page_id, regexp_extract_all(clean, {lit(ANCHOR)}, 1) as hrefs,
         regexp_extract_all(clean, {lit(ANCHOR)}, 2) as inners
  from (select *, regexp_replace(html, {lit(COMMENT)}, '', 'g') as clean from pages)),
{name}_all as (
  select source, page_id, unnest(generate_series(1, len(hrefs))) as i, unnest(hrefs) as href_raw,
         unnest(inners) as inner_html from {name}_raw),
{name}_kept as (
  select source, page_id, i, {unescape('href_raw')} as href,
         array_to_string({strings_of('inner_html')}, '') as title from {name}_all),
{name} as (
  select source, page_id, cast(row_number() over (partition by page_id order by i) - 1 as bigint) as pos, title, href
  from {name}_kept where contains(href, {lit(href_substring)}) and length(title) >= {min_title})"""


def absolute(x: str, base: str = K.LISTING_BASE_URL) -> str:
    return f"case when starts_with({x}, 'http') then {x} else {lit(base)} || {x} end"
