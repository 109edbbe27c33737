"""HTML by patterns, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HIDDEN = r"(?is)<!--.*?-->|<(?:script|style|noscript)\b[^>]*>.*?</(?:script|style|noscript)\s*>"
BLOCK = r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|table|article|section|nav|header|footer|title|head|body)\b[^>]*>"
ANY = r"<[a-zA-Z/!][^>]*>"


def _space(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def unescaped(x: Column) -> Column:
    for a, b in (("&nbsp;", " "), ("&copy;", "©"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def visible(html: Column) -> Column:
    return _space(unescaped(F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), ANY, " ")))


def title(html: Column) -> Column:
    return _space(unescaped(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title", 1)))


def headings(html: Column) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<h1[^>]*>(.*?)</h1"), F.lit(1)), lambda x: _space(unescaped(F.regexp_replace(x, ANY, ""))))


def hrefs(html: Column) -> Column:
    """Targets of all links, quoted in either way or bare."""
    tags = F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(1))
    return F.transform(tags, lambda t: F.regexp_replace(t, r"""^["']|["']$""", ""))


def lines(html: Column) -> Column:
    """Lines of the page, in order, each once, of two characters or more."""
    x = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), r"\s+", " "), BLOCK, "\n")
    parts = F.transform(F.split(F.regexp_replace(x, ANY, ""), "\n"), lambda s: _space(unescaped(s)))
    return F.array_distinct(F.filter(parts, lambda s: F.length(s) >= 2))
