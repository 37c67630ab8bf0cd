"""Markup extraction: regular-expression forms as columns, the parser form as an Arrow UDF."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weirlake.functions.bind import let

ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
_HREF = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"']"


def unescape(text: Column) -> Column:
    out = text
    for name, c in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(c))
    return out


def html_text_regex(html: Column) -> Column:
    """Tags and script, style and noscript blocks removed, entities resolved, white space collapsed."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style|noscript).*?>.*?</\1>", " ")
    t = unescape(F.regexp_replace(t, r"(?s)<[^>]+>", " "))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def html_links(html: Column) -> Column:
    """All ``href`` values of anchors, in order."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_HREF), F.lit(1))
    return F.filter(F.transform(links, lambda x: unescape(F.trim(x))), lambda x: x != "")


def html_anchors(html: Column) -> Column:
    """Array of (href, label) of the anchors that are closed before the next one begins; scripts and styles are no markup.

    Pages are split where anchors begin, so that the time grows with the page's length whatever is left open in it.
    """
    shown = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style|noscript)\b.*?</\1\s*>", " ")
    value = r"(?is)^(?:[^>]*?\s)?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"

    def anchor(piece):
        href = F.concat(*(F.regexp_extract(piece, value, i) for i in (1, 2, 3)))
        label = F.regexp_replace(F.regexp_extract(piece, r"(?is)^[^>]*>(.*?)</a\s*>", 1), r"(?s)<[^>]+>", " ")
        return F.struct(unescape(F.trim(href)).alias("href"), F.trim(unescape(label)).alias("label"), piece.rlike(r"(?i)</a\s*>").alias("closed"))

    pieces = F.split(shown, r"(?i)<a(?=\s)")
    return F.filter(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), anchor), lambda x: x["closed"] & (x["href"] != ""))


def labelled_links(text: Column) -> Column:
    """Array of (href, label) of a markdown text's links that have a label; a title holds no ``](``.

    A text is split where labels end and targets begin, in time that grows with its length.
    """
    target = r"(?s)^([^)\s]+)(?:\s++[^)]*)?\)"

    def links(ps):
        # What follows the target before, and the last bracket that closes, from the first that opens.
        label = lambda p: F.regexp_extract(F.regexp_replace(F.regexp_replace(p, target, ""), r"(?s)^.*\]", ""), r"(?s)^[^\[]*\[(.+)$", 1)
        found = F.transform(F.slice(ps, F.lit(2), F.size(ps)), lambda p, i: F.struct(F.regexp_replace(F.regexp_extract(p, target, 1), "^[<>]+|[<>]+$", "").alias("href"), label(F.get(ps, i)).alias("label")))
        return F.filter(found, lambda x: (x["href"] != "") & (x["label"] != ""))

    return let(F.split(F.coalesce(text, F.lit("")), r"\]\("), links)


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "noscript")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "noscript") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


#: Pages whose texts are held at a time.
PAGES = 256


@F.arrow_udf(StringType())
def html_text_parsed(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Text nodes outside script, style and noscript, one a line, by a real parser; clean it afterwards.

    Of an Arrow batch only ``PAGES`` pages and their texts are Python strings at a time.
    """

    def one(page):
        if page is None:
            return None
        p = _Text()
        p.feed(page)
        p.close()
        return "\n".join(p.parts)

    for batch in pages:
        for at in range(0, len(batch), PAGES):
            yield pa.array([one(page.as_py()) for page in batch.slice(at, PAGES)], pa.string())
        if not len(batch):
            yield pa.array([], pa.string())


def markdown_links(text: Column) -> Column:
    """Targets of markdown links, then bare URLs that begin a line; distinct, in order."""
    t = F.coalesce(text, F.lit(""))
    marked = F.transform(F.regexp_extract_all(t, F.lit(r"\[[^\]]*\]\(([^)\s]+)(?:\s+[^)]*)?\)"), F.lit(1)), lambda x: F.regexp_replace(x, "^<+|>+$", ""))
    bare = F.regexp_extract_all(t, F.lit(r"(?m)^\s*(https?://\S+)"), F.lit(1))
    return F.array_distinct(F.concat(marked, F.transform(bare, lambda x: F.regexp_replace(x, "^<+|>+$", ""))))


def sitemap_entries(xml: Column) -> Column:
    """(url, lastmod) of each entry of a sitemap, or of a sitemap index."""
    blocks = F.regexp_extract_all(F.coalesce(xml, F.lit("")), F.lit(r"(?is)<(?:\w+:)?(?:url|sitemap)>(.*?)</(?:\w+:)?(?:url|sitemap)>"), F.lit(1))
    inner = lambda b, tag: F.nullif(F.trim(F.regexp_extract(b, rf"(?is)<(?:\w+:)?{tag}>\s*(.*?)\s*</(?:\w+:)?{tag}>", 1)), F.lit(""))
    got = F.transform(blocks, lambda b: F.struct(unescape(inner(b, "loc")).alias("url"), inner(b, "lastmod").alias("lastmod")))
    return F.filter(got, lambda x: x["url"].isNotNull())


def xml_text(xml: Column, tag: str) -> Column:
    """Text of the first element of that name, whatever its namespace prefix; null if there is none."""
    return F.nullif(F.trim(F.regexp_extract(F.coalesce(xml, F.lit("")), rf"(?s)<(?:\w+:)?{tag}(?:\s[^>]*)?>([^<]*)</(?:\w+:)?{tag}>", 1)), F.lit(""))


def properties(text: Column) -> Column:
    """Map of a properties file's lines; comments are left out and the last of equal keys counts."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda x: x.rlike(r"^\s*[^#!\s][^=:]*[=:]"))
    pair = F.transform(lines, lambda x: F.struct(F.trim(F.regexp_extract(x, r"^\s*([^=:]*?)\s*[=:]", 1)).alias("key"), F.trim(F.regexp_extract(x, r"^[^=:]*[=:]\s*(.*)$", 1)).alias("value")))
    last = F.filter(pair, lambda p, i: ~F.exists(F.slice(pair, i + 2, F.size(pair)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def pdf_text():
    """An Arrow UDF from PDF bytes to the text of all pages, null for files that cannot be read.

    It needs the pypdf library, which is optional; asking for it without the library is an error.
    """
    import pypdf  # noqa: F401

    @F.pandas_udf(StringType())
    def text(files: pd.Series) -> pd.Series:
        import io

        from pypdf import PdfReader

        def one(raw):
            try:
                return "\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(raw)).pages)
            except Exception:
                return None

        return files.map(lambda raw: None if raw is None else one(raw))

    return text
