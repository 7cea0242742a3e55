"""Landed HTML pages: links, text blocks and embedded JSON state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, trim_all
from .feeds import flatten_feed, without_tags


def extract_links(
    pages: DataFrame, html: str, pattern: str, n: int, href_group: int = 1, text_group: int = 2, base: str = "", drop_empty: bool = False
) -> DataFrame:
    """The first ``n`` anchors per page matching ``pattern``: (pos, href, link_text)."""
    hrefs = F.regexp_extract_all(html, F.lit(pattern), F.lit(href_group))
    texts = F.regexp_extract_all(html, F.lit(pattern), F.lit(text_group))
    pairs = F.slice(F.arrays_zip(hrefs.alias("href"), texts.alias("text")), 1, n)
    keep = [c for c in pages.columns if c != html]
    rows = pages.select(*keep, F.posexplode(pairs).alias("pos", "_l"))
    out = rows.select(*keep, "pos", F.concat(F.lit(base), F.col("_l.href")).alias("href"), trim_all("_l.text").alias("link_text"))
    return out.filter("link_text <> ''") if drop_empty else out


def extract_blocks(
    html: Column | str, body_pattern: str, reply_pattern: str, body_chars: int = 2000, reply_chars: int = 500, min_chars: int = 10, n: int = 10
) -> Column:
    """struct(content, replies): the body block and the first ``n`` reply blocks, tags stripped.

    Patterns have one group and match across lines.  Replies of up to ``min_chars`` drop.
    """
    h = col(html)
    body = trim_all(without_tags(F.regexp_extract(h, "(?s)" + body_pattern, 1)))
    found = F.slice(F.regexp_extract_all(h, F.lit("(?s)" + reply_pattern), F.lit(1)), 1, n)
    plain = F.filter(F.transform(found, lambda x: trim_all(without_tags(x))), lambda x: F.length(x) > min_chars)
    return F.struct(
        F.substring(body, 1, body_chars).alias("content"),
        F.transform(plain, lambda x: F.substring(x, 1, reply_chars)).alias("replies"),
    )


def extract_embedded_json(pages: DataFrame, html: str, pattern: str, kind: str = "note_list") -> DataFrame:
    """Rows of the JSON state object in a page script; ``pattern`` has one group around the object."""
    keep = [c for c in pages.columns if c != html]
    state = pages.select(*keep, F.regexp_extract(html, "(?s)" + pattern, 1).alias("payload")).filter("payload <> ''")
    return flatten_feed(state, kind)
