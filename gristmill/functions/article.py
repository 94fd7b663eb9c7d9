"""The readable text of a page: what is no article goes, blocks are kept by their length and by how much of them is links.

Not a parser: elements that hold their own kind aren't told apart, and an element that is never closed isn't taken out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import strip, strip_tags

#: Elements that hold no article, and tags that begin or end a block.
ASIDE = ("head", "script", "style", "noscript", "nav", "header", "footer", "aside", "form")
BLOCK = r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|tr|td|table|section|article|main|blockquote|figure|figcaption|body|html)\b[^>]*>"
LINK = r"(?is)<a\b[^>]*>(.*?)</a\s*>"
#: Characters of a block, and the share of links in it: strictly, and where that leaves too little.
STRICT, LOOSE, LEAST = (40, 0.2), (10, 0.5), 250


def blocks(html: Column) -> Column:
    """array(text, linked): each block's text in single blanks, and how many of its characters are links. Blank ones are left out."""
    bare = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    bare = reduce(lambda c, tag: F.regexp_replace(c, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", ""), ASIDE, bare)
    line = lambda x: strip(F.regexp_replace(strip_tags(x), r"\s+", " "))
    linked = lambda x: F.aggregate(F.regexp_extract_all(x, F.lit(LINK), F.lit(1)), F.lit(0), lambda a, t: a + F.length(line(t)))
    made = F.transform(F.split(bare, BLOCK), lambda x: F.struct(line(x).alias("text"), linked(x).alias("linked")))
    return F.filter(made, lambda b: b["text"] != "")


def kept(found: Column, least: int, links: float) -> Column:
    """The texts of blocks that are long enough and not links in the main, a line each."""
    good = F.filter(found, lambda b: (F.length(b["text"]) >= least) & (b["linked"] <= links * F.length(b["text"])))
    return F.array_join(F.transform(good, lambda b: b["text"]), "\n")


def article_text(found: Column, least: int = LEAST) -> Column:
    """The article of blocks: strictly, unless that gives less than `least` characters and the loose measure more."""
    strict, loose = kept(found, *STRICT), kept(found, *LOOSE)
    return F.when((F.length(strict) < least) & (F.length(loose) > F.length(strict)), loose).otherwise(strict)


def meta(html: Column, name: str) -> Column:
    """The content of a page's meta element of that name or property, in either order of its attributes; null if there is none."""
    key, value = rf"(?:name|property)\s*=\s*[\"']{name.replace('.', '[.]')}[\"']", r"content\s*=\s*[\"']([^\"']*)[\"']"
    first, second = F.regexp_extract(html, rf"(?is)<meta\b[^>]*?{key}[^>]*?{value}", 1), F.regexp_extract(html, rf"(?is)<meta\b[^>]*?{value}[^>]*?{key}", 1)
    return F.nullif(strip(F.coalesce(F.nullif(first, F.lit("")), second)), F.lit(""))


def with_page(press: Column, published: Column, html: Column) -> Column:
    """struct(press, published): what a record lacks, from its page."""
    filled = lambda c, name: F.coalesce(F.nullif(c, F.lit("")), meta(html, name))
    return F.struct(filled(press, "og:site_name").alias("press"), filled(published, "article:published_time").alias("published"))
