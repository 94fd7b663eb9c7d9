"""Drafts after they are written: what markup left over, chapter numbers, the closing text, excerpts, and their report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.structure import prose_chars, rewritten
from gristmill.functions.text import strip

# Block marks, markup that an editor would show as it stands, and how a chapter begins.
BLOCK_WORDS = "소제목|본문|인용구"
HEADING, BULLET, BOLD = r"(?m)^\s{0,3}#{1,6}\s+", r"(?m)^(\s{0,3})[-*•]\s+", r"\*\*(.+?)\*\*"
ITALIC = r"(?<!\*)\*(?!\*)(.+?)(?<!\*)\*(?!\*)"
CHAPTER = r"^\s*\d{1,2}\s*[.)]\s*((?:첫|두|세|네|다섯|여섯|일곱|여덟)\s*번째는.*)$"
NO_WIDTH = "​"

_RTRIM = r"\s+\z"


def without_closing(text: Column, closing: str) -> Column:
    """Without the closing text, if the draft ends with it; elsewhere it stays."""
    bare = F.regexp_replace(text, _RTRIM, "")
    cut = F.regexp_replace(F.substring(bare, F.lit(1), F.length(bare) - len(closing)), _RTRIM, "")
    return F.when(F.endswith(bare, F.lit(closing)), cut).otherwise(text) if closing else text


def measured(text: Column, closing: str = "") -> Column:
    """What lengths are measured on: without closing text, block marks, characters of no width and blanks at the ends of lines."""
    lines = F.split(without_closing(text, closing), "\n")
    bare = lambda x: F.regexp_replace(F.replace(F.regexp_replace(x, rf"/\*\s*(?:{BLOCK_WORDS})\s*\*/", ""), F.lit(NO_WIDTH), F.lit("")), _RTRIM, "")
    return F.array_join(F.transform(lines, bare), "\n")


def without_residue(text: Column) -> tuple[Column, Column]:
    """The text without headings', bullets', bold and italic signs, and how many there were. Block marks stay."""
    hidden = F.regexp_replace(text, rf"/\*(\s*(?:{BLOCK_WORDS})\s*)\*/", "\u0001$1\u0002")
    out, n = rewritten(hidden, [(HEADING, ""), (BULLET, "$1"), (BOLD, "$1"), (ITALIC, "$1")])
    return F.replace(F.replace(out, F.lit("\u0001"), F.lit("/*")), F.lit("\u0002"), F.lit("*/")), n


def without_chapter_numbers(text: Column) -> tuple[Column, Column]:
    """Lines that begin a chapter lose their number, and how many did."""
    lines = F.split(text, "\n")
    bare = lambda x: strip(F.replace(x, F.lit(NO_WIDTH), F.lit("")))
    out = F.transform(lines, lambda x: F.when(bare(x).rlike(CHAPTER), F.regexp_extract(bare(x), CHAPTER, 1)).otherwise(x))
    return F.array_join(out, "\n"), F.size(F.filter(lines, lambda x: bare(x).rlike(CHAPTER))).cast("long")


def postprocessed(text: Column, style: list[tuple[str, str]], closing: str = "") -> Column:
    """struct(text, residue, chapters, style): the steps in their order, with what each changed; closing is put at the end once."""
    out, residue = without_residue(text)
    out, chapters = without_chapter_numbers(out)
    out, styled = rewritten(out, style)
    bare = F.regexp_replace(out, _RTRIM, "")
    whole = F.when(F.endswith(bare, F.lit(closing)), out).otherwise(F.concat(bare, F.lit("\n\n" + closing))) if closing else out
    return F.struct(whole.alias("text"), residue.alias("residue"), chapters.alias("chapters"), styled.alias("style"))


def excerpt(text: Column, most: int = 1800) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("…"))).otherwise(text)


def line_facts(text: Column, short: int = 20) -> Column:
    """struct(chars, lines, short, longest) of the lines that aren't blank."""
    sizes = F.filter(F.transform(F.split(text, "\n"), lambda x: F.length(strip(x))), lambda n: n > 0)
    return F.struct(prose_chars(text).alias("chars"), F.size(sizes).cast("long").alias("lines"), F.size(F.filter(sizes, lambda n: n <= short)).cast("long").alias("short"), F.coalesce(F.array_max(sizes), F.lit(0)).cast("long").alias("longest"))


def base_name(path: Column) -> Column:
    """The last part of a path, whatever its separators."""
    return F.element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), -1)


def set_name(title: Column) -> Column:
    """The name of a series: without the number at its end, in lower case."""
    return F.lower(strip(F.regexp_replace(title, r"[\s_-]+\d{1,3}$", "")))
