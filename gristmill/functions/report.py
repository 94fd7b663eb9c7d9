"""The structure of drafts measured against settings that a row may carry itself: title, length, chapters, layout, pictures, keyword."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import WHITE, strip

#: The settings of a report and what holds where a row says nothing.
DEFAULTS: dict[str, str | int | float] = {
    "format": "blog", "title_min": 15, "title_max": 40, "body_min": 1600, "body_max": 2800, "min_chapters": 3, "max_line": 20, "short_share": 0.9,
    "max_paragraph": 500, "min_images": 3, "caption_min": 20, "caption_max": 50, "title_head": 15, "max_density": 0.08, "density_count": 3,
    "density_nouns": 50, "min_diversity": 0.35, "min_consistency": 0.9, "max_negative": 0.35, "max_sentence": 90.0,
}
#: Patterns of a draft's layout. (?d) makes the line feed the only line end, (?U) takes white space of any script.
H1, H2, H3 = (rf"(?mdU)^\s{{0,3}}{mark}\s+(.+)$" for mark in ("#", "##", "###"))
HEADING, BULLET, IMAGE = r"(?mdU)^\s{0,3}#{1,6}\s+.*$", r"(?mdU)^\s{0,3}[-*•]\s+", r"!\[([^\]]*)\]\(([^)]*)\)"
MARKER, SLOT = r"/\*\s*소제목\s*\*/", r"(?U)^\s*\d{1,2}\s*$"
ORDINAL = r"(?mdU)^\s*(?:첫|두|세|네|다섯|여섯|일곱)\s*번째(?:는|로|으로)?"
NUMBERED = r"(?U)^\s*\d{1,2}[.)]?(?:\s|$)(?!\s*[년월일원명개])"
ZERO_WIDTH = "​"
_TYPES = {str: "string", int: "int", float: "double"}


def settings_of(json: Column) -> Column:
    """struct(error, value) of settings as JSON. Missing ones have their default; what can't be read is an error and has no value."""
    schema = ", ".join(f"{n} {_TYPES[type(v)]}" for n, v in DEFAULTS.items())
    read = F.from_json(F.coalesce(json, F.lit("{}")), f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    broken = read.isNull() | read["_broken"].isNotNull()
    value = F.struct(*(F.coalesce(read[n], F.lit(v)).alias(n) for n, v in DEFAULTS.items()))
    return F.struct(F.when(broken, F.lit("settings")).alias("error"), F.when(~broken, value).alias("value"))


def content_lines(text: Column) -> Column:
    """Lines without zero-width spaces and white space around them; blank ones left out."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: strip(F.replace(x, F.lit(ZERO_WIDTH), F.lit("")))), lambda x: x != "")


def _blocks(text: Column) -> Column:
    """Paragraphs between blank lines, in single blanks, without headings, pictures and quotations."""
    bare = F.regexp_replace(F.regexp_replace(text, HEADING, ""), IMAGE, "")
    joined = F.transform(F.split(bare, r"(?U)\n\s*\n"), lambda b: strip(F.regexp_replace(F.replace(b, F.lit(ZERO_WIDTH), F.lit("")), r"(?U)\s+", " ")))
    return F.filter(joined, lambda b: (b != "") & ~F.startswith(b, F.lit(">")))


def _chapters(text: Column, lines: Column, markdown: Column) -> Column:
    """Second and third headings; in a blog, lines with the marker, else ordinals, else lines that begin with a number."""
    marked = F.transform(F.filter(lines, lambda x: x.rlike(MARKER)), lambda x: strip(F.regexp_replace(x, MARKER, "")))
    ordinal, numbers = F.filter(lines, lambda x: x.rlike(ORDINAL)), F.filter(lines, lambda x: x.rlike(NUMBERED) & ~x.rlike(SLOT))
    headings = F.transform(F.concat(F.regexp_extract_all(text, F.lit(H2), F.lit(1)), F.regexp_extract_all(text, F.lit(H3), F.lit(1))), strip)
    return F.when(markdown, headings).when(F.size(marked) > 0, marked).when(F.size(ordinal) > 0, ordinal).otherwise(numbers)


def _says(when: Column, what: str, *values: Column) -> Column:
    return F.when(when, F.concat_ws(" ", F.lit(what), *(v.cast("string") for v in values)))


def measured_structure(df: DataFrame, text: str, keyword: str, settings: str, alt_white: str = WHITE) -> DataFrame:
    """df with title, chapters, body_chars, lines, short_share, longest_line, headings, bullets, images, paragraphs, longest_paragraph,
    in_title, in_head, in_intro, in_chapters and structure_warnings. settings: a column like settings_of's value.

    Places of the keyword are counted without blanks and are null where the row has no keyword. A draft without lines has a null title.
    alt_white: the characters that don't count at the ends of a picture's text.
    """
    t, s = F.coalesce(F.col(text), F.lit("")), lambda name: F.col(settings)[name]
    longest = lambda a: F.coalesce(F.array_max(F.transform(a, F.length)), F.lit(0))
    df = df.withColumns({"_lines": content_lines(t), "_blocks": _blocks(t), "_markdown": s("format") == "markdown"})
    title = F.when(t.rlike(H1), strip(F.regexp_extract(t, H1, 1))).otherwise(F.get("_lines", F.lit(0)))
    df = df.withColumns({"title": title, "chapters": _chapters(t, F.col("_lines"), F.col("_markdown"))})
    n = F.size("_lines")
    df = df.withColumns({
        "body_chars": F.aggregate("_lines", F.lit(0).cast("long"), lambda a, x: a + F.length(x)), "lines": n.cast("long"),
        "short_share": F.when(n > 0, F.bround(F.size(F.filter("_lines", lambda x: F.length(x) <= s("max_line"))) / n, 4)).otherwise(0.0),
        "longest_line": longest("_lines").cast("long"), "headings": F.regexp_count(t, F.lit(HEADING)).cast("long"), "bullets": F.regexp_count(t, F.lit(BULLET)).cast("long"),
        "_alts": F.transform(F.regexp_extract_all(t, F.lit(IMAGE), F.lit(1)), lambda a: F.btrim(a, F.lit(alt_white))), "paragraphs": F.size("_blocks").cast("long"), "longest_paragraph": longest("_blocks").cast("long"),
        "_key": F.replace(strip(F.coalesce(F.col(keyword), F.lit(""))), F.lit(" "), F.lit("")),
    })
    close = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    asked, key = F.col("_key") != "", F.col("_key")
    at = F.instr(close(F.coalesce("title", F.lit(""))), key)
    intro = close(F.array_join(F.slice("_blocks", 1, 2), " "))
    df = df.withColumns({
        "images": F.size("_alts").cast("long"), "in_title": F.when(asked, at > 0), "in_head": F.when(asked, (at > 0) & (at - 1 <= s("title_head"))),
        "in_intro": F.when(asked, F.contains(intro, key)), "in_chapters": F.when(asked, F.size(F.filter("chapters", lambda c: F.contains(close(c), key))).cast("long")),
    })
    size, ordinals = F.length("title"), F.regexp_count(t, F.lit(ORDINAL))
    over = F.filter("_blocks", lambda b: F.length(b) > s("max_paragraph"))
    alts = F.transform("_alts", lambda a: F.when(a == "", "alt empty").when(F.length(a) < s("caption_min"), F.concat(F.lit("alt short "), F.length(a))).when(F.length(a) > s("caption_max"), F.concat(F.lit("alt long "), F.length(a))))
    few = F.size("chapters") < s("min_chapters")
    blog, mark = ~F.col("_markdown"), F.col("_markdown")
    told = F.array(
        _says(F.col("title").isNull(), "no title"), _says(size < s("title_min"), "title short", size), _says(size > s("title_max"), "title long", size),
        _says(F.col("body_chars") < s("body_min"), "body short", F.col("body_chars")), _says(F.col("body_chars") > s("body_max"), "body long", F.col("body_chars")),
        _says(few, "chapters", F.size("chapters")), _says(few & blog & (ordinals >= s("min_chapters")), "chapters unmarked", ordinals),
        _says(blog & (F.col("headings") > 0), "headings", F.col("headings")), _says(blog & (F.col("bullets") > 0), "bullets", F.col("bullets")),
        _says(blog & (n > 0) & (F.col("short_share") < s("short_share")), "long lines", F.col("longest_line")),
        _says(mark & (F.size(over) > 0), "long paragraphs", F.size(over)), _says(mark & (F.col("images") < s("min_images")), "images", F.col("images")),
    )
    placed = F.array(_says(F.col("title").isNotNull() & ~F.col("in_title"), "keyword not in title"), _says(~F.col("in_intro"), "keyword not in intro"))
    warnings = F.array_compact(F.concat(told, F.when(mark, alts).otherwise(F.array().cast("array<string>")), placed))
    return df.withColumn("structure_warnings", warnings).drop("_lines", "_blocks", "_markdown", "_alts", "_key")
