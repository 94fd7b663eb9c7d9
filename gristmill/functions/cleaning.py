"""Cleaning of record bodies, line by line, as an ordered list of Column functions. The order is part of the result."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import any_of, strip

# Patterns, labels and limits of the cleaning steps.
EMAIL = r"(?U)[\w.\-]+@[\w.\-]+\.\w+"
URL = r"https?://\S+|www\.\S+"
BYLINE = r"(?U)^\s*(?:[가-힣A-Za-z]+\s*=\s*)?[가-힣]{2,4}\s*기자(?:\s*[\w.\-]+@[\w.\-]+)?\s*$"
BRACKET_BYLINE = r"\[[^\[\]]{0,30}(?:기자|특파원)[^\[\]]{0,30}\]"
ANGLE_BYLINE = r"<[^<>]{0,30}(?:기자|특파원)[^<>]{0,10}>"
AGENCY = r"(?U)^\s*\([^()]{1,30}=[^()]{1,30}\)\s*[가-힣]{2,4}\s*(?:기자|특파원)\s*=\s*"
DATE_TAIL = r"(?U)\d{4}\s*\.\s*\d{1,2}\s*\.\s*\d{1,2}\s*\.?\s*$"
TERMINATOR = r"(?U)^\s*\(끝\)"
CAPTION_TAIL = r"(?U)(?:모습|장면)\s*\.?\s*$"
LIST_MARKER = r"(?U)^\s*(?:[-*•]\s|[▶▷►☞※])"
COPYRIGHT = r"(?iUu)(무단\s*전재|재배포|저작권자|ⓒ|©|copyright)"
COPYRIGHT_NOTICE = r"(?iUu)[<\[(]?\s*(?:ⓒ|©|copyright)?[^.\n]{0,40}?(?:무단\s*전재|재배포|저작권자)[^.\n]{0,40}?(?:금지|엄금)\s*[>\])]?\.?"
UI_LINE = r"(?U)^\s*(?:기사\s*본문\s*영역|읽어주기\s*기능|브라우저에서만\s*사용)"
SECTION_HEADERS = (
    "관련기사", "관련 기사", "연관기사", "추천기사", "추천 기사", "많이 본 뉴스", "많이본 뉴스", "많이 본 기사", "인기기사", "인기 기사", "주요뉴스", "주요 뉴스", "핫이슈",
    "실시간 뉴스", "최신기사", "최신 기사", "이시각 주요뉴스", "포토뉴스", "많이 읽은 기사", "베스트 클릭", "이 기사 어때요", "함께 보면 좋은 기사", "오늘의 주요뉴스", "관련 키워드", "관련키워드", "제보하기",
)
INLINE_HEADERS = ("관련 키워드", "관련키워드", "관련 기사", "관련기사")
HEADER_EDGES = r"^[\[\]<>()【】〔〕·■□◆◇●○▶▷►▸☞※★☆|\-*•\s]+|[\[\]<>()【】〔〕·■□◆◇●○▶▷►▸☞※★☆|\-*•\s]+$"
COPYRIGHT_CHARS, UI_CHARS, CAPTION_CHARS, HEADER_CHARS, BODY_BEFORE_HEADER = 80, 40, 100, 20, 100
CAPTION_KEPT, FOREIGN_LETTERS, FOREIGN_SHARE, LEAST_CHARS, HOME_SHARE = 0.3, 40, 0.7, 100, 0.5


def _lines(text: Column, keep: Callable[[Column], Column]) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), keep), "\n")


def _chars(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(strip(x)))


def _where(text: Column, hint: str, out: Column) -> Column:
    """out, but for a text that holds nothing the step looks for: that one is spared the walk over its lines."""
    return F.when(text.rlike(hint), out).otherwise(text)


def caption_lines(text: Column) -> Column:
    """Out with lines that begin or end with a pipe, unless less than a third or so of the text would stay."""
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda x: ~(F.startswith(strip(x), F.lit("|")) | F.endswith(strip(x), F.lit("|"))))
    few = (_chars(lines) > 0) & (_chars(kept) < _chars(lines) * CAPTION_KEPT)
    return _where(text, r"\|", F.when(few, text).otherwise(F.array_join(kept, "\n")))


def agency_lines(text: Column) -> Column:
    """A line with an agency prefix goes if it ends with a date, else it loses the prefix."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~(x.rlike(AGENCY) & x.rlike(DATE_TAIL)))
    return _where(text, "기자|특파원", F.array_join(F.transform(kept, lambda x: F.regexp_replace(x, AGENCY, "")), "\n"))


def boilerplate_lines(text: Column) -> Column:
    """Short copyright lines, bylines and screen texts go; long lines lose the notice alone."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~(x.rlike(COPYRIGHT) & (F.length(x) <= COPYRIGHT_CHARS)))
    cut = F.transform(kept, lambda x: F.when(x.rlike(COPYRIGHT), F.regexp_replace(x, COPYRIGHT_NOTICE, " ")).otherwise(x))
    out = F.array_join(F.filter(cut, lambda x: ~x.rlike(BYLINE) & ~((F.length(strip(x)) <= UI_CHARS) & x.rlike(UI_LINE))), "\n")
    return _where(text, "기자|기사|읽어주기|브라우저|" + COPYRIGHT, out)


def bracket_bylines(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, BRACKET_BYLINE, ""), ANGLE_BYLINE, "")


def plain_captions(text: Column) -> Column:
    return _where(text, "모습|장면", _lines(text, lambda x: ~((strip(x) != "") & (F.length(strip(x)) <= CAPTION_CHARS) & strip(x).rlike(CAPTION_TAIL))))


def cut_at_terminator(text: Column) -> Column:
    lines = F.split(text, "\n")
    marks = F.transform(lines, lambda x: x.rlike(TERMINATOR))
    place = F.array_position(marks, True)
    return _where(text, r"\(끝\)", F.when(place > 0, F.array_join(F.slice(lines, F.lit(1), (place - 1).cast("int")), "\n")).otherwise(text))


def cut_at_section(text: Column) -> Column:
    """From a section header on nothing stays, if enough body stands before it; else the header line alone goes.

    One fold over the lines carries the kept lines, their characters, and whether the text has ended.
    """
    is_header = lambda x: (F.length(F.regexp_replace(x, HEADER_EDGES, "")).between(1, HEADER_CHARS)) & F.regexp_replace(x, HEADER_EDGES, "").rlike("^(?:" + any_of(SECTION_HEADERS) + ")")
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("chars"), F.lit(False).alias("over"))

    def step(a: Column, x: Column) -> Column:
        skip, over = a["over"] | is_header(x), a["over"] | (is_header(x) & (a["chars"] >= BODY_BEFORE_HEADER))
        return F.struct(F.when(skip, a["kept"]).otherwise(F.concat(a["kept"], F.array(x))).alias("kept"), F.when(skip, a["chars"]).otherwise(a["chars"] + F.length(strip(x))).alias("chars"), over.alias("over"))

    # without any header the fold, which copies, isn't needed
    return F.when(text.rlike(any_of(SECTION_HEADERS)), F.aggregate(F.split(text, "\n"), start, step, lambda a: F.array_join(a["kept"], "\n"))).otherwise(text)


def cut_at_inline_header(text: Column) -> Column:
    """From the first header that is stuck to the text before it, if enough body stands there."""
    pieces = F.split(text, r"(?<=\S)(?=(?:" + any_of(INLINE_HEADERS) + "))")
    heads = F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda i: F.array_join(F.slice(pieces, F.lit(1), i), ""))
    first = F.get(F.filter(heads, lambda h: F.length(strip(h)) >= BODY_BEFORE_HEADER), F.lit(0))
    return F.when(text.rlike(any_of(INLINE_HEADERS)) & (F.size(pieces) > 1), F.when(first == text, text).otherwise(F.regexp_replace(F.coalesce(first, text), r"(?U)\s+$", ""))).otherwise(text)


def edge_lists(text: Column) -> Column:
    """List and blank lines at both ends go; lists inside the text stay."""
    lines = F.split(text, "\n")
    solid = F.filter(F.transform(lines, lambda x, i: F.when((strip(x) != "") & ~strip(x).rlike(LIST_MARKER), i)), lambda i: i.isNotNull())
    a, b = F.array_min(solid), F.array_max(solid)
    return F.when(F.size(solid) > 0, F.array_join(F.slice(lines, a + 1, b - a + 1), "\n")).otherwise("")


def emails(text: Column) -> Column:
    return F.regexp_replace(text, EMAIL, "")


def foreign_lines(text: Column) -> Column:
    latin, home = lambda x: F.regexp_count(x, F.lit("[A-Za-z]")), lambda x: F.regexp_count(x, F.lit("[가-힣]"))
    return _lines(text, lambda x: ~((latin(x) + home(x) >= FOREIGN_LETTERS) & (latin(x) >= (latin(x) + home(x)) * FOREIGN_SHARE)))


def white_space(text: Column) -> Column:
    lines = F.transform(F.split(text, "\n"), lambda x: strip(F.regexp_replace(F.replace(x, F.lit("|"), F.lit(" ")), "[ \\t\u00a0]+", " ")))
    return strip(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"))


STEPS: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("caption_lines", caption_lines),
    ("agency_lines", agency_lines),
    ("boilerplate_lines", boilerplate_lines),
    ("bracket_bylines", bracket_bylines),
    ("plain_captions", plain_captions),
    ("cut_at_terminator", cut_at_terminator),
    ("cut_at_section", cut_at_section),
    ("cut_at_inline_header", cut_at_inline_header),
    ("edge_lists", edge_lists),
    ("emails", emails),
    ("foreign_lines", foreign_lines),
    ("white_space", white_space),
)


def cleaned(df: DataFrame, column: str, into: str = "body_clean", without: tuple[str, ...] = (), diagnose: bool = False) -> DataFrame:
    """df with the cleaned column; with diagnose also a map of how many characters each step took away.

    One projection a step: an expression that uses its input often is then computed once each time.
    """
    df = df.withColumn("_clean", F.coalesce(F.col(column), F.lit("")))
    lengths = [F.length("_clean").alias("n0")]
    for k, (name, step) in enumerate(STEPS, 1):
        if name not in without:
            df = df.withColumn(f"_was{k}", F.length("_clean")) if diagnose else df
            df = df.withColumn("_clean", step(F.col("_clean")))
            if diagnose:
                df = df.withColumn(f"_lost{k}", F.col(f"_was{k}") - F.length("_clean")).drop(f"_was{k}")
                lengths.append((name, f"_lost{k}"))
    # one row in, one row out; a filter on the result stops here instead of being rewritten in terms of all the steps
    df = df.withColumn("_clean", F.explode(F.array(F.col("_clean"))))
    df = df.withColumn(into, F.when(strip(F.col("_clean")) == "", "").otherwise(F.col("_clean"))).drop("_clean")
    if diagnose:
        pairs = [x for n, c in lengths[1:] for x in (F.lit(n), F.col(c))]
        df = df.withColumn("lost", F.explode(F.array(F.map_filter(F.create_map(*pairs), lambda _, n: n > 0)))).drop(*[c for _, c in lengths[1:]])
    return df


def _without(text: Column, pattern: str, *hints: str) -> Column:
    """text with a blank for each match of pattern; texts that hold none of the hints, one of which is in every match, are spared the search."""
    any_hint = reduce(Column.__or__, [F.contains(text, F.lit(h)) for h in hints])
    return F.when(any_hint, F.regexp_replace(text, pattern, " ")).otherwise(text)


def home_share(text: Column) -> Column:
    """Hangul among Hangul and Latin letters, without addresses; 0 if there is neither."""
    # lambdas compute each step once, where an expression that is used twice may be computed twice; letters are counted without a list of them
    once = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))
    letters = lambda t: F.struct(F.length(F.regexp_replace(t, "[^가-힣]+", "")).alias("home"), F.length(F.regexp_replace(t, "[^A-Za-z]+", "")).alias("latin"))
    share = lambda n: F.when(n["home"] + n["latin"] > 0, n["home"] / (n["home"] + n["latin"])).otherwise(0.0)
    sample = once(once(text, lambda t: _without(t, URL, "://", "www.")), lambda t: _without(t, EMAIL, "@"))
    return once(once(sample, letters), share)


def kept_records(df: DataFrame, column: str = "body_clean") -> DataFrame:
    """Records whose cleaned body is long enough and in the home script."""
    judged = F.transform(F.array(column), lambda t: (F.length(t) >= LEAST_CHARS) & (home_share(t) >= HOME_SHARE))
    return df.where(F.get(judged, F.lit(0)))


# Markdown syntax, in the order in which it is taken off, and what stays of it.
MARKDOWN = (
    (r"(?s)```.*?```", ""),
    (r"!\[[^\]]*\]\([^)]*\)", ""),
    (r"\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"`([^`]*)`", "$1"),
    (r"(?md)^\s{0,3}(?:-{3,}|\*{3,}|_{3,})\s*$", ""),
    (r"(?md)^\s{0,3}#{1,6}\s*", ""),
    (r"(?md)^\s{0,3}>\s?", ""),
    (r"(?md)^\s{0,3}(?:[-*+]|\d+\.)\s+", ""),
    (r"(?s)(\*{1,3}|_{1,3}|~~)(.+?)\1", "$2"),
    (r"\n{3,}", "\n\n"),
)


def strip_markdown(text: Column) -> Column:
    for pattern, by in MARKDOWN:
        text = F.regexp_replace(text, pattern, by)
    return strip(text)


def excluded_lines(df: DataFrame, column: str, rules: list[tuple[str, tuple[str, ...]]]) -> DataFrame:
    """df with kept_text and excluded, an array of (line, text, rule): the first rule that a line meets."""
    lines = F.split(F.coalesce(F.col(column), F.lit("")), "\n")

    def rule(x: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, patterns in reversed(rules):
            out = F.when(x.rlike("|".join(f"(?:{p})" for p in patterns)), name).otherwise(out)
        return F.when(strip(x) == "", F.lit(None).cast("string")).otherwise(out)

    ruled = F.transform(lines, lambda x, i: F.struct((i + 1).cast("long").alias("line"), x.alias("text"), rule(x).alias("rule")))
    df = df.withColumn("_ruled", ruled)
    df = df.withColumn("excluded", F.filter("_ruled", lambda r: r["rule"].isNotNull()))
    return df.withColumn("kept_text", F.array_join(F.transform(F.filter("_ruled", lambda r: r["rule"].isNull()), lambda r: r["text"]), "\n")).drop("_ruled")
