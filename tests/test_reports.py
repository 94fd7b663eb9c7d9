"""The structure of drafts against a plain reading of the same rules, on made drafts with odd lines."""

import random
import re

from pyspark.sql import functions as F

from gristmill.functions import report
from gristmill.operators import reports

LINES = ["# Ein Titel on a", "## Teil eins", "### Teil zwei on a", "첫 번째는 on a /* 소제목 */", "두 번째로", "1. eins", "12", " 7 ", "3 년", "- Punkt", "", "   ", "​", "> Zitat on a", "![alt text](a.jpg)", "![](b)", "![%s](c.png)" % ("x" * 60), "wort on a " * 9, "kurz", "  ##   ", "on a"]
FIELDS = "id long, text string, keyword string, settings string"


def plain(text, keyword, s):
    lines = [x for x in (line.replace("​", "").strip() for line in text.split("\n")) if x]
    h1 = re.search(r"^\s{0,3}#\s+(.+)$", text, re.M)
    title = h1.group(1).strip() if h1 else (lines[0] if lines else None)
    marker, slot, markdown = r"/\*\s*소제목\s*\*/", r"^\s*\d{1,2}\s*$", s["format"] == "markdown"
    ordinal = re.compile(r"^\s*(첫|두|세|네|다섯|여섯|일곱)\s*번째(는|로|으로)?", re.M)
    if markdown:
        chapters = [h.strip() for n in (2, 3) for h in re.findall(rf"^\s{{0,3}}{'#' * n}\s+(.+)$", text, re.M)]
    else:
        chapters = [re.sub(marker, "", x).strip() for x in lines if re.search(marker, x)] or [x for x in lines if ordinal.match(x)] or [x for x in lines if re.match(r"^\s*(\d{1,2})[.)]?(?:\s|$)(?!\s*[년월일원명개])", x) and not re.match(slot, x)]
    bare = re.sub(r"!\[([^\]]*)\]\(([^)]*)\)", "", re.sub(r"^\s{0,3}#{1,6}\s+.*$", "", text, flags=re.M))
    blocks = [b for b in (" ".join(x.replace("​", "").split()) for x in re.split(r"\n\s*\n", bare)) if b and not b.startswith(">")]
    alts = [a.strip() for a, _ in re.findall(r"!\[([^\]]*)\]\(([^)]*)\)", text)]
    chars, heads, bullets = sum(map(len, lines)), len(re.findall(r"^\s{0,3}#{1,6}\s+.*$", text, re.M)), len(re.findall(r"^\s{0,3}[-*•]\s+", text, re.M))
    share = round(sum(len(x) <= s["max_line"] for x in lines) / len(lines), 4) if lines else 0.0
    w, size, ordinals = [], len(title or ""), len(ordinal.findall(text))
    say = lambda when, *what: w.append(" ".join(map(str, what))) if when else None
    say(title is None, "no title")
    say(title is not None and size < s["title_min"], "title short", size)
    say(title is not None and size > s["title_max"], "title long", size)
    say(chars < s["body_min"], "body short", chars)
    say(chars > s["body_max"], "body long", chars)
    few = len(chapters) < s["min_chapters"]
    say(few, "chapters", len(chapters))
    say(few and not markdown and ordinals >= s["min_chapters"], "chapters unmarked", ordinals)
    over = [b for b in blocks if len(b) > s["max_paragraph"]]
    if not markdown:
        say(heads, "headings", heads)
        say(bullets, "bullets", bullets)
        say(lines and share < s["short_share"], "long lines", max(map(len, lines), default=0))
    else:
        say(over, "long paragraphs", len(over))
        say(len(alts) < s["min_images"], "images", len(alts))
        for a in alts:
            say(not a, "alt empty")
            say(a and len(a) < s["caption_min"], "alt short", len(a))
            say(len(a) > s["caption_max"], "alt long", len(a))
    key = (keyword or "").strip().replace(" ", "")
    places = (None,) * 4
    if key:
        close = (title or "").replace(" ", "")
        intro = key in " ".join(blocks[:2]).replace(" ", "")
        say(title is not None and key not in close, "keyword not in title")
        say(not intro, "keyword not in intro")
        places = (key in close, key in close and close.index(key) <= s["title_head"], intro, sum(key in c.replace(" ", "") for c in chapters))
    return (title, chapters, chars, len(lines), share, max(map(len, lines), default=0), heads, bullets, len(alts), len(blocks), max(map(len, blocks), default=0), *places, w)


def test_structure(spark):
    rng, rows, want = random.Random(7), [], {}
    for i in range(300):
        text = "\n".join(rng.choice(LINES) for _ in range(rng.randrange(1, 25)))
        own = rng.choice([{}, {"format": "markdown"}, {"title_min": 1, "min_chapters": 1, "body_min": 10, "max_paragraph": 20, "short_share": 0.5}])
        keyword = rng.choice([None, "", " on a ", "nie"])
        rows.append((i, text, keyword, None if not own and i % 2 else str(own).replace("'", '"')))
        want[i] = plain(text, keyword, report.DEFAULTS | own)
    rows.append((300, None, "x", None))
    want[300] = plain("", "x", report.DEFAULTS)
    df = spark.createDataFrame(rows, FIELDS).withColumn("_set", report.settings_of(F.col("settings"))["value"])
    got = report.measured_structure(df, "text", "keyword", "_set").collect()
    for r in got:
        assert tuple(r[c] for c in [*reports.MEASURES, "structure_warnings"]) == want[r.id], (r.id, r.text)


def test_errors_are_rows(spark):
    rows = [(1, "Ein Text", None, "{broken"), (2, "Ein Text", None, '{"title_min": 3, "title_max": 9, "unknown": 1}'), (3, "", None, None), (4, None, None, None), (5, "eins zwei", None, '{"title_min": "many"}'), (6, "x" * 100_000, None, "[]")]
    of = lambda rows, kind: spark.createDataFrame(rows, kind)
    got = reports.quality_reports(
        of(rows, FIELDS), of([(2, 10, 1, 60, 0.1)], "id long, tokens long, distinct_tokens long, nouns long, diversity double"), of([(2, 1, "text", 9, 0.9), (2, 2, "ein", 2, 0.5), (1, 1, "a", 9, 0.9)], "id long, rank long, word string, n long, density double"),
        of([(2, 3, 95.0, "plain", 0.5)], "id long, sentences long, mean_length double, style string, consistency double"), of([(2, 0.5)], "id long, negative double"), of([(2, 4, True), (1, 4, True)], "id long, n long, blocked boolean"),
    )
    rows = {r.id: r for r in got.collect()}
    assert set(rows) == {1, 2, 5, 6}
    assert rows[1].error == "settings" and all(rows[1][c] is None for c in got.columns[2:]) and rows[5].error == "settings" and rows[6].error == "settings"
    assert rows[2].error is None and rows[2].passed is False and rows[2].banned == 4
    assert rows[2].warnings == ["overused text 9", "few different words", "mixed style plain", "negative", "long sentences", "structure: body short 8", "structure: chapters 0"]


def test_white_space_of_picture_texts(spark):
    """By default any white space at the ends of a picture's text doesn't count; a caller may say which does, as the query's SQL does."""
    from gristmill.functions.report import measured_structure, settings_of

    df = spark.createDataFrame([("![ Wh erth at at.\n](p.jpg)",)], "text string").withColumns({"key": F.lit(""), "set": settings_of(F.lit('{"format": "markdown"}'))["value"]})
    told = lambda **white: [w for w in measured_structure(df, "text", "key", "set", **white).first().structure_warnings if w.startswith("alt")]
    assert told() == ["alt short 14"] and told(alt_white=" ") == ["alt short 15"]
