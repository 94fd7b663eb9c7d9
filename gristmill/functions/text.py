"""Scalars over addresses, titles, dates and plain strings. Regular expressions are Java's, with \\n as the only line end."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Query keys that only track.
TRACKING = tuple("utm_source utm_medium utm_campaign utm_term utm_content fbclid gclid igshid spm ref referer referrer from sid cid s_kwcid n_media n_query n_rank".split())
#: White space of any script.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.btrim(c, F.lit(WHITE))


def squash(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", "")


def any_of(words: tuple[str, ...]) -> str:
    """A pattern of words taken literally."""
    return "|".join(r"\Q" + w + r"\E" for w in words)


def canonical_url(url: Column, tracking: tuple[str, ...] = TRACKING) -> Column:
    """Scheme and host in lower case, no tracking keys, no fragment, no slash at the end of the path (an empty one is /).

    What has no host stays as it is but for white space around it. Keys without a value and the order of keys stay.
    Escapes are left as they are.
    """
    u = strip(url)
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda k: (k != "") & ~F.lower(F.substring_index(k, "=", 1)).isin(*tracking))
    pairs = F.transform(kept, lambda k: F.when(F.instr(k, "=") > 0, k).otherwise(F.concat(k, F.lit("="))))
    short = F.regexp_replace(path, "/+$", "")
    tail = F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise("")
    return F.when(host == "", u).otherwise(F.concat(scheme, F.lit("://"), host, F.when(short == "", "/").otherwise(short), tail))


def history_key(url: Column) -> Column:
    """The key of the processed history: no slashes at the end; unlike the canonical form in all else."""
    return F.regexp_replace(strip(url), "/+$", "")


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def title_key(title: Column) -> Column:
    """Letters and digits before the last ' - '; may be empty, which is no key."""
    return F.regexp_replace(F.regexp_replace(title, r"(?s)^(.*) - .*$", "$1"), r"[^\p{L}\p{N}]", "")


_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def strip_tags(html: Column) -> Column:
    """Tags out, then the usual entities decoded, then trimmed. '&amp;' goes last, so nothing is decoded twice."""
    bare = F.regexp_replace(html, "<[^>]+>", "")
    return strip(reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), _ENTITIES.items(), bare))


def body_of(html: Column, least: int = 250) -> Column:
    """The text of the article element; of the whole page without scripts and styles if that is short and the page has more."""
    precise = strip_tags(F.regexp_extract(html, r"(?s)<article[^>]*>(.*)</article>", 1))
    loose = strip_tags(F.regexp_replace(html, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", ""))
    return F.when((F.length(precise) < least) & (F.length(loose) > F.length(precise)), loose).otherwise(precise)


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    """All named and numeric entities, where the usual ones aren't enough."""
    import html

    return s.map(html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def decode_bytes(data: pd.Series) -> pd.Series:
    """The decoding with the most Hangul syllables of UTF-8, CP949 and EUC-KR; the first of equals, at once above ten."""

    def one(raw: bytes | None) -> str | None:
        if raw is None:
            return None
        best, most = "", -1
        for name in ("utf-8", "cp949", "euc-kr"):
            text = bytes(raw).decode(name, errors="replace")
            n = sum("가" <= ch <= "힣" for ch in text)
            if n > most:
                best, most = text, n
            if n > 10:
                break
        return best

    return data.map(one)


def parse_time(value: Column, zone: str = "+09:00") -> Column:
    """ISO time as an instant; without an offset it is local to zone; null if it can't be read."""
    has_zone = value.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    return F.try_to_timestamp(F.when(has_zone | ~value.rlike(r"\d\d:\d\d"), F.when(value.rlike(r"\d\d:\d\d"), value).otherwise(F.concat(value, F.lit("T00:00:00" + zone)))).otherwise(F.concat(value, F.lit(zone))))


def mail_time(value: Column) -> Column:
    """RFC 2822 time as ISO in +09:00; what can't be read stays."""
    t = F.try_to_timestamp(F.regexp_replace(value, r"^[A-Za-z]{3},\s*", ""), F.lit("d MMM yyyy HH:mm:ss Z"))
    local = F.date_format(F.from_utc_timestamp(F.to_utc_timestamp(t, F.current_timezone()), "+09:00"), "yyyy-MM-dd'T'HH:mm:ss'+09:00'")
    return F.coalesce(local, value)


def age_days(then: Column, now: Column) -> Column:
    """Whole days since then, never below 0."""
    return F.greatest(F.lit(0), F.floor((F.unix_timestamp(now) - F.unix_timestamp(then)) / 86400)).cast("long")


def slug(title: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(title, "[^0-9A-Za-z가-힣]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(s, 1, 40), F.lit("")), F.lit("draft"))


def chunks(text: Column, size: int = 2000) -> Column:
    """The text in pieces of size characters; none for an empty text."""
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text), F.lit(size)), lambda i: F.substring(text, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda p: p != "")


def first_title(markdown: Column) -> Column:
    """The first heading, else the first line that isn't blank."""
    heading = F.regexp_extract(markdown, r"(?md)^#\s+(.+)$", 1)
    line = F.get(F.filter(F.transform(F.split(F.regexp_replace(markdown, "\u200b", ""), "\n"), strip), lambda x: x != ""), F.lit(0))
    return F.coalesce(F.nullif(strip(heading), F.lit("")), line)


def is_caption_title(title: Column, tags: tuple[str, ...]) -> Column:
    return title.rlike(r"[\[\(【][^\]\)】]{0,11}(?:" + any_of(tags) + r")[^\]\)】]{0,11}[\]\)】]")


def rule_of(text: Column, rules: list[tuple[str, tuple[str, ...]]], other: str) -> Column:
    """The first rule any of whose words occurs."""
    out = F.lit(other)
    for name, words in reversed(rules):
        out = F.when(text.rlike(any_of(words)), F.lit(name)).otherwise(out)
    return out


def mark_of(value: Column, yes: tuple[str, ...] = ("o", "y", "yes", "1", "true", "v"), no: tuple[str, ...] = ("x", "n", "no", "0", "false")) -> Column:
    v = F.lower(strip(F.coalesce(value, F.lit(""))))
    return F.when(v == "", "blank").when(v.isin(*yes), "pass").when(v.isin(*no), "fail").otherwise("doubt")
