"""Places of words in folded text, headings of drafts, verdicts from marks, quota errors."""

from __future__ import annotations

import unicodedata
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.text import mark_of, strip

PLACES = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("start", T.LongType()), T.StructField("finish", T.LongType())]))


@cache
def _fold(ch: str) -> str:
    return "".join(low for low in unicodedata.normalize("NFKC", ch).lower() if low.isalnum())


def folded(text: str) -> tuple[str, np.ndarray]:
    """Letters and digits of a text in compatible form and lower case, and the source place of each."""
    sizes = np.fromiter((len(_fold(ch)) for ch in text), np.int32, len(text))
    return "".join(map(_fold, text)), np.repeat(np.arange(len(text), dtype=np.int32), sizes)


def _hits(text: str, keys: list[tuple[str, str]]) -> list[tuple[int, int, int]]:
    """(start, finish, place of the word in keys), in the order of start, the longest first, and of the word."""
    flat, at = "".join(map(_fold, text)), None
    out = []
    for n, (_, key) in enumerate(keys):
        k = flat.find(key) if key else -1
        while k >= 0:
            at = folded(text)[1] if at is None else at
            out.append((int(at[k]), int(at[k + len(key) - 1]) + 1, n))
            k = flat.find(key, k + 1)
    return sorted(out, key=lambda x: (x[0], -x[1], keys[x[2]][0]))


def places_of(texts: pa.Array, words: tuple[str, ...]) -> pa.Array:
    """The places of folded_places for some texts. One text at a time is a Python value; places are kept as numbers."""
    keys = [(w, folded(w)[0]) for w in words]
    ends, word, start, finish = array("i", [0]), array("i"), array("q"), array("q")
    for text in texts:
        for first, last, n in _hits(text.as_py() or "", keys):
            word.append(n), start.append(first), finish.append(last)
        ends.append(len(word))
    told = pa.DictionaryArray.from_arrays(pa.array(word, pa.int32()), pa.array([w for w, _ in keys], pa.string())).cast(pa.string())
    places = pa.StructArray.from_arrays([told, pa.array(start, pa.int64()), pa.array(finish, pa.int64())], ["word", "start", "finish"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), places)


def folded_places(text: Column, words: tuple[str, ...]) -> Column:
    """array(word, start, finish) in code points of the source: each word wherever its folded form stands, overlaps too."""

    @F.arrow_udf(PLACES)
    def find(column: pa.Array) -> pa.Array:
        return places_of(column, words)

    return find(text)


def once_a_place(hits: DataFrame) -> DataFrame:
    """hits (id, category, start, finish, ...): of those at one place in one category, the first by word."""
    w = W.partitionBy("id", "category", "start", "finish").orderBy("word")
    return hits.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def context(text: Column, start: Column, finish: Column, around: int = 20) -> Column:
    a, b = F.greatest(start - around, F.lit(0)), F.least(finish + around, F.length(text))
    return F.concat(F.when(a > 0, "…").otherwise(""), F.substring(text, (a + 1).cast("int"), (b - a).cast("int")), F.when(b < F.length(text), "…").otherwise(""))


#: The mark of a heading, what may lead and end it.
HEADING, LEAD, TAILS = r"/\*\s*소제목\s*\*/", r"^\d+\.\s*(?:(?:첫|두|세|네|다섯|여섯)\s*번째는\s*)?", r"(?:이야기예요\.|이야기에요\.)$"


def headings(drafts: DataFrame, mark: str = HEADING) -> DataFrame:
    """(id, place, heading) of drafts (id, text): a marked line and the lines up to the next blank one, joined."""
    lines = drafts.select("id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    upto = W.partitionBy("id").orderBy("place")
    lines = lines.withColumn("marked", F.col("line").rlike(mark)).withColumn("blocks", F.sum((strip(F.col("line")) == "").cast("int")).over(upto))
    heads = lines.where("marked").select("id", "place", "blocks", F.regexp_replace("line", mark, "").alias("own"))
    rest = lines.select(F.col("id"), F.col("place").alias("later"), "blocks", "line")
    parts = heads.join(rest, ["id", "blocks"]).where("later >= place").withColumn("part", strip(F.when(F.col("later") == F.col("place"), F.col("own")).otherwise(F.col("line"))))
    whole = parts.groupBy("id", "place").agg(F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("later", "part"))), lambda x: x["part"] != ""), lambda x: x["part"]), " ").alias("h"))
    return whole.select("id", "place", strip(F.regexp_replace(strip(F.regexp_replace("h", LEAD, "")), TAILS, "")).alias("heading")).where("heading <> ''")


def verdict(mark: Column, reason: Column, vetoes: list[tuple[Column, str]], worn: Column, own: list[tuple[Column, int]], rivals: list[list[tuple[Column, int]]], worn_right: tuple[str, ...] = ("정상", "없음", ""), **marks: tuple[str, ...]) -> Column:
    """struct(verdict, reason): by the mark; in doubt by vetoes, then by weighted signals of the own kind against its rivals."""
    on = lambda c: strip(F.coalesce(c, F.lit(""))) != ""
    add = lambda signals: sum((F.when(on(c), w).otherwise(0) for c, w in signals), F.lit(0))
    score, others = add(own), [add(r) for r in rivals]
    rival = F.greatest(*others) if len(others) > 1 else others[0]
    nothing = score == 0
    for o in others:
        nothing = nothing & (o == 0)
    m, worn_as = mark_of(mark, **marks), strip(F.coalesce(worn, F.lit("")))
    pair = lambda v, r: F.struct(F.lit(v).alias("verdict"), (r if isinstance(r, Column) else F.lit(r)).alias("reason"))
    told = F.concat_ws(" / ", score.cast("string"), *[o.cast("string") for o in others])
    out = F.when(m == "blank", pair("held", "no mark")).when(m == "fail", pair("rejected", F.coalesce(F.nullif(strip(reason), F.lit("")), F.lit("no reason")))).when(m == "pass", pair("accepted", "seen"))
    for c, label in vetoes:
        out = out.when(on(c), pair("rejected", label))
    out = out.when(~worn_as.isin(*worn_right), pair("rejected", "worn wrong")).when(nothing, pair("held", "no signals"))
    return out.when((score >= 5) & (score - rival >= 3), pair("accepted", told)).when(score >= 3, pair("held", told)).otherwise(pair("rejected", told))


ERROR = "struct<error:struct<details:array<struct<`@type`:string,violations:array<struct<quotaId:string,quotaValue:string>>>>>>"


def quota_error(body: Column) -> Column:
    """struct(ids, daily, minute, none_left, wait) of an error response: which limits it names, and the seconds it asks for."""
    details = F.coalesce(F.from_json(body, ERROR)["error"]["details"], F.array().cast("array<struct<`@type`:string,violations:array<struct<quotaId:string,quotaValue:string>>>>"))
    broken = F.flatten(F.transform(F.filter(details, lambda d: F.contains(d["@type"], F.lit("QuotaFailure")) & d["violations"].isNotNull()), lambda d: d["violations"]))
    ids = F.filter(F.transform(broken, lambda v: v["quotaId"]), lambda i: i.isNotNull() & (i != ""))
    wait = F.regexp_extract(body, r'(?i)"?retryDelay"?\s*[:=]\s*"?(\d+(?:\.\d+)?)s', 1)
    return F.struct(
        ids.alias("ids"),
        F.exists(ids, lambda i: F.contains(i, F.lit("PerDay")) | F.contains(i, F.lit("PerProjectPerDay"))).alias("daily"),
        F.exists(ids, lambda i: F.contains(i, F.lit("PerMinute"))).alias("minute"),
        F.exists(broken, lambda v: F.coalesce(F.try_to_number(v["quotaValue"], F.lit("S999999999999")) <= 0, F.lit(False))).alias("none_left"),
        (F.nullif(wait, F.lit("")).cast("double") + 1).alias("wait"),
    )


def within_budget(items: Column, budget: int) -> Column:
    """Of items array(priority, cost, text) those of all priorities, best first, that fit together; a priority goes whole."""
    ranks = F.array_sort(F.array_distinct(F.transform(items, lambda x: x["priority"])))
    cost = lambda p: F.aggregate(F.filter(items, lambda x: x["priority"] <= p), F.lit(0).cast("long"), lambda a, x: a + x["cost"])
    last = F.array_max(F.filter(ranks, lambda p: cost(p) <= budget))
    return F.transform(F.filter(items, lambda x: F.coalesce(x["priority"] <= last, F.lit(False))), lambda x: x["text"])
