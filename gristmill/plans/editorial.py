"""Registered queries of lanes, bundles, pictures, replies and analyser units. Each takes (spark, sf_dir) and reads whole tables.

events stand in for records with a lane (event_type) and an event (user_id), pages for pictures, conversations for analysed texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.functions import drafts, matching, media, text
from gristmill.operators import events, lanes, ordering, units
from gristmill.operators.greedy import cut
from gristmill.plans.flagship import TABLES, records

CREDITS = [("utm_source", "Feed"), (r"^\d", "Number"), ("html", media.GENERATED)]
CONTENT, NOUNS = ("NN", "VV"), ("NN",)
ENDINGS = [("action", "(tion|ment)$"), ("plain", "(er|es|ed)$"), ("going", "ing$")]
LANES = ["en", "src0", "de", "src1"]
NOW = "timestamp_ntz'2024-01-31 00:00:00'"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- pictures, prompts, settings, replies ---------------------------------------------------------------------


def picture_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each host's credits in one sentence, in the order of its pages."""
    name = drafts.base_name(F.col("url"))
    p = _table(spark, sf_dir, "pages").select(F.split("url", "/")[2].alias("host"), "page_id", media.credit_by_name(name, CREDITS).alias("credit"))
    first = p.groupBy("host", "credit").agg(F.min("page_id").alias("at"))  # so that a host's list is no longer than the rules
    listed = first.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "credit"))).alias("c"))
    return listed.select("host", media.credit_line(F.transform("c", lambda x: x["credit"])).alias("line"))


def alt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir).join(_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality"), "id", "left")
    return r.select("id", media.alt_text(F.col("title"), F.split("body", " "), F.col("quality") == 1, "picture").alias("alt"))


def _terms() -> Column:
    fixed = F.array(F.array(F.lit("the"), F.lit("tion"), F.lit("x")), F.array(F.lit(" an "), F.lit("the")))
    return media.all_terms(F.concat(fixed, F.array(F.slice(F.split("text", " "), 1, 2))))


def filtered_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "conversations").withColumn("terms", _terms())
    return c.select("conv_id", "turn", F.array_join("terms", "|").alias("terms"), media.without_terms(F.col("text"), F.col("terms")).alias("text"))


def lane_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = F.concat("lang", F.lit(": "), "source", F.lit(" , x:"), F.col("n_chars").cast("string"), F.lit(":"), F.col("doc_id").cast("string"), F.lit(" | "), "source", F.lit("::many | : |"))
    d = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(media.lanes_of(spec, 30, 2)).alias("place", "l"))
    return d.select("doc_id", "place", "l.name", F.array_join("l.keywords", ",").alias("keywords"), "l.display", "l.lookback")


def reply_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of documents told in replies of at most 20 items, as JSON in a fence, and read back; only 15 were asked for."""
    kind = F.when(F.col("toxic") == 1, "unknown").when(F.col("quality") == 1, " good ").otherwise("bad")
    item = F.struct((F.col("doc_id") % 20).cast("string").alias("i"), kind.alias("label"), F.repeat(kind, 12).alias("why"))
    told = _table(spark, sf_dir, "labels").groupBy(F.floor(F.col("doc_id") / 20).alias("batch")).agg(F.collect_list(item).alias("items"))
    reply = F.concat(F.lit(" ```json\n"), F.to_json("items"), F.lit("\n```"))
    return told.select("batch", F.explode(media.replies(reply, ["good", "bad"], F.lit(15))).alias("r")).select("batch", "r.*")


def labels_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("label"), F.when(F.col("toxic") == 1, "person").otherwise("model").alias("by"))
    told = _table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.col("event_type").alias("label"))
    return lanes.labels_merged(rows, told)


def realigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events of a type, turned round and cut into the first two and the rest."""
    g = _table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.sort_array(F.collect_list("event_id")).alias("ids"))
    cut_ = media.regrouped(F.array(F.slice("ids", 1, 2), F.slice("ids", F.lit(3), F.size("ids"))), F.reverse("ids"))
    return g.select("user_id", "event_type", F.array_join(cut_[0], ",").alias("first"), F.array_join(cut_[1], ",").alias("rest"))


def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.when(F.col("event_type") != "error", F.col("ts"))
    e = _table(spark, sf_dir, "events").withColumn("at", at)
    rules = [("old", F.col("at") < F.expr(NOW) - F.make_dt_interval(F.lit(20))), ("done", F.col("event_type") == "click"), ("small", F.col("value") < 50)]
    return lanes.with_reason(e, rules).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("at").isNull()).alias("of_unknown_age"))


def reset_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    stamp = F.when(F.col("quality").isNotNull(), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int")))
    board = d.select(F.col("doc_id").alias("id"), stamp.alias("stamp"), F.col("lang").alias("body"))
    return lanes.reset_notices(board, F.lit("2024-01-31").cast("date"), "nothing yet").withColumn("stamp", F.date_format("stamp", "yyyy-MM-dd"))


def cached_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose text was a first turn before have a vector; the other texts are to be encoded, each once."""
    c = _table(spark, sf_dir, "conversations")
    cache = c.where("turn = 0").select(F.sha1("text").alias("key"), F.length("text").alias("vector")).distinct()
    known, new = lanes.with_cached(c, cache)
    return known.select(F.lit("known").alias("part"), F.concat_ws("/", "conv_id", "turn").alias("item")).union(new.select(F.lit("new"), F.md5("text")))


# --- analyser units -------------------------------------------------------------------------------------------


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.posexplode(F.split("text", r"\. ")).alias("sentence", "text"))


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _sentences(spark, sf_dir).select("id", "sentence", F.posexplode(F.split("text", " ")).alias("pos", "lemma")).where("lemma <> ''")
    tag = F.when(F.col("lemma").rlike("tion$"), "NN-R").when(F.col("lemma").rlike("ing$"), "VV").when(F.length("lemma") > 9, "NN").otherwise("XX")
    start = F.col("sentence").cast("long") * 100000 + F.col("pos")
    return u.select("id", "sentence", start.alias("start"), (start + 1).alias("finish"), "lemma", tag.alias("tag"))


def unit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.word_counts(_units(spark, sf_dir), CONTENT, NOUNS)


def unit_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text's three commonest words (the bound is the feature)."""
    return units.top_words(_units(spark, sf_dir), CONTENT, 3)


def text_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.styles(_sentences(spark, sf_dir), ENDINGS)


def lemma_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lemmas = spark.createDataFrame([("tion", "filler", "warn"), ("the", "filler", "warn"), ("ing", "claims", "block")], "lemma string, category string, severity string")
    return units.lemma_hits(_units(spark, sf_dir), lemmas)


def argument_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words on tion are nouns with a valence, short words particles, de and und verbs of more and less, que and the negations."""
    u = _sentences(spark, sf_dir).select("id", "sentence", F.posexplode(F.split("text", " ")).alias("pos", "lemma")).where("lemma <> ''")
    u = u.withColumn("tag", F.when(F.col("lemma").rlike("(tion|ment|er|es)$"), "NN").when(F.length("lemma") < 5, "JK").otherwise("XX"))
    of = lambda rows, kind: spark.createDataFrame(rows, kind)
    lexicon = u.where("tag = 'NN'").select(F.col("lemma").alias("word"), (F.length("lemma") % 3 - 1).alias("score")).distinct()
    return units.argument_polarity(u, of([("de", 1), ("und", -1), ("la", 1)], "verb string, direction int"), lexicon, of([("les", 1), ("der", -1)], "word string, valence int"), ("que", "the"), ("NN",), ("JK",))


# --- lanes and bundles ----------------------------------------------------------------------------------------


def lane_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five bundles a lane of four users' first events, with all events of those users in the lane."""
    e = _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("lane"), "user_id")
    reps = cut(e.groupBy("lane", "user_id").agg(F.min("id").alias("id")))
    members = e.join(reps.select("lane", "user_id", F.col("id").alias("leader")), ["lane", "user_id"]).select("id", "leader")
    n = ordering.numbered(reps.select("lane", "id"), "lane", "id")
    n = n.join(n.groupBy("lane").agg(F.min("rn").alias("first")), "lane").withColumn("pack", F.floor((F.col("rn") - F.col("first")) / 4))
    w = W.partitionBy("lane", "pack")
    packs = cut(n.select("id", "lane", F.min("id").over(w).alias("bundle"), F.when(F.count(F.lit(1)).over(w) == 4, "topic").otherwise("held").alias("kind")))
    rows, held = lanes.bundle_rows(packs, reps.select("id", F.concat("lane", F.lit("#"), F.col("id").cast("string")).alias("title")), members, 5)
    left = held.groupBy("lane").agg(F.count(F.lit(1)).alias("held"))
    return rows.join(left, "lane", "left").select("lane", "nth", "bundle", "title", F.array_join("ids", ",").alias("ids"), F.array_join("members", ",").alias("members"), F.coalesce("held", F.lit(0)).alias("held"))


def lane_signatures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(members, signatures, known, tokens) of documents, each in the lanes of its language and of its source."""
    w, whole = TABLES.words, F.concat_ws("\n", "title", "body")
    r = records(spark, sf_dir)
    m = r.select("id", F.explode(F.array("lane", "press")).alias("lane"), text.title_key(F.col("title")).alias("key"), text.is_caption_title(F.col("title"), ("photo",)).alias("caption"), F.length("body").alias("chars"), matching.types_in(whole, w.core).cast("double").alias("score"))
    tokens = r.select("id", matching.signature_tokens(whole, w).alias("tokens"))  # not written: whole words are asked of a few records only
    sig = cut(events.signature_sets(tokens, F.col("tokens"), TABLES.events))
    before = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), matching.signature_tokens(F.col("text"), w).alias("tokens"))
    known = events.tell_of(sig, events.signatures(before, F.col("tokens"), TABLES.events), TABLES.events)
    return cut(m), sig, known, tokens


def lane_members(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(members, pairs, known, tokens), for selections by pairs."""
    members, sig, known, tokens = lane_signatures(spark, sf_dir)
    return members, cut(events.similar_pairs(sig, TABLES.events)), cut(known), tokens


def lane_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten records of each of four lanes, in turn (the bound is the feature)."""
    members, sig, known, _ = lane_signatures(spark, sf_dir)
    return lanes.select_by_lane(members, None, LANES, 10, 2, cut(known), TABLES.events, sig)[0]


def lane_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How alike the selected of two lanes are, by the reports that come first and the likeness that makes an event."""
    members, sig, _, tokens = lane_signatures(spark, sf_dir)
    return lanes.lane_sweep(members, None, LANES[:2], 10, (1, 3), (0.15, 0.3), tokens, sig)


ALL: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    picture_credits, alt_texts, filtered_prompts, lane_settings, reply_labels, labels_kept, realigned, skip_reasons, reset_notices, cached_texts,
    unit_counts, unit_top_words, text_styles, lemma_hits, argument_polarity, lane_bundles, lane_selection, lane_sweep,
)
