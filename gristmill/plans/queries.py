"""The registered queries of the engine's own operators. Each takes (spark, sf_dir), reads whole tables and returns a DataFrame.

documents stand in for records (title: first line, body: the rest, lane: language, press: source, order: doc_id), pages for
fetched pages, events for dated records and state, conversations for drafts, embeddings for anchors, benchmark for events
already known, labels for human judgements.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.functions import cleaning, drafts, matching, sentiment, structure, text, wording
from gristmill.operators import board, evaluation, events, greedy, ordering, scoring, sets, vectors
from gristmill.plans import archives, drafting, editorial, scans
from gristmill.plans.flagship import TABLES, facts, records, selected
from gristmill.sources.shared import shared_folder
from gristmill.streaming import incremental

TOPICS = [("motion", ("tion", "ción")), ("state", ("ment", "keit")), ("actor", ("erin", "ingst")), ("article", ("the", "der", "les"))]
RULES = [("notice", ("(?i)copyright", "(?i)licen[cs]e")), ("address", (r"\S+@\S+",)), ("short", (r"^\S{1,12}$",))]
BANNED = [("claims", "block", ("the best", "ation", "eaux")), ("filler", "warn", ("und", "and the", "de la"))]
REWRITES = [("tion ", "TION "), (" the ", " THE "), ("ment", "MENT")]
NOW = "timestamp_ntz'2024-01-31 00:00:00'"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _whole(c: str = "body") -> Column:
    return F.concat_ws("\n", "title", c)


# --- scans and scalars ----------------------------------------------------------------------------------------


def url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return _table(spark, sf_dir, "pages").select("page_id", text.canonical_url(u).alias("canonical"), text.history_key(u).alias("history_key"), text.host_of(u).alias("host"))


def page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = text.strip_tags(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1))
    p = _table(spark, sf_dir, "pages").select("page_id", title.alias("title"), text.body_of(F.col("html")).alias("body"))
    return p.select("page_id", "title", text.slug(F.col("title")).alias("slug"), F.length("body").cast("long").alias("chars"), F.md5("body").alias("digest"))


def title_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    r = records(spark, sf_dir)
    return r.select("id", text.title_key(t).alias("key"), F.array_join(structure.title_issues(t), ",").alias("issues"), structure.fixed_title(t).alias("fixed"), text.is_caption_title(t, ("photo", "video")).alias("caption"))


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").withColumn("t", F.col("ts").cast("timestamp"))
    mail = F.date_format("t", "EEE, d MMM yyyy HH:mm:ss '+0000'")
    iso = F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss")
    age = text.age_days(F.col("t"), F.lit("2024-01-31 00:00:00").cast("timestamp"))
    return e.select("event_id", text.mail_time(mail).alias("local"), F.date_format(text.parse_time(iso), "yyyy-MM-dd HH:mm:ss").alias("read_back"), age.alias("age"), F.date_format(incremental.quota_day(F.col("ts")), "yyyy-MM-dd").alias("quota_day"))


def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents").select("doc_id", F.explode(F.flatten(F.transform(text.paragraphs(F.col("text")), lambda p: text.chunks(p)))).alias("chunk"))
    return d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), F.max(F.length("chunk")).cast("long").alias("longest"), F.sum(F.length("chunk")).alias("chars"))


def topic_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir).select(text.rule_of(_whole(), TOPICS, "other").alias("topic"), "lane")
    return evaluation.crosstab(r, "topic", "lane")


# --- cleaning -------------------------------------------------------------------------------------------------


def clean_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = cleaning.cleaned(records(spark, sf_dir), "body", without=("foreign_lines",))
    return r.select("id", F.length("body_clean").cast("long").alias("chars"), F.md5("body_clean").alias("digest"))


def clean_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = cleaning.cleaned(records(spark, sf_dir), "body", without=("foreign_lines",), diagnose=True)
    return r.select("id", F.explode("lost").alias("step", "lost")).groupBy("step").agg(F.count(F.lit(1)).alias("records"), F.sum("lost").alias("chars"))


def home_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir).withColumn("foreign", cleaning.foreign_lines(F.col("body")))
    return r.select("id", cleaning.home_share(F.col("body")).alias("share"), F.length("foreign").cast("long").alias("left_chars"))


def plain_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(cleaning.strip_markdown(F.col("text"))).alias("digest"))


def excluded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = cleaning.excluded_lines(_table(spark, sf_dir, "documents"), "text", RULES)
    return d.select("doc_id", F.explode("excluded").alias("x")).groupBy("doc_id", F.col("x.rule").alias("rule")).agg(F.count(F.lit(1)).alias("n"), F.sum("x.line").alias("line_sum"))


# --- structure and wording ------------------------------------------------------------------------------------


def draft_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents").withColumn("chars", structure.prose_chars(F.col("text")))
    return d.select("doc_id", "chars", structure.length_tier(F.col("chars")).alias("tier"), structure.target_length(F.col("text")).cast("long").alias("target"), F.when(F.col("chars") >= 120, "bundle").otherwise("hold").alias("mode"))


def within_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "conversations").withColumn("t", F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return c.select("conv_id", "turn", F.length(structure.within_length(F.col("t"), 400)).cast("long").alias("kept"))


def draft_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "conversations").withColumn("s", structure.structure(F.col("text"), F.lit("tion")))
    return c.select("conv_id", "turn", "s.paragraphs", "s.chars", "s.in_title", "s.in_head", "s.in_intro", "s.mentions", F.array_join("s.warnings", ",").alias("warnings"))


def rewrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, n = structure.rewritten(F.col("text"), REWRITES)
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(out).alias("digest"), n.alias("changed"))


def banned_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = structure.banned_counts(_table(spark, sf_dir, "documents"), "text", BANNED)
    return d.select("doc_id", *[F.col("hits")[name].alias(name) for name, *_ in BANNED], "blocked")


def banned_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return structure.banned_places(d, "text", BANNED)


def folded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often words stand in the texts if blanks, punctuation and case don't count."""
    d = _table(spark, sf_dir, "documents").select("doc_id", F.explode(wording.folded_places(F.col("text"), ("eaux", "The Re"))).alias("p"))
    return d.groupBy("doc_id", F.col("p.word").alias("word")).agg(F.count(F.lit(1)).alias("n"))


def sentiment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the turns as sentences, with a small lexicon of Latin words."""
    lines = _table(spark, sf_dir, "conversations").select("conv_id", F.explode(F.split("text", "\n")).alias("line"))
    lexicon = sentiment.Lexicon({"de": 1, "und": 1, "the": -1, "que": -1}, negations=())
    scored = lines.select("conv_id", sentiment.sentence_scores(sentiment.simple_units(F.col("line")), lexicon)["score"].alias("score"))
    return sentiment.document_sentiment(scored, "conv_id", "score", 0.5)


def image_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as paragraphs of a draft, each followed by a slot line; the images of odd slots are there."""
    c = _table(spark, sf_dir, "conversations").withColumn("line", F.concat(F.length("text").cast("string"), F.lit("\n"), (F.col("turn") % 90 + 1).cast("string")))
    drafts = c.groupBy(F.col("conv_id").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "line"))), lambda x: x["line"]), "\n").alias("text"))
    images = c.where("turn % 2 = 0").select(F.col("conv_id").alias("id"), (F.col("turn") + 1).cast("int").alias("slot"), F.concat(F.lit("image of "), "role").alias("image"))
    return structure.filled_slots(drafts, images).select("id", structure.image_slots(F.col("text")).alias("open"), F.md5("text").alias("digest"))


# --- matching and the gate ------------------------------------------------------------------------------------


def gate_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(records(spark, sf_dir), TABLES).select("id", *[F.col(f"facts.{c}").cast("long").alias(c) for c in ("title_incidents", "body_incidents", "chars", "core", "spans", "mentions", "hits")], "facts.titled")


def gate_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(records(spark, sf_dir), TABLES).select("id", "gate")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(records(spark, sf_dir), TABLES).join(_table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id"), "id")


def gate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.precision_recall(_judged(spark, sf_dir), F.col("quality") == 1, F.col("gate") == "ok")


def gate_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).where("quality = 1 and gate <> 'ok'").groupBy("gate").agg(F.count(F.lit(1)).alias("n"))


def gate_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = evaluation.grid(spark, core_types=[1, 2, 3], body_chars=[100, 250, 500], domain_hits=[3, 5])
    return evaluation.gate_sweep(_judged(spark, sf_dir), F.col("quality") == 1, grid)


# --- sets, histories and state --------------------------------------------------------------------------------


def dedupe_two_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _table(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit(":"), F.col("n_chars") % 97).alias("k1"), F.nullif(text.title_key(F.substring_index("text", "\n", 1)), F.lit("")).alias("k2"))
    return greedy.two_key_dedupe(r, "doc_id", "k1", "k2").select("doc_id")


def pool_of_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.pool(_table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


def unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id", "user_id", F.floor("value").alias("key"), "event_type")
    return sets.without_history(e.where("event_type <> 'purchase'"), e.where("event_type = 'purchase'"), "key").select("event_id", "key")


def held_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views are selected, purchases done, errors held before, signups new."""
    e = _table(spark, sf_dir, "events").select("event_id", "event_type", F.floor("value").alias("key"), F.date_format("ts", "yyyy-MM-dd").alias("held_since"))
    of = lambda kind: e.where(F.col("event_type") == kind)
    held = sets.held_entries(of("view").drop("held_since"), of("purchase"), of("error"), "key", "event_id", F.lit("2024-01-31"))
    return sets.merge_held(of("signup").select("event_id", "key", "held_since"), held.select("event_id", "key", "held_since"), "key", "event_id")


def per_user_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    prior = e.where("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return sets.per_key_cap(e.where("event_type <> 'error'").select("event_id", "user_id"), "user_id", "event_id", 15, prior)


def last_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded history: of what was known and what is new, the last 5000 keys (the bound is the feature)."""
    e = _table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.concat("event_type", F.lit("/"), "value").alias("key"), "event_type")
    known, fresh = e.where("event_type <> 'click'").drop("event_type"), e.where("event_type = 'click'").drop("event_type")
    return sets.last_n(sets.append_processed(known, fresh, "key", "seq"), "seq", 5000).select("seq", "key")


def lane_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id", F.floor(F.col("value") * 10).alias("key"), F.col("event_type").alias("lane"), "ts")
    verdicts = e.groupBy("key").agg(F.max("lane").alias("lane")).select("key", F.when(F.col("lane") == "view", "view").otherwise("click").alias("verdict"))
    lanes = spark.createDataFrame([("view", 14), ("click", 3), ("error", 30), ("purchase", 30), ("signup", 30)], "lane string, lookback_days int")
    return sets.route(e, verdicts, "key", "event_id", "view", lanes, "ts", F.expr(NOW)).select("event_id", "lane", "moved_from")


def written_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    new = _table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("").alias("source"))
    return sets.upsert(old, new, "doc_id")


def since_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    cut = incremental.cutoff(F.expr("timestamp_ntz'2024-01-26 12:00:00'"), F.expr(NOW), 7)
    return incremental.since(e, "ts", cut).select("event_id", F.col("ts").isNull().alias("unknown"))


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = spark.createDataFrame([("view", 3), ("click", 7), ("error", 14)], "status string, days int")
    e = _table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("status"), "ts")
    return sets.retained(e, policy, "ts", F.expr(NOW)).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))


def held_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("lane"), F.floor("value").alias("key"), "ts")
    lanes = spark.createDataFrame([("view",), ("click",), ("error",)], "lane string")
    return incremental.held_status(e, e.where("lane = 'purchase'"), lanes, "key", "ts", F.expr(NOW), 7).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file stream without repeats of a key inside the watermark, run to its end and read back."""
    folder = shared_folder(spark, "first-seen")
    kinds = _table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(kinds).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    keyed = stream.select(F.concat("user_id", F.lit("/"), "event_type").alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    seen = incremental.first_seen(keyed, "key", "ts", "60 days").select("key")
    seen.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("key string").parquet(f"{folder}/out")


# --- scores and retrieval -------------------------------------------------------------------------------------


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.trend_keywords(records(spark, sf_dir), matching.tokens(_whole(), TABLES.words), TABLES.words, TABLES.trend)


def trend_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(spark, sf_dir)


def record_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = TABLES.words
    s = scoring.record_scores(records(spark, sf_dir), matching.tokens(F.col("title"), w), matching.tokens(F.col("body"), w), greedy.cut(_weights(spark, sf_dir)), TABLES.trend)
    return s.select("id", F.round("score", 4).alias("score"), F.array_join("matched", ",").alias("matched"))


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{2,})"), F.lit(1))
    d, q = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return scoring.bm25(d.select(F.col("doc_id").alias("id"), words.alias("tokens")), q.select(F.col("item_id").alias("query_id"), words.alias("tokens")), 5).withColumn("rank", F.col("rank").cast("long"))


def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "conversations").withColumn("seq", F.col("conv_id") * 1000 + F.col("turn")).withColumn("keyword", F.when(F.col("turn") < 6, F.col("role")))
    return ordering.round_robin(c.select("seq", "keyword", F.length("text").alias("rank")), "keyword", "rank", "seq", ["user", "assistant"]).select("seq", "place")


def packs_of_four(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.packs(_table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", F.col("pack").cast("long").alias("pack"), "full")


def lowest_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.lowest_quarter(_table(spark, sf_dir, "events").select("event_id", "value"), "value", "event_id").select("event_id", "low")


# --- events ---------------------------------------------------------------------------------------------------


def _signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.signatures(records(spark, sf_dir), matching.signature_tokens(_whole(), TABLES.words), TABLES.events)


def _signature_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.signature_sets(records(spark, sf_dir), matching.signature_tokens(_whole(), TABLES.words), TABLES.events)


def signature_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signatures(spark, sf_dir).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("df").alias("df_sum"))


def event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.similar_pairs(_signature_sets(spark, sf_dir), TABLES.events).where(events.same_event(TABLES.events))


def near_miss_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.near_misses(events.similar_pairs(_signature_sets(spark, sf_dir), TABLES.events), TABLES.events)


def history_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = TABLES.words
    known = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.explode(matching.signature_tokens(F.col("text"), w)).alias("token"))
    return events.history_matches(known, _signature_sets(spark, sf_dir), 3, TABLES.events).withColumn("rank", F.col("rank").cast("long"))


def event_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.grouped(records(spark, sf_dir), _signature_sets(spark, sf_dir), TABLES.events)


def cluster_bonus(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir)
    members = r.select("id", text.is_caption_title(F.col("title"), ("photo",)).alias("caption"), F.length("body").alias("chars"), matching.types_in(_whole(), TABLES.words.core).cast("double").alias("score"))
    return events.representatives(members.join(event_clusters(spark, sf_dir), "id"), TABLES.events)


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = TABLES.words
    told = events.topic_words(records(spark, sf_dir), matching.signature_tokens(_whole(), w), matching.signature_tokens(F.col("title"), w))
    return events.topics(told)


def topic_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _topics(spark, sf_dir)


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.bundles(records(spark, sf_dir), _topics(spark, sf_dir))


# --- vectors --------------------------------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("v"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("id", "label", F.round("score", 6).alias("score"), F.round("margin", 6).alias("margin"))


def centroid_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(vectors.centroid_predict(_vectors(spark, sf_dir)))


def centroid_labels_loo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(vectors.centroid_predict(_vectors(spark, sf_dir), leave_out=True))


def _voted(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    return greedy.cut(vectors.knn_vote(v, v, 5))


def knn_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_voted(spark, sf_dir))


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = _vectors(spark, sf_dir).select("id", F.col("label").alias("truth"))
    return _voted(spark, sf_dir).withColumnRenamed("label", "predicted").withColumn("margin", F.round("margin", 6)).join(truth, "id")


def knn_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion(_told(spark, sf_dir), "truth", "predicted")


def knn_adoption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.adoption(_told(spark, sf_dir), "truth", "predicted", "margin", "id")


def near_equal_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_equal(_vectors(spark, sf_dir), 0.4).select("a", "b", F.round("sim", 6).alias("sim"))


def _probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(q, i, sim): the class means as probes against all vectors."""
    v = _vectors(spark, sf_dir)
    means = vectors.class_sums(v).select(F.col("label").alias("q"), F.transform("total", lambda x: x / F.col("n")).alias("m"))
    return v.crossJoin(means).select("q", F.col("id").alias("i"), F.round(vectors.dot(F.col("m"), F.col("v")), 6).alias("sim"))


def probe_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.assign(_probes(spark, sf_dir), 0.05)


def fallback_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probes against vectors without the recently used, and for what is left open with them."""
    v = _vectors(spark, sf_dir).select(F.col("id").alias("i"), "label")
    return vectors.assign_again(_probes(spark, sf_dir), v.where("label >= 4").select("i"), v.where("label = 0").select("i"), 0.05)


def probe_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = _probes(spark, sf_dir).groupBy("i").agg(F.max_by("q", F.struct("sim", -F.col("q"))).alias("q"))
    probes = _vectors(spark, sf_dir).select(F.col("label").alias("probe")).distinct().union(spark.range(90, 92).toDF("probe"))
    return evaluation.coverage(best, probes, "q")


# --- evaluation -----------------------------------------------------------------------------------------------


def value_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _judged(spark, sf_dir).select(F.col("facts.core").alias("core"), (F.col("gate") == "ok").alias("ok"))
    return evaluation.spread(j, "core", "ok")


def label_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _judged(spark, sf_dir).withColumn("ok", (F.col("gate") == "ok").cast("int"))
    return j.groupBy("lane").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("ok") == F.col("quality")).cast("double")).alias("agree"))


def press_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected and all records of each press, with the rate."""
    r = facts(records(spark, sf_dir), TABLES)
    return r.groupBy("press").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("gate") != "ok").alias("rejected")).withColumn("rate", F.col("rejected") / F.col("n"))


def newest_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 newest rows of each source (the bound is the feature)."""
    e = _table(spark, sf_dir, "events")
    return e.withColumn("rn", F.row_number().over(W.partitionBy("event_type").orderBy(F.desc("ts"), "event_id"))).where("rn <= 20").select("event_type", F.col("rn").cast("long").alias("rn"), "event_id")


def flagship_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected(records(spark, sf_dir), TABLES, top=40)


# --- boards, drafts and state ----------------------------------------------------------------------------------


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with markup: a heading, bullets, bold words and the closing text in every third."""
    bold = F.replace(F.replace("text", F.lit("*"), F.lit("")), F.lit(" the "), F.lit(" **the** "))
    t = F.concat(F.lit("# "), F.replace(bold, F.lit("\n"), F.lit("\n- ")), F.when(F.col("doc_id") % 3 == 0, "\n\nSee you soon.").otherwise(""))
    return _table(spark, sf_dir, "documents").select("doc_id", t.alias("text"))


def postprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = drafts.postprocessed(F.col("text"), [("ment", "MENT")], "See you soon.")
    return _marked(spark, sf_dir).select("doc_id", p.alias("p")).select("doc_id", "p.residue", "p.chapters", "p.style", F.md5("p.text").alias("digest"))


def measured_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(spark, sf_dir).select("doc_id", structure.prose_chars(drafts.measured(F.col("text"), "See you soon.")).alias("chars"), F.length(drafts.excerpt(F.col("text"))).cast("long").alias("excerpt"))


def _drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = structure.banned_counts(_table(spark, sf_dir, "conversations"), "text", BANNED)
    c = c.select("conv_id", "turn", "blocked", (F.col("hits")["claims"] + F.col("hits")["filler"]).alias("banned"), structure.structure(F.col("text"), F.lit("tion"))["warnings"].alias("warnings"), drafts.line_facts(F.col("text")).alias("f"))
    return board.draft_verdicts(c.select("conv_id", "turn", "blocked", "banned", "warnings", "f.*"))


def draft_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drafts(spark, sf_dir).withColumn("warnings", F.array_join("warnings", ","))


def draft_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return board.draft_summary(_drafts(spark, sf_dir))


def pending_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as contents with the ids of their events, in falling order; the events' values are looked up in documents."""
    e = _table(spark, sf_dir, "events")
    listed = F.array_join(F.transform(F.sort_array(F.collect_list("event_id"), False), lambda x: x.cast("string")), ", ")
    contents = e.groupBy(F.col("user_id").alias("id")).agg(F.max_by("event_type", "event_id").alias("status"), listed.alias("ids"))
    articles = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "lang")
    p = board.pending(contents, articles, "click")
    return p.select("id", F.array_join(F.transform("articles", lambda a: F.concat(a["key"], F.lit("/"), a["lang"])), ",").alias("articles"))


def changed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("status"))
    changes = _table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.col("event_type").alias("status"))
    return board.with_status(pages, changes)


def name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = drafts.base_name(F.col("url"))
    return _table(spark, sf_dir, "pages").select("page_id", base.alias("base"), drafts.set_name(base).alias("series"))


def recently_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("ts").alias("at"), "event_type")
    used = board.last_used(e.where("event_type = 'view'").drop("event_type"), e.where("event_type = 'click'").drop("event_type"))
    return board.recently_used(used, F.expr(NOW), 10)


def unlisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label: files without provenance."""
    return sets.without_history(_table(spark, sf_dir, "documents").select("doc_id"), _table(spark, sf_dir, "labels"), "doc_id")


def size_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("n_chars") < 1000, "small").when(F.col("n_chars") > 4000, "oblong").otherwise("fits")
    return evaluation.crosstab(_table(spark, sf_dir, "documents").select(size.alias("size"), "source"), "size", "source")


def left_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in order of time without every seventh."""
    n = ordering.numbered(_table(spark, sf_dir, "events").select("ts", "event_id"), "ts", "event_id")
    return board.without_places(n, n.where("rn % 7 = 0").select("rn")).select("rn", "event_id")


def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("at"))
    return incremental.live_events(e, "at", F.expr(NOW), 9).select("event_id")


def state_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after a run over clicks: keys, events and the watermark, as (part, item, n)."""
    e = _table(spark, sf_dir, "events").select("event_id", "ts", "event_type", F.concat("event_type", F.lit("/"), F.floor("value")).alias("key"), F.col("user_id").cast("string").alias("user"))
    of = lambda kind: e.where(F.col("event_type") == kind)
    seq = lambda df: df.select(F.col("event_id").alias("seq"), "key")
    tokens = lambda df: df.select(F.col("ts").alias("at"), F.array("key", "user").alias("tokens"))
    before = {"processed": seq(of("view")), "events": tokens(of("view")), "watermark": of("view").agg(F.max("ts").alias("at"))}
    after = incremental.next_state(before, seq(of("click")), tokens(of("click")).select("tokens"), F.expr("timestamp_ntz'2024-01-05 00:00:00'"), F.expr(NOW), 5000, 12)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    keys = after["processed"].select(F.lit("key").alias("part"), F.col("key").alias("item"))
    events_ = after["events"].select(F.lit("event"), F.concat_ws(" ", text(F.col("at")), F.array_join(F.array_sort("tokens"), " ")))
    return keys.union(events_).union(after["watermark"].select(F.lit("watermark"), text(F.col("at")))).groupBy("part", "item").agg(F.count(F.lit(1)).alias("n"))


def search_excluding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three nearest vectors of every tenth one, without those of three labels."""
    v = _vectors(spark, sf_dir)
    found = vectors.neighbours(v.where("id % 10 = 0"), v.where("label not in (1, 2, 3)"), 3)
    return found.select("id", "other", "label", F.round("sim", 6).alias("sim"))


ALL: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    url_keys, page_bodies, title_keys, dates, text_chunks, topic_crosstab, clean_bodies, clean_losses, home_records, plain_markdown, excluded_lines,
    draft_lengths, within_length, draft_structure, rewrites, banned_counts, banned_places, folded_counts, sentiment_report, image_slots, gate_facts, gate_trace, gate_scores, gate_misses,
    gate_sweep, dedupe_two_key, pool_of_users, unprocessed, held_over, per_user_cap, last_keys, lane_route, written_over, since_cutoff, retention,
    held_status, stream_first_seen, trend_keywords, record_scores, bm25_topk, round_robin, packs_of_four, lowest_quarter, signature_sizes, event_pairs,
    near_miss_pairs, history_matches, event_clusters, cluster_bonus, topic_components, bundles, centroid_labels, centroid_labels_loo, knn_labels,
    knn_confusion, knn_adoption, near_equal_vectors, probe_assignment, fallback_assignment, probe_coverage, value_spread, label_agreement, press_shares, newest_by_type,
    flagship_select, postprocessed, measured_lengths, draft_report, draft_summary, pending_contents, changed_status, name_parts, recently_used, unlisted,
    size_buckets, left_places, recent_events, state_step, search_excluding,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in ALL + editorial.ALL + scans.ALL + drafting.ALL + archives.ALL}
