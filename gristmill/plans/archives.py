"""Registered queries of archives, state files, marks, contexts and counts that other steps build on. Each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import article, cleaning, media, sentiment, structure, text, wording
from gristmill.operators import board, explain
from gristmill.plans.flagship import TABLES
from gristmill.plans.flagship import records as documents_as_records
from gristmill.sources import records
from gristmill.sources.shared import shared_folder
from gristmill.streaming import incremental

BANNED = [("claims", "block", ("the best", "ation", "eaux")), ("filler", "warn", ("und", "and the", "de la"))]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- archives and state ---------------------------------------------------------------------------------------


def csv_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as two CSV archives, of which the second repeats every third; read back, the first of each address stays."""
    folder = shared_folder(spark, "csv")
    p = _table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit('say "'), F.col("page_id").cast("string"), F.lit('",\nline')).alias("title"), "url", F.lit("1 | 2").alias("subtopics"), F.lit("k").alias("matched_keywords"), (F.col("page_id") % 9).cast("string").alias("search_rank"))
    lists = {"subtopics": F.split("subtopics", r" \| "), "matched_keywords": F.array("matched_keywords")}
    for k, part in enumerate((p, p.where("page_id % 3 = 0").withColumn("title", F.lit("again")))):
        records.write_csv(part.withColumns(lists).orderBy("page_id").drop("page_id"), f"{folder}/{k}")
    read = records.read_csv(spark, [f"{folder}/0"]).withColumn("file", F.concat(F.lit("0/"), "file")).unionByName(records.read_csv(spark, [f"{folder}/1"]).withColumn("file", F.concat(F.lit("1/"), "file")))
    return records.gather(read).select("url", "title", F.array_join("subtopics", "+").alias("subtopics"), "search_rank", "score_norm")


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts' pages as responses to three keywords; every fifth page has no address of its own, every tenth none at all."""
    p = _table(spark, sf_dir, "pages")
    own, other = F.when(F.col("page_id") % 5 != 0, F.col("url")), F.when(F.col("page_id") % 10 != 0, F.concat(F.lit("http://link/"), F.col("page_id").cast("string"))).otherwise("")
    item = F.struct(F.concat(F.lit("<b>p</b> "), F.col("page_id").cast("string")).alias("title"), own.alias("originallink"), other.alias("link"), F.lit("d &amp; e").alias("description"), F.lit("Mon, 01 Jan 2024 09:00:00 +0900").alias("pubDate"))
    r = p.groupBy(F.concat(F.lit("k"), (F.col("page_id") % 3).cast("string")).alias("keyword")).agg(F.array_sort(F.collect_list(F.struct("page_id", item.alias("i")))).alias("l"))
    r = r.select("keyword", F.transform("l", lambda x: x["i"]).alias("items"))
    return records.search_results(r, ["k2", "k0", "k1"]).select("search_keyword", "search_rank", "title", "url", "summary", "published")


def state_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' events as state files, one a line of text; broken entries and a broken file are left out."""
    folder = shared_folder(spark, "state")
    e = _table(spark, sf_dir, "events").withColumn("key", F.concat("event_type", F.lit("/"), F.col("event_id").cast("string")))
    s = e.groupBy("user_id").agg(
        F.max(F.date_format("ts", "yyyy-MM-dd")).alias("last_collected_at"), F.array_sort(F.collect_list(F.when(F.col("event_type") == "view", F.col("key")))).alias("processed_urls"),
        F.collect_list(F.when(F.col("event_type") == "click", F.struct(F.when(F.col("event_id") % 2 == 0, "2024-01-01").alias("at"), F.concat_ws(" ", "event_type", "key", "event_type").alias("tokens")))).alias("written_events"),
        F.collect_list(F.when(F.col("event_type") == "error", F.struct(F.lit("l").alias("lane"), F.lit("d").alias("held_since"), F.struct("event_type", F.when(F.col("event_id") % 3 > 0, F.col("key")).alias("url")).alias("article")))).alias("held"),
    )
    for k in range(2):  # the second file is broken
        value = F.to_json(F.struct("last_collected_at", "processed_urls", "written_events", "held")) if k == 0 else F.lit("{broken")
        s.where("user_id = 1").select(value.alias("value")).coalesce(1).write.text(f"{folder}/{k}")
    parts = [records.read_state(spark, f"{folder}/{k}") for k in range(2)]
    out = None
    for k, state in enumerate(parts):
        rows = state["processed"].select(F.lit(k).alias("file"), F.lit("processed").alias("part"), F.col("url").alias("item"))
        rows = rows.union(state["events"].select(F.lit(k), F.lit("event"), F.array_join("tokens", "+"))).union(state["held"].select(F.lit(k), F.lit("held"), "article.url")).union(state["watermark"].select(F.lit(k), F.lit("watermark"), "last_collected_at"))
        out = rows if out is None else out.union(rows)
    return out.where("item is not null")


def latest_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last time that can be read, of each kind of event; every fourth time can't be."""
    iso = F.when(F.col("event_id") % 4 > 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("soon")
    e = _table(spark, sf_dir, "events").select("event_type", text.parse_time(iso).alias("at"))
    return e.groupBy("event_type").agg(F.date_format(F.max("at"), "yyyy-MM-dd HH:mm:ss").alias("latest"))


def history_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of batches: keys that no batch before had are handled, and then belong to the history."""
    folder = shared_folder(spark, "history")
    e = _table(spark, sf_dir, "events").select(F.concat("event_type", F.lit("/"), F.floor("value").cast("string")).alias("key"), "event_id")
    for k in range(3):
        e.where(F.col("event_id") % 3 == k).write.mode("append").parquet(f"{folder}/in")
    handled = lambda batch, epoch: batch.select("key").write.mode("overwrite").parquet(f"{folder}/out/batch={epoch}")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 4).parquet(f"{folder}/in")
    run = incremental.history_batch(f"{folder}/history", "key", handled)
    stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("key string").parquet(f"{folder}/out").groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def windowed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by six hours and kind of a stream, run to its end; the windows that the watermark has closed."""
    folder, kinds = shared_folder(spark, "windows"), _table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(kinds).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("at", F.col("ts").cast("timestamp"))
    counts = incremental.windowed_counts(stream, "at", "1 hour", "6 hours", "event_type").select(F.date_format("window.start", "yyyy-MM-dd HH").alias("start"), "event_type", "n")
    counts.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("start string, event_type string, n long").parquet(f"{folder}/out")


# --- texts ----------------------------------------------------------------------------------------------------


def decoded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as bytes, with syllables in front: the decoding that shows the most of them is UTF-8."""
    d = _table(spark, sf_dir, "documents").withColumn("t", F.concat(F.lit("가나다라마바사아자차카타 "), F.coalesce("text", F.lit(""))))
    return d.select("doc_id", F.md5(text.decode_bytes(F.encode("t", "UTF-8"))).alias("digest"))


def article_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a meta element in front; records of every third page lack the press, of every second the date."""
    k = F.col("page_id")
    front = F.concat(F.lit('<meta content="Press '), (k % 7).cast("string"), F.lit('" property="og:site_name"><META name=\'article:published_time\' content=\'2024-01-0'), (k % 9 + 1).cast("string"), F.lit("'>"))
    p = _table(spark, sf_dir, "pages").withColumn("html", F.concat(front, F.coalesce("html", F.lit(""))))
    p = p.withColumn("blocks", article.blocks(F.col("html"))).withColumn("body", article.article_text(F.col("blocks")))
    own = article.with_page(F.when(k % 3 > 0, "own"), F.when(k % 2 > 0, "then").otherwise(""), F.col("html"))
    return p.select("page_id", F.size("blocks").cast("long").alias("blocks"), F.length("body").cast("long").alias("chars"), F.md5("body").alias("digest"), own["press"].alias("press"), own["published"].alias("published"))


def unescaped_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "conversations").withColumn("t", F.replace("text", F.lit("e"), F.lit("&eacute;&#65;&amp;lt;")))
    return c.select("conv_id", "turn", F.md5(text.unescape(F.col("t"))).alias("digest"))


def kept_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with some letters turned into syllables, as many as the first letter says."""
    d = _table(spark, sf_dir, "documents").withColumn("body_clean", F.when(F.col("doc_id") % 3 > 0, F.translate("text", "eaionrtsdlu", "가나다라마바사아자차카")).otherwise(F.translate("text", "e", "가")))
    return cleaning.kept_records(d).select("doc_id")


def match_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surroundings of each place of an unwanted word."""
    d = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    places = structure.banned_places(d, "text", BANNED).join(d, "id")
    return places.select("id", "start", wording.context(F.col("text"), F.col("start"), F.col("finish")).alias("context"))


def section_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in which every fifth line is marked as a heading."""
    marked = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.when(i % 5 == 1, F.concat(F.lit("1. 첫 번째는 "), x, F.lit(" /* 소제목 */"))).when(i % 5 == 3, F.lit(" ")).otherwise(x))
    d = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array_join(marked, "\n").alias("text"))
    return wording.headings(d).select("id", "place", F.md5("heading").alias("digest"))


def source_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a record has to tell (body, title, subtopics), and the chapters of the bundle of its source: subtopics, or records if there are none."""
    words = F.filter(F.slice(F.split("title", " "), 1, 3), lambda x: x != "")
    r = documents_as_records(spark, sf_dir).withColumn("subtopics", F.when(F.col("id") % 4 == 0, words).otherwise(F.array().cast("array<string>")))
    r = r.withColumn("chars", structure.source_chars(F.col("title"), F.col("body"), F.col("subtopics")))
    bundles = r.groupBy("press", "lane").agg(F.sum(F.size("subtopics")).alias("s"), F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    return bundles.select("press", "lane", structure.chapter_count(F.col("s"), F.col("n")).alias("chapters"), "chars")


def gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.gate_reasons(documents_as_records(spark, sf_dir), TABLES)


def counting_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.counting_differences(documents_as_records(spark, sf_dir), TABLES)


# --- marks, quotas, lexicons ----------------------------------------------------------------------------------


def quota_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as error responses that name a limit by kind, with a wait for every second one."""
    ids = F.when(F.col("event_type") == "view", "RequestsPerDayPerModel").when(F.col("event_type") == "click", "RequestsPerMinute").otherwise("Tokens")
    value, wait = (F.col("event_id") % 3).cast("string"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"@type":"x.RetryInfo","retryDelay":"'), (F.col("event_id") % 50).cast("string"), F.lit('.5s"},'))).otherwise("")
    body = F.concat(F.lit('{"error":{"details":['), wait, F.lit('{"@type":"x.QuotaFailure","violations":[{"quotaId":"'), ids, F.lit('","quotaValue":"'), value, F.lit('"}]}]}}'))
    q = _table(spark, sf_dir, "events").select("event_id", wording.quota_error(body).alias("q"))
    return q.select("event_id", F.array_join("q.ids", ",").alias("ids"), "q.daily", "q.minute", "q.none_left", "q.wait")


def mark_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as marked pictures: marks by id, a veto, what is worn, two own signals and one of a rival."""
    k = F.col("doc_id")
    on = lambda n, r: F.when(k % n == r, "x")
    mark = F.get(F.array(F.lit(" O "), F.lit("no"), F.lit(""), F.lit("?"), F.lit("?"), F.lit("?")), (k % 6).cast("int"))
    v = wording.verdict(mark, F.when(k % 4 == 0, "blurred"), [(on(11, 3), "people")], F.when(k % 13 == 5, "torn"), [(on(2, 1), 3), (on(3, 1), 4)], [[(on(5, 1), 5)]])
    return _table(spark, sf_dir, "documents").select("doc_id", text.mark_of(mark).alias("mark"), v["verdict"].alias("verdict"), v["reason"].alias("reason"))


def model_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain of models that is tried for an event, and the pool's entry whose turn it is."""
    e = _table(spark, sf_dir, "events")
    tried = media.chain(F.concat(F.lit("m"), (F.col("event_id") % 3).cast("string")), F.array(F.lit("m1"), F.lit(""), F.lit("m2"), F.lit("m1")), F.array(F.when(F.col("event_type") == "view", "m1").otherwise("none")))
    return e.select("event_id", F.array_join(tried, ",").alias("tried"), media.rotating(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.col("user_id") - 70).alias("turn"))


def sentiment_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First words of documents as layers of a lexicon by source, without words that labels call good."""
    word = F.substring_index("text", " ", 1)
    d = _table(spark, sf_dir, "documents").select(word.alias("word"), (F.col("doc_id") % 7 - 3).cast("int").alias("score"), (F.length("source") * 10 + F.col("doc_id") % 3).cast("int").alias("priority"), "doc_id")
    good = d.join(_table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id").select("word")
    return sentiment.merged_lexicon(d, good)


def provenance_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as pictures: every seventh is generated, every fifth has no original; of every third name the provenance is recorded."""
    p, k = _table(spark, sf_dir, "pages"), F.col("page_id")
    pictures = p.select("page_id", F.when(k % 7 == 0, "generated").otherwise("stock").alias("source"), F.when(k % 5 != 0, F.concat(F.lit("data\\\\"), "url")).alias("original"))
    named = p.where(k % 3 == 0).groupBy(F.element_at(F.split("url", "/"), -1).alias("name")).agg(F.min("page_id").alias("at"))
    at = F.col("at")
    recorded = named.select("name", F.when(at % 4 == 0, "lens").when(at % 4 == 1, "commons").when(at % 4 == 2, "drawn").otherwise("odd").alias("source"), F.when(at % 8 == 1, "Museum").otherwise(F.lit(None)).alias("provider"))
    made = board.with_credits(pictures, recorded, [("utm_source", "Feed"), (r"^\d", "Number")], {"lens": "Lens"}, {"commons": {"museum": "The Museum", "": "Commons"}}, ("generated", "drawn"))
    return made.select("page_id", "credit")


def select_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as the options of a board; wanted are languages; src1 is to be de, src2 to be fresh, src3 to be fresh too."""
    d = _table(spark, sf_dir, "documents")
    have = d.groupBy(F.col("source").alias("name")).agg(F.min("doc_id").alias("pos"))
    wanted = d.groupBy(F.col("lang").alias("name")).agg(F.min("doc_id").alias("pos"))
    renames = spark.createDataFrame([(1, "src1", "de"), (2, "src2", "fresh"), (3, "src3", "fresh"), (4, "src4", "src5")], "pos long, old string, new string")
    return board.merged_options(have, wanted, renames)


ALL: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    csv_archive, search_hits, state_file, latest_published, history_keys, windowed_events, decoded_texts, article_bodies, unescaped_texts, kept_records, match_contexts, section_headings,
    source_sizes, gate_reasons, counting_differences, quota_errors, mark_verdicts, model_turns, sentiment_lexicon, provenance_credits, select_options,
)
