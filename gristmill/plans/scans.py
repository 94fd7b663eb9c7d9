"""Registered queries of accepting scans, trees of blocks and state by key, and their SQL. Each takes (spark, sf_dir) and reads whole tables.

documents stand in for pictures that a scan meets (category, query, set, name) and, line by line, for pages of blocks; events for
records that are carried over, events that were written, and models that are exhausted (by user_id).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import quotas, trees
from gristmill.operators.quotas import Quota
from gristmill.sources.shared import shared_folder
from gristmill.streaming import keyed

CHAIN = ("m0", "m1", "m2")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- accepting scans ------------------------------------------------------------------------------------------


def accepting_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages as categories that want 60 each, sources as queries, first words as sets of which two are taken, those of
    benchmark items before; equal first lines are one picture. The bounds are the feature."""
    word = lambda c: F.lower(F.substring_index(c, " ", 1))
    d = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.substring_index("text", "\n", 1).alias("name"), word("text").alias("set"), "n_chars")
    taken = _table(spark, sf_dir, "benchmark").groupBy(word("text").alias("set")).agg(F.count(F.lit(1)).alias("n"))
    asked = [Quota("target", "lang", 60, stops=True), Quota("duplicate", "name", 1, first=True), Quota("set", "set", 2, taken)]
    return quotas.scanned(d, ["lang", "source", "doc_id"], asked, F.when(F.col("n_chars") < 200, "small")).select("doc_id", "verdict")


def quota_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as categories that want 12 each, languages as queries with an equal share of that; a name counts once it was read."""
    d = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", F.concat_ws("/", "source", "lang").alias("query"), (F.col("n_chars") % 211).alias("name"))
    asked = [Quota("target", "source", 12, stops=True), Quota("quota", "query", 3, stops=True), Quota("duplicate", "name", 1, first=True, read=True)]
    return quotas.scanned(d, ["source", "lang", "doc_id"], asked, F.when(F.col("n_chars") % 5 == 0, "small")).select("doc_id", "verdict")


def query_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotas.stock(_table(spark, sf_dir, "documents"), "lang", "source")


# --- trees of blocks ------------------------------------------------------------------------------------------


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as blocks: some are headings, toggles with the two lines after them inside, pictures and slot lines."""
    d = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("n", "line"))
    head, r = F.col("n") == 12 + F.col("page") % 5, F.col("n") % 9
    kind = F.when(head, "heading_1").when(r == 4, "toggle").when(r == 8, "image").otherwise("paragraph")
    text = F.when(head, trees.DRAFT).when(r == 4, F.concat(F.lit(trees.SOURCE), F.lit(" "), "line")).when(r == 0, F.floor(F.col("n") / 9).cast("string")).otherwise(F.col("line"))
    name = lambda c: F.concat_ws("/", "page", c.cast("string"))
    parent = F.when(~head & r.isin(5, 6), name(F.col("n") - r + 4))
    return d.select("page", name(F.col("n")).alias("id"), parent.alias("parent"), F.col("n").cast("long").alias("pos"), kind.alias("type"), text.alias("text"))


def source_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = trees.source_bodies(_blocks(spark, sf_dir))
    return b.select("page", F.length("body").cast("long").alias("chars"), F.md5("body").alias("digest"))


def draft_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = trees.drafts_of(_blocks(spark, sf_dir))
    return b.select("page", F.length("draft").cast("long").alias("chars"), F.md5("draft").alias("digest"), "has_image")


def cleared_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.cleared_images(_blocks(spark, sf_dir))


def draft_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as drafts in which every seventh line is a slot; even documents have pictures for even slots."""
    d = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.when(i % 7 == 3, F.lit("1")).when(i % 7 == 5, F.lit(" ")).otherwise(x)).alias("lines"))
    images = d.where("page % 2 = 0").select("page", F.explode(F.sequence(F.lit(0), F.size("lines"), F.lit(2))).alias("slot"), F.lit("picture").alias("image"))
    b = trees.batches(trees.drafted_blocks(d.select("page", F.array_join("lines", "\n").alias("draft")), images))
    return b.select("page", "rn", "type", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"), "batch")


# --- state by key ---------------------------------------------------------------------------------------------


def _kept(spark: SparkSession, sf_dir: str, name: str, fields: dict[str, Column], processor: keyed.InOrder) -> DataFrame:
    """A stream over events by user_id, run to its end and read back. The rows arrive in four parts that overlap by up to two days,
    and a last row moves the watermark on past all deadlines."""
    spark, folder = keyed.with_state(spark), shared_folder(spark, name)
    e = _table(spark, sf_dir, "events").select("user_id", F.date_trunc("millisecond", F.col("ts").cast("timestamp")).alias("ts"), "event_id", *(c.alias(n) for n, c in fields.items()))
    span = e.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    if span.a is None:
        return spark.createDataFrame([], keyed.OUT)
    part = F.least(F.lit(3), F.floor((F.unix_seconds("ts") + (F.col("event_id") % 48) * 3600 - F.unix_seconds(F.lit(span.a))) * 4 / (F.unix_seconds(F.lit(span.b)) - F.unix_seconds(F.lit(span.a)) + 1)))
    for k in range(4):  # one after the other, as files are read by age
        e.where(part == k).write.mode("append").parquet(f"{folder}/in")
    end = e.limit(1).select(F.lit(-1).cast("long").alias("user_id"), F.lit(span.b) + F.expr("interval 100 days"), F.lit(-1).cast("long").alias("event_id"), *(F.lit(None).cast(t).alias(n) for n, t in e.dtypes[3:]))
    end.toDF(*e.columns).write.mode("append").parquet(f"{folder}/in")
    # a batch is a part, however many files it has, so that a key isn't looked at more often in larger tables
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", max(8, e.rdd.getNumPartitions())).parquet(f"{folder}/in")
    days = (span.b - span.a).days // 4 + 3  # a part's length and the overlap: no row is late
    out = keyed.kept_by_key(stream, "user_id", "ts", "event_id", list(fields), processor, f"{days} days")
    out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    made = spark.read.schema(keyed.OUT).parquet(f"{folder}/out").where("key is distinct from '-1'")
    ms = lambda c: F.unix_millis(F.col(c)).alias(c)
    return made.select(F.col("key").cast("long").alias("key"), ms("at"), "what", "detail", ms("since"))


def carried_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases are done, other events held, with a date up to nine days back; errors have none, signups no lane. Three days are kept."""
    kind = F.when(F.col("event_type") == "purchase", "done").otherwise("held")
    published = F.when(F.col("event_type") != "error", F.unix_millis(F.col("ts").cast("timestamp")) - (F.col("event_id") % 9) * (keyed.DAY_MS // 2))
    return _kept(spark, sf_dir, "carried", {"kind": kind, "lane": F.col("event_type"), "published": published.cast("long")}, keyed.CarriedOver(3, ("view", "click", "error")))


def written_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir, "written", {"kind": F.col("event_type")}, keyed.WrittenEvents(2)).select("key", "at", "what", "since")


def model_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors report one of four models as exhausted, of which three are in the chain; all else asks."""
    kind = F.when(F.col("event_type") == "error", "exhausted").otherwise("ask")
    return _kept(spark, sf_dir, "chain", {"kind": kind, "model": F.concat(F.lit("m"), (F.col("event_id") % 4).cast("string"))}, keyed.DailyChain(CHAIN))


ALL: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    accepting_scan, quota_scan, query_stock, source_bodies, draft_bodies, cleared_images, draft_blocks, carried_over, written_events, model_chain,
)

# --- SQL ------------------------------------------------------------------------------------------------------


def _scan_sql(rows: str, caps: list[tuple[str, str, int, bool, bool, bool]], prior: str = "[]::varchar[]") -> str:
    """The scan row by row. rows: (rn, doc_id, reason, k0, k1, ...); caps: (name, key, most, stops, first, read)."""
    full = lambda k, most: f"len(list_filter(used, lambda x: x = '{k}:' || r.k{k}::varchar)) >= {most}"
    early = [f"WHEN r.k{k} IS NOT NULL AND {full(k, c[2])} THEN '{c[0]}'" for stops in (True, False) for k, c in enumerate(caps) if c[3] == stops and (stops or c[4])]
    late = [f"WHEN r.k{k} IS NOT NULL AND {full(k, c[2])} THEN '{c[0]}'" for k, c in enumerate(caps) if not c[3] and not c[4]]
    verdict = f"CASE {' '.join(early)} WHEN r.reason IS NOT NULL THEN r.reason {' '.join(late)} ELSE 'accepted' END"
    keys = lambda test: "[" + ", ".join(f"'{k}:' || r.k{k}::varchar" for k, c in enumerate(caps) if test(c)) + "]::varchar[]"
    return f"""
WITH RECURSIVE r AS ({rows}),
s AS (SELECT 0::bigint AS rn, NULL::bigint AS doc_id, NULL::varchar AS verdict, {prior} AS used
  UNION ALL SELECT v.rn, v.doc_id, v.verdict, list_concat(used, CASE WHEN v.verdict = 'accepted' THEN v.every WHEN v.verdict = v.reason THEN v.was_read ELSE [] END) FROM
    (SELECT r.rn, r.doc_id, r.reason, {verdict} AS verdict, {keys(lambda c: True)} AS every, {keys(lambda c: c[5])} AS was_read, used FROM s JOIN r ON r.rn = s.rn + 1) v)
SELECT doc_id, verdict FROM s WHERE rn > 0"""


_FIRST = "lower(split_part(text, ' ', 1))"
ACCEPTING_SCAN = _scan_sql(
    f"SELECT row_number() OVER (ORDER BY lang, source, doc_id) AS rn, doc_id, CASE WHEN n_chars < 200 THEN 'small' END AS reason, lang AS k0, split_part(text, chr(10), 1) AS k1, {_FIRST} AS k2 FROM documents",
    [("target", "lang", 60, True, False, False), ("duplicate", "name", 1, False, True, False), ("set", "set", 2, False, False, False)],
    f"(SELECT coalesce(list('2:' || {_FIRST}), []) FROM benchmark)",
)
QUOTA_SCAN = _scan_sql(
    "SELECT row_number() OVER (ORDER BY source, lang, doc_id) AS rn, doc_id, CASE WHEN n_chars % 5 = 0 THEN 'small' END AS reason, source AS k0, source || '/' || lang AS k1, n_chars % 211 AS k2 FROM documents",
    [("target", "source", 12, True, False, False), ("quota", "query", 3, True, False, False), ("duplicate", "name", 1, False, True, True)],
)
QUERY_STOCK = "SELECT lang AS category, source AS query, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)"

_LINES = f"""l AS (SELECT doc_id AS page, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS n FROM documents),
b AS (SELECT page, n, n = 12 + page % 5 AS head, n % 9 AS r, line FROM l),
k AS (SELECT page, n, head, CASE WHEN NOT head AND r IN (5, 6) THEN n - r + 4 END AS parent, CASE WHEN head THEN 'heading' WHEN r = 4 THEN 'toggle' WHEN r = 8 THEN 'image' ELSE 'paragraph' END AS type,
  CASE WHEN head THEN '{trees.DRAFT}' WHEN r = 4 THEN '{trees.SOURCE} ' || line WHEN r = 0 THEN (n // 9)::varchar ELSE line END AS text FROM b),
h AS (SELECT page, min(n) AS n FROM k WHERE head AND parent IS NULL GROUP BY page),
t AS (SELECT k.*, coalesce(k.n >= h.n, false) AS below FROM k LEFT JOIN h USING (page) WHERE parent IS NULL)"""
SOURCE_BODIES = f"""
WITH {_LINES},
x AS (SELECT page, n, text FROM t WHERE NOT below AND type <> 'toggle' UNION ALL SELECT k.page, k.n, k.text FROM k JOIN t ON t.page = k.page AND t.n = k.parent AND t.type = 'toggle' AND NOT t.below),
y AS (SELECT page, string_agg(text, chr(10) ORDER BY n) AS body FROM x WHERE text <> '' GROUP BY page)
SELECT doc_id AS page, length(coalesce(body, '')) AS chars, md5(coalesce(body, '')) AS digest FROM documents LEFT JOIN y ON page = doc_id"""
DRAFT_BODIES = f"""
WITH {_LINES},
y AS (SELECT page, string_agg(text, chr(10) || chr(10) ORDER BY n) FILTER (type = 'paragraph') AS draft, bool_or(type = 'image') AS has_image FROM t WHERE below GROUP BY page)
SELECT doc_id AS page, length(coalesce(draft, '')) AS chars, md5(coalesce(draft, '')) AS digest, coalesce(has_image, false) AS has_image FROM documents LEFT JOIN y ON page = doc_id"""
CLEARED_IMAGES = rf"""
WITH {_LINES},
y AS (SELECT page, n, type, sum(CASE WHEN type = 'image' OR (type = 'paragraph' AND regexp_full_match(trim(text), '[0-9]{{1,2}}')) THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY n) AS slot FROM t WHERE below)
SELECT page, page || '/' || n AS id, slot::bigint AS slot FROM y WHERE type = 'image'"""
DRAFT_BLOCKS = f"""
WITH l AS (SELECT doc_id AS page, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS n FROM documents),
m AS (SELECT page, n, CASE WHEN n % 7 = 3 THEN '1' WHEN n % 7 = 5 THEN ' ' ELSE line END AS line FROM l),
k AS (SELECT page, n, regexp_replace(line, '\\s+$', '') AS line, CASE WHEN trim(line, ' ' || chr(9) || chr(13)) = '' THEN 'blank' WHEN regexp_full_match(trim(line), '[0-9]{{1,2}}') THEN 'slot' ELSE 'text' END AS kind FROM m),
g AS (SELECT *, sum((kind <> 'text')::int) OVER (PARTITION BY page ORDER BY n) AS run, sum((kind = 'slot')::int) OVER (PARTITION BY page ORDER BY n) - 1 AS slot FROM k),
p AS (SELECT page, min(n) AS n, string_agg(line, chr(10) ORDER BY n) AS text FROM g WHERE kind = 'text' GROUP BY page, run),
c AS (SELECT page, n, i AS piece, 'paragraph' AS type, substr(text, i * 2000 + 1, 2000) AS text FROM p, LATERAL (SELECT unnest(range((length(text) + 1999) // 2000)) AS i)),
a AS (SELECT doc_id AS page, -2 AS n, 0 AS piece, 'divider' AS type, '' AS text FROM documents UNION ALL SELECT doc_id, -1, 0, 'heading_1', '{trees.DRAFT}' FROM documents UNION ALL SELECT * FROM c
  UNION ALL SELECT page, n, 0, CASE WHEN page % 2 = 0 AND slot % 2 = 0 THEN 'image' ELSE 'paragraph' END, CASE WHEN page % 2 = 0 AND slot % 2 = 0 THEN 'picture' ELSE trim(line) END FROM g WHERE kind = 'slot'),
r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY n, piece) AS rn FROM a)
SELECT page, rn, type, length(text) AS chars, md5(text) AS digest, (rn - 1) // 100 AS batch FROM r"""

_DAY = 86_400_000
_EVENTS = 'e AS (SELECT user_id AS key, (epoch_us(ts) // 1000) AS "at", event_id, event_type AS kind, row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) AS rn FROM events)'
_PUBLISHED = f"event_type AS kind, CASE WHEN event_type <> 'error' THEN (epoch_us(ts) // 1000) - (event_id % 9) * {_DAY // 2} END AS published"
CARRIED_OVER = f"""
WITH RECURSIVE {_EVENTS.replace('event_type AS kind', _PUBLISHED)},
s AS (SELECT DISTINCT key, 0::bigint AS rn, NULL::bigint AS since, NULL::varchar AS lane, NULL::bigint AS published, []::struct("at" bigint, what varchar, detail varchar, since bigint)[] AS made FROM e
  UNION ALL SELECT key, rn, CASE WHEN what IN ('held', 'kept') THEN since END, CASE WHEN what IN ('held', 'kept') THEN kind END, CASE WHEN what IN ('held', 'kept') THEN published END,
    list_concat(gone, CASE WHEN what IS NULL THEN [] ELSE [{{'at': "at", 'what': what, 'detail': CASE WHEN what = 'processed' THEN lane ELSE kind END, 'since': CASE WHEN what IN ('held', 'kept', 'expired') THEN since ELSE old END}}] END)
  FROM (SELECT key, rn, "at", kind, published, lane, old, gone, coalesce(old, "at") AS since,
      CASE WHEN kind = 'purchase' THEN CASE WHEN old IS NOT NULL THEN 'processed' END WHEN kind NOT IN ('view', 'click', 'error') THEN 'no lane' WHEN published + 3 * {_DAY} < "at" THEN 'expired' WHEN old IS NULL THEN 'held' ELSE 'kept' END AS what
    FROM (SELECT e.key, e.rn, e."at", e.kind, e.published, CASE WHEN gone_by THEN NULL ELSE lane END AS lane, CASE WHEN gone_by THEN NULL ELSE since END AS old,
        CASE WHEN gone_by THEN [{{'at': was + 3 * {_DAY}, 'what': 'expired', 'detail': lane, 'since': since}}] ELSE [] END AS gone
      FROM (SELECT key, rn, since, lane, published AS was FROM s) p JOIN e ON e.key = p.key AND e.rn = p.rn + 1, LATERAL (SELECT coalesce(p.was + 3 * {_DAY} < e."at", false) AS gone_by)))),
o AS (SELECT key, unnest(made) AS m FROM s UNION ALL
  SELECT key, {{'at': published + 3 * {_DAY}, 'what': 'expired', 'detail': lane, 'since': since}} FROM s WHERE published IS NOT NULL AND rn = (SELECT max(rn) FROM e WHERE e.key = s.key))
SELECT key, m."at" AS "at", m.what AS what, m.detail AS detail, m.since AS since FROM o"""
WRITTEN_EVENTS = f"""
WITH RECURSIVE {_EVENTS},
s AS (SELECT key, rn, "at", "at" AS since FROM e WHERE rn = 1
  UNION ALL SELECT e.key, e.rn, e."at", CASE WHEN s.since + 2 * {_DAY} < e."at" THEN e."at" ELSE s.since END FROM s JOIN e ON e.key = s.key AND e.rn = s.rn + 1)
SELECT key, "at", CASE WHEN "at" = since AND rn = min(rn) OVER (PARTITION BY key, since) THEN 'written' ELSE 'known' END AS what, since FROM s"""
MODEL_CHAIN = f"""
WITH {_EVENTS},
d AS (SELECT *, 'm' || (event_id % 4) AS model, (make_timestamp("at" * 1000) AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles')::date AS day FROM e),
x AS (SELECT key, day, model, min(rn) AS rn FROM d WHERE kind = 'error' GROUP BY key, day, model),
f AS (SELECT key, day, min(x.rn) AS rn FROM x GROUP BY key, day),
g AS (SELECT f.key, f.day, f.rn, e."at" AS since FROM f JOIN e ON e.key = f.key AND e.rn = f.rn),
a AS (SELECT d.key, d.rn, any_value(d."at") AS "at", any_value(g.since) FILTER (g.rn < d.rn) AS since, list(x.model) FILTER (x.rn < d.rn) AS dead FROM d LEFT JOIN x ON x.key = d.key AND x.day = d.day LEFT JOIN g ON g.key = d.key AND g.day = d.day WHERE kind <> 'error' GROUP BY d.key, d.rn),
c AS (SELECT key, "at", since, list_filter({list(CHAIN)}, lambda m: NOT list_contains(coalesce(dead, []), m)) AS rest FROM a)
SELECT key, "at", 'chain' AS what, CASE WHEN len(rest) = 0 THEN '{",".join(CHAIN)}' ELSE array_to_string(rest, ',') END AS detail, since FROM c
UNION ALL SELECT x.key, e."at", 'marked', x.model, g.since FROM x JOIN e ON e.key = x.key AND e.rn = x.rn JOIN g ON g.key = x.key AND g.day = x.day
UNION ALL SELECT g.key, epoch_ms((g.day + 1)::timestamp AT TIME ZONE 'America/Los_Angeles') - 1, 'reset', string_agg(x.model, ',' ORDER BY x.rn), any_value(g.since) FROM g JOIN x ON x.key = g.key AND x.day = g.day GROUP BY g.key, g.day"""


def oracle_sql() -> dict[str, str]:
    return {f.__name__: globals()[f.__name__.upper()] for f in ALL}
