"""SQL of the registered queries, for DuckDB on the same tables. Each is written from what the query means, not from its plan."""

from __future__ import annotations

from gristmill.config import LATIN, Events, Gate, Trend
from gristmill.functions.text import TRACKING
from gristmill.plans import drafting, scans

G, E, T = Gate(), Events(), Trend()

RECORDS = "rec AS (SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS body, lang AS lane, source AS press FROM documents)"


def _in(words: tuple[str, ...]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _lines(x: str) -> str:
    return f"string_split({x}, chr(10))"


def _types(x: str, words: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"contains({x}, '{w}')::bigint" for w in words) + ")"


def _any(x: str, words: tuple[str, ...]) -> str:
    return f"regexp_matches({x}, '{'|'.join(words)}')"


def _count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def _tokens(x: str) -> str:
    bare = "CASE WHEN t LIKE '%ing' AND length(t) >= 5 THEN t[:length(t) - 3] WHEN t LIKE '%ed' AND length(t) >= 4 THEN t[:length(t) - 2] ELSE t END"
    return f"list_filter(list_transform(regexp_extract_all({x}, '[a-z]{{2,}}'), lambda t: {bare}), lambda t: length(t) >= 2 AND t NOT IN {_in(LATIN.stopwords)} AND NOT regexp_matches(t, '(tion|ly)$'))"


WHOLE = "(title || chr(10) || body)"

# --- scans and scalars

_ADDRESS = "^[A-Za-z][A-Za-z0-9+.-]*://"
URL_KEYS = rf"""
WITH u AS (SELECT page_id, {_strip('url')} AS u FROM pages),
p AS (SELECT page_id, u, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, regexp_extract(u, '{_ADDRESS}([^/?#]*)', 1) AS host,
  regexp_replace(regexp_extract(u, '{_ADDRESS}[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
  list_transform(list_filter(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&'), lambda k: k <> '' AND lower(split_part(k, '=', 1)) NOT IN {_in(TRACKING)}), lambda k: CASE WHEN contains(k, '=') THEN k ELSE k || '=' END) AS kept FROM u)
SELECT page_id, CASE WHEN host = '' THEN u ELSE scheme || '://' || lower(host) || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical,
  regexp_replace(u, '/+$', '') AS history_key, host FROM p"""


def _untagged(x: str) -> str:
    for entity, by in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&apos;", "chr(39)"), ("&nbsp;", "chr(160)"), ("&amp;", "'&'")):
        x = f"replace({x}, '{entity}', {by})" if "regexp_replace" in x else f"replace(regexp_replace({x}, '<[^>]+>', '', 'g'), '{entity}', {by})"
    return _strip(x)


PAGE_BODIES = rf"""
WITH raw AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS t, regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1) AS a,
  regexp_replace(html, '(?s)<(?:script|style)[^>]*>.*?</(?:script|style)>', '', 'g') AS w FROM pages),
b AS (SELECT page_id, {_untagged('t')} AS title, {_untagged('a')} AS precise, replace(w, '', '') AS w FROM raw),
c AS (SELECT b.page_id, title, precise, {_untagged('w')} AS loose FROM b),
d AS (SELECT page_id, title, CASE WHEN length(precise) < 250 AND length(loose) > length(precise) THEN loose ELSE precise END AS body FROM c)
SELECT page_id, title, coalesce(nullif(substr(regexp_replace(regexp_replace(title, '[^0-9A-Za-z가-힣]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 40), ''), 'draft') AS slug, length(body) AS chars, md5(body) AS digest FROM d"""

_BANNED_CHARS = "[\"''“”‘’!…·,]"
TITLE_KEYS = rf"""
WITH {RECORDS}
SELECT id, regexp_replace(regexp_replace(title, '(?s)^(.*) - .*$', '\1'), '[^\p{{L}}\p{{N}}]', '', 'g') AS key,
  concat_ws(',', CASE WHEN length(title) NOT BETWEEN 17 AND 18 THEN 'length' END, CASE WHEN regexp_matches(title, '{_BANNED_CHARS}') THEN 'characters' END, CASE WHEN NOT ends_with(title, '?') THEN 'ending' END) AS issues,
  {_strip(rf"regexp_replace(regexp_replace(title, '{_BANNED_CHARS}', '', 'g'), '\s+', ' ', 'g')")} AS fixed,
  regexp_matches(title, '[\[\(【][^\]\)】]{{0,11}}(?:photo|video)[^\]\)】]{{0,11}}[\]\)】]') AS caption
FROM rec"""

DATES = """
SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S') || '+09:00' AS local, strftime(date_trunc('second', ts) - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS read_back,
  greatest(0, floor((epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(ts))) / 86400))::bigint AS age, strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d') AS quota_day
FROM events"""

TEXT_CHUNKS = f"""
WITH p AS (SELECT doc_id, {_strip('x')} AS x FROM (SELECT doc_id, unnest({_lines('text')}) AS x FROM documents)),
c AS (SELECT doc_id, unnest(list_transform(range(0, length(x), 2000), lambda i: substr(x, i + 1, 2000))) AS chunk FROM p WHERE x <> '')
SELECT doc_id, count(*) AS chunks, max(length(chunk)) AS longest, sum(length(chunk))::bigint AS chars FROM c GROUP BY doc_id"""

TOPIC_CROSSTAB = f"""
WITH {RECORDS},
t AS (SELECT CASE WHEN {_any(WHOLE, ('tion', 'ción'))} THEN 'motion' WHEN {_any(WHOLE, ('ment', 'keit'))} THEN 'state' WHEN {_any(WHOLE, ('erin', 'ingst'))} THEN 'actor' WHEN {_any(WHOLE, ('the', 'der', 'les'))} THEN 'article' ELSE 'other' END AS topic, lane FROM rec),
g AS (SELECT CASE WHEN grouping(topic) = 1 THEN 'all' ELSE topic END AS topic, CASE WHEN grouping(lane) = 1 THEN 'all' ELSE lane END AS lane, count(*) AS n FROM t GROUP BY CUBE (topic, lane))
SELECT topic, lane, n, n / max(n) OVER (PARTITION BY lane) AS share FROM g"""

# --- cleaning: of the steps, those that need another script leave Latin text as it is

_MARKER = r"^\s*(?:[-*•]\s|[▶▷►☞※])"
_CLEAN = rf"""
WITH {RECORDS},
s0 AS (SELECT id, body AS c0, list_filter({_lines('body')}, lambda x: NOT (starts_with({_strip('x')}, '|') OR ends_with({_strip('x')}, '|'))) AS kept FROM rec),
s1 AS (SELECT id, c0, CASE WHEN coalesce(list_sum(list_transform(kept, lambda x: length({_strip('x')}))), 0) < 0.3 * coalesce(list_sum(list_transform({_lines('c0')}, lambda x: length({_strip('x')}))), 0) THEN c0 ELSE array_to_string(kept, chr(10)) END AS c1 FROM s0),
s2 AS (SELECT id, c0, c1, array_to_string(list_filter({_lines('c1')}, lambda x: NOT (regexp_matches(x, '(?i)(ⓒ|©|copyright)') AND length(x) <= 80)), chr(10)) AS c2 FROM s1),
s3 AS (SELECT *, {_lines('c2')} AS l, list_filter(list_transform({_lines('c2')}, lambda x, i: CASE WHEN {_strip('x')} <> '' AND NOT regexp_matches({_strip('x')}, '{_MARKER}') THEN i END), lambda i: i IS NOT NULL) AS solid FROM s2),
s4 AS (SELECT id, c0, c1, c2, CASE WHEN len(solid) > 0 THEN array_to_string(l[list_min(solid):list_max(solid)], chr(10)) ELSE '' END AS c3 FROM s3),
s5 AS (SELECT *, regexp_replace(c3, '[\p{{L}}\p{{M}}\p{{N}}_.\-]+@[\p{{L}}\p{{M}}\p{{N}}_.\-]+\.[\p{{L}}\p{{M}}\p{{N}}_]+', '', 'g') AS c4 FROM s4),
s6 AS (SELECT *, {_strip(rf"regexp_replace(array_to_string(list_transform({_lines('c4')}, lambda x: {_strip(r"regexp_replace(replace(x, '|', ' '), '[ \t\x{A0}]+', ' ', 'g')")}), chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g')")} AS c5 FROM s5)"""
CLEAN_BODIES = f"{_CLEAN} SELECT id, length(c5) AS chars, md5(c5) AS digest FROM s6"
CLEAN_LOSSES = f"""{_CLEAN},
d AS (SELECT unnest([{{'step': 'caption_lines', 'lost': length(c0) - length(c1)}}, {{'step': 'boilerplate_lines', 'lost': length(c1) - length(c2)}}, {{'step': 'edge_lists', 'lost': length(c2) - length(c3)}}, {{'step': 'emails', 'lost': length(c3) - length(c4)}}, {{'step': 'white_space', 'lost': length(c4) - length(c5)}}]) AS x FROM s6)
SELECT x.step AS step, count(*) AS records, sum(x.lost)::bigint AS chars FROM d WHERE x.lost > 0 GROUP BY x.step"""

HOME_RECORDS = f"""
WITH {RECORDS},
s AS (SELECT id, body, regexp_replace(regexp_replace(body, 'https?://\\S+|www\\.\\S+', ' ', 'g'), '[\\p{{L}}\\p{{M}}\\p{{N}}_.\\-]+@[\\p{{L}}\\p{{M}}\\p{{N}}_.\\-]+\\.[\\p{{L}}\\p{{M}}\\p{{N}}_]+', ' ', 'g') AS x FROM rec)
SELECT id, CASE WHEN {_count('x', '[가-힣A-Za-z]')} > 0 THEN {_count('x', '[가-힣]')} / {_count('x', '[가-힣A-Za-z]')} ELSE 0.0::double END AS share,
  length(array_to_string(list_filter({_lines('body')}, lambda y: NOT ({_count('y', '[가-힣A-Za-z]')} >= 40 AND {_count('y', '[A-Za-z]')} >= {_count('y', '[가-힣A-Za-z]')} * 0.7)), chr(10))) AS left_chars FROM s"""

_RULE = rf"CASE WHEN {_strip('x')} = '' THEN NULL WHEN regexp_matches(x, '(?i)copyright|(?i)licen[cs]e') THEN 'notice' WHEN regexp_matches(x, '\S+@\S+') THEN 'address' WHEN regexp_matches(x, '^\S{{1,12}}$') THEN 'short' END"
EXCLUDED_LINES = f"""
WITH l AS (SELECT doc_id, unnest(list_transform({_lines('text')}, lambda x, i: {{'rule': {_RULE}, 'line': i}})) AS r FROM documents)
SELECT doc_id, r.rule AS rule, count(*) AS n, sum(r.line)::bigint AS line_sum FROM l WHERE r.rule IS NOT NULL GROUP BY doc_id, r.rule"""

# --- structure and wording

_PROSE = lambda x: f"coalesce(list_sum(list_transform({_lines(x)}, lambda y: length({_strip('y')}))), 0)::bigint"
DRAFT_LENGTHS = f"""
WITH d AS (SELECT doc_id, text, {_PROSE('text')} AS chars FROM documents)
SELECT doc_id, chars, CASE WHEN chars >= 1200 THEN 'long' WHEN chars >= 600 THEN 'middle' WHEN chars >= 250 THEN 'short' ELSE 'thin' END AS tier,
  greatest(900, least(1800, floor(length(text) * 1.8)))::bigint AS target, CASE WHEN chars >= 120 THEN 'bundle' ELSE 'hold' END AS mode FROM d"""

WITHIN_LENGTH = """
WITH p AS (SELECT conv_id, turn, replace(text, chr(10), chr(10) || chr(10)) AS t, string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)) AS parts FROM conversations),
n AS (SELECT *, len(list_filter(range(1, len(parts) + 1), lambda k: list_sum(list_transform(parts[1:k], lambda x: length(x))) <= 400)) AS n FROM p)
SELECT conv_id, turn, CASE WHEN n > 0 THEN length(array_to_string(parts[1:n], chr(10) || chr(10))) ELSE length(substr(t, 1, 400)) END AS kept FROM n"""

DRAFT_STRUCTURE = rf"""
WITH p AS (SELECT conv_id, turn, text, list_filter(list_transform({_lines('text')}, lambda x: {_strip('x')}), lambda x: x <> '') AS paras FROM conversations),
q AS (SELECT *, regexp_replace(coalesce(paras[1], ''), '\s+', '', 'g') AS title, regexp_replace(coalesce(paras[2], ''), '\s+', '', 'g') AS intro, regexp_replace(array_to_string(paras[2:], chr(10)), '\s+', '', 'g') AS rest FROM p),
r AS (SELECT conv_id, turn, len(paras) AS paragraphs, {_PROSE('text')} AS chars, contains(title, 'tion') AS in_title, contains(substr(title, 1, 15), 'tion') AS in_head, contains(intro, 'tion') AS in_intro, {_count('rest', 'tion')} AS mentions FROM q)
SELECT *, concat_ws(',', CASE WHEN NOT in_title THEN 'title' END, CASE WHEN in_title AND NOT in_head THEN 'head' END, CASE WHEN NOT in_intro THEN 'intro' END, CASE WHEN mentions = 0 THEN 'body' END) AS warnings FROM r"""

BANNED_COUNTS = f"""
WITH c AS (SELECT doc_id, {_count('lower(text)', 'the best|ation|eaux')} AS claims, {_count('lower(text)', 'und|and the|de la')} AS filler FROM documents)
SELECT doc_id, claims, filler, claims > 0 AS blocked FROM c"""


def _places(name: str, severity: str, pattern: str) -> str:
    return f"""SELECT id, '{name}' AS category, '{severity}' AS severity, unnest(list_transform(range(1, len(m) + 1), lambda k: {{'start': list_sum(list_transform(p[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0), 'w': m[k]}})) AS x
  FROM (SELECT doc_id AS id, regexp_extract_all(text, '(?i){pattern}') AS m, regexp_split_to_array(text, '(?i){pattern}') AS p FROM documents)"""


BANNED_PLACES = f"""
SELECT id, category, severity, x.start::bigint AS start, (x.start + length(x.w))::bigint AS finish, x.w AS matched
FROM ({_places('claims', 'block', 'the best|ation|eaux')} UNION ALL {_places('filler', 'warn', 'and the|de la|und')})"""

_FOLDED = r"regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g')"
FOLDED_COUNTS = f"""
WITH c AS (SELECT doc_id, unnest([{{'word': 'eaux', 'n': {_count(_FOLDED, 'eaux')}}}, {{'word': 'The Re', 'n': {_count(_FOLDED, 'there')}}}]) AS x FROM documents)
SELECT doc_id, x.word AS word, x.n AS n FROM c WHERE x.n > 0"""

SENTIMENT_REPORT = rf"""
WITH l AS (SELECT conv_id, unnest({_lines('text')}) AS line FROM conversations), w AS (SELECT conv_id, regexp_extract_all(lower(line), '\p{{L}}+') AS words FROM l),
s AS (SELECT conv_id, len(list_filter(words, lambda x: x IN ('de', 'und'))) - len(list_filter(words, lambda x: x IN ('the', 'que'))) AS score FROM w),
g AS (SELECT conv_id, count(*) AS sentences, count(*) FILTER (score > 0.5) AS up, count(*) FILTER (score < -0.5) AS down, sum(score)::double AS total FROM s GROUP BY conv_id)
SELECT conv_id, sentences, round(up / sentences, 4) AS positive, round(down / sentences, 4) AS negative, round((sentences - up - down) / sentences, 4) AS neutral, round(total / sentences, 4) AS mean, up / nullif(up + down, 0) AS binary FROM g"""

IMAGE_SLOTS = """
WITH l AS (SELECT conv_id AS id, turn, role, length(text)::varchar AS head, (turn % 90 + 1)::varchar AS slot FROM conversations),
s AS (SELECT *, regexp_matches(head, '^[0-9]{1,2}$')::int AS h FROM l),
n AS (SELECT *, (sum(1 + h) OVER (PARTITION BY id ORDER BY turn))::bigint AS upto FROM s),
image AS (SELECT conv_id AS id, turn + 1 AS slot, 'image of ' || role AS image FROM conversations WHERE turn % 2 = 0),
f AS (SELECT n.id, n.turn, CASE WHEN h = 1 THEN coalesce(a.image, head) ELSE head END AS x, coalesce(b.image, n.slot) AS y
  FROM n LEFT JOIN image a ON a.id = n.id AND a.slot = n.upto - 1 LEFT JOIN image b ON b.id = n.id AND b.slot = n.upto),
t AS (SELECT id, string_agg(x || chr(10) || y, chr(10) ORDER BY turn) AS text FROM f GROUP BY id)
SELECT id, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[0-9]{1,2}$'))) AS open, md5(text) AS digest FROM t"""

# --- matching and the gate

#: Overlapping and touching words as one span: the ways in which these words can overlap are written out.
_SPANS = "(?:tion|ment(?:ion)?|keit(?:ion)?|ción|erin(?:gst(?:ion)?)?|ingst(?:ion)?)+"
_FACTS = rf"""{RECORDS},
sq AS (SELECT *, {WHOLE} AS whole, regexp_replace(title, '\s+', '', 'g') AS st, regexp_replace(body, '\s+', '', 'g') AS sb FROM rec),
fact AS (SELECT id, lane, press, {_types('st', LATIN.crime)} AS title_incidents, ({' + '.join(f"(contains(sb, '{w}') AND NOT contains(st, '{w}'))::bigint" for w in LATIN.crime)}) AS body_incidents, length(body) AS chars,
  {_types('whole', LATIN.core)} AS core, {_count('whole', _SPANS)} AS spans, {_count('whole', LATIN.stem)} AS mentions, {_types('whole', LATIN.core + LATIN.generic)} AS hits, {_any('title', LATIN.core)} AS titled FROM sq)"""
GATE_FACTS = f"WITH {_FACTS} SELECT * EXCLUDE (lane, press) FROM fact"


def _gate(core_types: str = str(G.core_types), body_chars: str = str(G.body_chars), domain_hits: str = str(G.domain_hits)) -> str:
    thin = f"core / (chars / 1000) < CASE WHEN titled THEN {G.core_density} ELSE {G.core_density_untitled} END AND mentions / (chars / 1000) < CASE WHEN titled THEN {G.mention_density} ELSE {G.mention_density_untitled} END"
    return f"""CASE WHEN title_incidents > 0 OR body_incidents >= {G.incident_body_hits} THEN 'incident' WHEN chars < {body_chars} THEN 'body' WHEN NOT (core >= {core_types} AND spans >= {G.core_spans}) AND mentions < {G.mentions} THEN 'core'
  WHEN chars >= {G.density_from_chars} AND {thin} THEN 'density' WHEN hits < CASE WHEN titled THEN {domain_hits} ELSE {G.domain_hits_untitled} END THEN 'hits' ELSE 'ok' END"""


_JUDGED = f"{_FACTS}, judged AS (SELECT fact.*, quality, {_gate()} AS gate FROM fact JOIN labels ON labels.doc_id = fact.id)"
_SCORES = """SELECT *, CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0.0::double END AS f1 FROM (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0::double END AS "precision", CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0::double END AS recall FROM counts)"""
_COUNTS = "count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (t AND NOT p) AS fn, count(*) FILTER (NOT t AND NOT p) AS tn"
GATE_TRACE = f"WITH {_FACTS} SELECT id, {_gate()} AS gate FROM fact"
GATE_SCORES = f"WITH {_JUDGED}, j AS (SELECT quality = 1 AS t, gate = 'ok' AS p FROM judged), counts AS (SELECT {_COUNTS} FROM j) {_SCORES}"
GATE_MISSES = f"WITH {_JUDGED} SELECT gate, count(*) AS n FROM judged WHERE quality = 1 AND gate <> 'ok' GROUP BY gate"
GATE_SWEEP = f"""WITH {_JUDGED},
grid AS (SELECT a::double AS core_types, b::double AS body_chars, c::double AS domain_hits FROM unnest([1, 2, 3]) x(a), unnest([100, 250, 500]) y(b), unnest([3, 5]) z(c)),
j AS (SELECT core_types, body_chars, domain_hits, quality = 1 AS t, {_gate('core_types', 'body_chars', 'domain_hits')} = 'ok' AS p FROM judged, grid),
counts AS (SELECT core_types, body_chars, domain_hits, {_COUNTS} FROM j GROUP BY ALL) {_SCORES}"""

# --- sets, histories and state

DEDUPE_TWO_KEY = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, source || ':' || (n_chars % 97) AS k1, nullif(regexp_replace(regexp_replace(split_part(text, chr(10), 1), '(?s)^(.*) - .*$', '\1'), '[^\p{L}\p{N}]', '', 'g'), '') AS k2 FROM documents),
s AS (SELECT 0::bigint AS rn, []::varchar[] AS s1, []::varchar[] AS s2, []::bigint[] AS kept
  UNION ALL SELECT d.rn, CASE WHEN dup THEN s1 ELSE list_append(s1, k1) END, CASE WHEN dup OR k2 IS NULL THEN s2 ELSE list_append(s2, k2) END, CASE WHEN dup THEN kept ELSE list_append(kept, doc_id) END
  FROM (SELECT s.s1, s.s2, s.kept, d.*, list_contains(s1, k1) OR coalesce(list_contains(s2, k2), false) AS dup FROM s JOIN d ON d.rn = s.rn + 1) d)
SELECT unnest(kept) AS doc_id FROM (SELECT kept FROM s ORDER BY rn DESC LIMIT 1)"""
POOL_OF_USERS = "SELECT user_id, min(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id"
UNPROCESSED = "SELECT event_id, floor(value)::bigint AS key FROM events e WHERE event_type <> 'purchase' AND floor(value) NOT IN (SELECT floor(value) FROM events WHERE event_type = 'purchase')"
HELD_OVER = """
WITH e AS (SELECT event_id, event_type, floor(value)::bigint AS key, strftime(ts, '%Y-%m-%d') AS held_since FROM events),
held AS (SELECT min(event_id) AS event_id, key FROM e WHERE event_type = 'view' AND key NOT IN (SELECT key FROM e WHERE event_type = 'purchase') GROUP BY key),
since AS (SELECT key, min(held_since) AS held_since FROM e WHERE event_type = 'error' GROUP BY key)
SELECT event_id, key, held_since FROM e WHERE event_type = 'signup'
UNION ALL SELECT event_id, held.key, coalesce(held_since, '2024-01-31') FROM held LEFT JOIN since ON since.key = held.key WHERE held.key NOT IN (SELECT key FROM e WHERE event_type = 'signup')"""
PER_USER_CAP = """
WITH prior AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY user_id),
r AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events WHERE event_type <> 'error')
SELECT event_id, r.user_id FROM r LEFT JOIN prior ON prior.user_id = r.user_id WHERE rn + coalesce(n, 0) <= 15"""
LAST_KEYS = """
WITH e AS (SELECT event_id, event_type, event_type || '/' || value::varchar AS key FROM events), known AS (SELECT event_id AS seq, key FROM e WHERE event_type <> 'click'),
fresh AS (SELECT event_id + (SELECT max(seq) FROM known) + 1 AS seq, key FROM e WHERE event_type = 'click' AND key NOT IN (SELECT key FROM known))
SELECT seq, key FROM (SELECT * FROM known UNION ALL SELECT * FROM fresh) ORDER BY seq DESC LIMIT 5000"""
LANE_ROUTE = """
WITH e AS (SELECT event_id, floor(value * 10)::bigint AS key, event_type AS lane, ts FROM events),
v AS (SELECT key, CASE WHEN max(lane) = 'view' THEN 'view' ELSE 'click' END AS verdict FROM e GROUP BY key),
r AS (SELECT event_id, e.key, lane AS moved_from, CASE WHEN verdict = 'view' THEN 'view' WHEN lane = 'view' THEN verdict ELSE lane END AS lane, ts FROM e JOIN v ON v.key = e.key),
f AS (SELECT * FROM r WHERE lane = moved_from OR ts >= TIMESTAMP '2024-01-31' - INTERVAL 1 DAY * CASE lane WHEN 'view' THEN 14 WHEN 'click' THEN 3 ELSE 30 END)
SELECT event_id, lane, moved_from FROM f QUALIFY row_number() OVER (PARTITION BY lane, key ORDER BY event_id) = 1"""
WRITTEN_OVER = """
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, lang, coalesce(nullif(CASE WHEN quality = 1 THEN 'good' ELSE '' END, ''), source) AS source FROM documents d FULL JOIN labels l ON l.doc_id = d.doc_id"""
SINCE_CUTOFF = "SELECT event_id, event_type = 'error' AS \"unknown\" FROM events WHERE event_type = 'error' OR ts >= TIMESTAMP '2024-01-24 00:00:00'"
RETENTION = """
SELECT event_type AS status, count(*) AS n, min(event_id) AS first FROM events
WHERE event_type NOT IN ('view', 'click', 'error') OR ts >= TIMESTAMP '2024-01-31' - INTERVAL 1 DAY * CASE event_type WHEN 'view' THEN 3 WHEN 'click' THEN 7 ELSE 14 END GROUP BY event_type"""
HELD_STATUS = """
SELECT CASE WHEN floor(value) IN (SELECT floor(value) FROM events WHERE event_type = 'purchase') THEN 'processed' WHEN event_type NOT IN ('view', 'click', 'error') THEN 'no lane' WHEN ts < TIMESTAMP '2024-01-24' THEN 'expired' ELSE 'kept' END AS status, count(*) AS n
FROM events GROUP BY 1"""
STREAM_FIRST_SEEN = "SELECT DISTINCT user_id || '/' || event_type AS key FROM events"

# --- scores and retrieval

_TREND = f"""{RECORDS},
tok AS (SELECT id, unnest(list_distinct({_tokens(WHOLE)})) AS token FROM rec), often AS (SELECT token, count(*) AS df FROM tok GROUP BY token HAVING count(*) >= {T.least_documents}),
trend AS (SELECT token, df, df / (SELECT count(*) FROM rec) * CASE WHEN {_any('token', LATIN.core + LATIN.generic)} THEN {T.domain_weight} ELSE 1.0 END::double AS weight FROM often ORDER BY weight DESC, token LIMIT {T.keywords})"""
TREND_KEYWORDS = f"WITH {_TREND} SELECT token, df, weight FROM trend"
RECORD_SCORES = f"""WITH {_TREND},
pair AS (SELECT id, {_tokens('title')} AS tt, {_tokens('body')} AS bt FROM rec),
x AS (SELECT id, tt, unnest(list_distinct(list_concat(tt, bt))) AS token FROM pair),
g AS (SELECT id, x.token, weight * CASE WHEN list_contains(tt, x.token) THEN {T.title_bonus} ELSE 1.0 END::double AS gain FROM x JOIN trend ON trend.token = x.token)
SELECT id, round(sum(gain), 4) AS score, string_agg(token, ',' ORDER BY gain DESC, token) AS matched FROM g GROUP BY id"""
BM25_TOPK = """
WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[a-z]{2,}') AS tokens FROM documents), stats AS (SELECT count(*) AS n, avg(len(tokens)) AS mean FROM d),
q AS (SELECT item_id AS query_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{2,}'))) AS term FROM benchmark),
p AS (SELECT id, len(tokens) AS length, unnest(tokens) AS term FROM d), tf AS (SELECT id, length, term, count(*) AS tf FROM p GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * length / mean))), 4) AS score FROM tf JOIN df ON df.term = tf.term JOIN q ON q.term = tf.term CROSS JOIN stats GROUP BY query_id, id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM s QUALIFY rank <= 5"""
ROUND_ROBIN = """
WITH c AS (SELECT conv_id * 1000 + turn AS seq, CASE WHEN turn < 6 THEN role END AS keyword, length(text) AS r FROM conversations),
q AS (SELECT *, keyword IS NOT NULL AND r <> 0 AS has FROM c),
w AS (SELECT *, CASE WHEN has THEN row_number() OVER (PARTITION BY has, keyword ORDER BY r, seq) ELSE 0 END AS turn, CASE WHEN NOT has THEN 0 WHEN keyword = 'user' THEN 1 WHEN keyword = 'assistant' THEN 2 ELSE 3 END AS known,
  CASE WHEN has THEN min(seq) OVER (PARTITION BY has, keyword) ELSE 0 END AS head FROM q)
SELECT seq, row_number() OVER (ORDER BY NOT has, turn, known, head, seq) AS place FROM w"""
PACKS_OF_FOUR = "SELECT doc_id, (rn - 1) // 4 AS pack, count(*) OVER (PARTITION BY (rn - 1) // 4) = 4 AS \"full\" FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents)"
LOWEST_QUARTER = "WITH n AS (SELECT event_id, value, row_number() OVER (ORDER BY value, event_id) AS rn, count(*) OVER () AS total FROM events) SELECT event_id, value <= (SELECT value FROM n WHERE rn = greatest(total // 4 - 1, 0) + 1) AS low FROM n"

# --- events

_SIG = f"""{RECORDS},
raw AS (SELECT id, unnest(list_distinct(regexp_extract_all({WHOLE}, '{LATIN.signature}'))) AS token FROM rec),
kept AS (SELECT token, count(*) AS df FROM raw GROUP BY token HAVING count(*) <= greatest({E.frequent_least}, floor((SELECT count(*) FROM rec) * {E.frequent_share}))),
sig AS MATERIALIZED (SELECT id, raw.token, df FROM raw JOIN kept ON kept.token = raw.token), size AS (SELECT id, count(*) AS n FROM sig GROUP BY id)"""
_PAIRS = f"""{_SIG},
met AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM sig x JOIN sig y ON x.token = y.token AND x.id < y.id GROUP BY x.id, y.id),
pairs AS MATERIALIZED (SELECT a, b, shared, p.n AS n_a, q.n AS n_b, shared / (p.n + q.n - shared) AS jaccard, shared / least(p.n, q.n) AS overlap FROM met JOIN size p ON p.id = a JOIN size q ON q.id = b)"""
_SAME = f"(jaccard >= {E.jaccard} OR (shared >= {E.shared} AND overlap >= {E.overlap}))"
SIGNATURE_SIZES = f"WITH {_SIG} SELECT id, count(*) AS n, sum(df)::bigint AS df_sum FROM sig GROUP BY id"
EVENT_PAIRS = f"WITH {_PAIRS} SELECT * FROM pairs WHERE {_SAME}"
NEAR_MISS_PAIRS = f"WITH {_PAIRS} SELECT * FROM pairs WHERE jaccard < {E.jaccard} AND overlap >= {E.overlap}"
HISTORY_MATCHES = f"""WITH {_SIG},
known AS (SELECT item_id AS id, unnest(list_distinct(regexp_extract_all(text, '{LATIN.signature}'))) AS token FROM benchmark), ks AS (SELECT id, count(*) AS n FROM known GROUP BY id),
met AS (SELECT known.id AS a, sig.id AS b, count(*) AS shared FROM known JOIN sig ON sig.token = known.token GROUP BY known.id, sig.id),
p AS (SELECT a, b, shared, shared / (ks.n + size.n - shared) AS jaccard, shared / least(ks.n, size.n) AS overlap FROM met JOIN ks ON ks.id = a JOIN size ON size.id = b),
s AS (SELECT *, {_SAME} AS same FROM p)
SELECT a, row_number() OVER (PARTITION BY a ORDER BY same DESC, jaccard DESC, overlap DESC, b) AS rank, b, same, shared, jaccard, overlap FROM s QUALIFY rank <= 3"""
_CLUSTERS = f"""{_PAIRS},
near AS MATERIALIZED (SELECT b AS id, list(a) AS before FROM pairs WHERE {_SAME} GROUP BY b), placed AS MATERIALIZED (SELECT rec.id, row_number() OVER (ORDER BY rec.id) AS rn, coalesce(before, []) AS before FROM rec LEFT JOIN near ON near.id = rec.id),
scan AS (SELECT 0::bigint AS rn, []::bigint[] AS leaders UNION ALL SELECT p.rn, CASE WHEN list_has_any(leaders, before) THEN leaders ELSE list_append(leaders, p.id) END FROM scan JOIN placed p ON p.rn = scan.rn + 1),
final AS (SELECT leaders FROM scan ORDER BY rn DESC LIMIT 1),
grouped AS (SELECT id, CASE WHEN list_contains(leaders, id) THEN id ELSE list_min(list_intersect(before, leaders)) END AS leader FROM placed, final)"""
EVENT_CLUSTERS = f"WITH RECURSIVE {_CLUSTERS} SELECT id, leader FROM grouped"
CLUSTER_BONUS = f"""WITH RECURSIVE {_CLUSTERS},
m AS (SELECT rec.id, leader, regexp_matches(title, '[\\[\\(【][^\\]\\)】]{{0,11}}photo[^\\]\\)】]{{0,11}}[\\]\\)】]') AS caption, length(body) AS chars, {_types(WHOLE, LATIN.core)}::double AS score FROM rec JOIN grouped ON grouped.id = rec.id),
b AS (SELECT *, count(*) OVER (PARTITION BY leader) AS report_count, row_number() OVER (PARTITION BY leader ORDER BY caption, chars DESC, score DESC, id) AS rn FROM m)
SELECT leader, id, report_count, round(score * least(1 + {E.cluster_bonus} * (report_count - 1), {E.cluster_bonus_most}), 4) AS score FROM b WHERE rn = 1"""
_TOPICS = f"""{RECORDS},
rough AS (SELECT id, list_distinct(regexp_extract_all({WHOLE}, '{LATIN.signature}')) AS words, array_to_string(regexp_extract_all(title, '{LATIN.signature}'), chr(10)) AS stated FROM rec),
every AS (SELECT id, unnest(words) AS token, stated FROM rough), word AS (SELECT id, token, contains(stated, token) AS titled FROM every),
told AS MATERIALIZED (SELECT * FROM word WHERE token NOT IN (SELECT token FROM word GROUP BY token HAVING count(*) = (SELECT count(*) FROM rec) AND count(*) >= 4)),
edge AS MATERIALIZED (SELECT x.id AS a, y.id AS b FROM told x JOIN told y ON x.token = y.token AND x.id < y.id GROUP BY x.id, y.id HAVING count(*) >= 2 OR count(*) FILTER (x.titled AND y.titled) >= 1),
ends AS MATERIALIZED (SELECT a, b FROM edge UNION ALL SELECT b, a FROM edge),
reach AS (SELECT a AS id, least(a, min(b)) AS root FROM ends GROUP BY a UNION SELECT e.b, r.root FROM reach r JOIN ends e ON e.a = r.id),
topic AS (SELECT id, min(root) AS root FROM reach GROUP BY id)"""
TOPIC_COMPONENTS = f"WITH RECURSIVE {_TOPICS} SELECT id, root FROM topic"
BUNDLES = f"""WITH RECURSIVE {_TOPICS},
t AS (SELECT rec.id, coalesce(root, rec.id) AS root FROM rec LEFT JOIN topic ON topic.id = rec.id), p AS (SELECT id, root, (row_number() OVER (PARTITION BY root ORDER BY id) - 1) // 4 AS pack FROM t),
n AS (SELECT id, count(*) OVER w AS n, min(id) OVER w AS bundle FROM p WINDOW w AS (PARTITION BY root, pack)),
l AS (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 4 AS pack FROM n WHERE n < 4), d AS (SELECT id, count(*) OVER w AS n, min(id) OVER w AS bundle FROM l WINDOW w AS (PARTITION BY pack))
SELECT id, bundle, 'topic' AS kind FROM n WHERE n = 4 UNION ALL SELECT id, bundle, CASE WHEN n = 4 THEN 'daily' ELSE 'held' END FROM d"""

# --- vectors

_V = "v AS MATERIALIZED (SELECT vec_id AS id, label::bigint AS label, embedding::double[] AS v FROM embeddings), flat AS (SELECT id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v)"
_SUMS = f"{_V}, part AS (SELECT label, i, sum(x) AS x, count(*) AS n FROM flat GROUP BY label, i), total AS MATERIALIZED (SELECT label AS candidate, max(n) AS n, list(x ORDER BY i) AS total FROM part GROUP BY label)"
_BEST = """r AS (SELECT id, candidate, sim, row_number() OVER w AS rn, lead(sim) OVER w AS next FROM s WINDOW w AS (PARTITION BY id ORDER BY sim DESC, candidate))
SELECT id, candidate AS label, round(sim, 6) AS score, round(sim - coalesce(next, 0), 6) AS margin FROM r WHERE rn = 1"""


def _centroid(mean: str) -> str:
    return f"WITH {_SUMS}, m AS (SELECT v.id, candidate, {mean} AS mean, v FROM v, total), s AS (SELECT id, candidate, list_inner_product(mean, v) / sqrt(list_inner_product(mean, mean)) AS sim FROM m WHERE mean IS NOT NULL), {_BEST}"


_MEAN = "list_transform(total, lambda x: x / n)"
CENTROID_LABELS = _centroid(_MEAN)
CENTROID_LABELS_LOO = _centroid(f"CASE WHEN label <> candidate THEN {_MEAN} WHEN n > 1 THEN list_transform(list_zip(total, v), lambda p: (p[1] - p[2]) / (n - 1)) END")
_KNN = f"""{_V}, sims AS (SELECT a.id, b.label, list_inner_product(a.v, b.v) AS sim, row_number() OVER (PARTITION BY a.id ORDER BY list_inner_product(a.v, b.v) DESC, b.id) AS place FROM v a JOIN v b ON a.id <> b.id QUALIFY place <= 5),
votes AS (SELECT id, label AS candidate, sum(greatest(sim, 0)) AS w FROM sims GROUP BY id, label), s AS (SELECT id, candidate, coalesce(w / nullif(sum(w) OVER (PARTITION BY id), 0), 0) AS sim FROM votes)"""
KNN_LABELS = f"WITH {_KNN}, {_BEST}"
_TOLD = f"voted AS (WITH {_KNN}, {_BEST}), told AS (SELECT voted.id, vec.label::bigint AS truth, voted.label AS predicted, margin FROM voted JOIN embeddings vec ON vec.vec_id = voted.id)"
KNN_CONFUSION = f"WITH {_TOLD} SELECT truth, predicted, count(*) AS n FROM told GROUP BY ALL"
KNN_ADOPTION = f"""WITH {_TOLD}, placed AS (SELECT *, row_number() OVER (ORDER BY margin DESC, id) AS rn, count(*) OVER () AS total FROM told)
SELECT share, count(*) AS n, avg((truth = predicted)::int::double) AS accuracy FROM placed, (SELECT unnest([0.25, 0.5, 0.75, 1.0])::double AS share) WHERE rn <= round_even(total * share, 0) GROUP BY share"""
NEAR_EQUAL_VECTORS = f"WITH {_V}, s AS (SELECT a.id AS a, b.id AS b, list_inner_product(a.v, b.v) AS sim FROM v a JOIN v b ON a.id < b.id) SELECT a, b, round(sim, 6) AS sim FROM s WHERE sim > 0.4"
_PROBES = f"{_SUMS}, pair AS MATERIALIZED (SELECT candidate AS q, id AS i, round(list_inner_product({_MEAN}, v), 6) AS sim FROM v, total)"
PROBE_ASSIGNMENT = f"""WITH RECURSIVE {_PROBES},
pick AS (SELECT 0 AS step, []::bigint[] AS qs, []::bigint[] AS i_s, NULL::struct(s double, q bigint, i bigint) AS best
  UNION ALL SELECT step + 1, list_append(qs, best.q), list_append(i_s, best.i), best FROM (SELECT step, qs, i_s, min({{'s': -sim, 'q': q, 'i': i}}) AS best FROM (SELECT step, qs, i_s FROM pick) JOIN pair ON NOT list_contains(qs, q) AND NOT list_contains(i_s, i) WHERE sim >= 0.05 GROUP BY step, qs, i_s))
SELECT best.q AS q, best.i AS i, -best.s AS sim FROM pick WHERE step > 0"""
PROBE_COVERAGE = f"""WITH {_PROBES}, best AS (SELECT i, q FROM pair QUALIFY row_number() OVER (PARTITION BY i ORDER BY sim DESC, q) = 1),
probe AS (SELECT DISTINCT label AS probe FROM v UNION ALL SELECT unnest([90, 91])::bigint)
SELECT probe, count(i) AS n FROM probe LEFT JOIN best ON q = probe GROUP BY probe"""

# --- evaluation

VALUE_SPREAD = f"""WITH {_JUDGED}, m AS (SELECT min(core) FILTER (gate = 'ok') AS pass_min, max(core) FILTER (gate = 'ok') AS pass_max, min(core) FILTER (gate <> 'ok') AS fail_min, max(core) FILTER (gate <> 'ok') AS fail_max FROM judged)
SELECT *, CASE WHEN pass_min > fail_max THEN pass_min - fail_max END AS gap FROM m"""
LABEL_AGREEMENT = f"WITH {_JUDGED} SELECT lane, count(*) AS n, avg(((gate = 'ok')::int = quality)::int::double) AS agree FROM judged GROUP BY lane"
PRESS_SHARES = f"WITH {_FACTS}, j AS (SELECT press, {_gate()} AS gate FROM fact) SELECT press, count(*) AS n, count(*) FILTER (gate <> 'ok') AS rejected, count(*) FILTER (gate <> 'ok') / count(*) AS rate FROM j GROUP BY press"
NEWEST_BY_TYPE = "SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS rn, event_id FROM events QUALIFY rn <= 20"
REWRITES = f"""
WITH a AS (SELECT doc_id, text AS t0, replace(text, 'tion ', 'TION ') AS t1 FROM documents), b AS (SELECT *, replace(t1, ' the ', ' THE ') AS t2 FROM a)
SELECT doc_id, md5(replace(t2, 'ment', 'MENT')) AS digest, {_count('t0', 'tion ')} + {_count('t1', ' the ')} + {_count('t2', 'ment')} AS changed FROM b"""


# --- boards, drafts and state

_MARKED = "marked AS (SELECT doc_id, '# ' || replace(replace(replace(text, '*', ''), ' the ', ' **the** '), chr(10), chr(10) || '- ') || CASE WHEN doc_id % 3 = 0 THEN chr(10) || chr(10) || 'See you soon.' ELSE '' END AS text FROM documents)"
_RTRIM = lambda x: rf"regexp_replace({x}, '\s+$', '')"
POSTPROCESSED = rf"""WITH {_MARKED},
a AS (SELECT doc_id, text, regexp_replace(text, '(?m)^\s{{0,3}}#{{1,6}}\s+', '', 'g') AS t1 FROM marked),
b AS (SELECT *, regexp_replace(t1, '(?m)^(\s{{0,3}})[-*•]\s+', '\1', 'g') AS t2 FROM a), c AS (SELECT *, regexp_replace(t2, '\*\*(.+?)\*\*', '\1', 'g') AS t3 FROM b),
d AS (SELECT *, replace(t3, 'ment', 'MENT') AS t4 FROM c)
SELECT doc_id, {_count('text', r'(?m)^\s{0,3}#{1,6}\s+')} + {_count('t1', r'(?m)^\s{0,3}[-*•]\s+')} + {_count('t2', r'\*\*.+?\*\*')} AS residue, 0::bigint AS chapters, {_count('t3', 'ment')} AS style,
  md5(CASE WHEN ends_with({_RTRIM('t4')}, 'See you soon.') THEN t4 ELSE {_RTRIM('t4')} || chr(10) || chr(10) || 'See you soon.' END) AS digest FROM d"""
MEASURED_LENGTHS = f"""WITH {_MARKED}, m AS (SELECT doc_id, text, CASE WHEN ends_with({_RTRIM('text')}, 'See you soon.') THEN substr({_RTRIM('text')}, 1, length({_RTRIM('text')}) - 13) ELSE text END AS t FROM marked)
SELECT doc_id, {_PROSE('t')} AS chars, CASE WHEN length(text) > 1800 THEN 1801 ELSE length(text) END AS excerpt FROM m"""
_DRAFTS = f"""st AS ({DRAFT_STRUCTURE}),
bc AS (SELECT conv_id, turn, {_count('lower(text)', 'the best|ation|eaux')} AS claims, {_count('lower(text)', 'und|and the|de la')} AS filler, list_filter(list_transform({_lines('text')}, lambda x: length({_strip('x')})), lambda n: n > 0) AS sizes FROM conversations),
dr AS (SELECT bc.conv_id, bc.turn, claims > 0 AS blocked, claims + filler AS banned, warnings, chars, len(sizes) AS lines, len(list_filter(sizes, lambda n: n <= 20)) AS short, coalesce(list_max(sizes), 0) AS longest FROM bc JOIN st ON st.conv_id = bc.conv_id AND st.turn = bc.turn),
judged AS (SELECT *, CASE WHEN blocked THEN 'blocked' WHEN banned > 0 OR warnings <> '' THEN 'look' ELSE 'fine' END AS verdict FROM dr)"""
DRAFT_REPORT = f"WITH {_DRAFTS} SELECT * FROM judged"
DRAFT_SUMMARY = f"""WITH {_DRAFTS} SELECT count(*) AS drafts, round(avg(chars), 4) AS chars, round(sum(short) / sum(lines), 6) AS short_share, max(longest) AS longest, sum(banned)::bigint AS banned, count(*) FILTER (blocked) AS blocked,
  sum(CASE WHEN warnings = '' THEN 0 ELSE len(string_split(warnings, ',')) END)::bigint AS warnings FROM judged"""
PENDING_CONTENTS = """
WITH c AS (SELECT user_id AS id FROM events GROUP BY user_id HAVING arg_max(event_type, event_id) = 'click')
SELECT c.id, string_agg(doc_id || '/' || lang, ',' ORDER BY event_id DESC) AS articles FROM c JOIN events e ON e.user_id = c.id JOIN documents d ON d.doc_id = e.event_id GROUP BY c.id"""
CHANGED_STATUS = "SELECT doc_id AS id, coalesce(s, lang) AS status FROM documents LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS s FROM events GROUP BY user_id) u ON user_id = doc_id"
NAME_PARTS = rf"SELECT page_id, base, lower({_strip(r"regexp_replace(base, '[\s_-]+[0-9]{1,3}$', '')")}) AS series FROM (SELECT page_id, string_split(url, '/')[-1] AS base FROM pages)"
RECENTLY_USED = "SELECT user_id AS key FROM events WHERE event_type IN ('view', 'click') GROUP BY user_id HAVING max(ts) >= TIMESTAMP '2024-01-21'"
UNLISTED = "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"
SIZE_BUCKETS = """
WITH t AS (SELECT CASE WHEN n_chars < 1000 THEN 'small' WHEN n_chars > 4000 THEN 'oblong' ELSE 'fits' END AS size, source FROM documents),
g AS (SELECT CASE WHEN grouping(size) = 1 THEN 'all' ELSE size END AS size, CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source, count(*) AS n FROM t GROUP BY CUBE (size, source))
SELECT size, source, n, n / max(n) OVER (PARTITION BY source) AS share FROM g"""
LEFT_PLACES = "SELECT rn, event_id FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events) WHERE rn % 7 <> 0"
RECENT_EVENTS = "SELECT event_id FROM events WHERE event_type = 'error' OR ts >= TIMESTAMP '2024-01-22'"
STATE_STEP = """
WITH e AS (SELECT event_id, ts, event_type, event_type || '/' || floor(value)::bigint AS key, user_id::varchar AS u FROM events),
k AS (SELECT event_id AS seq, key FROM e WHERE event_type = 'view' UNION ALL SELECT event_id + (SELECT max(event_id) FROM e WHERE event_type = 'view') + 1, key FROM e WHERE event_type = 'click' AND key NOT IN (SELECT key FROM e WHERE event_type = 'view')),
r AS (SELECT 'key' AS part, key AS item FROM (SELECT * FROM k ORDER BY seq DESC LIMIT 5000)
  UNION ALL SELECT 'event', strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || least(key, u) || ' ' || greatest(key, u) FROM e WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-19'
  UNION ALL SELECT 'event', '2024-01-31 00:00:00 ' || least(key, u) || ' ' || greatest(key, u) FROM e WHERE event_type = 'click'
  UNION ALL SELECT 'watermark', strftime(greatest(max(ts), TIMESTAMP '2024-01-05'), '%Y-%m-%d %H:%M:%S') FROM e WHERE event_type = 'view')
SELECT part, item, count(*) AS n FROM r GROUP BY part, item"""
SEARCH_EXCLUDING = f"""WITH {_V}, s AS (SELECT a.id, b.id AS other, b.label, list_inner_product(a.v, b.v) AS sim FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 10 = 0 AND b.label NOT IN (1, 2, 3))
SELECT id, other, label, round(sim, 6) AS sim FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY s.sim DESC, other) <= 3"""


# --- lanes, pictures, replies, units

PICTURE_CREDITS = """
WITH p AS (SELECT string_split(url, '/')[3] AS host, page_id, lower(string_split(url, '/')[-1]) AS name FROM pages),
c AS (SELECT host, min(page_id) AS seen, CASE WHEN contains(name, 'utm_source') THEN 'Feed' WHEN regexp_matches(name, '^[0-9]') THEN 'Number' WHEN contains(name, 'html') THEN 'AI 생성 이미지' ELSE '' END AS credit FROM p GROUP BY ALL),
g AS (SELECT host, string_agg(credit, ', ' ORDER BY seen) FILTER (credit IN ('Feed', 'Number')) AS own, bool_or(credit LIKE 'AI%') AS drawn FROM c GROUP BY host)
SELECT host, CASE WHEN own IS NULL THEN CASE WHEN drawn THEN '삽화는 AI로 만들었어요.' ELSE '' END ELSE '이미지 출처: ' || own || CASE WHEN drawn THEN ' · 일부 삽화는 AI로 만들었어요.' ELSE '' END END AS line FROM g"""
ALT_TEXTS = f"""WITH {RECORDS}
SELECT id, {_strip("CASE WHEN title = '' THEN 'picture' ELSE title END")} || ' (' || array_to_string(string_split(body, ' ')[:3], ', ') || ')' || CASE WHEN quality = 0 THEN '' ELSE ' — AI 생성 이미지' END AS alt FROM rec LEFT JOIN labels ON doc_id = id"""


def _tidy(x: str, rounds: int = 4) -> str:
    for _ in range(rounds):
        x = rf"regexp_replace(regexp_replace({x}, '\s{{2,}}', ' ', 'g'), '\s+([,.])', '\1', 'g')"
        x = rf"regexp_replace({x}, '(^|[^\pL\pN_])(?:at|in|on|during|from|of|near|by)(?:\s+the)?(\s*[,.]|\s*$)', '\1\2', 'gi')"
        x = rf"trim(regexp_replace({x}, '(?:\s*,){{2,}}', ',', 'g'), ' ,.')"
    return x


FILTERED_PROMPTS = f"""
WITH t AS (SELECT conv_id, turn, text, list_transform(list_sort(list_transform(list_distinct(list_filter(list_transform(list_concat(['the', 'tion', 'x', ' an ', 'the'], string_split(text, ' ')[:2]), lambda w: {_strip("w")}), lambda w: length(w) >= 2)), lambda w: {{'n': -length(w), 't': w}})), lambda s: s.t) AS terms FROM conversations),
o AS (SELECT *, list_reduce(list_prepend(text, terms), lambda a, w: regexp_replace(a, regexp_escape(w), '', 'gi')) AS bare FROM t)
SELECT conv_id, turn, array_to_string(terms, '|') AS terms, CASE WHEN bare = text THEN trim(text, ' ,.') ELSE {_tidy("bare")} END AS text FROM o"""
LANE_SETTINGS = """
SELECT doc_id, 0 AS place, lang AS name, source || ',x' AS keywords, least(greatest(n_chars, 1), 100)::int AS display, greatest(doc_id, 1)::int AS lookback FROM documents
UNION ALL SELECT doc_id, 1, source, source, 30, 2 FROM documents"""
REPLY_LABELS = """
WITH t AS (SELECT doc_id // 20 AS batch, (doc_id % 20)::int AS i, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS label, toxic, quality FROM labels)
SELECT batch, i, label, substr(CASE WHEN quality = 1 THEN repeat(' good ', 12) ELSE repeat('bad', 12) END, 1, 40) AS why FROM t WHERE toxic = 0 AND i BETWEEN 1 AND 15"""
LABELS_KEPT = """
WITH t AS (SELECT user_id, arg_max(event_type, event_id) AS told FROM events GROUP BY user_id)
SELECT coalesce(doc_id, user_id) AS id, CASE WHEN toxic = 1 OR told IS NULL THEN quality::varchar ELSE told END AS label, CASE WHEN toxic = 1 THEN 'person' ELSE 'model' END AS by FROM labels FULL JOIN t ON doc_id = user_id"""
REALIGNED = """
WITH g AS (SELECT user_id, event_type, list(event_id ORDER BY event_id DESC) AS ids FROM events GROUP BY ALL)
SELECT user_id, event_type, array_to_string(ids[:2], ',') AS first, array_to_string(ids[3:], ',') AS rest FROM g"""
SKIP_REASONS = """
SELECT CASE WHEN event_type <> 'error' AND ts < TIMESTAMP '2024-01-11' THEN 'old' WHEN event_type = 'click' THEN 'done' WHEN value < 50 THEN 'small' ELSE 'open' END AS reason, count(*) AS n, count(*) FILTER (event_type = 'error') AS of_unknown_age FROM events GROUP BY 1"""
RESET_NOTICES = """
WITH b AS (SELECT d.doc_id AS id, lang, CASE WHEN l.doc_id IS NOT NULL THEN DATE '2024-01-01' + (d.doc_id % 60)::int END AS stamp FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT id, strftime(greatest(stamp, DATE '2024-01-31'), '%Y-%m-%d') AS stamp, CASE WHEN stamp >= DATE '2024-01-31' THEN lang ELSE 'nothing yet' END AS body FROM b"""
CACHED_TEXTS = """
WITH f AS (SELECT DISTINCT text FROM conversations WHERE turn = 0)
SELECT 'known' AS part, conv_id || '/' || turn AS item FROM conversations WHERE text IN (FROM f)
UNION ALL SELECT DISTINCT 'new', md5(text) FROM conversations WHERE text NOT IN (FROM f)"""
_SENTENCES = "s AS (SELECT conv_id * 1000 + turn AS id, unnest(string_split(text, '. ')) AS text, generate_subscripts(string_split(text, '. '), 1) - 1 AS sentence FROM conversations)"
_UNITS = f"""{_SENTENCES}, w AS (SELECT id, sentence, unnest(string_split(text, ' ')) AS lemma, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM s),
u AS (SELECT id, lemma, sentence * 100000 + pos AS start, CASE WHEN lemma LIKE '%tion' THEN 'NN' WHEN lemma LIKE '%ing' THEN 'VV' WHEN length(lemma) > 9 THEN 'NN' ELSE 'XX' END AS base FROM w WHERE lemma <> '')"""
UNIT_COUNTS = f"""WITH {_UNITS}
SELECT id, count(*) FILTER (base <> 'XX') AS tokens, count(DISTINCT lemma) FILTER (base <> 'XX') AS distinct_tokens, count(*) FILTER (base = 'NN') AS nouns,
  coalesce(round(count(DISTINCT lemma) FILTER (base <> 'XX') / nullif(count(*) FILTER (base <> 'XX'), 0), 6), 0.0) AS diversity FROM u GROUP BY id"""
UNIT_TOP_WORDS = f"""WITH {_UNITS}, g AS (SELECT id, lemma AS word, count(*) AS n, min(start) AS seen FROM u WHERE base <> 'XX' GROUP BY ALL)
SELECT id, row_number() OVER (PARTITION BY id ORDER BY n DESC, seen) AS rank, word, n, round(n / sum(n) OVER (PARTITION BY id), 6) AS density FROM g QUALIFY rank <= 3"""
TEXT_STYLES = f"""WITH {_SENTENCES},
k AS (SELECT *, {_strip("text")} AS bare FROM s), t AS (SELECT *, CASE WHEN regexp_matches(bare, '(tion|ment)$') THEN 'action' WHEN regexp_matches(bare, '(er|es|ed)$') THEN 'plain' WHEN regexp_matches(bare, 'ing$') THEN 'going' END AS style FROM k WHERE bare <> ''),
g AS (SELECT id, style, count(*) AS n, min(sentence) AS seen FROM t WHERE style IS NOT NULL GROUP BY ALL),
b AS (SELECT id, style, n / sum(n) OVER (PARTITION BY id) AS share FROM g QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, seen) = 1)
SELECT id, a.sentences, a.mean_length, coalesce(b.style, '') AS style, coalesce(round(b.share, 6), 0.0) AS consistency FROM (SELECT id, count(*) AS sentences, round(sum(length(text)) / count(*), 6) AS mean_length FROM t GROUP BY id) a LEFT JOIN b USING (id)"""
LEMMA_HITS = f"""WITH {_UNITS} SELECT id, start, start + 1 AS finish, lemma, CASE lemma WHEN 'ing' THEN 'claims' ELSE 'filler' END AS category, CASE lemma WHEN 'ing' THEN 'block' ELSE 'warn' END AS severity FROM u WHERE lemma IN ('tion', 'the', 'ing')"""
ARGUMENT_POLARITY = f"""
WITH {_SENTENCES}, w AS (SELECT id, sentence, unnest(string_split(text, ' ')) AS lemma, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM s),
u AS (SELECT *, CASE WHEN regexp_matches(lemma, '(tion|ment|er|es)$') THEN 'NN' WHEN length(lemma) < 5 THEN 'JK' ELSE 'XX' END AS tag, row_number() OVER (PARTITION BY id, sentence ORDER BY pos) AS nth FROM w WHERE lemma <> ''),
a AS (SELECT u.*, u.tag = 'NN' AND coalesce(n.tag = 'JK', false) AS arg FROM u LEFT JOIN u n ON n.id = u.id AND n.sentence = u.sentence AND n.nth = u.nth + 1),
v AS (SELECT *, CASE lemma WHEN 'und' THEN -1 ELSE 1 END AS direction FROM a WHERE lemma IN ('de', 'und', 'la')),
f AS (SELECT v.id, v.sentence, v.nth, v.pos AS verb_at, v.lemma AS verb, v.direction, max(p.pos) FILTER (p.arg AND p.nth BETWEEN v.nth - 8 AND v.nth - 1) AS noun_at, coalesce(bool_or(p.lemma IN ('que', 'the')) FILTER (p.nth BETWEEN v.nth + 1 AND v.nth + 2), false) AS negated
  FROM v JOIN a p ON p.id = v.id AND p.sentence = v.sentence GROUP BY ALL)
SELECT f.id, f.sentence, verb_at, verb, noun_at, n.lemma AS noun, negated, (CASE WHEN n.lemma = 'les' THEN 1 WHEN n.lemma = 'der' THEN -1 WHEN n.lemma IS NULL THEN 0 ELSE sign(length(n.lemma) % 3 - 1) END * direction * CASE WHEN negated THEN -1 ELSE 1 END)::int AS score
FROM f LEFT JOIN a n ON n.id = f.id AND n.sentence = f.sentence AND n.pos = f.noun_at"""
LANE_BUNDLES = """
WITH r AS (SELECT event_type AS lane, user_id, min(event_id) AS id, list(event_id) AS all_ids FROM events GROUP BY ALL),
n AS (SELECT *, (row_number() OVER (PARTITION BY lane ORDER BY id) - 1) // 4 AS pack FROM r),
b AS (SELECT lane, pack + 1 AS nth, min(id) AS bundle, string_agg(id, ',' ORDER BY id) AS ids, array_to_string(list_sort(flatten(list(all_ids))), ',') AS members, count(*) AS size FROM n GROUP BY lane, pack),
h AS (SELECT lane, sum(size) FILTER (size < 4 OR nth > 5) AS held FROM b GROUP BY lane)
SELECT lane, nth, bundle, lane || '#' || bundle || ' 외 3건' AS title, ids, members, coalesce(held, 0)::bigint AS held FROM b JOIN h USING (lane) WHERE size = 4 AND nth <= 5"""


_REPORT_SETTINGS = """c (st, md, title_min, title_max, body_min, min_chapters, short_share, max_paragraph, min_images, max_density, density_count, density_nouns, max_negative, max_sentence) AS (VALUES
  (0, false, 15, 40, 1600, 3, 0.9, 500, 3, 0.08, 3, 50, 0.35, 90.0), (1, false, 5, 60, 300, 0, 0.9, 500, 3, 0.08, 3, 50, 0.35, 90.0), (2, true, 15, 40, 1600, 3, 0.9, 200, 1, 0.08, 3, 50, 0.35, 90.0), (4, false, 15, 40, 1600, 3, 0.9, 500, 3, 0.02, 2, 5, 0.05, 40.0))"""
_CLOSE = "replace({}, ' ', '')"
QUALITY_REPORTS = rf"""
WITH {_UNITS}, {_REPORT_SETTINGS},
d AS (SELECT id, f || text AS text, CASE WHEN id % 3 <> 0 THEN 'ona' END AS key, id % 5 AS st, text AS own FROM (SELECT id, text, CASE id % 6 WHEN 2 THEN '## ' || substr(text, 1, 12) || chr(10) WHEN 3 THEN '# ' || substr(text, 1, 30) || chr(10)
    WHEN 4 THEN '![' || substr(text, 1, 15) || '](p.jpg)' || chr(10) || chr(10) WHEN 5 THEN '두 번째는 /* 소제목 */' || chr(10) || '- ' ELSE '' END AS f FROM (SELECT conv_id * 1000 + turn AS id, text FROM conversations))),
l AS (SELECT *, list_filter(list_transform({_lines("text")}, lambda x: {_strip("x")}), lambda x: x <> '') AS lines,
  list_filter(list_transform(regexp_split_to_array(regexp_replace(regexp_replace(text, '(?m)^\s{{0,3}}#{{1,6}}\s+.*$', '', 'g'), '!\[([^\]]*)\]\(([^)]*)\)', '', 'g'), '\n\s*\n'), lambda x: {_strip("regexp_replace(x, '[ ]*[" + chr(92) + "s]+', ' ', 'g')")}), lambda x: x <> '' AND x NOT LIKE '>%') AS blocks,
  list_transform(regexp_extract_all(text, '(?m)^\s{{0,3}}##\s+(.+)$', 1), lambda x: {_strip("x")}) AS h2, regexp_extract_all(text, '!\[([^\]]*)\]\(([^)]*)\)', 1) AS alts FROM d),
m AS (SELECT l.*, c.* EXCLUDE (st), coalesce(md, false) AS mark, CASE WHEN regexp_matches(text, '(?m)^\s{{0,3}}#\s+(.+)$') THEN {_strip("regexp_extract(text, '(?m)^" + chr(92) + "s{0,3}#" + chr(92) + "s+(.+)$', 1)")} ELSE lines[1] END AS title,
  list_transform(list_filter(lines, lambda x: contains(x, '/* 소제목 */')), lambda x: trim(replace(x, '/* 소제목 */', ''))) AS marked, list_filter(lines, lambda x: regexp_matches(x, '^(두) 번째는')) AS ordinal,
  list_filter(lines, lambda x: regexp_matches(x, '^[0-9]{{1,2}}[.)]?(\s|$)') AND NOT regexp_full_match(x, '[0-9]{{1,2}}')) AS numbered FROM l LEFT JOIN c ON c.st = l.st),
n AS (SELECT *, CASE WHEN mark THEN h2 WHEN len(marked) > 0 THEN marked WHEN len(ordinal) > 0 THEN ordinal ELSE numbered END AS chapters, list_sum(list_transform(lines, lambda x: length(x)))::bigint AS body_chars, len(lines) AS lines_, list_max(list_transform(lines, lambda x: length(x))) AS longest_line,
  len(list_filter(lines, lambda x: length(x) <= 20)) / len(lines) AS share, len(regexp_extract_all(text, '(?m)^\s{{0,3}}#{{1,6}}\s+.*$')) AS headings, len(regexp_extract_all(text, '(?m)^\s{{0,3}}[-*•]\s+')) AS bullets,
  coalesce(list_max(list_transform(blocks, lambda x: length(x))), 0) AS longest_paragraph, {_CLOSE.format("title")} AS close_title, {_CLOSE.format("array_to_string(blocks[1:2], ' ')")} AS intro FROM m),
e AS (SELECT *, CASE WHEN key IS NOT NULL THEN contains(close_title, key) END AS in_title, CASE WHEN key IS NOT NULL THEN strpos(close_title, key) BETWEEN 1 AND 16 END AS in_head, CASE WHEN key IS NOT NULL THEN contains(intro, key) END AS in_intro,
  CASE WHEN key IS NOT NULL THEN len(list_filter(chapters, lambda x: contains({_CLOSE.format("x")}, key))) END AS in_chapters FROM n),
wc AS (SELECT id, count(*) FILTER (base <> 'XX') AS tokens, count(*) FILTER (base = 'NN') AS nouns, coalesce(round(count(DISTINCT lemma) FILTER (base <> 'XX') / nullif(count(*) FILTER (base <> 'XX'), 0), 6), 0.0) AS diversity FROM u GROUP BY id),
tg AS (SELECT id, lemma AS word, count(*) AS n, min(start) AS seen FROM u WHERE base <> 'XX' GROUP BY ALL),
tw AS (SELECT id, word, n, round(n / sum(n) OVER (PARTITION BY id), 6) AS density, row_number() OVER (PARTITION BY id ORDER BY n DESC, seen) AS rank FROM tg),
tk AS (SELECT tw.id, list('overused ' || word || ' ' || n ORDER BY rank) AS often FROM tw JOIN e USING (id) JOIN wc USING (id) WHERE rank <= 15 AND nouns >= density_nouns AND density > max_density AND n >= density_count GROUP BY tw.id),
sk AS (SELECT *, {_strip("text")} AS bare FROM s), st AS (SELECT *, CASE WHEN regexp_matches(bare, '(tion|ment)$') THEN 'action' WHEN regexp_matches(bare, '(er|es|ed)$') THEN 'plain' WHEN regexp_matches(bare, 'ing$') THEN 'going' END AS style FROM sk WHERE bare <> ''),
sg AS (SELECT id, style, count(*) AS n, min(sentence) AS seen FROM st WHERE style IS NOT NULL GROUP BY ALL),
sb AS (SELECT id, style, n / sum(n) OVER (PARTITION BY id) AS share FROM sg QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, seen) = 1),
ss AS (SELECT id, a.mean_length, coalesce(sb.style, '') AS style, coalesce(round(sb.share, 6), 0.0) AS consistency FROM (SELECT id, round(sum(length(text)) / count(*), 6) AS mean_length FROM st GROUP BY id) a LEFT JOIN sb USING (id)),
sw AS (SELECT id, regexp_extract_all(lower(text), '\p{{L}}+') AS words FROM s),
sn AS (SELECT id, round(count(*) FILTER (len(list_filter(words, lambda x: x IN ('de', 'und'))) - len(list_filter(words, lambda x: x IN ('the', 'que'))) < -0.5) / count(*), 4) AS negative FROM sw GROUP BY id),
b AS (SELECT id, len(regexp_extract_all(lower(text), 'ationi|eaux')) AS block, len(regexp_extract_all(lower(text), 'und|and the|de la')) AS warn FROM d),
x AS (SELECT e.*, st IS NOT NULL AND md IS NULL AS broken, block, block + warn AS banned, tokens, diversity, mean_length, style, consistency, negative, coalesce(often, []) AS often FROM e LEFT JOIN wc USING (id) LEFT JOIN tk USING (id) LEFT JOIN ss USING (id) LEFT JOIN sn USING (id) JOIN b USING (id)),
y AS (SELECT *, list_concat(often, list_filter([CASE WHEN tokens > 0 AND diversity < 0.35 THEN 'few different words' END, CASE WHEN style <> '' AND consistency < 0.9 THEN 'mixed style ' || style END, CASE WHEN negative > max_negative THEN 'negative' END,
  CASE WHEN mean_length > max_sentence THEN 'long sentences' END], lambda z: z IS NOT NULL), list_transform(list_filter(list_concat([CASE WHEN length(title) < title_min THEN 'title short ' || length(title) END, CASE WHEN length(title) > title_max THEN 'title long ' || length(title) END,
  CASE WHEN body_chars < body_min THEN 'body short ' || body_chars END, CASE WHEN body_chars > 2800 THEN 'body long ' || body_chars END, CASE WHEN len(chapters) < min_chapters THEN 'chapters ' || len(chapters) END, CASE WHEN NOT mark AND len(chapters) < min_chapters AND len(ordinal) >= min_chapters THEN 'chapters unmarked ' || len(ordinal) END,
  CASE WHEN NOT mark AND headings > 0 THEN 'headings ' || headings END, CASE WHEN NOT mark AND bullets > 0 THEN 'bullets ' || bullets END, CASE WHEN NOT mark AND round(share, 4) < 0.9 THEN 'long lines ' || longest_line END,
  CASE WHEN mark AND len(list_filter(blocks, lambda z: length(z) > max_paragraph)) > 0 THEN 'long paragraphs ' || len(list_filter(blocks, lambda z: length(z) > max_paragraph)) END, CASE WHEN mark AND len(alts) < min_images THEN 'images ' || len(alts) END],
  CASE WHEN mark THEN list_transform(alts, lambda z: CASE WHEN trim(z) = '' THEN 'alt empty' WHEN length(trim(z)) < 20 THEN 'alt short ' || length(trim(z)) END) ELSE [] END, [CASE WHEN NOT in_title THEN 'keyword not in title' END, CASE WHEN NOT in_intro THEN 'keyword not in intro' END]), lambda z: z IS NOT NULL), lambda z: 'structure: ' || z)) AS warnings FROM x)
SELECT id, CASE WHEN broken THEN 'settings' END AS error, CASE WHEN NOT broken THEN block = 0 END AS passed, CASE WHEN NOT broken THEN banned END AS banned, CASE WHEN NOT broken THEN array_to_string(warnings, '; ') END AS warnings, CASE WHEN NOT broken THEN title END AS title,
  CASE WHEN NOT broken THEN array_to_string(chapters, '; ') END AS chapters, CASE WHEN NOT broken THEN body_chars END AS body_chars, CASE WHEN NOT broken THEN lines_ END AS lines, CASE WHEN NOT broken THEN round(share, 4) END AS short_share, CASE WHEN NOT broken THEN longest_line END AS longest_line,
  CASE WHEN NOT broken THEN headings END AS headings, CASE WHEN NOT broken THEN bullets END AS bullets, CASE WHEN NOT broken THEN len(alts) END AS images, CASE WHEN NOT broken THEN len(blocks) END AS paragraphs, CASE WHEN NOT broken THEN longest_paragraph END AS longest_paragraph,
  CASE WHEN NOT broken THEN in_title END AS in_title, CASE WHEN NOT broken THEN in_head END AS in_head, CASE WHEN NOT broken THEN in_intro END AS in_intro, CASE WHEN NOT broken THEN in_chapters END AS in_chapters, CASE WHEN NOT broken THEN diversity END AS diversity,
  CASE WHEN NOT broken THEN style END AS style, CASE WHEN NOT broken THEN consistency END AS consistency, CASE WHEN NOT broken THEN mean_length END AS mean_length, CASE WHEN NOT broken THEN negative END AS negative FROM y"""


_WORDS, _POINTS = "len(regexp_extract_all({}, '[A-Za-z0-9'']+'))", "len(regexp_extract_all({}, '[,.:;()-]'))"


def _tokens_of(x: str) -> str:
    return f"(round_even({_WORDS.format(x)} * 1.3::double, 0) + {_POINTS.format(x)})::bigint"


_T = drafting.TEXTS
_PART = lambda p, t, when="true": f"CASE WHEN {when} THEN {{'p': {p}, 't': {t}}} END"
_CHOICE = " ".join(f"WHEN {_tokens_of(f't{p}')} <= 40 OR n{p} <= 2 THEN t{p}" for p in range(7, 0, -1))
PROMPTS = f"""
WITH t AS (SELECT conv_id * 1000 + turn AS id, turn % 2 = 0 AS person, (conv_id * 1000 + turn) % 3 <> 0 AS own, role, text, {_strip("regexp_replace(" + _strip("split_part(text, '.', 1)") + ", '[.]+$', '')")} AS scene, coalesce(string_split(text, ' ')[2], '') AS mood FROM conversations),
p AS (SELECT id, CASE WHEN scene = '' THEN [] ELSE list_filter([{_PART(1, "scene")}, {_PART(2, f"'{_T['dress']}'", "own AND person")}, {_PART(4, f"'{_T['place']}'", "own AND person AND NOT regexp_matches(lower(scene), 'wall|ation')")},
  {_PART(2, f"'{_T['setting']}'", "own AND NOT person AND NOT regexp_matches(lower(scene), 'tion|eaux')")}, {_PART(3, f"CASE WHEN person THEN '{_T['somebody']}' ELSE '{_T['nobody']}' END")}, {_PART(5, f"'{_T['style']}'")},
  {_PART(6, _strip("regexp_replace(" + _strip("mood") + ", '[.]+$', '')"), "mood <> ''")}, {_PART(7, "role || ' shot'")}], lambda x: x IS NOT NULL) END AS parts FROM t),
q AS (SELECT id, {", ".join(f"array_to_string(list_transform(list_filter(parts, lambda x: x.p <= {k}), lambda x: x.t), ', ') AS t{k}, len(list_filter(parts, lambda x: x.p <= {k})) AS n{k}" for k in range(1, 8))} FROM p),
r AS (SELECT id, CASE {_CHOICE} ELSE t1 END AS prompt FROM q)
SELECT id, prompt, {_tokens_of("prompt")} AS tokens FROM r"""
NEGATIVE_PROMPTS = f"""
WITH w AS (SELECT conv_id * 1000 + turn AS id, turn, list_filter(list_transform(string_split(text, ' '), lambda x: {_strip("x")}), lambda x: x <> '') AS asked FROM conversations),
f AS (SELECT id, {list(drafting.FIXED)} AS fixed, list_filter(asked, lambda x, i: list_position(list_transform(asked, lambda y: lower(y)), lower(x)) = i AND NOT list_contains({list(drafting.FIXED)}, lower(x)) AND NOT (turn % 2 = 0 AND list_contains({list(drafting.CONFLICTS)}, lower(x)))) AS more FROM w),
n AS (SELECT id, list_concat(fixed, more) AS terms, unnest(range(1, len(fixed) + len(more) + 1)) AS k FROM f),
c AS (SELECT id, array_to_string(terms[1:k], ', ') AS prompt, k FROM n)
SELECT id, prompt, k::int AS terms FROM c WHERE k <= 7 OR {_tokens_of("prompt")} <= 30 QUALIFY row_number() OVER (PARTITION BY id ORDER BY k DESC) = 1"""
CHAPTER_SHARES = """
WITH l AS (SELECT doc_id, list_transform(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> ''), lambda x: length(x)) AS lines, greatest(900, least(1800, floor(length(coalesce(text, '')) * 1.8)::int)) AS target FROM documents),
i AS (SELECT doc_id, target, unnest(lines[1:12]) AS x, generate_subscripts(lines[1:12], 1) AS i, least(len(lines), 12) AS n FROM l),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY x DESC, i DESC) AS rn, sum(x) OVER (PARTITION BY doc_id ORDER BY x DESC, i DESC) - x AS above FROM i),
m AS (SELECT doc_id, coalesce(min(rn) FILTER (x * (n - rn + 1) <= target - above), any_value(n) + 1) AS stop FROM o GROUP BY doc_id),
s AS (SELECT o.*, rn >= stop AS shares, target - coalesce(sum(x) FILTER (rn < stop) OVER (PARTITION BY o.doc_id), 0) AS rest, n - stop + 1 AS many, sum((rn >= stop)::int) OVER (PARTITION BY o.doc_id ORDER BY i) AS nth FROM o JOIN m ON m.doc_id = o.doc_id),
z AS (SELECT doc_id, string_agg(CASE WHEN shares THEN rest // many + (nth <= rest % many)::int ELSE x END::bigint::varchar, ',' ORDER BY i) AS shares FROM s GROUP BY doc_id)
SELECT l.doc_id, CASE WHEN len(lines) > 0 THEN greatest(100, floor((target - 650) / len(lines)))::bigint END AS share, coalesce(z.shares, '') AS shares FROM l LEFT JOIN z ON z.doc_id = l.doc_id"""
VOTE_SWEEP = f"""
WITH {_V}, near AS MATERIALIZED (SELECT a.id, a.label AS truth, b.label, greatest(list_inner_product(a.v, b.v), 0) AS w, row_number() OVER (PARTITION BY a.id ORDER BY list_inner_product(a.v, b.v) DESC, b.id) AS place FROM v a JOIN v b ON a.id <> b.id QUALIFY place <= 9),
votes AS (SELECT id, truth, k, label, sum(w) AS w FROM near JOIN (SELECT unnest([1, 3, 5, 9]) AS k) g ON place <= k GROUP BY ALL),
shares AS (SELECT *, coalesce(w / nullif(sum(w) OVER (PARTITION BY id, k), 0), 0) AS sim FROM votes),
told AS (SELECT id, truth, k, label, sim - coalesce(lead(sim) OVER (PARTITION BY id, k ORDER BY sim DESC, label), 0) AS margin, row_number() OVER (PARTITION BY id, k ORDER BY sim DESC, label) AS rn FROM shares),
means AS ({CENTROID_LABELS_LOO})
SELECT 'votes' AS method, k::bigint AS k, count(*) AS n, count(*) FILTER (label = truth) AS correct, count(*) FILTER (label = truth AND margin >= 0.1) AS sure FROM told WHERE rn = 1 GROUP BY k
UNION ALL SELECT 'means', NULL, count(*), count(*) FILTER (means.label = v.label), count(*) FILTER (means.label = v.label AND margin >= 0.1) FROM means JOIN v ON v.id = means.id"""
LABEL_STORE = f"""
WITH u AS (SELECT * FROM ({URL_KEYS})), p AS (SELECT pages.page_id, canonical AS key FROM pages JOIN u ON u.page_id = pages.page_id),
a AS (SELECT key, 'l' || (page_id % 4) AS label, page_id % 2 AS batch, page_id FROM p UNION ALL SELECT key, 'again', 2, page_id FROM p WHERE page_id % 4 < 2),
z AS (SELECT key, label FROM a QUALIFY row_number() OVER (PARTITION BY key ORDER BY batch DESC, page_id DESC) = 1)
SELECT label, count(*) AS n, count(DISTINCT key) AS keys FROM z GROUP BY label"""


# --- archives, state files, marks and contexts

CSV_ARCHIVE = f"""
WITH u AS ({URL_KEYS}), p AS (SELECT pages.*, canonical FROM pages JOIN u ON u.page_id = pages.page_id)
SELECT url, 'say "' || page_id || '",' || chr(10) || 'line' AS title, '1+2' AS subtopics, page_id % 9 AS search_rank, 0 AS score_norm FROM p QUALIFY row_number() OVER (PARTITION BY canonical ORDER BY page_id) = 1"""
SEARCH_HITS = """
WITH r AS (SELECT 'k' || (page_id % 3) AS search_keyword, row_number() OVER (PARTITION BY page_id % 3 ORDER BY page_id) AS search_rank, page_id, CASE WHEN page_id % 5 <> 0 THEN url WHEN page_id % 10 <> 0 THEN 'http://link/' || page_id END AS url FROM pages)
SELECT search_keyword, search_rank, 'p ' || page_id AS title, url, 'd & e' AS summary, '2024-01-01T09:00:00+09:00' AS published FROM r WHERE url <> ''"""
STATE_FILE = """
WITH e AS (SELECT * FROM events WHERE user_id = 1)
SELECT 0 AS file, 'processed' AS part, 'view/' || event_id AS item FROM e WHERE event_type = 'view' UNION ALL SELECT 0, 'event', 'click+click/' || event_id FROM e WHERE event_type = 'click' AND event_id % 2 = 0
UNION ALL SELECT 0, 'held', 'error/' || event_id FROM e WHERE event_type = 'error' AND event_id % 3 > 0 UNION ALL SELECT 0, 'watermark', strftime(max(ts), '%Y-%m-%d') FROM e HAVING count(*) > 0"""
LATEST_PUBLISHED = "SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest FROM events WHERE event_id % 4 > 0 GROUP BY event_type"
HISTORY_KEYS = "SELECT event_type || '/' || floor(value)::bigint AS key, 1 AS n FROM events GROUP BY ALL"
WINDOWED_EVENTS = """
WITH w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS s, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT strftime(s, '%Y-%m-%d %H') AS start, event_type, n FROM w WHERE s + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""
DECODED_TEXTS = "SELECT doc_id, md5('가나다라마바사아자차카타 ' || coalesce(text, '')) AS digest FROM documents"
_BARE = "regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"
for _tag in ("head", "script", "style", "noscript", "nav", "header", "footer", "aside", "form"):
    _BARE = rf"regexp_replace({_BARE}, '(?is)<{_tag}\b[^>]*>.*?</{_tag}\s*>', '', 'g')"
_LINE = lambda x: _strip(rf"regexp_replace({_untagged(x)}, '\s+', ' ', 'g')")
_KEPT = lambda least, links: f"array_to_string(list_transform(list_filter(bs, lambda b: length(b.text) >= {least} AND b.linked <= {links}::double * length(b.text)), lambda b: b.text), chr(10))"
ARTICLE_BODIES = rf"""
WITH s AS (SELECT page_id, regexp_split_to_array({_BARE}, '(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|tr|td|table|section|article|main|blockquote|figure|figcaption|body|html)\b[^>]*>') AS parts FROM pages),
b AS (SELECT page_id, list_filter(list_transform(parts, lambda x: {{'text': {_LINE("x")}, 'linked': coalesce(list_sum(list_transform(regexp_extract_all(x, '(?is)<a\b[^>]*>(.*?)</a\s*>', 1), lambda t: length({_LINE("t")}))), 0)}}), lambda b: b.text <> '') AS bs FROM s),
k AS (SELECT page_id, len(bs) AS blocks, {_KEPT(40, 0.2)} AS strict, {_KEPT(10, 0.5)} AS loose FROM b),
a AS (SELECT *, CASE WHEN length(strict) < 250 AND length(loose) > length(strict) THEN loose ELSE strict END AS body FROM k)
SELECT page_id, blocks, length(body) AS chars, md5(body) AS digest, CASE WHEN page_id % 3 > 0 THEN 'own' ELSE 'Press ' || (page_id % 7) END AS press, CASE WHEN page_id % 2 > 0 THEN 'then' ELSE '2024-01-0' || (page_id % 9 + 1) END AS published FROM a"""
UNESCAPED_TEXTS = "SELECT conv_id, turn, md5(replace(text, 'e', 'éA&lt;')) AS digest FROM conversations"
KEPT_RECORDS = r"""
WITH b AS (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN translate(text, 'eaionrtsdlu', '가나다라마바사아자차카') ELSE translate(text, 'e', '가') END AS b FROM documents),
s AS (SELECT doc_id, b, regexp_replace(regexp_replace(b, 'https?://\S+|www\.\S+', ' ', 'g'), '[\p{L}\p{N}_.\-]+@[\p{L}\p{N}_.\-]+\.[\p{L}\p{N}_]+', ' ', 'g') AS t FROM b),
c AS (SELECT doc_id, length(b) AS n, len(regexp_extract_all(t, '[가-힣]')) AS h, len(regexp_extract_all(t, '[A-Za-z]')) AS a FROM s)
SELECT doc_id FROM c WHERE n >= 100 AND h + a > 0 AND h / (h + a) >= 0.5"""
MATCH_CONTEXTS = f"""
WITH p AS ({BANNED_PLACES}), q AS (SELECT id, start, text, greatest(start - 20, 0) AS a, least(finish + 20, length(text)) AS b FROM p JOIN documents ON doc_id = id)
SELECT id, start, CASE WHEN a > 0 THEN '…' ELSE '' END || substr(text, a + 1, b - a) || CASE WHEN b < length(text) THEN '…' ELSE '' END AS context FROM q"""
SECTION_HEADINGS = f"""
WITH l AS (SELECT doc_id AS id, {_lines("coalesce(text, '')")} AS x FROM documents), i AS (SELECT id, x, unnest(range(len(x))) AS place FROM l),
h AS (SELECT id, place, trim({_strip("x[place + 1]")} || ' ' || {_strip("coalesce(x[place + 2], '')")}) AS heading FROM i WHERE place % 5 = 1)
SELECT id, place, md5(heading) AS digest FROM h WHERE heading <> ''"""
SOURCE_SIZES = f"""
WITH {RECORDS}, s AS (SELECT *, CASE WHEN id % 4 = 0 THEN list_filter(string_split(title, ' ')[1:3], lambda x: x <> '') ELSE [] END AS sub FROM rec),
c AS (SELECT press, lane, len(sub) AS s, length({_strip("body")}) + length(title) + coalesce(list_sum(list_transform(sub, lambda x: length(x))), 0) AS chars FROM s)
SELECT press, lane, CASE WHEN sum(s) > 0 THEN sum(s) ELSE count(*) END::bigint AS chapters, sum(chars)::bigint AS chars FROM c GROUP BY press, lane"""
_GENERIC = tuple(w for w in LATIN.generic if w not in LATIN.core)
GATE_REASONS = f"""
WITH {_FACTS}, g AS (SELECT fact.id, {_gate()} AS gate, whole FROM fact JOIN sq ON sq.id = fact.id),
w AS (SELECT unnest({list(LATIN.core)}) AS word, 'core' AS kind UNION ALL SELECT unnest({list(_GENERIC)}), 'generic'),
f AS (SELECT g.id, kind, word, CASE WHEN kind = 'core' THEN replace(substr(whole, greatest(strpos(whole, word) - 1 - 12, 0) + 1, least(strpos(whole, word) - 1 + length(word) + 12, length(whole)) - greatest(strpos(whole, word) - 1 - 12, 0)), chr(10), ' ') END AS place FROM g JOIN w ON contains(whole, word))
SELECT g.id, gate, f.kind, f.word, f.place FROM g LEFT JOIN f ON f.id = g.id"""
_HOLDING = lambda x, words: f"len(list_filter(list_distinct({x}), lambda t: regexp_matches(t, '{'|'.join(words)}')))"
COUNTING_DIFFERENCES = f"""
WITH {_FACTS}, old AS (SELECT fact.* EXCLUDE (core, hits, titled), {_HOLDING(_tokens("whole"), LATIN.core)} AS core, {_HOLDING(_tokens("whole"), LATIN.core + _GENERIC)} AS hits, {_HOLDING(_tokens("title"), LATIN.core)} > 0 AS titled FROM fact JOIN sq ON sq.id = fact.id)
SELECT a.id, a.core, b.core AS core_by_token, a.hits, b.hits AS hits_by_token, a.gate, b.gate AS gate_by_token FROM (SELECT *, {_gate()} AS gate FROM fact) a JOIN (SELECT *, {_gate()} AS gate FROM old) b ON a.id = b.id"""
QUOTA_ERRORS = """
SELECT event_id, CASE event_type WHEN 'view' THEN 'RequestsPerDayPerModel' WHEN 'click' THEN 'RequestsPerMinute' ELSE 'Tokens' END AS ids, event_type = 'view' AS daily, event_type = 'click' AS minute, event_id % 3 = 0 AS none_left,
  CASE WHEN event_id % 2 = 0 THEN event_id % 50 + 1.5::double END AS wait FROM events"""
MARK_VERDICTS = """
WITH d AS (SELECT doc_id, doc_id % 6 AS m, CASE WHEN doc_id % 2 = 1 THEN 3 ELSE 0 END + CASE WHEN doc_id % 3 = 1 THEN 4 ELSE 0 END AS own, CASE WHEN doc_id % 5 = 1 THEN 5 ELSE 0 END AS rival FROM documents),
v AS (SELECT *, CASE WHEN m = 2 THEN ['held', 'no mark'] WHEN m = 1 THEN ['rejected', CASE WHEN doc_id % 4 = 0 THEN 'blurred' ELSE 'no reason' END] WHEN m = 0 THEN ['accepted', 'seen'] WHEN doc_id % 11 = 3 THEN ['rejected', 'people'] WHEN doc_id % 13 = 5 THEN ['rejected', 'worn wrong']
  WHEN own = 0 AND rival = 0 THEN ['held', 'no signals'] WHEN own >= 5 AND own - rival >= 3 THEN ['accepted', own || ' / ' || rival] WHEN own >= 3 THEN ['held', own || ' / ' || rival] ELSE ['rejected', own || ' / ' || rival] END AS r FROM d)
SELECT doc_id, CASE m WHEN 0 THEN 'pass' WHEN 1 THEN 'fail' WHEN 2 THEN 'blank' ELSE 'doubt' END AS mark, r[1] AS verdict, r[2] AS reason FROM v"""
MODEL_TURNS = """
WITH c AS (SELECT event_id, event_type, user_id, CASE event_id % 3 WHEN 0 THEN ['m0', 'm1', 'm2'] WHEN 1 THEN ['m1', 'm2'] ELSE ['m2', 'm1'] END AS c FROM events)
SELECT event_id, array_to_string(list_filter(c, lambda m: NOT (event_type = 'view' AND m = 'm1')), ',') AS tried, ['a', 'b', 'c'][((user_id - 70) % 3 + 3) % 3 + 1] AS turn FROM c"""
SENTIMENT_LEXICON = """
WITH d AS (SELECT doc_id, split_part(text, ' ', 1) AS word, (doc_id % 7 - 3)::int AS score, length(source) * 10 + doc_id % 3 AS priority FROM documents)
SELECT word, score FROM d WHERE word NOT IN (SELECT word FROM d JOIN labels ON labels.doc_id = d.doc_id WHERE toxic = 1) QUALIFY row_number() OVER (PARTITION BY word ORDER BY priority DESC, abs(score) DESC, score DESC) = 1"""
PROVENANCE_CREDITS = """
WITH p AS (SELECT page_id, string_split(url, '/')[-1] AS name FROM pages), r AS (SELECT name, min(page_id) AS pos FROM p WHERE page_id % 3 = 0 GROUP BY name)
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'AI 생성 이미지' WHEN page_id % 5 = 0 THEN '' WHEN pos % 4 = 0 THEN 'Lens' WHEN pos % 8 = 1 THEN 'The Museum' WHEN pos % 4 = 1 THEN 'Commons' WHEN pos % 4 = 2 THEN 'AI 생성 이미지'
  WHEN contains(lower(p.name), 'utm_source') THEN 'Feed' WHEN regexp_matches(lower(p.name), '^[0-9]') THEN 'Number' ELSE '' END AS credit FROM p LEFT JOIN r ON r.name = p.name"""
SELECT_OPTIONS = """
WITH h AS (SELECT source AS old, CASE source WHEN 'src1' THEN 'de' WHEN 'src2' THEN 'fresh' WHEN 'src3' THEN CASE WHEN 'src2' NOT IN (SELECT source FROM documents) THEN 'fresh' END END AS fresh, min(doc_id) AS pos FROM documents GROUP BY source),
k AS (SELECT 0 AS part, pos, coalesce(fresh, old) AS name, CASE WHEN fresh IS NOT NULL THEN old END AS change FROM h), w AS (SELECT lang AS name, min(doc_id) AS pos FROM documents GROUP BY lang),
a AS (SELECT * FROM k UNION ALL SELECT 1, pos, name, '+' FROM w WHERE name NOT IN (SELECT name FROM k))
SELECT row_number() OVER (ORDER BY part, pos, name) - 1 AS pos, name, change FROM a"""


def oracle_sql() -> dict[str, str]:
    """Names without SQL: plain_markdown (back-references); flagship_select, lane_selection, lane_sweep and fallback_assignment
    (many rounds, tested against plain versions)."""
    return {k.lower(): v for k, v in globals().items() if k.isupper() and not k.startswith("_") and isinstance(v, str) and k not in ("RECORDS", "WHOLE", "G", "E", "T")} | scans.oracle_sql()
