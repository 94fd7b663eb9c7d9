"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import divergence, merkle, mixing, ngram_lm, packing, pieces, secrets, subword, toxicity, vectors, warc
from gristmill.llm.common import table
from gristmill.llm.near_dedup import near_duplicates


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), capacity=1024)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, cap=2.0)
    return mix.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.exact_topk(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.report(table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"), least_docs=3, top=200)


def op12_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_best_fit_packing, op2_near_dedup, op3_toxicity, op4_secret_scan, op5_quality, op6_source_mixing, op7_exact_topk, op8_warc, op9_lm_scoring, op10_nearest, op11_source_divergence, op12_piece_encoding, op13_merkle_manifest)}


OP7_SQL = """
WITH u AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) AS z FROM u),
q AS (SELECT vec_id, list_transform(min(embedding), lambda x: floor(256 * x::double)) AS z FROM u WHERE vec_id % 50 = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.z, c.z)::bigint AS score FROM q JOIN v c ON q.vec_id <> c.vec_id),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::int AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(t, {LETTERS}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*)::hugeint AS v, sum(n)::hugeint AS n FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
g AS (SELECT d.lang, d.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0)::hugeint AS n FROM (SELECT DISTINCT lang, source FROM d) d),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::hugeint * (coalesce(c.n, 0) + 1) // (g.n + l.v) AS p, 1 + 1000000000::hugeint * (k.n + 1) // (l.n + l.v) AS q
  FROM g JOIN l ON g.lang = l.lang JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
b AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(b.value, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN b ON b.lang = x.lang AND b.source = x.source AND b.item = y.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM a)
SELECT lang, source, part, item, value::bigint AS value, rank::int AS rank FROM r WHERE part = 'pair' OR rank <= 200"""


def _op13_sql(levels: int = 6, upper: int = 4) -> str:
    """Levels are written out: up to 16 ** levels rows of a source, and 16 ** upper sources."""

    def storeys(name: str, n: int) -> list[str]:
        """Tables name0 to name<n> of nodes (g, pos, h, alone, l, r): l and r are the siblings, joined; alone: the tree ends here."""
        out = []
        for k in range(n + 1):
            made = f"{name}_" if k == 0 else f"(SELECT g, pos // 16 AS pos, CASE WHEN bool_and(alone) THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {name}{k - 1} GROUP BY g, pos // 16)"
            run = "OVER (PARTITION BY g, pos // 16 ORDER BY pos ROWS BETWEEN"
            out.append(
                f"{name}{k} AS (SELECT g, pos, h, count(*) OVER (PARTITION BY g) = 1 AS alone, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {made})"
            )
        return out

    part = lambda c: f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}, '-')"
    leaf = lambda t: "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", t))) + ")"
    crc = "xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(str_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"
    tables = [
        f"d AS (SELECT doc_id, coalesce('=' || source, '') AS g, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(f'translate(text, {LETTERS})')} ELSE {leaf('text')} END AS shown FROM documents)",
        "e AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d)",
        "n_ AS (SELECT g, pos, leaf AS h FROM e)",
        *storeys("n", levels),
        f"t AS (SELECT g AS of, row_number() OVER (ORDER BY g) - 1 AS pos, h FROM n{levels})",
        "m_ AS (SELECT '' AS g, pos, h FROM t)",
        *storeys("m", upper),
        f"f0 AS (SELECT e.*, t.pos AS top, t.h AS subroot, (SELECT h FROM m{upper}) AS root, shown AS node, '' AS proof FROM e JOIN t ON t.of = e.g)",
    ]
    for k in range(levels + upper):
        name, on = (f"n{k}", f"x.g = f.g AND x.pos = f.pos // {16**k}") if k < levels else (f"m{k - levels}", f"x.pos = f.top // {16 ** (k - levels)}")
        tables.append(f"f{k + 1} AS (SELECT f.* REPLACE (CASE WHEN x.alone THEN node ELSE sha256(x.l || node || x.r) END AS node, CASE WHEN x.alone THEN proof ELSE proof || x.l || x.r END AS proof) FROM f{k} f JOIN {name} x ON {on})")
    return "WITH " + ",\n".join(tables) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM f{levels + upper}"


def oracle_sql() -> dict[str, str]:
    """The other queries are trained, sampled or need what SQL lacks; their tests hold them against plain versions."""
    return {"op7_exact_topk": OP7_SQL, "op11_source_divergence": OP11_SQL, "op13_merkle_manifest": _op13_sql()}
