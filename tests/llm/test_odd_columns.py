"""Columns with clashing names change nothing, and very long texts and payloads are taken whole."""

import random

import pyarrow as pa
import pytest

from gristmill.llm import ngram_lm, packing, toxicity, vectors, warc
from pyspark.sql import functions as F

CLASH = ("_id", "id", "y", "ids", "votes", "_pattern", "toxicity_score", "score", "v", "dim", "b", "c", "rank", "query_id", "digest", "best", "revisit", "refers_to", "payload_bytes", "held_out", "n_tokens", "part", "w0", "counts", "keys", "bin", "size", "_y", "at")


def with_clashes(df):
    taken = {c.lower() for c in df.columns}
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASH if c.lower() not in taken))


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_clashing_columns(spark):
    at = "/root/testdata/sf0.001/{}.parquet"
    docs, labels, embeddings, pages = (spark.read.parquet(at.format(t)) for t in ("documents", "labels", "embeddings", "pages"))
    same(toxicity.report(docs, labels), toxicity.report(with_clashes(docs), with_clashes(labels).drop("_id", "y")))
    same(vectors.exact_topk(embeddings, 50, 5), vectors.exact_topk(with_clashes(embeddings), 50, 5))
    same(vectors.nearest(embeddings, 50, 5), vectors.nearest(with_clashes(embeddings), 50, 5))
    same(warc.round_trip(pages), warc.round_trip(with_clashes(pages)))
    same(ngram_lm.report(docs), ngram_lm.report(with_clashes(docs)))
    same(packing.packed(docs, capacity=1024), packing.packed(with_clashes(docs), capacity=1024).select(packing.packed(docs, capacity=1024).columns))
    with pytest.raises(ValueError):
        toxicity.scored(with_clashes(docs), ({}, 0.0))


def test_long_payloads_cross_ranges(spark, monkeypatch):
    """Members over 64 KiB, longer than a range and across its border."""
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzé<>", k=n))
    rows = [(i, f"u{i}", noise(n)) for i, n in enumerate([10, 70_000, 300_000, 5, 1_500_000, 64, 200_000])] + [(50, "v", "x" * 9_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1)
    archives = warc.write(pages, warc.shared_dir(spark, "long"))
    for size in (100_000, warc.RANGE_BYTES):
        got = {r.page_id: r for r in warc.read(archives, size).collect()}
        assert {i: (r.payload_bytes, r.html) for i, r in got.items()} == {i: (len(h.encode()), h) for i, _, h in rows}


def test_long_text_of_the_language_model(spark):
    text = " ".join(random.Random(1).choices(["a", "b", "Word", "ü"], k=400_000))
    rows = [(1, text), (2, "a b"), (3, text[:50])]
    got = {r.doc_id: r for r in ngram_lm.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_tokens == 400_001 and got[2].n_tokens == 3
    model = ngram_lm.count(spark.createDataFrame([r for r in rows if not got[r[0]].held_out], "doc_id long, text string"))
    for chunk in (1 << 10, 4 << 20):
        scores = [s for _, _, raw, offsets in ngram_lm.text_chunks(pa.array([t for _, t in rows]), chunk) for s in ngram_lm.Mapped(model).score(*ngram_lm.word_hashes(raw, offsets))[3]]
        assert all(abs(s - got[i].score) < 1e-6 * abs(s) for s, (i, _) in zip(scores, rows, strict=True))
