"""The pipeline: each stage against a plain version on its own input."""

import corpus_pipeline as cp
from gristmill.llm import secrets, subword

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    assert all(d.columns == docs.columns for d in out[:-1])
    _, good, single, clean, mixed, packed = out
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = good.join(labels, "doc_id").groupBy("quality").count().collect()
    assert {r.quality: r["count"] for r in kept}.get(1, 0) >= 0.98 * labels.where("quality = 1").count()
    accepted = {r.doc_id for r in subword.scored(docs, subword.fit(docs, labels, "quality", 3, 1)).where("quality_score >= 0.5").collect()}
    assert {r.doc_id for r in good.collect()} == accepted
    assert single.count() < good.count() and single.select("doc_id").distinct().count() == single.count()
    assert clean.count() == single.count()
    assert secrets.report(clean).where("n_assign + n_access + n_hex > 0").count() == 0
    untouched = secrets.report(single).where("spans = ''").select("doc_id")
    assert clean.join(untouched, "doc_id").join(single.withColumnRenamed("text", "was"), "doc_id").where("text <> was").count() == 0
    words = lambda d: d.selectExpr(r"sum(regexp_count(text, '[^\\x20\\x09-\\x0D]+')) n").first().n
    assert abs(words(mixed) / words(clean) - 1.5) < 0.05
    assert packed.selectExpr("sum(words) n").first().n == words(mixed)
    assert packed.groupBy("bin_id").sum("words").where("bin_id is not null and `sum(words)` > 1024").count() == 0


def test_run(spark):
    assert cp.run(spark, "/root/testdata/sf0.001").count() > 0


def test_odd_rows_and_clashing_names(spark):
    """Nulls, blanks, repeats, a very long text and columns named as helpers are, through every stage."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, quality_score string, _was int, _row int, mark int"
    rows = [(1, "a fine text of some words", "en", "s", 25, "q", 1, 1, 1)] * 3 + [(1, "another text under this id", "en", "s", 26, None, 2, 2, 2), (2, None, None, None, None, None, None, None, None)]
    rows += [(3, "", "en", None, 0, "q", 0, 0, 0), (None, "no id but words", "en", "t", 15, "q", 0, 0, 0), (4, "long words " * 40_000, "en", "t", 440_000, "q", 0, 0, 0), (5, "token=abcdefgh1 here", "en", "t", 20, "q", 0, 0, 0)]
    df = spark.createDataFrame(rows, kind)
    for docs in (df, df.limit(0)):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.001").cache()
            if name == "pack":
                break
            assert out.columns == df.columns
            docs = out
            if name == "quality" and docs.count():
                docs = df
            if name == "secrets" and docs.count():
                assert {r.text: r.n_chars for r in out.collect()}["[SECRET] here"] == 13
            if name == "near_duplicates" and docs.count():
                assert docs.where("doc_id = 1").count() == 2
        assert (out.count() > 0) == (docs.count() > 0)
