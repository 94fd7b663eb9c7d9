"""Quality and toxicity: held-out accuracy on the given tables, and defined results of odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from gristmill.llm import subword, toxicity

SF = "/root/testdata/sf0.1"
DOCS, LABELS = "doc_id long, text string, lang string, source string, n_chars long", "doc_id long, quality int, toxic int"


def auc(rows, label):
    one, none = (np.array([r.score for r in rows if r[label] == k]) for k in (1, 0))
    return (one[:, None] > none).mean() + 0.5 * (one[:, None] == none).mean()


@pytest.mark.parametrize(("module", "label", "least"), [(subword, "quality", 0.99), (toxicity, "toxic", 0.95)])
def test_held_out(spark, module, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = module.report(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert auc(rows, label) >= least
    assert np.mean([r.predicted == r[label] for r in rows]) >= 0.97
    clean = [r.predicted for r in rows if r[label] == (1 if label == "quality" else 0)]
    assert np.mean([p == (1 if label == "quality" else 0) for p in clean]) >= 0.99  # clean documents are left alone


@pytest.mark.parametrize("module", [subword, toxicity])
def test_odd_rows(spark, module):
    docs = [(i, t, None, None, None) for i, t in [(1, "a fine text of words"), (2, None), (3, ""), (None, "x"), (4, "bad " * 30_000), (1, "a fine text of words")]]
    df = spark.createDataFrame(docs, DOCS)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (2, None, None), (None, 1, 1), (77, 1, 1)], LABELS)
    for have in (labels, labels.limit(0)):
        rows = module.report(df, have).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out is not None for r in rows)
        assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert module.report(df.limit(0), labels).count() == 0


def test_scores_match_plain_features(spark):
    """The scorers against sums over each text's features, one by one, and the fold and the limit against their definition."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(9001, None), (9002, " \n"), (None, "same same same"), (9003, "ab " * 50_000)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    sigmoid = lambda z: 1 / (1 + math.exp(-min(max(z, -500), 500)))
    held = lambda i, n, k: i is not None and zlib.crc32(str(i).encode()) % n == k

    model = subword.fit(df, labels, "quality", 3, 1)
    logits, bias = model.logits(), float(model.bias[1] - model.bias[0])
    want = {}
    for i, t in rows:
        ids, share = subword._bag(t)
        want[i] = (held(i, 3, 1), sigmoid(bias + float(share.astype(float) @ logits[ids])))
    for r in subword.report(df, labels).collect():
        assert r.held_out == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-4 and r.predicted == (r.score >= 0.5)

    weights, bias = toxicity.fit(df, labels, "toxic", 5, 0)
    for r in toxicity.report(df, labels).collect():
        z = bias + sum(weights.get(int(f), 0.0) for f in toxicity._ids(dict(rows)[r.doc_id] or ""))
        assert r.held_out == held(r.doc_id, 5, 0) and abs(r.score - sigmoid(z)) < 1e-9 and r.predicted == (r.score >= 0.5)


def test_documents_without_label_get_weak_ones():
    texts = ["you are a stupid moron", "nice weather today"] * 20
    bags = [toxicity._ids(t) for t in texts]
    lexicons = toxicity.learned_lexicons(bags[:20], np.array([1, 0] * 10))
    shown = [toxicity.pattern_of(toxicity.votes(t), b, lexicons) for t, b in zip(texts, bags, strict=True)]
    y = [1, 0] * 10 + [-1, -1] * 10
    weak = toxicity.weak_labels(Counter(zip(shown, y, strict=True)))
    assert weak[shown[0], -1] > 0.9 and weak[shown[1], -1] < 0.1


def test_patterns_of_all_documents(spark):
    """Every document of the training fold is counted, whatever the bound of the labelled sample."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    lexicons = {f: f % toxicity.LEARNED for f in toxicity._ids("the and of in").tolist()}
    told = {r.doc_id: r.toxic for r in labels.collect()}
    want = Counter((toxicity.pattern_of(toxicity.votes(r.text or ""), toxicity._ids(r.text or ""), lexicons), told.get(r.doc_id, -1)) for r in docs.collect())
    assert toxicity.patterns(docs, labels, "toxic", lexicons) == dict(want)


def test_label_model_counts_patterns():
    rng = np.random.default_rng(1)
    seen = rng.integers(-1, 2, (300, 4))
    distinct, back, times = np.unique(seen, axis=0, return_inverse=True, return_counts=True)
    assert np.allclose(toxicity.label_model(seen)[0], toxicity.label_model(distinct, times)[0][back.ravel()], atol=1e-3)


def test_sample_is_a_parameter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    for module, label, folds, held in ((subword, "quality", 3, 1), (toxicity, "toxic", 5, 0)):
        picked = subword.labelled_sample(docs, labels, label, lambda c, n=folds, k=held: toxicity.fold(c, n) != k, "doc_id", "text", 7)
        assert {r.y: r["count"] for r in picked.groupBy("y").count().collect()} == {0: 7, 1: 7}
        assert module.report(docs, labels, sample=20).count() == docs.count()


def test_label_model_finds_accurate_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    votes = [np.where(rng.random(4000) < right, y, ~y) * 2 - 1 for right in (0.95, 0.85, 0.8, 0.7, 0.6)]
    votes.append(votes[4])  # a copy of the weakest voter
    posterior, weight = toxicity.label_model(np.array(votes).T)
    assert ((posterior >= 0.5) == y).mean() >= 0.93
    assert weight[5] < 0.7 and weight[0] > weight[5]
