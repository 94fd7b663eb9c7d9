"""Sentiment, folded places, headings, verdicts and quota errors on small cases."""

import json

from pyspark.sql import functions as F

from gristmill.functions import sentiment, wording

LEX = sentiment.Lexicon({"좋다": 2, "기분좋다": 1, "부상자": -1, "통하다": 1}, {"늘다": 1, "줄다": -1}, {"참가자": 1}, {"통하다": ("JKO",)})


def units(*pairs):
    return [{"lemma": w, "tag": t, "start": i, "finish": i + 1} for i, (w, t) in enumerate(pairs)]


def test_scores(spark):
    cases = {
        "less injured": (units(("부상자", "NNG"), ("가", "JKS"), ("줄다", "VV")), 1.0),
        "more people": (units(("참가자", "NNG"), ("가", "JKS"), ("늘다", "VV")), 1.0),
        "not more": (units(("참가자", "NNG"), ("가", "JKS"), ("늘다", "VV"), ("않다", "VX")), -1.0),
        "no argument": (units(("늘다", "VV")), 0.0),
        "longest": (units(("기분", "NNG"), ("좋다", "VA")), 1.0),
        "not good": (units(("좋다", "VA"), ("지", "EC"), ("않다", "VX")), -2.0),
        "function word": (units(("를", "JKO"), ("통하다", "VV")), 0.0),
        "real verb": (units(("이", "JKS"), ("통하다", "VV")), 1.0),
        "null": (None, 0.0),
    }
    df = spark.createDataFrame([(k, u) for k, (u, _) in cases.items()], "k string, u array<struct<lemma:string,tag:string,start:int,finish:int>>")
    got = {r.k: r.s.score for r in df.select("k", sentiment.sentence_scores(F.col("u"), LEX).alias("s")).collect()}
    assert got == {k: s for k, (_, s) in cases.items()}


def test_overlaps():
    row = [{"start": 0, "finish": 2}, {"start": 0, "finish": 3}, {"start": 2, "finish": 7}]
    assert sentiment.without_overlaps(row) == [row[1]] and sentiment.without_overlaps(row, longer_wins=True) == [row[2]]


def test_documents_and_lexicon(spark):
    s = spark.createDataFrame([(1, 2.0), (1, -1.0), (1, 0.0), (2, 0.0)], "id long, score double")
    assert {tuple(r) for r in sentiment.document_sentiment(s, "id", "score").collect()} == {(1, 3, 0.3333, 0.3333, 0.3333, 0.3333, 0.5), (2, 1, 0.0, 0.0, 1.0, 0.0, None)}
    layers = spark.createDataFrame([("a", 1, 0), ("a", -2, 0), ("b", 2, 0), ("b", -1, 1), ("c", 1, 0)], "word string, score int, priority int")
    assert {tuple(r) for r in sentiment.merged_lexicon(layers, spark.createDataFrame([("c",)], "word string")).collect()} == {("a", -2), ("b", -1)}


def test_folded_places(spark):
    df = spark.createDataFrame([("그 최 고!! ＢＥＳＴ best",), (None,)], "t string")
    rows = df.select("t", wording.folded_places(F.col("t"), ("최고", "best")).alias("p")).collect()
    assert [(p.word, p.start, p.finish) for p in rows[0].p] == [("최고", 2, 5), ("best", 8, 12), ("best", 13, 17)] and rows[1].p == []
    assert df.select(wording.context(F.col("t"), F.lit(2), F.lit(5), 1).alias("c")).first().c == "… 최 고!…"


def test_headings(spark):
    draft = "/* 소제목 */ 1. 첫 번째는\n국기원 시범\n이야기예요.\n\n본문\n/* 소제목 */\n\n/* 소제목 */ 2. 결과"
    got = wording.headings(spark.createDataFrame([(1, draft), (2, "none"), (3, None)], "id long, text string")).orderBy("place").collect()
    assert [(r.id, r.heading) for r in got] == [(1, "국기원 시범"), (1, "결과")]


def test_verdict(spark):
    rows = [("?", "x", "x", "", ""), ("?", "x", "", "", ""), ("", "", "", "", ""), ("?", "x", "x", "x", ""), ("o", "", "", "", ""), ("?", "", "", "", ""), ("?", "x", "x", "", "반전")]
    df = spark.createDataFrame(rows, "mark string, neck string, trim string, veto string, worn string")
    c = F.col
    out = wording.verdict(c("mark"), F.lit(""), [(c("veto"), "grip")], c("worn"), [(c("neck"), 3), (c("trim"), 2)], [[(F.lit(""), 3)], [(F.lit(""), 1)]])
    assert [r.v.verdict for r in df.select(out.alias("v")).collect()] == ["accepted", "held", "held", "rejected", "accepted", "held", "rejected"]


def test_quota_and_budget(spark):
    body = json.dumps({"error": {"details": [{"@type": "x.QuotaFailure", "violations": [{"quotaId": "RequestsPerDay", "quotaValue": "0"}]}, {"@type": "x.RetryInfo", "retryDelay": "32s"}]}})
    rows = spark.createDataFrame([(body,), ("not json",), (None,)], "b string").select(wording.quota_error(F.col("b")).alias("q")).collect()
    assert (rows[0].q.ids, rows[0].q.daily, rows[0].q.minute, rows[0].q.none_left, rows[0].q.wait) == (["RequestsPerDay"], True, False, True, 33.0)
    assert rows[1].q.ids == [] and not rows[1].q.daily and rows[2].q.wait is None
    items = spark.createDataFrame([([(1, 3, "a"), (3, 9, "c"), (2, 4, "b"), (3, 1, "d")],)], "i array<struct<priority:int,cost:int,text:string>>")
    fit = lambda n: items.select(wording.within_budget(F.col("i"), n).alias("t")).first().t
    assert fit(17) == ["a", "c", "b", "d"] and fit(16) == ["a", "b"] and fit(2) == []


def test_argument_polarity_as_in_a_sentence(spark):
    """The windows over units tell the same arguments as the loop over one sentence."""
    import random

    from gristmill.functions.sentiment import ARGUMENT_REACH, ARGUMENT_TAGS, NEGATION_REACH, NOUN_TAGS, Lexicon, score_units
    from gristmill.operators import units

    rng, rows, want = random.Random(5), [], []
    lex = Lexicon({"good": 2, "bad": -1}, {"more": 1, "less": -1}, {"price": -1}, {}, ("not",))
    for i in range(200):
        tags = [*NOUN_TAGS, *ARGUMENT_TAGS, "XX"]
        row = [{"lemma": rng.choice(["good", "bad", "price", "x", "more", "less", "not"]), "tag": rng.choice(tags), "start": k, "finish": k + 1} for k in range(rng.randrange(1, 25))]
        rows += [(i, 0, k, u["lemma"], u["tag"]) for k, u in enumerate(row)]
        found = score_units(row, lex)[1]
        verbs = sum(u["lemma"] in lex.directions for u in row)
        want += [(i, f) for f in found[:verbs]]
    of = lambda rows, kind: spark.createDataFrame(rows, kind)
    got = units.argument_polarity(of(rows, "id int, sentence int, pos int, lemma string, tag string"), of([("more", 1), ("less", -1)], "verb string, direction int"), of([("good", 2), ("bad", -1)], "word string, score int"), of([("price", -1)], "word string, valence int"), ("not",), tuple(NOUN_TAGS), tuple(ARGUMENT_TAGS), ARGUMENT_REACH, NEGATION_REACH)
    told = [(r.id, f"{r.noun + '+' if r.noun else ''}{r.verb}{'!' if r.negated else ''}:{r.score:+d}") for r in got.orderBy("id", "verb_at").collect()]
    assert told == want


def test_folding_holds_one_text_as_numbers(spark):
    """Neither a text nor its places become a Python object a letter or a place."""
    import random
    import tracemalloc
    import unicodedata

    rng = random.Random(3)
    texts = ["".join(rng.choice("abAB ﬁİßㅎ①.-é") for _ in range(rng.randrange(60))) for _ in range(300)] + [None, ""]
    words = ("ab", "fi", "B a", "a", "ss", "1", "--")

    def plain(t):
        flat = [(low, i) for i, ch in enumerate(t or "") for low in unicodedata.normalize("NFKC", ch).lower() if low.isalnum()]
        keys = [(w, "".join(low for ch in w for low in unicodedata.normalize("NFKC", ch).lower() if low.isalnum())) for w in words]
        hits = [(w, flat[k][1], flat[k + len(key) - 1][1] + 1) for w, key in keys if key for k in range(len(flat) - len(key) + 1) if "".join(c for c, _ in flat[k : k + len(key)]) == key]
        return sorted(hits, key=lambda x: (x[1], -x[2], x[0]))

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").repartition(3)
    got = {r.i: [tuple(p) for p in r.p] for r in df.select("i", wording.folded_places(F.col("t"), words).alias("p")).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    long_ = "Straße Nr. 12, " * 60_000
    tracemalloc.start()
    flat, at = wording.folded(long_)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert flat.startswith("straßenr12") and len(at) == len(flat) and at[-1] == len(long_) - 3
    assert most < 24 * len(long_), most
