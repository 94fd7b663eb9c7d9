"""BM25 against a plain sum over all pairs, with ids that come twice, and what it shuffles."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gristmill.operators import scoring


def plain(documents, queries, k):
    mean = sum(len(t) for _, t in documents if t is not None) / sum(t is not None for _, t in documents)
    tf = {}
    for i, t in documents:
        for x in t or ():
            if x is not None:
                tf[i, len(t), x] = tf.get((i, len(t), x), 0) + 1
    df = {}
    for _, _, x in tf:
        df[x] = df.get(x, 0) + 1
    out = []
    for q in dict.fromkeys(q for q, _ in queries):
        score = {}
        for _, words in (x for x in queries if x[0] == q):
            for (i, n, x), f in tf.items():
                if x in set(words or ()):
                    idf = math.log(1 + (len(documents) - df[x] + 0.5) / (df[x] + 0.5))
                    score[i] = score.get(i, 0) + idf * f * 2.5 / (f + 1.5 * (1 - 0.75 + 0.75 * n / mean))
        best = sorted((-round(s, 4), i) for i, s in score.items())[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("cells, twice", [(64, False), (1 << 21, True)])
def test_bm25(spark, monkeypatch, cells, twice):
    monkeypatch.setattr(scoring, "CELLS", cells, raising=False)
    monkeypatch.setattr(scoring, "ROWS", 7, raising=False)
    rng = random.Random(2)
    made = lambda n: [f"t{min(rng.randrange(30), rng.randrange(30))}" for _ in range(rng.randrange(n))]
    documents = [(i, made(25)) for i in range(90)] + [(90, None), (91, []), (92, ["t1", None, "other"])]
    documents += [(100 + i, documents[i % 5][1]) for i in range(20)]  # copies, so that ties are broken by id
    documents += [(3, documents[3][1]), (4, ["t1", "t2"]), (5, [])] if twice else []
    queries = [(i, made(9)) for i in range(12)] + [(50, ["unknown", None]), (51, None), (2, ["t1"])]
    of = lambda rows, key: spark.createDataFrame(rows, f"{key} long, tokens array<string>").repartition(3)
    got = scoring.bm25(of(documents, "id"), of(queries, "query_id"), 5)
    assert sorted(map(tuple, got.collect())) == plain(documents, queries, 5)
    assert scoring.bm25(of(documents, "id").limit(0), of(queries, "query_id"), 5).count() == 0
    assert scoring.bm25(of(documents, "id"), of(queries, "query_id").limit(0), 5).count() == 0


def test_bm25_shuffles_only_the_best(spark):
    """No row is shuffled for a query and a document that share a term."""
    documents = spark.createDataFrame([(i, ["a", "b", f"c{i}"]) for i in range(4000)], "id long, tokens array<string>")  # dealt by no key
    queries = spark.range(0, 50, 1, 2).select(F.col("id").alias("query_id"), F.array(F.lit("a"), F.lit("b"), F.lit("c7")).alias("tokens"))
    sc, gateway = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway

    def written():
        sc.listenerBus().waitUntilEmpty()
        found = sc.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (found.apply(i) for i in range(found.size()))}

    before = written()
    got = sorted((r.query_id, r.rank, r.id) for r in scoring.bm25(documents, queries, 3).collect())  # a filter on the result would spare the other queries
    assert got == [(q, rank, i) for q in range(50) for rank, i in ((1, 7), (2, 0), (3, 1))]
    moved = sum(n for k, n in written().items() if k not in before)
    assert moved < 4000 + 50 * 3 * 4 * 4 + 200, moved  # ids once, and the best of each batch; 200,000 pairs share a term
