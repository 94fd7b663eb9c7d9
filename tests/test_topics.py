"""Topics and record scores against comparisons of all pairs."""

import random

from pyspark.sql import functions as F

from gristmill.operators import events, scoring


def roots(rows, universal_from=4):
    """rows: (id, words, title words). Smallest id of each topic with two records or more."""
    keys = {i: set(w) | set(t) for i, w, t in rows}
    titled = {i: {w for w in keys[i] if any(w in x for x in t)} for i, _, t in rows}
    everywhere = set.intersection(*keys.values()) if len(rows) >= universal_from else set()
    root = {i: i for i in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    linked = set()
    for a in keys:
        for b in keys:
            shared = (keys[a] & keys[b]) - everywhere
            if a < b and (len(shared) >= 2 or shared & titled[a] & titled[b]):
                linked |= {a, b}
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in linked}


def test_topics_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(events, "BLOCK", 24)
    rng = random.Random(11)
    rows = []
    for i in range(260):
        topic = rng.randrange(40)
        words = [f"t{topic}w{rng.randrange(9)}" for _ in range(rng.randrange(4))] + [f"own{i}"] + ["all"]
        words += ["third"] if rng.random() < 0.34 else []  # a word in a third of all records links nothing by itself
        title = [f"xxt{topic}w{rng.randrange(9)}yy"] if rng.random() < 0.3 else []
        rows.append((i * 3 % 263, words, title))
    rows += [(900, ["all"], []), (901, ["all", "lone"], ["lone"])]
    df = spark.createDataFrame(rows, "id long, words array<string>, title array<string>").repartition(3)
    told = events.topic_words(df, F.col("words"), F.col("title"))
    want = roots(rows)
    assert len(set(want.values())) > 10
    for rounds in (1, 3):
        assert {r.id: r.root for r in events.topics(told, rounds).collect()} == want
    assert events.topics(told.limit(0)).count() == 0


def test_record_scores_of_long_titles(spark):
    rows = [(1, ["a"] * 20_000 + ["b"], ["c"] * 20_000), (2, [], ["b", "x"]), (3, [], []), (4, None, ["a"])]
    df = spark.createDataFrame(rows, "id long, title array<string>, body array<string>")
    weights = spark.createDataFrame([("a", 1.0), ("b", 0.5), ("c", 0.25)], "token string, weight double")
    got = {r.id: (r.score, r.matched) for r in scoring.record_scores(df, F.col("title"), F.coalesce("body", F.array().cast("array<string>")), weights).collect()}
    bonus = scoring.Trend().title_bonus
    assert got == {1: (1.5 * bonus + 0.25, ["a", "b", "c"]), 2: (0.5, ["b"])}


def test_topics_make_no_row_for_a_word(spark, monkeypatch):
    monkeypatch.setattr(events, "BLOCK", 16)
    monkeypatch.setattr(events, "HUBS", 2)
    rng = random.Random(5)
    rows = [(i, [f"t{i % 6}w{rng.randrange(30)}" for _ in range(rng.randrange(9))] + ["all"], [f"h{rng.randrange(400)}"][: i % 2]) for i in range(150)]
    df = spark.createDataFrame(rows + rows[:3], "id long, words array<string>, title array<string>").repartition(3)
    told = events.topic_words(df, F.col("words"), F.col("title"))
    assert told.columns == ["id", "words", "titled"] and told.count() == 150  # a record that comes twice is one
    assert {r.id: r.root for r in events.topics(told).collect()} == roots(rows)


def test_topics_of_hubs_outside_the_largest(spark, monkeypatch):
    monkeypatch.setattr(events, "BLOCK", 16)
    monkeypatch.setattr(events, "HUBS", 3)
    seen, led = [], events._led_outside
    monkeypatch.setattr(events, "_led_outside", lambda *a: seen.append(led(*a).cache()) or seen[-1])
    for seed in range(3):
        rng, rows = random.Random(seed), []
        for i in range(160):
            t = min(rng.randrange(12), 8)  # one topic is larger, but most records are outside it
            some = [f"t{t}w{rng.randrange(14)}" for _ in range(rng.randrange(2, 7))]
            if rng.random() < 0.04:  # holds two topics together
                some += [f"t{rng.randrange(9)}w{k}" for k in (1, 2, 3)]
            rows.append((1000 - i, some + ["all"], []))
        df = spark.createDataFrame(rows, "id long, words array<string>, title array<string>").repartition(3)
        told = events.topic_words(df, F.col("words"), F.col("title"))
        assert {r.id: r.root for r in events.topics(told).collect()} == roots(rows)
    assert {r.tokens is None for s in seen for r in s.collect()} == {True, False}  # records and links of hubs
