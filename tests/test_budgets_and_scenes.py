"""Budgets, scenes that are too alike and the label store against the plain rules that define them."""

import difflib
import random
import re
import time

import pandas as pd
import pytest

from gristmill.functions import budgets
from gristmill.operators import similarity
from gristmill.sources import labels
from pyspark.sql import functions as F


def cost(text):
    return round(len(re.findall(r"[A-Za-z0-9']+", text)) * 1.3) + len(re.findall(r"[,.:;()\-]", text))


def test_priorities_and_tails(spark):
    rng, rows, want = random.Random(3), [], []
    word = lambda: rng.choice(["a", "two words", "x-y", "it's (so)", "three. more, words", "é"])
    for i in range(300):
        parts = [(rng.randrange(1, 8), word()) for _ in range(rng.randrange(0, 9))]
        asked = [rng.choice([" a ", "A", "", "b", "Two", "two", "the", "c d e", "x-y"]) for _ in range(rng.randrange(0, 15))]
        budget, person = rng.choice([5, 12, 20]), i % 2 == 0
        rows.append((i, parts, asked, person, budget))
        left = list(parts)
        while cost(", ".join(t for _, t in left)) > budget and len(left) > 2:
            worst = max(p for p, _ in left)
            left = [x for x in left if x[0] != worst]
        terms, seen = ["f one", "Two"], {"f one", "two"}
        for t in asked:
            t = t.strip()
            if t and t.lower() not in seen and not (person and t.lower() in {"the", "b"}):
                terms.append(t)
                seen.add(t.lower())
        while cost(", ".join(terms)) > budget and len(terms) > 3:
            terms.pop()
        want.append((", ".join(t for _, t in left), terms))
    df = spark.createDataFrame(rows, "i int, parts array<struct<priority:int,text:string>>, asked array<string>, person boolean, budget int")
    none = F.array().cast("array<string>")
    for budget in (5, 12, 20):
        some = df.where(F.col("budget") == budget)
        got = some.select("i", budgets.within_tokens(F.col("parts"), budget).alias("p"), budgets.negative_terms(F.array(F.lit("f one"), F.lit("Two")), F.col("asked"), F.when(F.col("person"), F.array(F.lit("the"), F.lit("b"))).otherwise(none), budget, 3).alias("t")).collect()
        assert got and [(r.p, r.t) for r in got] == [want[r.i] for r in got]


def test_a_prompt_in_parts(spark):
    texts = {k: k.upper() for k in ("dress", "place", "setting", "somebody", "nobody", "style")}
    rows = [(1, " Runs in a hall.. ", True, True, " calm. ", "wide"), (2, "Stands", True, True, None, "wide"), (3, "a belt", False, True, "", "close"), (4, "dobok", False, True, "", "close"), (5, "x", True, False, "", "close"), (6, " . ", True, True, "m", "wide")]
    df = spark.createDataFrame(rows, "i int, scene string, person boolean, own boolean, mood string, shot string")
    parts = budgets.prompt_parts(F.col("scene"), F.col("person"), F.col("own"), F.col("mood"), F.col("shot"), texts, (("hall", "wall"), ("dobok",)))
    got = {r.i: [tuple(x) for x in r.p] for r in df.select("i", parts.alias("p")).collect()}
    assert got[1] == [(1, "Runs in a hall"), (2, "DRESS"), (3, "SOMEBODY"), (5, "STYLE"), (6, "calm"), (7, "wide shot")]
    assert [p for p, _ in got[2]] == [1, 2, 4, 3, 5, 7] and got[3][1] == (2, "SETTING") and [p for p, _ in got[4]] == [1, 3, 5, 7] and [p for p, _ in got[5]] == [1, 3, 5, 7] and got[6] == []


def test_shares(spark):
    rng, rows = random.Random(4), []
    for i in range(300):
        rows.append((i, rng.randrange(0, 200), [rng.choice([0, 5, 20, 20, 90]) for _ in range(rng.randrange(0, 8))]))
    df = spark.createDataFrame(rows, "i int, total int, floors array<bigint>")
    for r in df.select("*", budgets.shares_with_floors(F.col("total"), F.col("floors")).alias("s"), budgets.chapter_share(F.col("total") * 10, F.size("floors")).alias("c")).collect():
        assert len(r.s) == len(r.floors) and all(x >= f for x, f in zip(r.s, r.floors, strict=True))
        assert not r.s or sum(r.s) == max(r.total, sum(r.floors))
        # those above their floor are level
        over = [x for x, f in zip(r.s, r.floors, strict=True) if x > f]
        assert not over or max(over) - min(over) <= 1 and all(x >= max(over) - 1 for x in r.s)
        assert r.c == (max(100, (r.total * 10 - 650) // len(r.floors)) if r.floors else None)


@pytest.mark.parametrize("block", [3, 512])
def test_scenes(spark, monkeypatch, block):
    monkeypatch.setattr(similarity, "BLOCK", block)
    rng = random.Random(block)
    base = ["a man runs in a hall", "a man runs in the hall", "two dogs", "Two Dogs sleep", "é漢字 scene", "", "long scene " * 30, "long scenes " * 30, "spare one is used", "spare two is used"]
    rows = [(f"g{rng.randrange(2)}", i, rng.choice([None, *base]), rng.choice(base[-2:])) for i in range(60)]
    got = {r.seq: (r.replaced, r.text) for r in similarity.chosen_scenes(spark.createDataFrame(rows, "grp string, seq long, scene string, spare string"), 0.72).collect()}
    used: dict[str, list[str]] = {}
    for g, i, scene, spare in rows:
        before = used.setdefault(g, [])
        alike = any(difflib.SequenceMatcher(None, (scene or "").lower(), (u or "").lower()).ratio() >= 0.72 for u in before)
        text = spare if alike else scene
        before.append(text)
        assert got[i] == (alike, text), i
    assert {x for x, _ in got.values()} == {True, False}


def test_label_store(spark, tmp_path):
    folder = f"file://{tmp_path}/store"
    of = lambda rows: spark.createDataFrame(rows, "url string, label string, other int")
    assert labels.load_labels(spark, folder).count() == 0
    labels.save_labels(of([("http://a/x/", "one", 1), ("http://b/", "one", 1), ("", "none", 1)]).coalesce(1), folder, 0)
    labels.save_labels(of([("HTTP://A/x?utm_source=1", "two", 1), ("http://a/x", "three", 1)]).coalesce(1), folder, 1)
    (tmp_path / "store/log/batch=1/more.txt").write_text('{broken\n{"url": "http://c/", "label": "kept"}\n[1]\n')
    told = lambda: {r.key: (r.label, r.title) for r in labels.load_labels(spark, folder).collect()}
    want = {"http://a/x": ("three", ""), "http://b/": ("one", ""), "http://c/": ("kept", None)}
    assert told() == want
    assert {r.value for r in labels.broken_lines(spark, folder).collect()} > {"[1]", "{broken"}
    labels.compact(spark, folder)
    assert told() == want and labels.broken_lines(spark, folder).count() == 0
    # a run that was lost before its pointer leaves a version that nobody reads
    of([("http://z/", "lost", 1)]).write.parquet(f"{folder}/version-lost/labels")
    labels.save_labels(of([("http://b/", "new", 1)]), folder, 2)
    labels.save_labels(of([("http://b/", "new", 1)]), folder, 2)
    assert told() == want | {"http://b/": ("new", "")}
    df = labels.load_labels(spark, folder).withColumn("search_keyword", F.when(F.col("label") == "new", " ").otherwise("k"))
    assert labels.labelled(df, ["new", "kept"]).count() == 2 and labels.labelled(df, ["new", "kept"], keyword_only=True).count() == 1


def test_negative_terms_of_long_lists(spark):
    """Twenty thousand terms a row, mostly new: work by the square of a row, each item anew, wouldn't end."""
    words = [f"W{i % 15_000}" if i % 3 else f"w{i % 15_000} " for i in range(20_000)] + ["", None, "Fixed"]
    df = spark.createDataFrame([(words, ["w0", "W7"]), ([], []), (None, [])], "asked array<string>, bad array<string>")
    began = time.time()
    got = [r.t for r in df.select(budgets.negative_terms(F.array(F.lit("fixed")), F.col("asked"), F.col("bad"), 10**6, 3).alias("t")).collect()]
    assert time.time() - began < 60
    seen, want = {"fixed", "w0", "w7"}, ["fixed"]
    for w in words:
        if w and w.strip().lower() not in seen:
            seen.add(w.strip().lower())
            want.append(w.strip())
    assert got == [want, ["fixed"], None]


def test_pairs_that_reach_no_ratio_are_not_compared():
    """Lines with the same characters in another order pass the counts of characters; few of them get as far as the ratio."""
    rng = random.Random(6)
    letters = "".join(rng.choice("abcdefghij klmnop") for _ in range(60))
    texts = ["".join(rng.sample(letters, 60)) for _ in range(80)] + [letters, letters[:58] + "zz", "", "é漢字", "x" * 64, "x" * 63 + "y", "w" * 65]
    known, coded = similarity._coded(texts)

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    for t in (texts[0], letters, "", "x" * 64, "字é"):
        assert similarity.common(t, known, coded).tolist() == [longest(t, u) for u in texts]
    seen, real = [], similarity.ratio
    similarity.ratio = lambda a, b: seen.append((a, b)) or real(a, b)
    try:
        frame = pd.DataFrame({"seq": range(len(texts)), "scene": texts})
        got = {(i, j) for i, j, _ in similarity._alike(frame, frame, "scene", 0.6)}
    finally:
        similarity.ratio = real
    assert got == {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts[:i]) if real(a, b) >= 0.6} and (81, 80) in got
    assert len(seen) < len(texts) ** 2 / 10


def test_whole_texts_are_scenes(spark, monkeypatch):
    """The query compares whole texts, not their beginnings."""
    from gristmill.plans import drafting

    seen = []
    monkeypatch.setattr(similarity, "chosen_scenes", lambda df, least: seen.append(df) or df.withColumns({"replaced": F.lit(False), "text": F.col("scene")}))
    drafting.chosen_scenes(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert seen[0].join(docs, F.col("seq") == F.col("doc_id")).where(F.col("scene").eqNullSafe(docs["text"])).count() == docs.count()


@pytest.mark.parametrize("least", [0.3, 0.6, 0.72])
def test_long_texts_that_are_left_out_reach_no_ratio(least):
    """Long texts in which words, halves or single characters differ: the pairs found are those of the plain ratio, which few pairs get to."""
    rng = random.Random(7)
    words = ["".join(rng.choice("etaoinshrdlucmfwypvbgkjqxz") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize()
    texts = [prose(n) for n in (30, 40, 45, 60, 60, 80, 90, 120, 120, 150)]
    for t in texts[:6]:
        own = t.split(" ")
        texts += [" ".join(w if rng.random() > share else rng.choice(words) for w in own) for share in (0.1, 0.4, 0.7)]
        texts += [" ".join(own[len(own) // 2 :] + own[: len(own) // 2]), t[: len(t) // 2] + prose(len(own) // 2), t.replace("e", "é"), t[1:], "#" + t]
    texts += ["".join(chr(0x4E00 + rng.randrange(400)) for _ in range(300)) for _ in range(4)] + ["x" * 300, "x" * 299 + "y", "z" * 250 + "x" * 50]
    rng.shuffle(texts)
    seen, real = [], similarity.ratio
    similarity.ratio = lambda a, b: seen.append((a, b)) or real(a, b)
    try:
        frame = pd.DataFrame({"seq": range(len(texts)), "scene": texts})
        got = {(i, j) for i, j, _ in similarity._alike(frame, frame, "scene", least)}
    finally:
        similarity.ratio = real
    low = [t.lower() for t in texts]
    assert got == {(i, j) for i, a in enumerate(low) for j, b in enumerate(low[:i]) if real(a, b) >= least} and got
    assert least < 0.5 or len(seen) < len(texts) ** 2 / 8


def test_equal_scenes_and_spares_make_no_pairs(spark, monkeypatch):
    """Of a hundred equal scenes with one spare text only the first is compared, and the choice is that of the loop."""
    rows = [("g", i, "the same scene for all" if i % 3 else f"scene of its own {i * 7919}", "the same scene for all of them") for i in range(150)]
    seen, real = [], similarity.alike_pairs
    monkeypatch.setattr(similarity, "alike_pairs", lambda *a: seen.append(real(*a)) or seen[-1])
    got = {r.seq: r.replaced for r in similarity.chosen_scenes(spark.createDataFrame(rows, "grp string, seq long, scene string, spare string"), 0.72).collect()}
    used: list[str] = []
    for _, i, scene, spare in rows:
        alike = any(difflib.SequenceMatcher(None, scene, u).ratio() >= 0.72 for u in dict.fromkeys(used))
        used.append(spare if alike else scene)
        assert got[i] == alike
    assert seen[0].count() < 51 * 51
