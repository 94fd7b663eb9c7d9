"""Lane selection, its sweep and the second assignment against loops; small cases of pictures, replies and units."""

from pyspark.sql import functions as F

from gristmill.config import Events
from gristmill.functions import media
from gristmill.operators import events, lanes, units, vectors
from gristmill.plans import editorial

SF = "/root/testdata/sf0.001"
E = Events()


def _same(p, jaccard):
    return p.jaccard >= jaccard or (p.shared >= E.shared and p.overlap >= E.overlap)


def plain_selection(members, pairs, known, order, top, least, jaccard=E.jaccard):
    same = set()
    for p in pairs:
        if _same(p, jaccard):
            same |= {(p.a, p.b), (p.b, p.a)}
    keys, taken, out = set(), set(), {}
    for lane in order:
        pool = sorted((m for m in members if m.lane == lane and m.key not in keys and m.id not in known and m.id not in taken and not any((m.id, t) in same for t in taken)), key=lambda m: m.id)
        groups = []
        for m in pool:
            own = next((g for g in groups if (m.id, g[0].id) in same), None)
            groups.append([m]) if own is None else own.append(m)
        placed = sorted(groups, key=(lambda g: -len(g)) if least <= 0 else (lambda g: len(g) < least))[:top]
        out[lane] = []
        for g in placed:
            best = max(g, key=lambda m: (not m.caption, m.chars, m.score, -m.id))
            out[lane].append((best.id, g[0].id, len(g), round(best.score * min(1 + E.cluster_bonus * (len(g) - 1), E.cluster_bonus_most), 4)))
        chosen = [m for g in placed for m in g]
        taken |= {m.id for m in chosen}
        keys |= {m.key for m in chosen}
    return out


def test_selection_and_sweep(spark):
    members, pairs, known, tokens = editorial.lane_members(spark, SF)
    m, p, k = members.collect(), pairs.collect(), {r.id for r in known.collect()}
    assert p
    k |= {r.id for r in m if r.id % 9 == 0}
    more = spark.createDataFrame([(i,) for i in k], "id long")
    for top, least in ((3, 2), (50, 1)):
        want = plain_selection(m, p, k, editorial.LANES, top, least)
        got, stand = lanes.select_by_lane(members, pairs, editorial.LANES, top, least, more)
        rows = sorted(got.collect(), key=lambda r: r.place)
        for lane in editorial.LANES:
            assert [(r.id, r.leader, r.report_count, r.score) for r in rows if r.lane == lane] == want[lane]
        assert stand.groupBy("lane", "leader").count().count() == len(rows)

    swept = lanes.lane_sweep(members, pairs, ["en", "src0"], 4, (1,), (0.3,), tokens).collect()
    sets = {r.id: set(r.tokens) for r in tokens.collect()}
    want = plain_selection(m, p, set(), ["en", "src0"], 4, 1, 0.3)
    for r in swept:
        own = [sets[i] for i, *_ in want[r.lane]]
        often = lambda t: sum(t in s for s in own) <= max(E.frequent_least, int(len(own) * E.frequent_share))  # noqa: B023, E731
        own = [{t for t in s if often(t)} for s in own]
        near = [len(a & b) / len(a | b) for i, a in enumerate(own) for b in own[:i] if a | b]
        assert r.n == len(want[r.lane]) and abs(r.most - max(near, default=0.0)) < 1e-6 and r.alike == sum(x >= 0.05 for x in near)


def test_empty_lanes(spark):
    members, pairs = spark.createDataFrame([], "id long, lane string, key string, caption boolean, chars long, score double"), spark.createDataFrame([], "a long, b long, shared long, jaccard double, overlap double")
    got, stand = lanes.select_by_lane(members, pairs, ["x", "y"], 3)
    assert got.count() == 0 and stand.count() == 0


def plain_assign(pairs, least, without):
    out, qs, items = [], set(), set(without)
    for q, i, sim in sorted(pairs, key=lambda x: (-x[2], x[0], x[1])):
        if sim >= least and q not in qs and i not in items:
            out.append((q, i, sim))
            qs.add(q)
            items.add(i)
    return out


def test_assign_again(spark):
    pairs = [(q, i, ((q * 7 + i * 13) % 20) / 20) for q in range(8) for i in range(9)]
    one = lambda xs: spark.createDataFrame([(x,) for x in xs], "i long")
    got = vectors.assign_again(spark.createDataFrame(pairs, "q long, i long, sim double"), one(range(4)), one([8]), 0.2)
    first = plain_assign(pairs, 0.2, {0, 1, 2, 3, 8})
    done = {q for q, *_ in first}
    again = plain_assign([p for p in pairs if p[0] not in done], 0.2, {8} | {i for _, i, _ in first})
    assert first and again
    assert sorted(map(tuple, got.collect())) == sorted(first + again)


def test_pictures(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    line = lambda *c: one(media.credit_line(F.array(*map(F.lit, c))))
    assert line("A", "", "B", "A") == "이미지 출처: A, B"
    assert line("A", media.GENERATED) == "이미지 출처: A · 일부 삽화는 AI로 만들었어요."
    assert line(media.GENERATED) == "삽화는 AI로 만들었어요."
    assert line("") == ""
    assert one(media.alt_text(F.lit(""), F.array(*map(F.lit, "abcd")), F.lit(False), "a picture")) == "a picture (a, b, c)"
    assert one(media.alt_text(F.lit("x"), F.lit(None), F.lit(None), "")).startswith("x — ")
    without = lambda t, *terms: one(media.without_terms(F.lit(t), F.array(*map(F.lit, terms))))
    assert without("a match at the Big.Cup in Muju", "big.cup", "muju") == "a match"
    assert without("at the", "zzz") == "at the"
    assert without(r"a\Eb c", r"a\Eb") == "c"
    assert one(media.named(F.array(*map(F.lit, [" Kim ", "", "Sport"])), ["sport"])) == ["Kim"]
    assert one(media.all_terms(F.array(F.array(F.lit("bb"), F.lit("a")), F.array(F.lit("ccc"), F.lit("aa"))))) == ["ccc", "aa", "bb"]
    assert one(media.chain(F.lit("m"), F.array(*map(F.lit, "anm")), F.array(F.lit("a")))) == ["m", "n"]
    assert [one(media.rotating(F.array(*map(F.lit, "abc")), F.lit(i))) for i in (0, 4, -1)] == ["a", "b", "c"]


def test_settings_and_replies(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    read = lambda s: one(media.lanes_of(F.lit(s), 30, 2))
    assert [tuple(x) for x in read("a : x, y:500:0 | b | :c | d::z:7")] == [("a", ["x", "y"], 100, 1), ("b", ["b"], 30, 2), ("d", ["d"], 30, 7)]
    assert read(" | :") is None
    reply = '```json\n[{"i": 1, "label": " good ", "why": "%s"}, {"i": 9, "label": "good"}, {"i": "2", "label": "odd"}, {"i": "x", "label": "good"}]\n```' % ("w" * 50)
    assert [tuple(x) for x in one(media.replies(F.lit(reply), ["good"], F.lit(3)))] == [(1, "good", "w" * 40)]
    assert not one(media.replies(F.lit("no"), ["good"], F.lit(3)))
    groups = F.array(F.array(F.lit(1)), F.array(F.lit(2), F.lit(3)))
    assert one(media.regrouped(groups, F.array(*map(F.lit, "xyz")))) == [["x"], ["y", "z"]]
    assert one(media.regrouped(groups, F.array(F.lit("x")))) is None


def test_units_without_any(spark):
    u = spark.createDataFrame([(1, 0, 0, 1, "a", "XX")], "id long, sentence int, start long, finish long, lemma string, tag string")
    assert tuple(units.word_counts(u, ("NN",), ("NN",)).first()) == (1, 0, 0, 0, 0.0)
    assert units.top_words(u, ("NN",)).count() == 0
    s = spark.createDataFrame([(1, 0, "b."), (1, 1, "a!"), (1, 2, " "), (2, 0, "none")], "id long, sentence int, text string")
    got = {r.id: tuple(r)[1:] for r in units.styles(s, [("x", "a!$"), ("y", r"b\.$")]).collect()}
    assert got == {1: (2, 2.0, "y", 0.5), 2: (1, 4.0, "", 0.0)}


def test_selection_without_pairs(spark, monkeypatch):
    """By signatures alone the selection is the same, in rounds and blocks smaller than a lane, and no table of pairs is made."""
    members, sig, known, tokens = editorial.lane_signatures(spark, SF)
    pairs = events.similar_pairs(sig, E)
    p, m, k = pairs.collect(), members.collect(), {r.id for r in known.collect()}
    monkeypatch.setattr(events, "HEAD", 9)
    monkeypatch.setattr(events, "BLOCK", 7)
    monkeypatch.setattr(events, "similar_pairs", None)
    order = editorial.LANES[:2]
    want = plain_selection(m, p, k, order, 5, 2)
    rows = sorted(lanes.select_by_lane(members, None, order, 5, 2, known, E, sig)[0].collect(), key=lambda r: r.place)
    for lane in order:
        assert [(r.id, r.leader, r.report_count, r.score) for r in rows if r.lane == lane] == want[lane]
    new, old = sig.where("id % 3 = 0"), sig.where("id % 3 > 0")
    assert {r.id for r in events.tell_of(new, old, E).collect()} == {x for r in p if _same(r, E.jaccard) for x, y in ((r.a, r.b), (r.b, r.a)) if x % 3 == 0 and y % 3}


def test_groups_are_read_only_as_far_as_they_are_asked_for(spark, monkeypatch):
    """The first groups are those of all groups, each whole, after fewer rounds; the records of a lane that has chosen are compared no more."""
    members, sig, known, _ = editorial.lane_signatures(spark, SF)
    monkeypatch.setattr(events, "FIRST", 8)
    monkeypatch.setattr(events, "HEAD", 8)
    seen, real, found = [], events.joined, {}
    monkeypatch.setattr(events, "joined", lambda *a: seen.append(a) or real(*a))
    pool = members.where("lane = 'en'").select("id")
    own = sig.join(pool, "id", "left_semi")
    for r in events.grouped(pool, own, E).collect():
        found.setdefault(r.leader, set()).add(r.id)
    rounds = len(seen)
    for top, least in ((2, 2), (5, 1), (10**6, 1)):
        seen.clear()
        got = {}
        for r in events.first_groups(pool, own, top, least, E).collect():
            got.setdefault(r.leader, set()).add(r.id)
        assert all(found[x] == ids for x, ids in got.items()) and set(got) == {x for x in found if x <= max(got)}
        assert sum(len(ids) >= least for ids in got.values()) >= top or got == found
        assert len(seen) < rounds or top == 10**6
    seen.clear()
    told = []
    monkeypatch.setattr(lanes, "tell_of", lambda new, *a: told.append(new.count()) or events.tell_of(new, *a))
    lanes.select_by_lane(members, None, ["en", "src0"], 2, 1, None, E, sig)
    assert len(told) == 1 and told[0] <= members.where("lane = 'src0'").count() and len(seen) < rounds


def test_what_is_known_is_known_by_its_tokens(spark):
    """A record isn't known because a known event happens to have its number."""
    of = lambda rows: spark.createDataFrame(rows, "id long, tokens array<long>")
    got = events.tell_of(of([(1, [1, 2, 3]), (2, [7, 8, 9]), (3, [50])]), of([(1, [7, 8]), (3, [60])]), E)
    assert [r.id for r in got.collect()] == [2]
