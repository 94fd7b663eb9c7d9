"""Divergence audit against a plain version in whole numbers, on made texts with hot, empty and null groups."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from gristmill.llm import divergence
from gristmill.llm.common import text_chunks

import pyarrow as pa

SCHEMA = "text string, lang string, source string, doc_id long, term string, n long, value long"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def plain(rows, least, top):
    docs = [((t or "").translate(LOW), lang or "", source or "") for t, lang, source in rows]
    held, count, groups = defaultdict(set), Counter(), {(lang, source) for _, lang, source in docs}
    for k, (text, lang, source) in enumerate(docs):
        for term in TERM.findall(text):
            held[lang, term].add(k)
            count[lang, source, term] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), d in held.items() if x == lang and len(d) >= least)
        sources = sorted(s for x, s in groups if x == lang)
        p_of = lambda n, v: 1 + 10**9 * (n + 1) // v
        p = {}
        for s in sources:
            total = sum(count[lang, s, t] for t in kept) + len(kept)
            p[s] = [p_of(count[lang, s, t], total) for t in kept]
        all_ = [sum(count[lang, s, t] for s in sources) for t in kept]
        q = [p_of(n, sum(all_) + len(kept)) for n in all_]
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(map(f, p[s], p[o])), o) for o in sources if o != s]
            terms = [(f(a, b), t) for t, a, b in zip(kept, p[s], q, strict=True) if count[lang, s, t] and a > b]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, t, v, k + 1) for k, (v, t) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


def ask(spark, rows, least=3, top=4):
    df = spark.createDataFrame([(*r, k, "clash", 7, 8) for k, r in enumerate(rows)], SCHEMA)
    return sorted(map(tuple, divergence.divergences(df, least, top).select("lang", "source", "part", "item", "value", "rank").collect()))


def test_against_a_plain_version(spark, monkeypatch):
    rng = random.Random(5)
    words = ["the", "The", "Ümlaut", "ümlaut", "x", "漢字", "don't", "a1b", "é", "I", *(f"w{chr(97 + i)}" for i in range(26))]
    rows = []
    for _ in range(300):
        source = rng.choice(["hot"] * 6 + ["a", "b", None, ""])
        rows.append((rng.choice([None, "", " ".join(rng.choices(words, k=rng.randrange(40)))]) if rng.random() < 0.2 else " ".join(rng.choices(words, k=rng.randrange(1, 60))), rng.choice(["en", "en", "de", None]), source))
    rows += [("alone only here", "zz", "s"), (None, "zz", "t"), ("12 34", "yy", "u")] + [("same same", "en", "rep")] * 50
    rows += [("long " * 200_000 + "end", "en", "long")]
    want = plain(rows, 3, 4)
    assert ask(spark, rows) == want
    monkeypatch.setattr(divergence, "SLOT_ROWS", 8)
    assert ask(spark, rows) == want
    assert ask(spark, rows[:0]) == []
    assert ask(spark, [(None, None, None), ("", "en", "a"), ("", "en", "b")]) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_bytes_decide_where_hashes_agree():
    raw, offsets = next((raw, offsets) for _, _, raw, offsets in text_chunks(pa.array(["Abc abd ABC", "bc", None, "c abd é"])))
    low, begin, end = divergence.slices(raw, offsets)
    for hashed in (lambda b: 1, lambda b: len(b)):
        terms, which = divergence.grouped(low, begin, end, hashed)
        assert [terms[k].decode() for k in which] == ["abc", "abd", "abc", "bc", "c", "abd", "é"]
        assert len(set(terms)) == len(terms)


def test_long_division_is_exact():
    rng = random.Random(1)
    for _ in range(2000):
        total = rng.choice([rng.randrange(1, 100), rng.randrange(1, 9 * 10**15)])
        count = rng.randrange(total)
        assert int(divergence.scaled(np.array([count]), np.array([total]))[0]) == 1 + 10**9 * (count + 1) // total
