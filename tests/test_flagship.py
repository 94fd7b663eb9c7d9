"""The main selection against loops over the same cleaned and gated records."""

import re
from collections import Counter

from pyspark.sql import functions as F

from gristmill.config import LATIN
from gristmill.functions.cleaning import cleaned
from gristmill.plans.flagship import TABLES, facts, records, selected

SF = "/root/testdata/sf0.001"


def tokens(text):
    out = []
    for t in re.findall("[a-z]{2,}", text):
        end = next((p for p in LATIN.particles if t.endswith(p) and len(t) - len(p) >= 2), "")
        t = t[: len(t) - len(end)]
        if len(t) >= 2 and t not in LATIN.stopwords and not re.search("(?:tion|ly)$", t):
            out.append(t)
    return out


def plain(rows, top, least):
    n, often = len(rows), Counter()
    for r in rows:
        often.update(set(tokens(f"{r.title}\n{r.body_clean}")))
    weight = {t: c / n * (2.0 if any(w in t for w in LATIN.core + LATIN.generic) else 1.0) for t, c in often.items() if c >= 2}
    weight = dict(sorted(weight.items(), key=lambda x: (-x[1], x[0]))[:15])
    good = [r for r in rows if r.gate == "ok"]
    sig = {r.id: set(re.findall("[a-z]{2,}", f"{r.title}\n{r.body_clean}")) for r in good}
    df = Counter(t for s in sig.values() for t in s)
    sig = {i: {t for t in s if df[t] <= max(3, len(good) // 2)} for i, s in sig.items()}

    def same(a, b):
        s = len(a & b)
        return bool(s) and (s / len(a | b) >= 0.15 or (s >= 15 and s / min(len(a), len(b)) >= 0.5))

    groups = []
    for r in good:
        own = next((g for g in groups if same(sig[r.id], sig[g[0].id])), None)
        groups.append([r]) if own is None else own.append(r)

    def score(r):
        title, body = set(tokens(r.title)), set(tokens(r.body_clean))
        return round(sum(w * (1.5 if t in title else 1.0) for t, w in weight.items() if t in title | body), 4)

    best = []
    for g in groups:
        r = max(g, key=lambda x: (len(x.body_clean), score(x)))
        best.append((r.id, len(g), score(r) * min(1 + 0.35 * (len(g) - 1), 1.5)))
    best = sorted(best, key=lambda x: x[1] < least)[:top]
    return best, max(s for *_, s in best)


def test_selection(spark):
    df = records(spark, SF)
    rows = facts(cleaned(df, "body", without=("foreign_lines",)), TABLES, "body_clean").select("id", "title", "body_clean", F.col("gate")).orderBy("id").collect()
    for top, least in ((40, 3), (7, 1)):
        want, most = plain(rows, top, least)
        got = selected(df, TABLES, top=top, least_reports=least).orderBy("place").collect()
        assert [(r.id, r.report_count) for r in got] == [(i, n) for i, n, _ in want]
        assert all(abs(r.score - s) < 2e-4 and abs(r.score_norm - 100 * s / most) <= 1 for r, (*_, s) in zip(got, want, strict=True))


def test_no_more_groups_than_are_chosen(spark, monkeypatch):
    """The best of the first groups need no others: not all of them are made."""
    from gristmill.plans import flagship

    monkeypatch.setattr(flagship.events, "grouped", None)
    assert selected(records(spark, SF).where("id < 60"), TABLES, top=3, least_reports=1).count() == 3
