"""Toxicity by weak supervision.

Many voters look at a text: one for each group of the insult lexicon and some patterns. Each says toxic (1), clean (-1) or
nothing (0). A generative label model, fitted by expectation maximisation, estimates from their votes how accurate each
voter is on either class; voters that agree more often than the model explains are found by their residual correlation and
share their weight. Its posterior labels train a linear classifier on hashed words and beginnings of words, each as
being there and as being there again, which scores whole texts. So the classifier also learns words that no voter knows.

What is looked at: the voters read every document of the training fold, labelled or not, and the label model is fitted on the
counts of all their patterns of votes, which Spark adds up: there are no more patterns than the voters allow, whatever the
size of the corpus. Some voters are lexicons learned from the labelled sample, which is bounded by `sample`, a parameter: so
many labelled rows of each class of the training fold, by a hash of their id. The classifier is fitted on that sample, with
the label model's posteriors as targets. A label is one more voter; it has nothing to say of documents without one.

Defined results: null or empty text has no words and gets the score of the bias alone; null ids are scored and aren't held
out; null labels aren't learned from; without labelled rows all scores are 0.5. Repeated rows get equal scores. Other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import fold
from gristmill.llm.subword import labelled_sample

BUCKETS, CACHE = 1 << 20, 300_000
#: Labelled rows of each class that a fit looks at, if the caller doesn't say.
SAMPLE = 3000
#: Lengths of the beginnings of a word; least documents of a feature; least |z| for the classifier, and for a learned lexicon.
PREFIXES, LEAST_DOCS, EVIDENCE, LEXICON_EVIDENCE, LEARNED = (4, 5, 6), 5, 4.0, 6.0, 6
COPY = 0.8

#: The insult lexicon, a voter for each group.
LEXICON = {
    "stupid": "idiot idiots idiotic moron morons moronic stupid dumb dumbass imbecile fool fools cretin dimwit halfwit brainless",
    "contempt": "pathetic loser losers worthless clown clowns useless laughable coward cowards",
    "disgust": "trash disgusting scum filth filthy vermin garbage vile repulsive revolting sickening subhuman",
    "hate": "hate hateful despise bastard bastards bitch bitches parasite parasites",
    "profane": "shit shitty fuck fucking fucker asshole crap damn piss bollocks wanker",
    "threat": "kill murder strangle lynch",
    "german": "dumm idiotisch trottel depp arschloch abschaum dreck widerlich versager wertlos hurensohn scheisse scheiße",
    "french": "stupide idiote connard connasse crétin ordure dégoûtant minable salaud merde imbécile",
    "spanish": "idiota estúpido estúpida imbécil basura asqueroso escoria inútil mierda cabrón payaso patético",
}
GROUPS = {k: frozenset(v.split()) for k, v in LEXICON.items()}
ALL = frozenset().union(*GROUPS.values())
_AIMED = re.compile(r"\b(?:you|your|youre|u)\b[^.!?\n]{0,40}\b(?:" + "|".join(sorted(ALL)) + r")\b", re.I)
_WORD = re.compile(r"[^\W\d_]+")
VOTERS = (*GROUPS, "aimed", "repeated", "dense", "varied", "none")


def votes(text: str) -> list[int]:
    """One vote each of VOTERS."""
    words = [w.lower() for w in _WORD.findall(text)]
    hits = [w for w in words if w in ALL]
    out = [1 if any(w in g for w in hits) else 0 for g in GROUPS.values()]
    out.append(1 if hits and _AIMED.search(text) else 0)
    out.append(1 if len(hits) >= 2 else 0)
    out.append(1 if hits and len(hits) * 200 >= len(words) else 0)
    out.append(1 if len(set(hits)) >= 2 else 0)
    out.append(0 if hits else -1)
    return out


def label_model(seen: np.ndarray, times: np.ndarray | None = None, rounds: int = 50, prior: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probability of class 1 for each pattern of votes (1, -1, 0), and each voter's weight. times: rows of each pattern.

    Correlated voters share their weight: with S the sum of a voter's absolute correlations with the others that stand out,
    its log odds count 1 / (1 + S) times. At first these are plain correlations of COPY and more; after each fit, what the
    class leaves unexplained, beyond chance.
    """
    k, v = seen.shape
    times = np.ones(k) if times is None else times.astype(float)
    n = max(times.sum(), 1.0)

    def shared(rest: np.ndarray, least: float) -> np.ndarray:
        scaled = rest / (np.sqrt(times @ rest**2 / n) + 1e-9)
        linked = np.abs(scaled.T @ (scaled * times[:, None]) / n)
        np.fill_diagonal(linked, 0)
        return 1 / (1 + np.where(linked >= least, linked, 0).sum(1))

    weight = shared(seen - times @ seen / n, COPY) if k else np.ones(v)
    rates = np.empty((2, v, 3))
    own = np.stack([(seen == x) for x in (-1, 0, 1)], -1).astype(float)
    posterior = np.clip(1 / (1 + np.exp(-2 * (seen @ weight - 0.5))), 0.02, 0.98)
    for step in range(3):
        for _ in range(rounds):
            for y, p in ((0, (1 - posterior) * times), (1, posterior * times)):
                rates[y] = (np.einsum("n,nvk->vk", p, own) + 0.5) / (p.sum() + 1.5)
            prior = float(np.clip(times @ posterior / n, 0.02, 0.98))
            odds = np.log(prior / (1 - prior)) + np.einsum("nvk,vk,v->n", own, np.log(rates[1] / rates[0]), weight)
            fresh = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
            moved, posterior = np.abs(fresh - posterior).max() if k else 0, fresh
            if moved < 1e-4:
                break
        if step < 2 and k:
            expected = np.stack([(rates[y, :, 2] - rates[y, :, 0]) for y in (0, 1)])
            weight = shared(seen - (np.outer(1 - posterior, expected[0]) + np.outer(posterior, expected[1])), 3 / np.sqrt(n))
    return posterior, weight


def token_features(token: str) -> list[int]:
    """Hashes of the lower-cased word in a token and of its beginnings; none if there is no letter."""
    m = _WORD.search(token)
    if not m:
        return []
    w = m[0].lower()
    return [zlib.crc32(f"{n}:{w[:n]}".encode()) % BUCKETS for n in PREFIXES if n < len(w)] + [zlib.crc32(f"={w}".encode()) % BUCKETS]


def _doc_features(counts: dict[int, int]) -> list[int]:
    """Feature f that occurs at all is f; that it occurs again is f + BUCKETS."""
    return list(counts) + [f + BUCKETS for f, n in counts.items() if n > 1]


def _ids(text: str) -> np.ndarray:
    counts: dict[int, int] = {}
    for token, n in Counter(text.split()).items():
        for f in token_features(token):
            counts[f] = counts.get(f, 0) + n
    return np.sort(np.array(_doc_features(counts), np.int32))


def evidence(bags: list[np.ndarray], target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """z of the difference in how often a feature occurs in either class, and in how many documents it occurs."""
    ids = np.concatenate([*bags, np.zeros(0, np.int32)]).astype(int)
    weight = np.repeat(target, [len(b) for b in bags])
    docs, ones = np.bincount(ids, minlength=2 * BUCKETS), np.bincount(ids, weight, minlength=2 * BUCKETS)
    n, n1 = len(bags), max(target.sum(), 1e-9)
    n0 = max(n - n1, 1e-9)
    p = (docs + 0.5) / (n + 1)
    z = (ones / n1 - (docs - ones) / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
    return np.where(docs >= LEAST_DOCS, z, 0.0), docs


def linear(bags: list[np.ndarray], target: np.ndarray, epochs: int = 40, rate: float = 0.1, ridge: float = 2e-3, seed: int = 3) -> tuple[np.ndarray, float]:
    """Logistic regression on which features occur, by AdaGrad over mini-batches. Features without evidence take no part."""
    weights, bias = np.zeros(2 * BUCKETS), 0.0
    if not bags:
        return weights, bias
    good = np.abs(evidence(bags, target)[0]) >= EVIDENCE
    kept = [b[good[b]] for b in bags]
    rng, grown, grown_bias = np.random.default_rng(seed), np.full(2 * BUCKETS, 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(kept))
        for i in range(0, len(order), 32):
            rows = order[i : i + 32]
            ids = np.concatenate([kept[r] for r in rows]).astype(int)
            row = np.repeat(np.arange(len(rows)), [len(kept[r]) for r in rows])
            z = bias + np.bincount(row, weights[ids], len(rows))
            error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target[rows]) / len(rows)
            distinct, back = np.unique(ids, return_inverse=True)
            g = np.bincount(back, error[row], len(distinct)) + ridge / len(rows) * weights[distinct]
            grown[distinct] += g * g
            weights[distinct] -= rate * g / np.sqrt(grown[distinct])
            grown_bias += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(grown_bias)
    return weights, float(bias)


def learned_lexicons(bags: list[np.ndarray], y: np.ndarray) -> dict[int, int]:
    """Voter of each feature that stands out in labelled toxic rows, dealt over LEARNED voters."""
    z, _ = evidence(bags, (y == 1).astype(float))
    return {int(f): int(f) % LEARNED for f in np.flatnonzero(z >= LEXICON_EVIDENCE)}


def pattern_of(seen: list[int], ids: np.ndarray, lexicons: dict[int, int]) -> str:
    """All votes on a text as letters: + toxic, - clean, 0 nothing."""
    found = {lexicons[f] for f in ids.tolist() if f in lexicons}
    return "".join("-0+"[x + 1] for x in seen) + "".join("+" if k in found else "0" for k in range(LEARNED))


def weak_labels(patterns: dict[tuple[str, int], int]) -> dict[tuple[str, int], float]:
    """The label model's probability of class 1 for each (pattern, y), from how many documents have it. y: 1, 0, or anything for none."""
    names = sorted(patterns)
    gold = {1: 1, 0: -1}
    seen = np.array([[*("-0+".index(x) - 1 for x in p), gold.get(y, 0)] for p, y in names], int).reshape(len(names), -1)
    return dict(zip(names, label_model(seen, np.array([patterns[k] for k in names]))[0].tolist(), strict=True))


def learn(bags: list[np.ndarray], target: np.ndarray) -> tuple[dict[int, float], float]:
    """The classifier from features and targets: weight of each feature that has one, and the bias."""
    weights, bias = linear(bags, target)
    some = np.flatnonzero(np.abs(weights) > 1e-3)
    return dict(zip(some.tolist(), weights[some].tolist(), strict=True)), bias


def fit(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[dict[int, float], float]:
    """The classifier of a label. sample: labelled rows of each class of the training fold that are looked at, at most."""
    train_fold = lambda c: F.coalesce(fold(c, folds) != held, F.lit(True))
    rows = looked_at(labelled_sample(docs, labels, label, lambda c: fold(c, folds) != held, id_col, text_col, sample))
    if rows.empty:
        return {}, 0.0
    bags, y = [np.frombuffer(b, np.int32) for b in rows.ids], rows.y.to_numpy()
    lexicons = learned_lexicons(bags, y)
    target = weak_labels(patterns(docs.where(train_fold(id_col)), labels, label, lexicons, id_col, text_col))
    own = [pattern_of(list(v), b, lexicons) for v, b in zip(rows.votes, bags, strict=True)]
    return learn(bags, np.array([target.get((p, int(k)), float(k)) for p, k in zip(own, y, strict=True)]))


def looked_at(sample: DataFrame) -> pd.DataFrame:
    """(id, y, votes, ids) of the labelled sample."""

    def look(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            texts = [t or "" for t in p.text]
            yield pd.DataFrame({"id": p["_id"], "y": p.y, "votes": [votes(t) for t in texts], "ids": [_ids(t).tobytes() for t in texts]})

    return sample.mapInPandas(look, "id long, y int, votes array<int>, ids binary").toPandas().sort_values(["id", "y", "ids"])


def patterns(docs: DataFrame, labels: DataFrame, label: str, lexicons: dict[int, int], id_col: str = "doc_id", text_col: str = "text") -> dict[tuple[str, int], int]:
    """How many of docs have each pattern of votes and label (-1: none). At most 2 ** voters patterns, whatever the size of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicons)

    @F.pandas_udf("string")
    def pattern(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _Known(sent.value)

        def one(text: str) -> str:
            found = {sent.value[f] for f in known.doc_features(text) if f in sent.value}
            return "".join("-0+"[x + 1] for x in votes(text)) + "".join("+" if k in found else "0" for k in range(LEARNED))

        for p in parts:
            yield pd.Series([one(t or "") for t in p], dtype=object)

    told = labels.where(F.col(label).isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.max(label).cast("int").alias("_y"))
    seen = docs.select(F.col(id_col).cast("long").alias("_id"), pattern(F.col(text_col).cast("string")).alias("_pattern"))
    found = seen.join(told, "_id", "left").groupBy("_pattern", F.coalesce("_y", F.lit(-1)).alias("_y")).count().collect()
    return {(r["_pattern"], r["_y"]): r["count"] for r in found}


class _Known(dict):
    """Token: those of its features that have a weight, once or again; None if it has none."""

    def __init__(self, weights: dict[int, float]):
        self.features = {f % BUCKETS for f in weights}

    def __missing__(self, token: str) -> tuple[int, ...] | None:
        if len(self) >= CACHE:
            self.clear()
        self[token] = out = tuple(f for f in token_features(token) if f in self.features) or None
        return out

    def doc_features(self, text: str) -> list[int]:
        """Those features of a text whose kind has a weight."""
        counts: dict[int, int] = {}
        for some in filter(None, map(self.__getitem__, text.split())):
            for f in some:
                counts[f] = counts.get(f, 0) + 1
        return _doc_features(counts)


def scored(docs: DataFrame, model: tuple[dict[int, float], float], text_col: str = "text", into: str = "toxicity_score") -> DataFrame:
    """docs with the column into: the probability that a text is toxic. A column of that name is refused."""
    if into.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {into} already")
    sent = docs.sparkSession.sparkContext.broadcast(model[0])  # at most two weights for each of BUCKETS
    bias = model[1]

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = sent.value
        known = _Known(weights)

        def one(text: str | None) -> float:
            return bias + sum(weights.get(f, 0.0) for f in sorted(known.doc_features(text or "")))

        for p in parts:
            yield pd.Series(1 / (1 + np.exp(-np.clip([one(t) for t in p], -500, 500))), dtype=float)

    return docs.withColumn(into, score(F.col(text_col).cast("string")))


def report(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held: int = 0, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row. sample: as in fit."""
    out = scored(docs.select("doc_id", "text"), fit(docs, labels, label, folds, held, sample=sample))
    return out.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), F.col("toxicity_score").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
