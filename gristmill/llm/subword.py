"""Quality classifier by supervised subword embeddings.

A document is the mean of learned vectors of its hashed features: each word as it stands, its character n-grams, and
whether a word repeats the one before it (a hashed word bigram of two classes). A softmax layer scores the mean. Both are
trained by stochastic gradient descent in numpy on at most SAMPLE labelled rows of each class, taken by a hash of their id;
that bound is what keeps the training set, a few hundred MB at most, on the driver. Scoring covers whole texts.

The output layer is linear in the mean, so each distinct word has one score of its own: workers keep them in a bounded
cache, and a document costs a look-up for each word.

Defined results: null or blank text has no features and gets the score of the bias alone; null ids are scored and are not
held out (their fold is null); a null label or one that isn't 0 or 1 isn't learned from; with one class or no labelled
row all scores are the class share (0.5 without rows). Repeated rows get equal scores. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import fold

BUCKETS, DIM, NGRAMS = 1 << 15, 16, (2, 3)
SAMPLE, EPOCHS, RATE = 1500, 12, 0.1
CACHE = 300_000
#: Features of a word after an equal word and after another one.
SAME, OTHER = 0, 1


def features(word: str) -> list[int]:
    """The word itself and its character n-grams, with marks at both ends; buckets 0 and 1 are kept for repetition."""
    code = f"<{word}>".encode("utf-32-le")
    out = [zlib.crc32(code)]
    for n in NGRAMS:
        out += [zlib.crc32(code[i : i + 4 * n]) for i in range(0, len(code) - 4 * n + 1, 4)]
    return [2 + x % (BUCKETS - 2) for x in out]


def _bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and their shares."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    counts: dict[int, int] = {}
    same = sum(map(eq, words, words[1:]))
    tally: dict[str, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    for w, n in tally.items():
        for f in features(w):
            counts[f] = counts.get(f, 0) + n
    counts[SAME], counts[OTHER] = same * WEIGHT, (len(words) - same) * WEIGHT
    ids = np.fromiter(counts, np.int32, len(counts))
    share = np.fromiter(counts.values(), np.float32, len(counts))
    return ids, share / share.sum()


#: How often a repetition feature counts: about as often as a word has n-grams.
WEIGHT = 8


class Model:
    def __init__(self, vectors: np.ndarray, output: np.ndarray, bias: np.ndarray):
        self.vectors, self.output, self.bias = vectors, output, bias

    def logits(self) -> np.ndarray:
        """What each feature adds to the log odds of class 1, before the mean is taken."""
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float64)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 5) -> Model:
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    output, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    weight = len(labels) / (2 * np.maximum(np.bincount(labels, minlength=2), 1))  # classes count alike
    if len(set(labels.tolist())) < 2:
        share = labels.mean() if len(labels) else 0.5
        bias[1] = np.log((share + 1e-6) / (1 - share + 1e-6))
        return Model(vectors, output, bias)
    steps, total = 0, EPOCHS * len(bags)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            ids, share = bags[i]
            rate = RATE * (1 - steps / total)
            steps += 1
            mean = share @ vectors[ids] if len(ids) else np.zeros(DIM, np.float32)
            z = output @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            p *= weight[labels[i]]
            back = p @ output
            output -= rate * np.outer(p, mean)
            bias -= rate * 0.1 * p
            # shares are small: a mean of many vectors moves only if each moves by more than its share
            vectors[ids] -= (rate * SPREAD) * share[:, None] * back
    return Model(vectors, output, bias)


SPREAD = 20.0


class _Scores(dict):
    """Word: its summed log odds and number of features, as one complex number."""

    def __init__(self, per_feature: list[float]):
        self.per_feature = per_feature

    def __missing__(self, word: str) -> complex:
        ids = features(word)
        if len(self) >= CACHE:
            self.clear()
        self[word] = out = complex(sum(map(self.per_feature.__getitem__, ids)), len(ids))
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train_fold, id_col: str, text_col: str, size: int = SAMPLE) -> DataFrame:
    """(text, y): at most size rows of each class, by a hash of the id, of the labelled rows in the training fold."""
    own = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & train_fold("_id"))
    order = [F.md5(F.col("_id").cast("string")), "_id"]
    picked = own.where("y = 0").orderBy(*order).limit(size).union(own.where("y = 1").orderBy(*order).limit(size))
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "_id").select("_id", "text", "y")


def fit(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """The classifier of a label. sample: labelled rows of each class of the training fold that are looked at, at most."""

    def bags(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            made = [_bag(t) for t in p.text]
            yield pd.DataFrame({"id": p["_id"], "y": p.y, "ids": [a.tobytes() for a, _ in made], "share": [b.tobytes() for _, b in made]})

    some = labelled_sample(docs, labels, label, lambda c: fold(c, folds) != held, id_col, text_col, sample)
    rows = some.mapInPandas(bags, "id long, y int, ids binary, share binary").toPandas().sort_values(["id", "y", "ids"])
    return train([(np.frombuffer(a, np.int32), np.frombuffer(b, np.float32)) for a, b in zip(rows.ids, rows.share, strict=True)], rows.y.to_numpy(int))


def scored(docs: DataFrame, model: Model, text_col: str = "text", into: str = "quality_score") -> DataFrame:
    """docs with the column into: the probability of class 1 from the whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model.logits().tolist())  # one number a bucket
    bias = float(model.bias[1] - model.bias[0])

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = _Scores(sent.value)
        same_odds, other_odds = sent.value[SAME] * WEIGHT, sent.value[OTHER] * WEIGHT

        def one(text: str | None) -> float:
            words = (text or "").split()
            if not words:
                return bias
            total = sum(map(cache.__getitem__, words))
            same = sum(map(eq, words, words[1:]))
            return bias + (total.real + same * same_odds + (len(words) - same) * other_odds) / (total.imag + len(words) * WEIGHT)

        for p in parts:
            yield pd.Series(1 / (1 + np.exp(-np.clip([one(t) for t in p], -500, 500))), dtype=float)

    return docs.withColumn(into, score(F.col(text_col).cast("string")))


def report(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, held: int = 1, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row. sample: as in fit."""
    out = scored(docs.select("doc_id", "text"), fit(docs, labels, label, folds, held, sample=sample))
    return out.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), F.col("quality_score").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
