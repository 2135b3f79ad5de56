"""Toxicity by multiple-instance learning: a document is toxic as soon as one of its sentences is.

Only documents have labels. A sentence's score is logistic in the weights of its words; the document's score joins
the sentence scores by noisy-or, ``1 - prod(1 - p)``, and the likelihood of the document labels is climbed through
that join, so that the blame falls on the sentences that explain it. Scoring then names the worst sentence's place.

Words count by themselves and by their first three to six letters (inflected forms share beginnings). Features must
occur in ``min_docs`` training documents; an L1 penalty leaves few. The model is a small dictionary (at most
``max_features`` entries), sent with the tasks; every text is scored whole.

Training and scoring read a sentence alike: each feature that any of its words has counts once. The sample that the model is
fitted on is bounded by rows and by characters in all; long documents stand in it as often as short ones, and whole.

Defined cases: null and empty texts have no sentence and get score 0. Without labels of both classes no word has a
weight and every score is 0. Repeated rows get equal scores. Extra columns of the input do not matter.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm.common import fold, free_name, labelled_sample, ready

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
BIAS = -5.0
LEAK = 1.0 / (1.0 + np.exp(-BIAS))
SCORE_TYPE = "score double, worst_start int, worst_end int, worst_score double"


def features(word: str) -> list[str]:
    """The word itself, and its beginnings marked by a star."""
    return [word, *(word[:n] + "*" for n in range(3, 7) if len(word) >= n)]


def sentences(text: str) -> list[tuple[int, int, set[str]]]:
    """Start, end and distinct lower-case words of each sentence that has a word."""
    out = []
    for found in SENTENCE.finditer(text):
        words = set(WORD.findall(found.group().lower()))
        if words:
            out.append((found.start(), found.end(), words))
    return out


def sentence_probability(z: np.ndarray) -> np.ndarray:
    """Logistic with a fixed bias, less what a sentence without evidence would get: no evidence counts nothing."""
    return np.maximum((1.0 / (1.0 + np.exp(-np.clip(z + BIAS, -40, 40))) - LEAK) / (1.0 - LEAK), 0.0)


@dataclass(frozen=True)
class Model:
    """Feature weights of the sentence scorer."""

    weights: dict[str, float]

    def known(self, token: str) -> tuple[str, ...]:
        """The features with a weight that the words of a token have."""
        return tuple({f for word in WORD.findall(token) for f in features(word) if f in self.weights})

    def score(self, text: str | None, cache: dict[str, tuple[str, ...]]) -> tuple[float, int, int, float]:
        """Document score; place and score of its worst sentence (-1, -1, 0 without a suspicious one)."""
        clean, worst = 1.0, (-1, -1, 0.0)
        for found in SENTENCE.finditer(text or ""):
            own: set[str] = set()
            for token in set(found.group().lower().split()):
                hits = cache.get(token)
                if hits is None:
                    if len(cache) > 400_000:
                        cache.clear()
                    hits = cache[token] = self.known(token)
                own.update(hits)
            if own:
                # In a fixed order, so that equal sentences get the same sum.
                p = float(sentence_probability(np.float64(sum(self.weights[f] for f in sorted(own)))))
                clean *= 1.0 - p
                if p > worst[2]:
                    worst = (found.start(), found.end(), p)
        return (1.0 - clean, *worst)


def train(texts: list[str], toxic: list[int], min_docs: int = 5, max_features: int = 30_000, steps: int = 250) -> Model:
    """Climb the penalised likelihood of document labels with Adam, over all documents at once."""
    # Sentences hold their words as numbers: sets of strings of all of them took hundreds of megabytes in the driver.
    number_of: dict[str, int] = {}
    bags = [[array("i", [number_of.setdefault(w, len(number_of)) for w in words]) for _, _, words in sentences(t or "")] for t in texts]
    vocabulary = list(number_of)
    toxic = np.asarray(toxic, float)
    if not len(toxic) or toxic.min() == toxic.max():
        return Model({})
    seen, hits = Counter(), Counter()
    for bag, y in zip(bags, toxic, strict=True):
        own = {f for w in set().union(*bag) for f in features(vocabulary[w])}
        seen.update(own)
        if y:
            hits.update(own)
    rate = toxic.mean()
    # Features that stand no more often in toxic documents than elsewhere cannot get a weight above nothing.
    useful = [f for f, n in seen.items() if n >= min_docs and hits[f] > 1.5 * rate * n]
    useful = sorted(useful, key=lambda f: (-hits[f] / (seen[f] + 2.0), f))[:max_features]
    if not useful:
        return Model({})
    number = {f: i for i, f in enumerate(useful)}
    numbers = [[number[f] for f in features(w) if f in number] for w in vocabulary]
    doc_of, sentence_of, feature_of, n_sentences = array("q"), array("q"), array("q"), 0
    for d, bag in enumerate(bags):
        for words in bag:
            own = sorted({i for w in words for i in numbers[w]})
            if own:
                doc_of.append(d)
                sentence_of.extend([n_sentences] * len(own))
                feature_of.extend(own)
                n_sentences += 1
    doc_of, sentence_of, feature_of = (np.array(x, np.int64) for x in (doc_of, sentence_of, feature_of))
    w = np.full(len(useful), 0.5)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = np.bincount(sentence_of, w[feature_of], n_sentences)
        sigma = 1.0 / (1.0 + np.exp(-np.clip(z + BIAS, -40, 40)))
        p = np.clip((sigma - LEAK) / (1.0 - LEAK), 0.0, 1.0 - 1e-9)
        log_clean = np.bincount(doc_of, np.log1p(-p), len(toxic))
        prob = np.clip(1.0 - np.exp(log_clean), 1e-3, 1.0 - 1e-9)
        # d loss / d log(1 - p): 1 - 1/prob for toxic documents, -1 for others (as a loss), then through p to z.
        outer = np.where(toxic > 0, (1.0 - prob) / prob, -1.0)[doc_of]
        slope = sigma * (1.0 - sigma) / (1.0 - LEAK) / (1.0 - p)
        gradient = -np.bincount(feature_of, (outer * slope)[sentence_of], len(useful)) / len(toxic)
        gradient = gradient + 2e-5 * np.sign(w)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w = np.maximum(w, 0.0)
    return Model({f: float(x) for f, x in zip(useful, w, strict=True) if x > 0.05})


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 5_000, max_chars: int = 50_000_000) -> Model:
    """Train on at most ``max_rows`` labelled documents outside the held-out fold, with about ``max_chars`` in all.

    Documents are taken whole, in a pseudo-random order by id, until these bounds are reached; the last may pass
    ``max_chars``. The bounds hold the sample that comes to the driver; they bound training only.
    """
    ready(docs.sparkSession)
    sample = labelled_sample(docs.select("doc_id", "text"), labels, "toxic", max_rows, train_only=True)
    # A window over all of the sample: it has at most max_rows rows.
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    taken = sample.withColumn("before", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)))
    rows = taken.where(F.col("before") < max_chars).select("doc_id", "text", "toxic").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    return train(rows["text"].tolist(), rows["toxic"].tolist())


def scores(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct column: score, place (code points, end exclusive) and score of the worst sentence."""
    ready(docs.sparkSession)
    names = [part.split()[0] for part in SCORE_TYPE.split(", ")]

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache: dict[str, float] = {}
        for texts in batches:
            yield pd.DataFrame([model.score(t, cache) for t in texts], columns=names)

    return F.pandas_udf(score, SCORE_TYPE)(F.col(text))


def toxicity_table(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and the worst sentence."""
    scored = docs.select("doc_id", scores(docs, fit(docs, labels)).alias("s"))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
        F.col("s.score").alias("score"),
        F.when(F.col("s.score") >= threshold, 1).otherwise(0).alias("predicted"),
        F.col("s.worst_start").alias("worst_start"),
        F.col("s.worst_end").alias("worst_end"),
        F.col("s.worst_score").alias("worst_score"),
    )


def toxicity_filter(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents below the threshold, with their own columns only."""
    name = free_name(docs, "_toxicity_")
    scored = docs.withColumn(name, scores(docs, fit(docs, labels)))
    return scored.where(F.col(f"{name}.score") < threshold).drop(name)
