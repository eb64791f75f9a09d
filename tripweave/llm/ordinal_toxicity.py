"""Toxicity: cumulative-link ordinal regression from sparse text features to severity grades.

P(grade >= j) = logistic(w x - cut_j): one set of weights for all ordered cuts. Features are words
and word beginnings, weighed by how often they occur. Labels tell toxic or not; grade 2 is a
toxic text with more marked words than the median toxic text, grade 1 the other toxic ones. The
expected severity is the sum of P(grade >= j).
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.batches import map_slices
from tripweave.session import cut

#: Labelled rows used for fitting at most: those with the smallest hash of doc_id.
SAMPLE_ROWS = 20_000
#: Features kept at most, by the strength of their association with the label.
MAX_FEATURES = 3_000
#: Least likelihood-ratio statistic of a feature, and least toxic texts that have it.
MIN_ASSOCIATION, MIN_TEXTS = 15.0, 3
#: Lengths of word beginnings used as features.
BEGINNINGS = (5, 6, 7, 8)
GRADES = 3
_WORD = re.compile(r"[^\W\d_]+")


def word_counts(text: str) -> Counter:
    return Counter(_WORD.findall(text.lower()))


def tokens(counts: Counter) -> Counter:
    """Words, and their beginnings marked with a dash, each with its number of occurrences."""
    out = Counter(counts)
    for word, n in counts.items():
        for size in BEGINNINGS:
            if len(word) > size:
                out[word[:size] + "-"] += n
    return out


class Model:
    """Weights by feature, and increasing cuts."""

    def __init__(self, weights: dict[str, float], cuts: list[float]):
        self.weights, self.cuts = weights, cuts

    def score(self, text: str) -> float:
        weights, total = self.weights, 0.0
        hits: dict[str, int] = {}
        for word, n in word_counts(text).items():
            if word in weights:
                hits[word] = hits.get(word, 0) + n
            for size in BEGINNINGS:
                if len(word) > size and (start := word[:size] + "-") in weights:
                    hits[start] = hits.get(start, 0) + n
        for feature in sorted(hits):
            total += weights[feature] * math.log2(1 + hits[feature])
        return total

    def exceeds(self, text: str) -> list[float]:
        """P(grade >= j) for j = 1, 2 ..."""
        s = self.score(text)
        return [1 / (1 + math.exp(-max(-500.0, min(500.0, s - c)))) for c in self.cuts]


def fit_cumulative(
    rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grade: np.ndarray, n_features: int,
    *, penalty: float = 1.0, steps: int = 400,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts that maximize the penalized likelihood, by Adam on all rows.

    Cuts are the first one and positive steps, so they stay in order.
    """
    n = len(grade)
    w, cuts = np.zeros(n_features), np.log(np.arange(1, GRADES) + 1.0)
    params = np.concatenate([w, [cuts[0]], np.log(np.diff(cuts))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, steps + 1):
        w = params[:n_features]
        cuts = params[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(params[n_features + 1:]))])
        s = np.bincount(rows, weights=values * w[cols], minlength=n)
        over = np.ones((GRADES + 1, n))
        over[GRADES] = 0.0
        over[1:GRADES] = sigmoid(s - cuts[:, None])
        slope = over * (1 - over)  # of P(grade >= j) by s
        each = np.maximum(over[grade, np.arange(n)] - over[grade + 1, np.arange(n)], 1e-12)
        by_s = (slope[grade, np.arange(n)] - slope[grade + 1, np.arange(n)]) / each
        by_cut = np.array([
            np.where(grade + 1 == j, slope[j], np.where(grade == j, -slope[j], 0.0)) / each for j in range(1, GRADES)
        ]).sum(axis=1)
        gradient = np.concatenate([
            np.bincount(cols, weights=values * by_s[rows], minlength=n_features) - penalty * w,
            [by_cut.sum()],
            [by_cut[j:].sum() * math.exp(params[n_features + j]) for j in range(1, GRADES - 1)],
        ]) / max(n, 1)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        params = params + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return params[:n_features], params[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(params[n_features + 1:]))])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, rows: int) -> DataFrame:
    """doc_id, text and label of at most ``rows`` labelled texts, chosen by a hash of doc_id, fixed."""
    chosen = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(label).alias("label")
    ).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    # at most ``rows`` rows on the broadcast side
    named = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    return cut(named.join(F.broadcast(chosen), "_id").dropDuplicates(["_id"]))


def fit(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
    rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES,
) -> Model:
    """Model from at most ``rows`` labelled texts; without toxic or without other ones, severity is about 0."""
    sample = labelled_sample(docs, labels, label, doc_id, text, rows)

    def find():
        return lambda texts: [[list(tokens(word_counts(t or ""))) for t in texts]]

    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model({}, [20.0 + j for j in range(GRADES - 1)])
    listed = map_slices(sample, ["text"], ["label"], [T.StructField("tokens", T.ArrayType(T.StringType()))], find)
    held = listed.select("label", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum("label").alias("a"), F.count("*").alias("n")
    ).where(F.col("a") >= MIN_TEXTS)
    share, total = sizes[1] / (sizes[0] + sizes[1]), sizes[0] + sizes[1]
    part = lambda seen, due: F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)
    a, n = F.col("a"), F.col("n")
    association = 2 * (
        part(a, n * share) + part(n - a, n * (1 - share))
        + part(sizes[1] - a, (total - n) * share) + part(sizes[0] - (n - a), (total - n) * (1 - share))
    )
    best = held.withColumn("g", association).where((F.col("g") >= MIN_ASSOCIATION) & (a > n * share))
    names = sorted(r["token"] for r in best.orderBy(F.desc("g"), "token").limit(max_features).select("token").collect())
    number = {t: i for i, t in enumerate(names)}

    def pick():
        def work(texts: list[str | None]) -> list[list]:
            at, times = [], []
            for t in texts:
                own = {number[k]: n for k, n in tokens(word_counts(t or "")).items() if k in number}
                at.append(list(own.keys()))
                times.append(list(own.values()))
            return [at, times]

        return work

    added = [T.StructField("at", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))]
    found = map_slices(sample, ["text"], ["_id", "label"], added, pick).collect()  # at most ``rows``
    found.sort(key=lambda r: r["_id"])
    hits = np.array([sum(r["times"]) for r in found])
    toxic = np.array([r["label"] == 1 for r in found])
    grade = np.where(toxic, 1 + (hits > np.median(hits[toxic])), 0)
    owner = np.repeat(np.arange(len(found)), [len(r["at"]) for r in found])
    cols = np.array([c for r in found for c in r["at"]], dtype=np.int64)
    values = np.log2(1.0 + np.array([c for r in found for c in r["times"]], dtype=float))
    w, cuts = fit_cumulative(owner, cols, values, grade, len(names))
    return Model({t: float(x) for t, x in zip(names, w, strict=True)}, [float(c) for c in cuts])


def score(df: DataFrame, model: Model, *, text: str = "text", keep: list[str], least: float = 0.5) -> DataFrame:
    """``keep`` plus severity (0 to 2, expected grade), p_toxic and toxic (p_toxic >= ``least``).

    A null text counts as empty and gets the score of a text without features. Every row gets a
    score, repeated rows the same one. A kept column named like an added one is replaced.
    """

    def start():
        def work(texts: list[str | None]) -> list[list]:
            over = [model.exceeds(t or "") for t in texts]
            return [[sum(x) for x in over], [x[0] for x in over], [x[0] >= least for x in over]]

        return work

    added = [
        T.StructField("severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("toxic", T.BooleanType()),
    ]
    return map_slices(df, [text], keep, added, start)
