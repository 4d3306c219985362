"""Severity of toxic language by cumulative-link ordinal regression."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import kept_names, sealed, unsealed
from riskloom.sources.ship import ship_package
from riskloom.sources.staging import stage

OUTPUTS = ("severity", "grade", "toxic", "score")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class ToxicityParams:
    """``sample_docs`` bounds the labelled documents the model is fitted on."""

    sample_docs: int = 20_000
    features: int = 4_096
    min_docs: int = 3
    min_evidence: float = 3.0
    penalty: float = 1e-4
    rounds: int = 400


@dataclass
class OrdinalModel:
    """P(grade > k) = logistic(weights . x - thresholds[k]), thresholds ascending."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = ()

    def severity(self, text: str | None) -> tuple[float, float, int]:
        """Expected grade, probability of any grade above 0, most likely side of each threshold."""
        if not self.thresholds:
            return 0.0, 0.0, 0
        signal = weighted(text, self.weights)
        above = 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - signal, -500, 500)))
        return float(above.sum()), float(above[0]), int((above >= 0.5).sum())


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def weighted(text: str | None, weights: dict[str, float]) -> float:
    """Weights times word shares in percent of all words of a text."""
    words = words_of(text)
    if not words:
        return 0.0
    return 100 * sum(map(weights.get, filter(weights.__contains__, words))) / len(words)


@dataclass(frozen=True)
class Sparse:
    """Entries of a matrix with few of them per row."""

    row: np.ndarray
    col: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def times(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * v[self.col], self.shape[0])

    def transposed_times(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value * v[self.row], self.shape[1])


def fit_cumulative_link(
    x: Sparse, grades: np.ndarray, top: int, penalty: float, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by penalised maximum likelihood (full-batch Adam).

    Every threshold k is a binary question "grade > k" with the same weights. The first
    threshold and the logarithms of the gaps are the parameters, which keeps their order.
    """
    n, d = x.shape
    asked = (grades[:, None] > np.arange(top)[None, :]).astype(float)
    p = np.zeros(d + top)
    p[d] = 1.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, rounds + 1):
        gaps = np.exp(np.clip(p[d + 1 :], -10, 10))
        cuts = p[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        miss = 1 / (1 + np.exp(np.clip(cuts - x.times(p[:d])[:, None], -500, 500))) - asked
        by_cut = -miss.mean(0)
        later = by_cut[::-1].cumsum()[::-1]
        slope = np.concatenate(
            [
                x.transposed_times(miss.sum(1)) / n + penalty * p[:d],
                [later[0]],
                later[1:] * gaps,
            ]
        )
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    gaps = np.exp(np.clip(p[d + 1 :], -10, 10))
    return p[:d], p[d] + np.concatenate([[0.0], np.cumsum(gaps)])


def labelled_sample(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> DataFrame:
    """At most ``sample_docs`` labelled documents, the first by md5 of their ids."""
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
        .limit(params.sample_docs)
    )
    # ``sample_docs`` bounds the broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(stage(chosen, "labelled")), "doc_id")


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, params: ToxicityParams | None = None
) -> OrdinalModel:
    """Fit on a bounded sample of labelled documents.

    ``labels`` has ``doc_id`` and ``toxic`` (0 or 1). Features are words with evidence:
    in ``min_docs`` toxic documents at least and with a log ratio of document shares
    of at least ``min_evidence``. Grades: 0 is not toxic; toxic texts are 1 or 2,
    parted by their median share of such words. Without toxic or without other
    labels the model is empty and finds nothing.
    """
    params = params or ToxicityParams()
    sample = stage(labelled_sample(docs, labels, params), "toxicity-sample")
    sizes = {r["toxic"] > 0: r["n"] for r in _sizes(sample)}
    if len(sizes) < 2:
        return OrdinalModel()
    bags = sample.select("toxic", F.explode(_bag("text")).alias("word"))
    counted = bags.groupBy("word").agg(
        F.count_if(F.col("toxic") > 0).alias("yes"), F.count_if(F.col("toxic") <= 0).alias("no")
    )
    share = lambda n, of: (F.col(n) + 0.5) / (of + 1)
    evidence = F.log(share("yes", sizes[True])) - F.log(share("no", sizes[False]))
    chosen = (
        counted.where(F.col("yes") >= params.min_docs)
        .where(evidence >= params.min_evidence)
        .orderBy((evidence * F.sqrt("yes")).desc(), "word")
        .limit(params.features)
        .collect()  # at most ``features`` rows
    )
    features = sorted(r["word"] for r in chosen)
    if not features:
        return OrdinalModel()
    rows = sample.select("doc_id", "toxic", _shares(features)("text").alias("x")).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")  # bounded by ``sample_docs``
    sizes = [len(pairs["at"]) for pairs in rows["x"]]
    x = Sparse(
        np.repeat(np.arange(len(rows)), sizes),
        np.concatenate([pairs["at"] for pairs in rows["x"]]).astype(np.int64),
        np.concatenate([pairs["share"] for pairs in rows["x"]]).astype(float),
        (len(rows), len(features)),
    )
    grades = (rows["toxic"].to_numpy() > 0).astype(int)
    amount = x.times(np.ones(len(features)))
    severe = grades.astype(bool) & (amount > 0)
    if severe.any():
        grades[severe & (amount >= np.median(amount[severe]))] = 2
    weights, cuts = fit_cumulative_link(x, grades, 2, params.penalty, params.rounds)
    return OrdinalModel(dict(zip(features, map(float, weights))), tuple(map(float, cuts)))


def _sizes(sample: DataFrame):
    return sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(
        F.count(F.lit(1)).alias("n")
    ).collect()


def _bag(column: str):
    def distinct(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: sorted(set(words_of(t))))

    return F.pandas_udf(distinct, "array<string>")(column)


def _shares(features: list[str]):
    place = {w: i for i, w in enumerate(features)}

    def shares(batch: pd.Series) -> pd.DataFrame:
        at, share = [], []
        for text in batch:
            words = words_of(text)
            found = Counter(place[w] for w in words if w in place)
            at.append(sorted(found))
            share.append([100 * found[k] / len(words) for k in sorted(found)])
        return pd.DataFrame({"at": at, "share": share})

    return F.pandas_udf(shares, "at array<int>, share array<double>")


def score_toxicity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Add ``severity`` (expected grade), ``grade``, ``toxic`` and ``score`` (0 to 1).

    Needs ``text``; input columns of those names are replaced. ``toxic`` says that the
    probability of a grade above 0 (``score``) is at least one half. Each whole text is
    scored alone: repeated rows, missing ids and extra columns make no difference. A
    NULL or empty text, and any text under an empty model, is scored as one without
    known words; without a model everything is 0.
    """
    ship_package(docs.sparkSession)
    names = kept_names(docs, OUTPUTS)

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [model.severity(t) for t in batch], columns=["severity", "score", "grade"]
            )

    result = F.pandas_udf(scored, "severity double, score double, grade int")
    judged = docs.select(*sealed(names), result(F.col("text")).alias("r"))
    return judged.select(
        *unsealed(names),
        F.col("r.severity").alias("severity"),
        F.col("r.grade").alias("grade"),
        (F.col("r.grade") > 0).alias("toxic"),
        F.col("r.score").alias("score"),
    )
