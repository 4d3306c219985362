"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.text import kept_names, sealed, unsealed
from riskloom.sources.ship import ship_package
from riskloom.sources.staging import stage

OUTPUTS = ("lang_pred", "score")
UNKNOWN = "und"
_NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class ProfileParams:
    """``docs_per_language`` bounds the sample that the profiles are learned from."""

    docs_per_language: int = 1_000
    longest: int = 3
    profile: int = 400


def letters_of(text: str | None) -> str:
    """Lower-cased words, one space around each; empty if there is no letter."""
    words = _NO_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {words} " if any(map(str.isalpha, set(words))) else ""


def gram_counts(letters: str, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of all n-grams up to ``longest`` (at most 3) characters."""
    points = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    grams = []
    for n in range(1, longest + 1):
        code = np.zeros(max(len(points) - n + 1, 0), np.uint64)
        for k in range(n):
            code = (code << np.uint64(21)) | points[k : k + len(code)]
        grams.append(code)
    codes, counts = np.unique(np.concatenate(grams), return_counts=True)
    blank = codes == ord(" ")
    return codes[~blank], counts[~blank]


def most_frequent(codes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Codes by falling count, equal counts by code."""
    return codes[np.lexsort((codes, -counts))[:n]]


class Profiles:
    """The most frequent n-grams of every language, with their ranks."""

    def __init__(self, ranked: dict[str, np.ndarray], params: ProfileParams):
        self.params, self.languages = params, sorted(ranked)
        self.codes, self.ranks = [], []
        for language in self.languages:
            codes = ranked[language]
            order = np.argsort(codes)
            self.codes.append(codes[order])
            self.ranks.append(order)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language with the least out-of-place distance, and 1 minus its share of the largest.

        An n-gram that a profile lacks counts as the profile's length.
        """
        letters = letters_of(text)
        if not letters or not self.languages:
            return UNKNOWN, 0.0
        mine = most_frequent(*gram_counts(letters, self.params.longest), self.params.profile)
        here, most = np.arange(len(mine)), self.params.profile
        distances = []
        for codes, ranks in zip(self.codes, self.ranks):
            at = np.minimum(np.searchsorted(codes, mine), len(codes) - 1)
            off = np.where(codes[at] == mine, np.abs(ranks[at] - here), most)
            distances.append(int(off.sum()))
        best = int(np.argmin(distances))
        return self.languages[best], 1 - distances[best] / (most * len(mine))


def learn_profiles(docs: DataFrame, params: ProfileParams | None = None) -> Profiles:
    """Profiles from rows with ``doc_id``, ``text`` and a known ``lang``.

    Each language is learned from at most ``docs_per_language`` documents, the first
    by md5 of their ids. Languages whose sample has no letter are not learned.
    """
    params = params or ProfileParams()
    ship_package(docs.sparkSession)
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    first = W.partitionBy("lang").orderBy(place, "doc_id")
    ids = (
        docs.where("lang is not null and text is not null and doc_id is not null")
        .select("doc_id", "lang")
        .withColumn("nth", F.row_number().over(first))
        .where(F.col("nth") <= params.docs_per_language)
        .select("doc_id", "lang")
        .distinct()
    )
    sample = docs.select("doc_id", "lang", "text").join(
        F.broadcast(stage(ids, "language-sample")), ["doc_id", "lang"], "left_semi"
    )

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, texts in batch.groupby("lang")["text"]:
                parts = [gram_counts(t, params.longest) for t in map(letters_of, texts) if t]
                if parts:
                    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                    counts = np.bincount(at, weights=np.concatenate([n for _, n in parts]))
                    yield pd.DataFrame(
                        {"lang": language, "gram": codes.view(np.int64), "n": counts.astype(np.int64)}
                    )

    grams = sample.select("lang", "text").mapInPandas(counted, "lang string, gram long, n long")
    by_count = W.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = (
        grams.groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(by_count))
        .where(F.col("rank") <= params.profile)
    )
    ranked: dict[str, list[tuple[int, int]]] = {}
    for row in top.collect():  # ``profile`` rows per language
        ranked.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return Profiles(
        {
            language: np.array([g for _, g in sorted(pairs)], np.int64).view(np.uint64)
            for language, pairs in ranked.items()
        },
        params,
    )


def identify_language(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1), from the whole text alone.

    Needs ``text``; input columns of those names are replaced. A NULL text, one without
    any letter, or one judged without profiles, is ``und`` with score 0. Equal
    distances go to the language first by name. Rows are judged alone, so repeated
    rows, missing ids and extra columns make no difference.
    """
    ship_package(docs.sparkSession)
    names = kept_names(docs, OUTPUTS)

    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([profiles.predict(t) for t in batch], columns=["lang_pred", "score"])

    result = F.pandas_udf(predicted, "lang_pred string, score double")
    judged = docs.select(*sealed(names), result(F.col("text")).alias("r"))
    return judged.select(
        *unsealed(names), F.col("r.lang_pred").alias("lang_pred"), F.col("r.score").alias("score")
    )
