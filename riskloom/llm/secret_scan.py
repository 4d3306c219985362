"""Find credentials by fixed patterns and by learned credential formats."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.automata import Automaton, learn_automaton, symbols
from riskloom.llm.text import kept_names, sealed, unsealed
from riskloom.sources.ship import ship_package
from riskloom.sources.staging import stage

# Patterns of the base kinds and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are matched whole, so shorter ones can be skipped
KINDS = ("assign", "access", "hex", "format")
MIN_ASSIGN, MIN_ACCESS = 12, 18

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
OUTPUTS = ("n_assign", "n_access", "n_hex", "spans")
SPAN = "array<struct<kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class SecretParams:
    """``samples`` bounds the labelled credentials of a kind that an automaton is learned from.

    A candidate is a secret if its format likelihood under some automaton is at least the
    one that the share ``miss`` of held-out credentials falls short of.
    """

    samples: int = 600
    miss: float = 0.05
    alpha: float = 0.05


@dataclass
class FormatModel:
    """An automaton and a least mean log likelihood per kind."""

    automata: dict[str, tuple[Automaton, float]] = field(default_factory=dict)

    def is_secret(self, token: str) -> bool:
        word = symbols(token)
        mixed = "d" in word and any(c.isalpha() and c != "d" for c in word)
        return mixed and any(a.log_likelihood(word) >= low for a, low in self.automata.values())


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) by start, then kind as listed."""
    spans = [
        ("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN
    ]
    spans += [
        ("access", m.start(), m.end(), m[0])
        for m in ACCESS.finditer(text)
        if len(m[0]) >= MIN_ACCESS
    ]
    spans += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
    """Credential-like tokens with a digit and a letter that no base span overlaps."""
    found = []
    for m in CANDIDATE.finditer(text):
        token = m[0].strip("=.-_/+") or m[0]
        start = m.start() + m[0].index(token)
        end = start + len(token)
        mixed = any(map(str.isdigit, token)) and any(map(str.isalpha, token))
        if len(token) >= 16 and mixed and not any(s < end and start < e for _, s, e, _ in taken):
            found.append((start, end, token))
    return found


def _located():
    def locate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, rest = [], []
            for text in batch:
                spans = base_spans(text or "")
                base.append([{"kind": k, "start": s, "end": e, "value": v} for k, s, e, v in spans])
                rest.append(
                    [{"start": s, "end": e, "value": v} for s, e, v in candidates(text or "", spans)]
                )
            yield pd.DataFrame({"base": base, "rest": rest})

    return F.pandas_udf(
        locate,
        "base array<struct<kind:string,start:int,end:int,value:string>>, "
        "rest array<struct<start:int,end:int,value:string>>",
    )


def learn_formats(located: DataFrame, params: SecretParams) -> FormatModel:
    """An automaton per kind from its labelled credentials, at most ``samples`` distinct ones.

    The sample is the first by md5; automata are learned from four fifths of it and
    the threshold from the rest. Kinds with fewer than ten are not learned.
    """
    labelled = located.select(F.explode("base").alias("s")).select("s.kind", "s.value").distinct()
    first = W.partitionBy("kind").orderBy(F.md5("value"), "value")
    sample = labelled.withColumn("nth", F.row_number().over(first)).where(
        F.col("nth") <= params.samples
    )
    by_kind: dict[str, list[str]] = {}
    for row in sample.orderBy("kind", "nth").collect():  # ``samples`` rows per kind
        by_kind.setdefault(row["kind"], []).append(symbols(row["value"]))
    automata = {}
    for kind, words in by_kind.items():
        if len(words) < 10:
            continue
        held = words[::5]
        automaton = learn_automaton([w for i, w in enumerate(words) if i % 5], params.alpha)
        scores = sorted(automaton.log_likelihood(w) for w in held)
        automata[kind] = (automaton, scores[int(params.miss * len(scores))])
    return FormatModel(automata)


def scan_secrets(
    docs: DataFrame, params: SecretParams | None = None, keep: Sequence[str] | None = None
) -> DataFrame:
    """Add the credentials of each whole text.

    Needs ``text``; returns all input columns, or only those of ``keep``, which spares
    writing texts in between, and the columns of ``OUTPUTS``, which replace input
    columns of the same names: numbers of base spans by kind, and all
    ``spans`` (kind, start, end in code points, end exclusive) by start, then kind.
    Kind "format" are tokens outside all base spans whose character classes an
    automaton learned from the base credentials finds likely; base spans always stay.

    A NULL text is empty and has no spans. Every row is scanned alone: repeated rows
    get equal spans, ids are not used. Too few credentials to learn from give no
    "format" spans. The learning sample is bounded; all candidates are scored.
    """
    params = params or SecretParams()
    ship_package(docs.sparkSession)
    names = kept_names(docs if keep is None else docs.select(*keep), OUTPUTS)
    located = stage(
        docs.select(*sealed(names), _located()(F.col("text")).alias("found")).select(
            *(f"in{i}" for i in range(len(names))), "found.base", "found.rest"
        ),
        "secret-spans",
    )
    model = learn_formats(located, params)

    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda tokens: [model.is_secret(t) for t in tokens])

    verdicts = F.pandas_udf(judged, "array<boolean>")
    scored = located.withColumn("verdicts", verdicts(F.transform("rest", lambda r: r["value"])))
    order = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    ranked = lambda kind, s: F.struct(
        s["start"].alias("start"), order[kind].alias("rank"), s["end"].alias("end"), kind.alias("kind")
    )
    base = F.transform("base", lambda s: ranked(s["kind"], s))
    fresh = F.transform(
        F.filter(F.col("rest"), lambda r, i: F.get(F.col("verdicts"), i)),
        lambda s: ranked(F.lit("format"), s),
    )
    spans = F.transform(
        F.sort_array(F.concat(base, fresh)),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scored.select(
        *unsealed(names),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        spans.alias("spans"),
    )
