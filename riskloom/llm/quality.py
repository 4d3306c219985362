"""Line-first cleaning: judge each line, then each document by what it loses."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.line_dedup import split_lines
from riskloom.llm.text import (
    BLANK,
    BLANK_CHARS,
    blank_words,
    kept_names,
    let,
    lower_ascii,
    sealed,
    total,
    unsealed,
    up_to,
)

# Phrases of page furniture, lower case.
FURNITURE = (
    "accept all cookies",
    "back to top",
    "click here to",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "terms of use",
)

OUTPUTS = (
    "text",
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "lost_share",
    "kept",
)


@dataclass(frozen=True)
class QualityRules:
    """Limits of the line rules and of the verdict on a document."""

    min_words: int = 10
    window: int = 5
    max_repeat_percent: int = 20
    max_mark_share: float = 0.15  # symbols and runs of ! and ? among a line's characters
    min_separators: int = 3  # menu separators that make a navigation line ...
    max_separator_share: float = 0.25  # ... if they are that share of its words
    max_furniture_words: int = 8  # a line with a phrase is furniture up to so many words ...
    max_furniture_share: float = 0.3  # ... or if phrases are more of its characters than that
    max_lost_share: float = 0.5  # share of a document's word characters in removed lines


# Characters that the line rules count.
MARKS = "#*$%&<>{}~^="
SHOUTS = "[!?]{2,}"  # one alone ends a sentence
SEPARATORS = "|»·•"


def _has_furniture(text: Column) -> Column:
    small = lower_ascii(text)
    found = F.lit(False)
    for phrase in FURNITURE:
        found = found | F.contains(small, F.lit(phrase))
    return found


def _held(text: Column, pattern: str) -> Column:
    """Characters in the matches of a pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _count(text: Column, characters: str) -> Column:
    return _held(text, f"[{re.escape(characters)}]+")


def _failing(rules: QualityRules, line: Column) -> Column:
    """Punctuation, navigation and boilerplate rules; a line without words never fails.

    A phrase of furniture makes only a short line fail, or one that is largely phrases:
    prose may name a privacy policy.
    """
    solid = F.length(F.regexp_replace(line, f"[{BLANK}]+", ""))
    marks, separators = _count(line, MARKS) + _held(line, SHOUTS), _count(line, SEPARATORS)
    words = F.size(blank_words(line))
    phrases = _held(lower_ascii(line), "|".join(FURNITURE))
    whole = F.length(F.btrim(line, F.lit(BLANK_CHARS)))
    return (
        ((marks > 0) & (marks > solid * rules.max_mark_share))
        | ((separators >= rules.min_separators) & (separators > words * rules.max_separator_share))
        | (
            _has_furniture(line)
            & ((words <= rules.max_furniture_words) | (phrases > whole * rules.max_furniture_share))
        )
    )


def _may_fail(text: Column) -> Column:
    """False only for texts of which no line can fail."""
    return text.rlike(f"[{re.escape(MARKS + SEPARATORS)}]|{SHOUTS}") | _has_furniture(text)


def _repeated_words(words: Column, window: int) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the text."""
    hashes = F.transform(
        up_to(F.size(words) - (window - 1)),
        lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(window))),
    )

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda x, k: F.get(s, k)["h"].eqNullSafe(x["h"])
            return F.sort_array(
                F.filter(
                    F.transform(s, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"])),
                    lambda i: i.isNotNull(),
                )
            )

        def lengths(p: Column) -> Column:
            until = lambda x, k: F.coalesce(F.get(p, k + 1), x + window)
            return total(F.transform(p, lambda x, k: F.least(F.lit(window), until(x, k) - x)))

        return let(let(placed, starts), lengths)

    return let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            covered(h)
        ),
    )


def quality_rules(docs: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """Clean every text line by line and judge the document.

    Needs ``text``; returns all input columns, ``text`` without the lines that
    fail a rule, and the columns of ``OUTPUTS``, which replace input columns of
    the same names. Counts are of the whole text before cleaning. ``kept`` is
    false where the base counts fail (too few words, too many words in repeated
    windows) or where the removed lines hold more than ``max_lost_share`` of the
    word characters (``lost_share``).

    A NULL text has no words: counts are 0, it is rejected, and stays NULL. Each
    row is judged alone, so repeated rows, ids without a value and extra columns
    make no difference. There is no shuffle; a very long text costs n log n.
    Windows are compared by 64-bit hashes within one text.
    """
    rules = rules or QualityRules()
    text = F.coalesce(F.col("text"), F.lit(""))
    solid = F.length(F.regexp_replace(text, f"[{BLANK}]+", "")).cast("long")
    lines = split_lines(F.col("text"))
    with_word = lambda x: F.btrim(x, F.lit(BLANK_CHARS)) != ""
    repeats = let(
        F.filter(lines, with_word), lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long")
    )
    words = let(
        blank_words(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            _repeated_words(w, rules.window).alias("repeated"),
        ),
    )
    cleaned = F.array_join(F.filter(lines, lambda x: ~_failing(rules, x)), "\n")
    good = F.when(_may_fail(text), cleaned).otherwise(text)
    names = kept_names(docs, OUTPUTS)
    facts = F.struct(
        words.alias("words"),
        solid.alias("word_chars"),
        _count(text, "#*$%&|<>").cast("long").alias("n_symbols"),
        repeats.alias("n_dup_lines"),
        F.when(F.col("text").isNotNull(), good).alias("text"),
    )
    # A generator's output is computed once, however often later expressions name it.
    counted = docs.select(*sealed(names), F.inline(F.array(facts)))
    left = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), f"[{BLANK}]+", ""))
    lost = F.when(F.col("word_chars") > 0, 1 - left / F.col("word_chars")).otherwise(F.lit(0.0))
    n, repeated = F.col("words.n"), F.col("words.repeated")
    failed = (n < rules.min_words) | (100 * repeated > rules.max_repeat_percent * n)
    return counted.select(
        *unsealed(names),
        "text",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeated.alias("n_repeat_words"),
        failed.alias("base_failed"),
        lost.alias("lost_share"),
        (~failed & (lost <= rules.max_lost_share)).alias("kept"),
    )
