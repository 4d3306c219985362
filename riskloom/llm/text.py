"""Column expressions the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"\x20\x09-\x0D"
BLANK_CHARS = " \t\n\x0b\f\r"
NOT_IN_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is (``lower`` alone also changes other letters)."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def blank_words(text: Column) -> Column:
    """Runs of anything but blanks; an empty array for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANK}]+"), "")


def token_words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and all characters beyond ASCII."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_IN_WORD), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once per row, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def up_to(n: Column) -> Column:
    """0, 1, ... n - 1; empty where n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda acc, x: acc + x)


def row_digest(text: Column) -> Column:
    """Tells rows that share a document id apart by their text; NULL has its own value."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def kept_names(df: DataFrame, outputs: Iterable[str]) -> list[str]:
    """Input columns, without those whose names an operator's outputs take, in any case."""
    taken = {n.lower() for n in outputs}
    return [c for c in df.columns if c.lower() not in taken]


def sealed(names: Iterable[str]) -> list[Column]:
    """Input columns under numbers, so that none clashes with an operator's own columns."""
    return [F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(names)]


def unsealed(names: Iterable[str]) -> list[Column]:
    return [F.col(f"in{i}").alias(c) for i, c in enumerate(names)]
