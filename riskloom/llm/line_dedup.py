"""Drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import (
    BLANK_CHARS,
    kept_names,
    lower_ascii,
    row_digest,
    sealed,
    unsealed,
    up_to,
)
from riskloom.sources.staging import stage

OUTPUTS = ("text", "n_lines", "n_dropped")


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANK_CHARS)))


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Remove every line whose key stands in ``min_docs`` documents or more.

    The key of a line is the line without blanks at both ends, A-Z lower-cased.
    Keys shorter than ``min_chars`` code points are never removed. Needs columns
    ``doc_id`` and ``text``; returns all input columns, ``text`` without the
    removed lines, and ``n_lines`` (before) and ``n_dropped``. Input columns of
    those two names are replaced.

    A document is a distinct ``doc_id``: repeated rows of one id count once, all
    rows without an id count as one document; every row is cleaned and returned.
    A NULL or empty text is one empty line and comes back empty. Lines are
    exploded and hashed to 128 bits; hashes, ids and positions are written once and
    shuffled for the counts, the texts move once, to be reassembled by position. A line
    in a third of all documents is one row per id and line when counted, and its
    join partner is a single row, so Spark can split it.
    """
    lines = docs.select(
        "doc_id",
        row_digest(F.col("text")).alias("digest"),
        F.posexplode(split_lines(F.col("text"))).alias("pos", "line"),
    ).select("doc_id", "digest", "pos", line_key(F.col("line")).alias("key"))
    hashed = stage(
        lines.where(F.length("key") >= min_chars).select(
            "doc_id",
            "digest",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
        ),
        "line-hashes",
    )
    common = (
        hashed.select("h1", "h2", "doc_id")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2")
    )
    hits = (
        hashed.join(common, ["h1", "h2"], "left_semi")
        .groupBy("doc_id", "digest")
        .agg(F.collect_set("pos").alias("gone"))
        .select(F.col("doc_id").alias("hit_id"), F.col("digest").alias("hit_digest"), "gone")
    )
    names = kept_names(docs, OUTPUTS)
    rows = docs.select(
        *sealed(names),
        F.col("doc_id").alias("key_id"),
        F.coalesce("text", F.lit("")).alias("all_text"),
        row_digest(F.col("text")).alias("key_digest"),
    )
    joined = rows.join(
        hits,
        F.col("key_id").eqNullSafe(F.col("hit_id")) & (F.col("key_digest") == F.col("hit_digest")),
        "left",
    ).withColumn("all_lines", split_lines(F.col("all_text")))
    stay = F.array_except(up_to(F.size("all_lines")), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("all_lines"), i)), "\n")
    return joined.select(
        *unsealed(names),
        F.when(F.col("gone").isNull(), F.col("all_text")).otherwise(kept).alias("text"),
        F.size("all_lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
    )
