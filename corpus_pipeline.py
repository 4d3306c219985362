"""A corpus pipeline: clean, deduplicate, decontaminate and mix documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its input is all that
the stage before kept. All but the last return the columns of ``documents``, with
``n_chars`` counted anew where a stage changes texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.decontaminate import decontaminate
from riskloom.llm.line_dedup import drop_common_lines
from riskloom.llm.mixing import mix_sources
from riskloom.llm.ngram_join import JaccardRule, jaccard_components
from riskloom.llm.oracles import (
    decontamination_sql,
    line_dedup_sql,
    ngram_components_sql,
    quality_sql,
    source_mixing_sql,
)
from riskloom.llm.quality import quality_rules
from riskloom.sources.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_COPIES = JaccardRule(words=5, percent=80)


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and so do the documents that the rules reject."""
    return _documents(quality_rules(docs.select(COLUMNS)).where("kept"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines in ten documents or more go; documents stay, if need be empty."""
    return _documents(drop_common_lines(docs.select(COLUMNS), min_docs=10, min_chars=1))


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Of repeated rows of one id one stays; rows without an id all stay.
    """
    docs = docs.select(COLUMNS)
    groups = jaccard_components(docs, NEAR_COPIES)
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    once = W.partitionBy("doc_id").orderBy(*COLUMNS[1:])
    kept = (
        docs.join(first, "doc_id", "left_semi")
        .withColumn("nth", F.row_number().over(once))
        .where("nth = 1")
    )
    return kept.select(COLUMNS).unionByName(docs.where("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs.select(COLUMNS), items).where("not contaminated").select(COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken and the virtual finish time."""
    return mix_sources(docs.select(COLUMNS)).where("taken > 0").drop("served")


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_join_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def _oracle() -> str:
    cut = "lang, source, CAST(length({0}) AS BIGINT) AS n_chars"
    cleaned = quality_sql(
        "documents", "doc_id, clean_text AS text, " + cut.format("clean_text"), "WHERE kept"
    )
    unique = line_dedup_sql(f"({cleaned})", "doc_id, kept_text AS text, " + cut.format("kept_text"))
    single = ngram_components_sql(
        f"({unique})",
        "doc_id, text, lang, source, n_chars",
        "WHERE doc_id = component_id OR doc_id IS NULL",
        NEAR_COPIES.words,
        NEAR_COPIES.percent,
    )
    clean = decontamination_sql(
        f"({single})", "doc_id, text, lang, source, n_chars", "WHERE NOT contaminated"
    )
    taken = "doc_id, text, lang, source, n_chars, size, source_size, target, taken, finish"
    return source_mixing_sql(f"({clean})", taken, "WHERE taken > 0")


ORACLE_SQL = _oracle()
