"""Mix sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.text import blank_words, kept_names, sealed, total, unsealed
from riskloom.sources.staging import stage

OUTPUTS = ("size", "source_size", "target", "taken", "finish", "served")
_HEX = 4  # digits of the shuffle hash that name a bucket: 65,536 buckets per source
_SPANS = 65_536  # spans of virtual time that partition the servings
_PIECES = 1_024  # into which the serving that is on at time 1 is cut
_SERVINGS = "array<struct<finish: double, words: bigint>>"


def source_targets(sizes: DataFrame, weights: Sequence[int], repeats: int) -> DataFrame:
    """Target words of each source, from one row per source.

    ``sizes`` has ``source``, ``no_source`` (true where it is NULL) and ``source_size``.

    Sources take the weights in turn, ordered by code point, NULL last. They share
    all words by weight; a target stops at ``repeats`` times its source's size and
    the excess goes to the others by weight. In order of size per weight the
    sources that stop come first, so running sums give the final level at once.
    """
    by_name = W.orderBy("no_source", "source")
    turn = F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1)
    listed = (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", turn.cast("long"))
        .withColumn("most", repeats * F.col("source_size"))
    )
    by_need = W.orderBy(F.col("most") / F.col("weight"), "rank")
    before = by_need.rowsBetween(W.unboundedPreceding, -1)
    onward = by_need.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    level = F.struct("place", "rest", "heavy")
    enough = F.col("most") * F.col("heavy") >= F.col("rest") * F.col("weight")
    ranked = listed.withColumns(
        {
            "place": F.row_number().over(by_need),
            "heavy": F.sum("weight").over(onward),
            "rest": F.sum("source_size").over(everything)
            - F.coalesce(F.sum("most").over(before), F.lit(0)),
        }
    ).withColumn("level", F.min(F.when(enough, level)).over(everything))
    shared = F.col("level.rest") * F.col("weight") / F.col("level.heavy")
    stopped = F.col("place") < F.col("level.place")
    target = F.when(stopped, F.col("most").cast("double")).otherwise(shared)
    return ranked.select("no_source", "source", "source_size", target.alias("target"))


def _queued(docs: DataFrame, weights: Sequence[int], repeats: int) -> DataFrame:
    """Documents in their sources' queues, with ``servings``, what they may be served as.

    Every source queues its documents in a shuffled order, by md5 of the id, up to
    ``repeats`` times in a row. A serving has a virtual finish time, the source's words up
    to its end over the source's target, and its words. What starts before time 1, where
    the targets are used up, may be served; a serving that is on at time 1 is one of many
    small ones, up to ``_PIECES``, so that no source runs far ahead with a long document.

    A hot source is not one group: its documents fall into 65,536 buckets by hash.
    Bucket sums are aggregated before any shuffle and their running sum is over at
    most 65,536 rows per source; the exact order is found inside a bucket.
    """
    names = kept_names(docs, OUTPUTS)
    place = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.select(
        *sealed(names),
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.size(blank_words(F.col("text"))).cast("long").alias("size"),
        place.alias("place"),
        F.col("doc_id").alias("id"),
    ).withColumn("bucket", F.substring("place", 1, _HEX))
    of = ["no_source", "source"]
    buckets = sized.groupBy(*of, "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = buckets.groupBy(*of).agg(F.sum("bucket_size").alias("source_size"))
    earlier = W.partitionBy(*of).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = buckets.select(
        *of, "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset")
    )
    starts = offsets.join(source_targets(sources, weights, repeats), of)
    queued = W.partitionBy(*of, "bucket").orderBy("place", "id", "size")
    queued = queued.rowsBetween(W.unboundedPreceding, -1)
    waiting = sized.withColumn("ahead", F.coalesce(F.sum("size").over(queued), F.lit(0)))
    joined = waiting.join(starts, [*of, "bucket"]).withColumn("begin", F.col("offset") + F.col("ahead"))
    size, target = F.col("size"), F.col("target")
    serving = lambda end, words: F.struct(
        (end / target).alias("finish"), words.alias("words")
    )

    def turn(lap: int) -> Column:
        start = F.col("begin") + lap * F.col("source_size")
        piece = F.ceil(size / _PIECES)
        upto = lambda k: F.least(size, k * piece)
        pieces = F.transform(
            F.sequence(F.lit(1).cast("long"), F.ceil(size / piece)),
            lambda k: serving(start + upto(k), upto(k) - upto(k - 1)),
        )
        return (
            F.when((size == 0) | (start >= target), F.array().cast(_SERVINGS))
            .when(start + size <= target, F.array(serving(start + size, size)))
            .otherwise(pieces)
        )

    return joined.withColumn("servings", F.concat(*(turn(lap) for lap in range(repeats))))


def _cut(queued: DataFrame) -> tuple[float, bool, str, int] | None:
    """Where the servings, in order of finish time, use up the total budget, all words.

    Finish time, source and words served of the serving there; NULL if all are served.
    Servings are range-partitioned by finish time: as sources are served at steady rates,
    equal spans of it hold about equally many words. Sums per span tell in which one the
    budget ends, and only its servings, about one in ``_SPANS``, are sorted.
    """
    servings = queued.select(
        F.inline("servings"), "no_source", "source"
    ).withColumn("span", F.least(F.floor(F.col("finish") * _SPANS), F.lit(_SPANS)))
    servings = stage(servings, "servings")
    budget = queued.agg(F.sum("size")).first()[0] or 0
    spans = servings.groupBy("span").agg(F.sum("words").alias("words")).collect()
    before = 0
    for span, words in sorted(tuple(r) for r in spans):  # at most ``_SPANS`` + 1 rows
        if before + words >= budget:
            break
        before += words
    else:
        return None
    order = W.orderBy("finish", "no_source", "source")
    last = (
        servings.where(F.col("span") == span)
        .withColumn("upto", F.sum("words").over(order.rowsBetween(W.unboundedPreceding, 0)))
        .where(F.col("upto") >= budget - before)
        .orderBy("finish", "no_source", "source")
        .first()
    )
    served = last["words"] - (last["upto"] - (budget - before))
    return last["finish"], last["no_source"], last["source"], served


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3
) -> DataFrame:
    """How many words of each document a mix of the total size of ``docs`` takes.

    Needs ``doc_id``, ``text`` and ``source``; returns all input columns and
    ``size`` (words), ``source_size``, ``target`` (of the source), ``taken``
    (words, repeats counted), ``finish`` (the virtual time at which the document is
    first served) and ``served``, a list of (finish, words), one for each time that it is
    served, the one on at time 1 in pieces; input columns of those names are replaced.
    All servings are put in order of their virtual finish time and cut where the total
    budget is used up; ``taken`` sums up what a document is served before. So each source
    gets its target to a word and a thousandth of its last document, and no document more than
    ``repeats`` times its size. ``mix_order`` lists the servings in order.

    A NULL text has size 0 and is never taken; NULL sources are one source, last in
    order. Rows of one id and size are interchangeable and keep their place in the
    queue together; a NULL id sorts like an empty string. No rows give no rows.
    """
    queued = _queued(docs, weights, repeats)
    cut = _cut(queued)
    if cut is None:
        served = F.col("servings")
    else:
        finish, no_source, source, rest = cut
        at = F.struct(F.lit(finish), F.lit(no_source), F.lit(source))
        own = lambda s: F.struct(s["finish"], F.col("no_source"), F.col("source"))
        cropped = lambda s: F.struct(
            s["finish"].alias("finish"),
            F.when(own(s) < at, s["words"]).when(own(s) == at, rest).otherwise(0).alias("words"),
        )
        served = F.filter(F.transform("servings", cropped), lambda s: s["words"] > 0)
    first = (F.col("begin") + F.col("size")) / F.col("target")
    names = kept_names(docs, OUTPUTS)
    return queued.withColumn("served", served.cast(_SERVINGS)).select(
        *unsealed(names),
        "size",
        "source_size",
        "target",
        total(F.transform("served", lambda s: s["words"])).alias("taken"),
        F.when(F.col("target") > 0, first).alias("finish"),
        "served",
    )


def mix_order(mixed: DataFrame) -> DataFrame:
    """One row for each serving of a mix, in the order of ``served_at``: a global range sort.

    ``words`` are those served; a document that is served repeatedly has a row each time.
    """
    rest = [c for c in mixed.columns if c != "served"]
    rows = mixed.select(*rest, F.inline("served").alias("served_at", "words"))
    return rows.orderBy("served_at", "source", "doc_id")
