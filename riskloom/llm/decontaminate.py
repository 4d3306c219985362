"""Find benchmark passages in documents with a positional inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import kept_names, let, row_digest, sealed, token_words, unsealed, up_to
from riskloom.sources.staging import stage

OUTPUTS = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")
SMALL_ROWS = 1_000_000  # a table of at most so many narrow rows may be broadcast


def _sent_if_small(df: DataFrame) -> DataFrame:
    """Broadcast after counting; a larger table is left to a shuffled join."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _terms(words: Column, length: int) -> Column:
    """Hashes of ``length`` consecutive words from each place on; fewer at the text's end."""
    return F.transform(
        up_to(F.size(words)), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(length)))
    )


def item_terms(items: DataFrame, length: int) -> DataFrame:
    """Postings of the items: ``item``, ``item_id``, ``off``, ``term``, ``item_words``, ``words``.

    Equal rows are one item. A term is ``words`` consecutive words: ``length`` of them,
    or all of a shorter item.
    """
    worded = (
        items.select("item_id", "text")
        .distinct()
        .select(
            F.xxhash64("item_id", "text").alias("item"),
            "item_id",
            token_words(F.col("text")).alias("w"),
        )
    )
    first = F.slice(
        _terms(F.col("w"), length), F.lit(1), F.greatest(F.lit(1), F.size("w") - (length - 1))
    )
    return worded.select(
        "item",
        "item_id",
        F.size("w").alias("item_words"),
        F.least(F.size("w"), F.lit(length)).alias("words"),
        F.posexplode(first).alias("off", "term"),
    )


def positional_index(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Postings ``doc_id``, ``digest``, ``pos``, ``term`` of the documents for the items' terms."""
    lengths = sorted(r["words"] for r in wanted.select("words").distinct().collect())
    words = let(
        token_words(F.col("text")),
        lambda w: F.array(*(_terms(w, length) for length in lengths or [1])),
    )
    by_length = docs.select(
        "doc_id", row_digest(F.col("text")).alias("digest"), F.explode(words).alias("terms")
    )
    postings = by_length.select("doc_id", "digest", F.posexplode("terms").alias("pos", "term"))
    return postings.join(_sent_if_small(wanted.select("term").distinct()), "term", "left_semi")


def rarest_anchors(index: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """For every window of an item, its rarest term: ``item``, ``off``, ``term``.

    Windows with a term that no document has are left out.
    """
    known = index.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    span = F.least(F.lit(window), F.col("item_words")) - F.col("words") + 1
    last = F.col("item_words") - F.col("words") + 1 - F.col("span")
    placed = (
        wanted.join(known, "term")
        .withColumn("span", span)
        .withColumn(
            "start",
            F.explode(
                F.sequence(
                    F.greatest(F.lit(0), F.col("off") - F.col("span") + 1),
                    F.least(F.col("off"), last),
                )
            ),
        )
    )
    rarest = placed.groupBy("item", "start").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("span").alias("span"),
        F.min(F.struct("freq", "off", "term")).alias("best"),
    )
    whole = rarest.where(F.col("n") == F.col("span"))
    return whole.select("item", "best.off", "best.term").distinct()


def _runs(offsets: Column, least: Column) -> Column:
    """(first, last) of the runs of at least ``least`` consecutive numbers in a sorted array."""
    start = F.struct(
        F.array().cast("array<struct<first:int,last:int>>").alias("done"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def closed(at: Column) -> Column:
        run = F.array(F.struct(at["first"].alias("first"), at["last"].alias("last")))
        long_enough = F.coalesce(at["last"] - at["first"] + 1 >= least, F.lit(False))
        return F.when(long_enough, F.concat(at["done"], run)).otherwise(at["done"])

    def step(at: Column, x: Column) -> Column:
        goes_on = F.coalesce(x == at["last"] + 1, F.lit(False))
        return F.struct(
            F.when(goes_on, at["done"]).otherwise(closed(at)).alias("done"),
            F.when(goes_on, at["first"]).otherwise(x).alias("first"),
            x.alias("last"),
        )

    return F.aggregate(offsets, start, step, closed)


def passage_matches(
    docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 0
) -> DataFrame:
    """Where item passages stand in documents.

    Rows: ``doc_id``, ``digest`` (of the text), ``item``, ``item_id``, ``first``,
    ``last`` (word positions in the document). With ``slop`` 0 a match is a run of
    at least ``window`` consecutive item words (a shorter item: all of it) at
    consecutive places. With a larger ``slop`` it is a proximity match: each word may
    stand up to ``slop`` places from where an exact match would have it.

    1. The index holds the postings of the items' terms and is written once. Terms are
       pairs of adjacent words, which are far rarer than words (single words for
       proximity matches and for items of one word); only benchmark terms are kept.
    2. Every window's rarest term proposes (document, item, offset difference).
    3. The offset-adjusted postings of the item's other terms are intersected with
       the proposals, in proposed documents only; runs of offsets are the matches.
    """
    wanted = stage(item_terms(items, 1 if slop else 2), "item-terms")
    index = stage(positional_index(docs, wanted), "postings")
    anchors = stage(rarest_anchors(index, wanted, window), "anchors")
    proposed = stage(
        index.join(
            _sent_if_small(anchors.withColumnRenamed("off", "anchor")), "term"
        )
        .select("doc_id", "digest", "item", (F.col("pos") - F.col("anchor")).alias("diff"))
        .distinct(),
        "proposals",
    )
    where = ["doc_id", "digest"]
    proposed_docs = stage(proposed.select(*where).distinct(), "proposed-docs")
    same_doc = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["digest"] == b["digest"])
    marked = _sent_if_small(proposed_docs)
    postings = index.join(marked, same_doc(index, marked), "left_semi")
    # Two sides of a null-safe key: the id, and whether there is one.
    flat = lambda df: df.withColumn("no_id", F.col("doc_id").isNull()).withColumn(
        "doc_id", F.coalesce("doc_id", F.lit(0))
    )
    expected = (
        flat(proposed)
        .join(_sent_if_small(wanted), "item")
        .withColumn("shift", F.explode(F.sequence(F.lit(-slop), F.lit(slop))))
        .withColumn("pos", F.col("diff") + F.col("off") + F.col("shift"))
    )
    keys = ["doc_id", "no_id", "digest"]
    met = (
        expected.join(flat(postings), [*keys, "pos", "term"])
        .groupBy(*keys, "item", "diff")
        .agg(
            F.sort_array(F.collect_set("off")).alias("offs"),
            F.first("item_id").alias("item_id"),
            F.first("item_words").alias("item_words"),
            F.first("words").alias("words"),
        )
    )
    span = F.least(F.lit(window), F.col("item_words")) - F.col("words") + 1
    runs = F.explode(_runs(F.col("offs"), span)).alias("run")
    return met.select(*keys, "item", "item_id", "diff", "words", runs).select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"),
        "digest",
        "item",
        "item_id",
        (F.col("diff") + F.col("run.first")).alias("first"),
        (F.col("diff") + F.col("run.last") + F.col("words") - 1).alias("last"),
    )


def _covered(spans: Column) -> Column:
    """Number of places in the union of sorted (first, last) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end"))

    def step(at: Column, span: Column) -> Column:
        new = span["last"] - F.greatest(at["end"], span["first"] - 1)
        return F.struct(
            (at["n"] + F.greatest(F.lit(0), new)).cast("long").alias("n"),
            F.greatest(at["end"], span["last"]).alias("end"),
        )

    return F.aggregate(spans, start, step, lambda at: at["n"])


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 0
) -> DataFrame:
    """Mark documents that hold passages of benchmark items.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` needs ``item_id`` and ``text``.
    Returns all columns of ``docs`` and the columns of ``OUTPUTS``, which replace
    input columns of the same names: words, words inside matches of
    ``passage_matches``, items with matches, their ids (sorted as strings) and
    whether any word is hit.

    A NULL or empty text has no words and matches nothing, on either side. Rows
    that share an id are told apart by their texts; repeated rows get equal results.
    Items without an id mark words but are neither counted nor listed. Several items
    of one id count once. Empty tables give no matches.

    A passage that very many documents hold is a few rows per document here: the
    groups are single documents and items, never all documents of a passage.
    """
    matches = passage_matches(docs.select("doc_id", "text"), items, window, slop)
    hits = matches.groupBy("doc_id", "digest").agg(
        _covered(F.sort_array(F.collect_set(F.struct("first", "last")))).alias("covered"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"),
    )
    hits = hits.select(
        F.col("doc_id").alias("hit_id"), F.col("digest").alias("hit_digest"), "covered", "ids"
    )
    names = kept_names(docs, OUTPUTS)
    rows = docs.select(
        *sealed(names),
        F.col("doc_id").alias("key_id"),
        row_digest(F.col("text")).alias("key_digest"),
        F.size(token_words(F.col("text"))).cast("long").alias("n_words"),
    )
    same = F.col("key_id").eqNullSafe(F.col("hit_id")) & (F.col("key_digest") == F.col("hit_digest"))
    none = F.array().cast("array<string>")
    return rows.join(hits, same, "left").select(
        *unsealed(names),
        "n_words",
        F.coalesce("covered", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("ids", none).alias("item_ids"),
        F.col("covered").isNotNull().alias("contaminated"),
    )
