"""Find license phrases and license notices in documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.line_dedup import split_lines
from riskloom.llm.text import kept_names, let, sealed, token_words, unsealed, up_to

# Phrases and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Short notices of public licenses, as words, and their labels.
NOTICES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files to deal in the software without restriction",
    ),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
)

# Words without which a notice that holds them is another license's.
TELLING = (
    "2",
    "apache",
    "attribution",
    "commons",
    "deal",
    "general",
    "gnu",
    "mit",
    "mozilla",
    "nc",
    "redistribution",
)

OUTPUTS = (
    "n_words",
    "n_base",
    "first_word",
    "last_word",
    "base_labels",
    "labels",
    "score",
    "notices",
    "matches",
)


@dataclass(frozen=True)
class Template:
    """A notice as distinct tokens, the corpus' rarest first; ``length`` counts repeats."""

    label: str
    tokens: tuple[str, ...]
    percent: int
    length: int
    telling: tuple[str, ...]

    @property
    def need(self) -> int:
        return -(-self.percent * len(self.tokens) // 100)

    @property
    def prefix(self) -> tuple[str, ...]:
        """Tokens of which every block that holds ``need`` tokens has one at least."""
        return self.tokens[: len(self.tokens) - self.need + 1]

    @property
    def window(self) -> int:
        """Words of text that may hold the notice: half as many again as its own."""
        return -(-3 * self.length // 2)


def _literal(words: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def order_templates(
    docs: DataFrame,
    notices: tuple[tuple[str, str], ...],
    percent: int,
    telling: tuple[str, ...] = TELLING,
) -> tuple[list[Template], tuple[str, ...]]:
    """Templates and their vocabulary, ordered by the number of documents with a token.

    Counts run over all documents; only one row per template word comes back.
    """
    vocabulary = tuple(sorted({w for _, notice in notices for w in notice.split()}))
    present = F.array_intersect(token_words(F.col("text")), _literal(vocabulary))
    counted = docs.select(F.explode(present).alias("word")).groupBy("word").count()
    known = {r["word"]: r["count"] for r in counted.collect()}
    ordered = tuple(sorted(vocabulary, key=lambda w: (known.get(w, 0), w)))
    rank = {w: i for i, w in enumerate(ordered)}
    templates = [
        Template(
            label,
            tuple(sorted(set(notice.split()), key=rank.__getitem__)),
            percent,
            len(notice.split()),
            tuple(w for w in telling if w in notice.split()),
        )
        for label, notice in notices
    ]
    return templates, ordered


def _share(block: Column, template: Template) -> Column:
    """Containment of the template in a block's ordered tokens, NULL below the threshold.

    The length filter needs ``need`` template words in the block; the prefix filter a
    token common to both prefixes; the positional filter that enough tokens follow
    the first common one on both sides. What passes is intersected exactly.
    """
    tokens, need = _literal(template.tokens), template.need
    common = F.array_intersect(
        F.slice(block, F.lit(1), F.size(block) - (need - 1)), _literal(template.prefix)
    )

    def placed(c: Column) -> Column:
        first = F.get(c, F.lit(0))
        room = F.least(
            F.size(block) - F.array_position(block, first),
            len(template.tokens) - F.array_position(tokens, first),
        )
        overlap = F.size(F.array_intersect(block, tokens))
        return F.when(
            (F.size(c) > 0) & (room + 1 >= need) & (overlap >= need),
            overlap / len(template.tokens),
        )

    return F.when(F.size(block) >= need, let(common, placed))


def _told_share(block: Column, template: Template) -> Column:
    """As ``_share``, and NULL too where a word that tells the license apart is missing."""
    share = _share(block, template)
    for word in template.telling:
        share = F.when(F.array_contains(block, word), share)
    return share


def scan_licenses(
    docs: DataFrame,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    percent: int = 80,
    block_lines: int = 2,
    telling: tuple[str, ...] = TELLING,
) -> DataFrame:
    """Add license phrases and notices to documents.

    Needs ``text``; returns all input columns and the columns of ``OUTPUTS``, which
    replace input columns of the same names. ``n_base``, ``first_word`` and
    ``last_word`` are the places of the fixed phrases, by words from 0 (NULL if there
    is none). ``notices`` lists (label, word, share), at most one per notice: the first of
    the text blocks that hold most of its distinct words, at least ``percent`` of them and
    all that are in ``telling``. Blocks are windows of consecutive words, whatever the lines,
    half as long again as the notice; every window is covered, since one that does not start
    with a word of the notice holds no more than the next that does. ``labels`` are the
    labels of phrases and notices, ``base_labels`` of the phrases alone; ``score`` is 1
    with a phrase, else the largest share of a notice, else 0.

    ``matches`` lists (label, line, share) of plain likeness: ``block_lines`` consecutive
    lines, from each line on, that hold at least ``percent`` of a notice's distinct
    words. No label follows from it, and it costs nothing unless it is selected.

    A NULL or empty text has no words and no labels. Rows are judged alone, so
    repeated rows, missing ids and extra columns make no difference. The set of
    notices is a parameter of fixed size and goes to the documents as literals, so
    the join needs no shuffle and no document group; texts that as a whole fail a
    notice's filters are not cut into blocks at all.
    """
    templates, ordered = order_templates(docs, notices, percent, telling)
    prefixes = tuple(sorted({w for t in templates for w in t.prefix}))
    names = kept_names(docs, OUTPUTS)
    text = F.coalesce(F.col("text"), F.lit(""))

    def starts(words: Column, phrase: str) -> Column:
        parts = phrase.split()
        here = lambda i: F.get(words, i) == parts[0]
        fits = lambda i: [F.get(words, i + k) == p for k, p in enumerate(parts)]

        def all_fit(i: Column) -> Column:
            fit = here(i)
            for condition in fits(i)[1:]:
                fit = fit & F.coalesce(condition, F.lit(False))
            return fit

        held = F.array_contains(words, parts[-1]) & F.array_contains(words, parts[0])
        return F.when(held, F.filter(up_to(F.size(words)), all_fit)).otherwise(
            F.array().cast("array<int>")
        )

    def blocks(_: Column) -> Column:
        def each(lines: Column) -> Column:
            join = lambda i: F.array_join(F.slice(lines, i + 1, F.lit(block_lines)), "\n")
            return F.transform(
                up_to(F.size(lines)),
                lambda i: F.array_intersect(_literal(ordered), token_words(join(i))),
            )

        return let(split_lines(text), each)

    def matches_of(template: Template):
        return lambda block, i: F.struct(
            F.lit(template.label).alias("label"),
            i.alias("line"),
            _share(block, template).alias("share"),
        )

    def found(parts: Column) -> Column:
        near = lambda m: m["share"].isNotNull()
        return F.concat(*(F.filter(F.transform(parts, matches_of(t)), near) for t in templates))

    def best_of(words: Column, template: Template) -> Column:
        """(share, -start, label) of the best window, NULL if none holds the notice."""
        tokens = _literal(template.tokens)

        def judged(i: Column) -> Column:
            block = F.array_intersect(
                _literal(ordered), F.slice(words, i + 1, F.lit(template.window))
            )
            return let(
                let(block, lambda b: _told_share(b, template)),
                lambda share: F.when(
                    share.isNotNull(),
                    F.struct(
                        share.alias("share"),
                        (-i).alias("before"),
                        F.lit(template.label).alias("label"),
                    ),
                ),
            )

        heads = F.filter(up_to(F.size(words)), lambda i: F.array_contains(tokens, F.get(words, i)))
        return F.array_max(F.transform(heads, judged))

    def noticed(words: Column) -> Column:
        """The best window per notice; only for notices that the whole text could hold."""
        held = F.array_intersect(_literal(ordered), F.array_intersect(words, _literal(ordered)))

        def each(present: Column) -> Column:
            return F.array(
                *(
                    F.when(_told_share(present, t).isNotNull(), best_of(words, t))
                    for t in templates
                )
            )

        found = F.filter(let(held, each), lambda m: m.isNotNull())
        return F.transform(
            found,
            lambda m: F.struct(
                m["label"].alias("label"), (-m["before"]).alias("word"), m["share"].alias("share")
            ),
        )

    no_matches = F.array().cast("array<struct<label:string,line:int,share:double>>")
    no_notices = F.array().cast("array<struct<label:string,word:int,share:double>>")

    def scanned(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            *(starts(words, phrase).alias(label) for phrase, label in PHRASES),
            (noticed(words) if templates else no_notices).alias("notices"),
        )

    def alike(words: Column) -> Column:
        likely = F.arrays_overlap(words, _literal(prefixes))
        return F.when(likely, let(blocks(words), found)).otherwise(no_matches)

    seen = docs.select(
        *sealed(names),
        let(token_words(F.col("text")), scanned).alias("scan"),
        let(token_words(F.col("text")), alike).alias("matches"),
    )
    places = [F.col("scan")[label] for _, label in PHRASES]
    every = F.concat(*places)
    labels = F.filter(
        F.array(*(F.when(F.size(p) > 0, F.lit(label)) for p, (_, label) in zip(places, PHRASES))),
        lambda x: x.isNotNull(),
    )
    noted = F.col("scan.notices")
    added = F.array_union(labels, F.transform(noted, lambda m: m["label"]))
    best = F.coalesce(F.array_max(F.transform(noted, lambda m: m["share"])), F.lit(0.0))
    return seen.select(
        *unsealed(names),
        F.col("scan.n_words").alias("n_words"),
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.sort_array(labels), ",").alias("base_labels"),
        F.array_join(F.sort_array(added), ",").alias("labels"),
        F.when(F.size(every) > 0, F.lit(1.0)).otherwise(best).alias("score"),
        noted.alias("notices"),
        "matches",
    )
