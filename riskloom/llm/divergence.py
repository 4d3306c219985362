"""Audit how far the sources of each language diverge in their words, in exact integers."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.sources.ship import ship_package
from riskloom.sources.staging import stage

# On UTF-8 bytes: A-Z to lower case, ASCII but letters to blanks, all beyond ASCII as it is.
_FOLD = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256)).lower()
_PIECE = 1 << 20  # bytes of a long text whose terms are listed at once
_ROWS = 200_000  # postings that a task indexes at once
_CELLS = 4_000_000  # accumulator cells that a task holds
_COUNTS = pa.schema(
    [("lang", "string"), ("source", "string"), ("term", "string"), ("n", "int64"), ("docs", "int64")]
)


@dataclass(frozen=True)
class AuditRule:
    """``scale`` (at most 10^9 for exact 64-bit values) is the sum that probabilities round to.

    ``block`` is the number of sources of one term that scatter in one task, ``salts`` the
    tasks that share the histograms of one language.
    """

    min_docs: int = 3
    scale: int = 1_000_000_000
    top_terms: int = 200
    block: int = 4_096
    salts: int = 64


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text, in lists of bounded length."""
    folded = text.translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + _PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """``n`` occurrences and ``docs`` documents of each term by ``lang`` and ``source``.

    Every group also has a row for the term "", with zeros.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: dict[tuple[str, str], Counter] = defaultdict(Counter)
            documents: dict[tuple[str, str], Counter] = defaultdict(Counter)
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                own, held = places[lang, source], set()
                for terms in terms_of(text):
                    own.update(terms)
                    held.update(terms)
                documents[lang, source].update(held)
            for (lang, source), n in places.items():
                has = documents[lang, source]
                n[b""] = has[b""] = 0
                columns = [list(n), list(n.values()), list(map(has.__getitem__, n))]
                group = [pa.repeat(pa.scalar(name), len(n)) for name in (lang, source)]
                kinds = (pa.binary(), pa.int64(), pa.int64())
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
                arrays[0] = arrays[0].cast(pa.string())
                yield pa.RecordBatch.from_arrays([*group, *arrays], schema=_COUNTS)

    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    texts = docs.select(*named, F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counted = texts.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    # A task hands each key out about once, so sums before the shuffle would save no row.
    keys = ("lang", "source", "term")
    sums = counted.repartition(*keys).groupBy(*keys)
    return sums.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, rule: AuditRule) -> Column:
    """1 + floor(scale * (n + 1) / total), without overflow."""
    wide = F.lit(rule.scale).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return 1 + F.call_function("div", wide, total.cast("decimal(20,0)"))


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row-wise sparse product of a task's postings with their own term-major index.

    Rows come sorted by language and term (``lang, term, block, gid, p, p0, peers,
    own``). Each own row's group scatters its terms through the index of the task: for
    every peer that has the term, a dense accumulator with a cell per peer gains what the
    pair's terms differ in, less what the zero baselines of both already count. Posting
    pairs live in one array per group and chunk only; out go nonzero cells.
    """
    held: dict[tuple[str, int], np.ndarray] = {}
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rest = rows if rest is None else pa.concat_tables([rest, rows])
        if rest.num_rows >= _ROWS:
            cut = _last_start(rest)
            _add(rest.slice(0, cut), held)
            rest = rest.slice(cut)
            if sum(map(len, held.values())) > _CELLS:
                yield from _cells(held)
                held.clear()
    if rest is not None and rest.num_rows:
        _add(rest, held)
    yield from _cells(held)


def _starts(rows: pa.Table) -> np.ndarray:
    """Whether a row begins a new term."""
    new = np.ones(rows.num_rows, bool)
    keys = [rows[c].combine_chunks() for c in ("lang", "term", "block")]
    new[1:] = False
    for key in keys:
        new[1:] |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    return new


def _last_start(rows: pa.Table) -> int:
    return int(np.flatnonzero(_starts(rows))[-1])


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _add(rows: pa.Table, held: dict[tuple[str, int], np.ndarray]) -> None:
    if not rows.num_rows:
        return
    starts = _starts(rows)
    term = starts.cumsum() - 1
    first = np.flatnonzero(starts)
    length = np.diff(np.append(first, rows.num_rows))
    gid, p, p0, peers = (rows[c].to_numpy() for c in ("gid", "p", "p0", "peers"))
    lang = rows["lang"].combine_chunks().dictionary_encode()
    code = lang.indices.to_numpy()
    own = np.flatnonzero(rows["own"].to_numpy(zero_copy_only=False))
    own = own[np.lexsort((own, gid[own], code[own]))]
    if not own.size:
        return
    turn = (np.diff(gid[own]) != 0) | (np.diff(code[own]) != 0)
    for mine in np.split(own, np.flatnonzero(turn) + 1):
        at, many = first[term[mine]], length[term[mine]]
        before = np.cumsum(many) - many
        postings = np.repeat(at - before, many) + np.arange(many.sum())
        pg, base = np.repeat(p[mine], many), p0[mine[0]]
        ph, qh = p[postings], p0[postings]
        more = _gap(pg, ph) - _gap(pg, qh) - _gap(base, ph) + _gap(base, qh)
        name = (lang.dictionary[code[mine[0]]].as_py(), int(gid[mine[0]]))
        if name not in held:
            held[name] = np.zeros(int(peers[mine[0]]), np.int64)
        np.add.at(held[name], gid[postings], more)


_CELL = pa.schema([("lang", "string"), ("g", "int32"), ("h", "int32"), ("value", "int64")])


def _cells(held: dict[tuple[str, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (lang, g), row in held.items():
        h = np.flatnonzero(row)
        columns = [[lang] * len(h), np.full(len(h), g), h, row[h]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _CELL)], schema=_CELL
        )


def audit_sources(docs: DataFrame, rule: AuditRule | None = None) -> DataFrame:
    """Distances between the sources of each language, and the terms that mark each source.

    Needs ``text``, ``lang`` and ``source``; other columns are not looked at, whatever
    their names. A NULL in any of the three is an empty string, so rows without a source
    are one source. Every row is a document, repeated rows too. Terms are runs of ASCII
    letters and of all characters beyond ASCII, only A-Z in lower case. A language keeps the
    terms that at least ``min_docs`` of its documents hold; each of its groups, and the
    language as a whole, then gives each kept term the smoothed share
    p = 1 + floor(scale * (n + 1) / (all + kept terms)).

    Returns ``lang, source, part, item, value, rank``. Part "pair": ``item`` is each other
    source of the language, ``value`` the sum of floor((p - q)^2 / q) over all kept terms,
    p of the source, q of the item; 0 if no term is kept. Part "term": ``item`` is a kept
    term that the source holds with p above the language's q, ``value`` its floor((p - q)^2 /
    q); the first ``top_terms`` only. Ranks go by value, highest first, then by item. A
    source alone in its language has no pair; empty texts make a group without terms. No
    rows give no rows.

    The sum over all kept terms is never walked: V equal terms with nothing in either
    source are one product; what one source has is added from the histogram of its
    shares against each peer's zero baseline; only terms that both hold meet in
    :func:`scatter`, which takes those baselines back. Postings are dealt by term, and a term
    of more than ``block`` sources by block of sources, each beside the whole list.
    """
    rule = rule or AuditRule()
    ship_package(docs.sparkSession)
    of_term = W.partitionBy("lang", "term")  # a row per source
    counts = term_counts(docs).withColumns(
        {
            "docs": F.sum("docs").over(of_term),
            "lang_n": F.sum("n").over(of_term),
            "lists": F.count(F.lit(1)).over(of_term),
            "first": F.min("source").over(of_term) == F.col("source"),
        }
    )
    listed = (F.col("docs") >= rule.min_docs) | (F.col("term") == "")
    counts = stage(counts.where(listed).drop("docs"), "kept-terms")
    kept = counts.where("term <> ''")
    langs = kept.groupBy("lang").agg(
        F.count_if("first").alias("v"), F.sum("n").alias("lang_total")
    )
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    everyone = W.partitionBy("lang")
    groups = (
        counts.where("term = ''")
        .select("lang", "source")
        .join(own, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["total", "v", "lang_total"])
        .withColumns(
            {
                "gid": F.row_number().over(everyone.orderBy("source")) - 1,
                "peers": F.count(F.lit(1)).over(everyone),
                "total": F.col("total") + F.col("v"),
                "lang_total": F.col("lang_total") + F.col("v"),
            }
        )
        .withColumn(
            "p0",
            F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"), rule)).otherwise(F.lit(1)),
        )
    )
    groups = stage(groups, "groups")
    shares = kept.join(groups, ["lang", "source"]).withColumns(
        {
            "p": _share(F.col("n"), F.col("total"), rule),
            "q": _share(F.col("lang_n"), F.col("lang_total"), rule),
        }
    )
    return _pairs(shares, groups, rule).unionByName(_terms(shares, rule))


def _ranked(rows: DataFrame) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _terms(shares: DataFrame, rule: AuditRule) -> DataFrame:
    rows = shares.where("p > q").select(
        "lang",
        "source",
        F.lit("term").alias("part"),
        F.col("term").alias("item"),
        _distance(F.col("p"), F.col("q")).alias("value"),
    )
    return _ranked(rows).where(F.col("rank") <= rule.top_terms)


def _pairs(shares: DataFrame, groups: DataFrame, rule: AuditRule) -> DataFrame:
    both = (
        shares.withColumn("blocks", F.ceil(F.col("lists") / rule.block).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("own", F.col("gid") % F.col("blocks") == F.col("block"))
        .select("lang", "term", "block", "gid", "p", "p0", "peers", "own")
        .repartition("lang", "term", "block")
        .sortWithinPartitions("lang", "term", "block")
        .mapInArrow(scatter, "lang string, g int, h int, value long")
        .where("g <> h")
    )
    histogram = shares.groupBy("lang", "gid", "p0", "p").agg(F.count(F.lit(1)).alias("many"))
    absent = groups.select("lang", "gid", "p0", F.col("p0").alias("p"), F.col("v").alias("many"))
    rows = histogram.withColumn("all", F.lit(False)).unionByName(absent.withColumn("all", F.lit(True)))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("gid", "p"), F.lit(rule.salts)).cast("int"))
    peers = groups.select(
        "lang",
        F.col("gid").alias("peer"),
        F.col("p0").alias("peer_p0"),
        F.explode(F.sequence(F.lit(0), F.lit(rule.salts - 1))).alias("salt"),
    )
    p, p0, q0, every = F.col("p"), F.col("p0"), F.col("peer_p0"), F.col("all")
    none = F.lit(0).cast("long")
    to_peer = _distance(p, q0) - F.when(every, none).otherwise(_distance(p0, q0))
    from_peer = F.when(every, none).otherwise(_distance(q0, p) - _distance(q0, p0))
    cell = lambda g, h, value: F.struct(
        g.alias("g"), h.alias("h"), (F.col("many") * value).alias("value")
    )
    gid, peer = F.col("gid"), F.col("peer")
    baselines = (
        rows.join(peers, ["lang", "salt"])
        .where("gid <> peer")
        .select(
            "lang",
            F.explode(F.array(cell(gid, peer, to_peer), cell(peer, gid, from_peer))).alias("cell"),
        )
        .select("lang", "cell.*")
    )
    sums = baselines.unionByName(both).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))
    named = groups.select("lang", F.col("gid").alias("g"), "source")
    items = groups.select("lang", F.col("gid").alias("h"), F.col("source").alias("item"))
    rows = sums.join(named, ["lang", "g"]).join(items, ["lang", "h"])
    return _ranked(rows.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
