"""Exact Jaccard join of documents on word n-grams, in size-banded tiles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.components import connected_components
from riskloom.llm.text import blank_words, let, lower_ascii, up_to
from riskloom.sources.ship import ship_package
from riskloom.sources.staging import stage


@dataclass(frozen=True)
class JaccardRule:
    """Two sets link when 100 * common >= percent * union.

    ``spare`` tiles beyond the least number make shared empty tiles needless for
    nearly every set; ``growth`` is the ratio of a band's largest to smallest size.
    ``brief_bits`` is the most bits of the bitmap that travels with every tile. Members of
    tiles with more than ``crowd`` of them are paired by rare n-grams instead of by tile.
    """

    words: int = 3
    percent: int = 90
    growth: float = 1.5
    spare: int = 2
    brief_bits: int = 1024
    small_rows: int = 1_000_000
    crowd: int = 32

    def most_different(self, sizes: int) -> int:
        """Largest symmetric difference of two linked sets whose sizes add up to ``sizes``."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def bands(self, largest: int = 1 << 31) -> list[int]:
        """First size of each band; neighbours overlap no further than one band."""
        edges = [1]
        while edges[-1] < largest:
            edges.append(max(edges[-1] * 100 // self.percent, int(edges[-1] * self.growth)) + 1)
        return edges


def shingles(text: Column, words: int) -> Column:
    """Sorted distinct hashes of the word n-grams; fewer words are one n-gram."""

    def hashed(w: Column) -> Column:
        grams = F.when(F.size(w) >= words, F.size(w) - (words - 1)).otherwise(
            F.least(F.size(w), F.lit(1))
        )
        return F.transform(
            up_to(grams), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(words)))
        )

    return F.sort_array(F.array_distinct(let(blank_words(lower_ascii(text)), hashed)))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sure_tiles(hashes: np.ndarray, rule: JaccardRule, edges: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of tiles, and how many of them any linked set is sure to share.

    A band's tile count exceeds the symmetric difference of any two linked sets
    in it, and each differing element spoils one tile at most: some tile holds
    the same elements in both. A set shows itself in its own band and, if a
    linked set may be in the next one, there too. The lowest bit of a key is that of
    its band's number; the sure numbers stand by that bit, and no linked set shows
    itself in a band where this one does not.
    """
    n = len(hashes)
    sure = np.full(2, np.iinfo(np.int64).max)  # of no keys, any number is sure
    if not n:
        return np.empty(0, np.int64), sure
    own = int(np.searchsorted(edges, n, "right")) - 1
    partner = n * 100 // rule.percent
    keys = []
    for band in range(own, int(np.searchsorted(edges, partner, "right"))):
        largest = edges[band + 1] - 1
        tiles = rule.most_different(2 * largest) + 1 + rule.spare
        spot = (_mixed(hashes) % np.uint64(tiles)).astype(np.int64)
        content, filled = np.zeros(tiles, np.uint64), np.zeros(tiles, bool)
        np.bitwise_xor.at(content, spot, hashes)
        filled[spot] = True
        spoiled = rule.most_different(n + min(partner, largest))
        shared_empty = tiles - spoiled <= tiles - filled.sum()
        place = np.arange(tiles, dtype=np.uint64) + (np.uint64(band) << np.uint64(40))
        key = _mixed(content ^ _mixed(place))[filled | shared_empty]
        keys.append(key & ~np.uint64(1) | np.uint64(band & 1))
        # A linked set need not show its empty tiles, so only filled ones are sure.
        least = 1 if shared_empty else int(filled.sum()) - spoiled
        sure[band & 1] = min(sure[band & 1], least)
    return np.concatenate(keys).view(np.int64), sure


def tile_keys(hashes: np.ndarray, rule: JaccardRule, edges: list[int]) -> np.ndarray:
    """Keys of which two linked sets share at least one."""
    return sure_tiles(hashes, rule, edges)[0]


def bitmap(hashes: np.ndarray, most: int = 1 << 30) -> np.ndarray:
    """A bit per element in a bitmap of four to eight times as many bits, 64 .. ``most``."""
    n = min(max(64, 1 << int(4 * len(hashes)).bit_length()), most)
    spots = (hashes & np.uint64(n - 1)).astype(np.int64)
    bits = np.zeros(n, np.uint8)
    bits[spots] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays)))


def _signed(sets: DataFrame, rule: JaccardRule) -> DataFrame:
    """Replace the last column, ``set``, by ``bits``, ``brief``, ``tiles`` and ``sure``."""
    edges = rule.bands()
    names = sets.columns[:-1]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(len(names))
            ends = column.offsets.to_numpy()
            hashes = column.values.to_numpy().view(np.uint64)
            each = [hashes[a:b] for a, b in zip(ends, ends[1:])]
            bits = _lists([bitmap(x) for x in each])
            brief = _lists([bitmap(x, rule.brief_bits) for x in each])
            tiles, sure = map(_lists, zip(*(sure_tiles(x, rule, edges) for x in each)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], bits, brief, tiles, sure],
                names=[*names, "bits", "brief", "tiles", "sure"],
            )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sets.schema.fields[:-1])
    arrays = ", ".join(f"{c} array<long>" for c in ("bits", "brief", "tiles", "sure"))
    return sets.mapInArrow(build, f"{kept}, {arrays}")


def _folded(bits: Column, words: Column) -> Column:
    """A bitmap halved until it has ``words`` words; neighbours differ by one halving or two."""

    def halved(b: Column) -> Column:
        half = F.greatest((F.size(b) / 2).cast("int"), F.lit(1))
        upper = F.slice(b, half + 1, half)
        return F.when(
            F.size(b) > words,
            F.zip_with(F.slice(b, F.lit(1), half), upper, lambda x, y: x.bitwiseOR(y)),
        ).otherwise(b)

    return let(let(bits, halved), halved)


def _sizes_fit(rule: JaccardRule) -> Column:
    return 100 * F.least("n", "n2") >= rule.percent * F.greatest("n", "n2")


def _bits_fit(rule: JaccardRule, bits: str) -> Column:
    """Bit counts leave room for the wanted overlap (columns n, bits and n2, bits + "2").

    A bit that only one bitmap has stands for an element that only its set has, so the
    overlap is at most half of what the sizes hold beyond the bits that differ.
    """
    words = F.least(F.size(bits), F.size(f"{bits}2"))
    a, b = _folded(F.col(bits), words), _folded(F.col(f"{bits}2"), words)
    differing = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    count = F.aggregate(differing, F.lit(0), lambda acc, n: acc + n)
    sizes = F.col("n") + F.col("n2")
    return (100 + rule.percent) * (sizes - count) >= 2 * rule.percent * sizes


def _sent_if_small(df: DataFrame, rule: JaccardRule) -> DataFrame:
    """Broadcast a counted table of few narrow rows; leave a larger one to a shuffled join."""
    return F.broadcast(df) if df.count() <= rule.small_rows else df


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, rule: JaccardRule) -> DataFrame:
    """The pairs (u, v) of nodes that link, by bit counts and then by exact intersection."""
    left = nodes.select(F.col("node").alias("u"), "n", "bits")
    right = nodes.select(F.col("node").alias("v"), F.col("n").alias("n2"), F.col("bits").alias("bits2"))
    near = stage(
        pairs.join(left, "u")
        .join(right, "v")
        .where(_sizes_fit(rule) & _bits_fit(rule, "bits"))
        .select("u", "v")
        .distinct(),
        "pairs",
    )
    ids = near.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    sets = stage(
        docs.join(_sent_if_small(stage(ids, "ids"), rule), "doc_id", "left_semi")
        .select("doc_id", shingles(F.col("text"), rule.words).alias("set")),
        "sets",
    )
    first = sets.select(F.col("doc_id").alias("u"), "set")
    second = sets.select(F.col("doc_id").alias("v"), F.col("set").alias("set2"))
    common = F.size(F.array_intersect("set", "set2"))
    total = F.size("set") + F.size("set2")
    return (
        near.join(first, "u")
        .join(second, "v")
        .where((total > 0) & ((100 + rule.percent) * common >= rule.percent * total))
        .select("u", "v")
        .distinct()
    )


def rare_gram_pairs(docs: DataFrame, members: DataFrame, rule: JaccardRule) -> DataFrame:
    """Pairs (u, v) of ``members`` that share one of their rarest n-grams, under the bounds.

    ``members`` has ``node``, ``component``, ``n`` and ``brief``, a row per text. Two linked
    sets hold ``percent`` of each other, so in any common order of n-grams their first
    n - ceil(n * percent / 100) + 1 have one in common. The order here is by the number
    of members that hold an n-gram: what a crowd shares comes last, and only sets that
    consist of it almost wholly are paired through it.
    """
    texts = docs.join(
        _sent_if_small(members.select(F.col("node").alias("doc_id")), rule),
        "doc_id",
        "left_semi",
    )
    # Written first: a filter that explode() implies would build the sets of all documents.
    sets = stage(
        texts.select(F.col("doc_id").alias("node"), shingles(F.col("text"), rule.words).alias("set")),
        "crowd",
    )
    # A node may have several texts, each with an order of its own n-grams.
    grams = stage(
        sets.select("node", F.xxhash64("set").alias("which"), F.explode("set").alias("gram")).distinct(),
        "grams",
    )
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    common = stage(held.where(F.col("held") > rule.crowd), "common")
    # The n-grams that few members hold are alike in the order.
    ordered = grams.join(_sent_if_small(common, rule), "gram", "left").select(
        "node", "which", F.struct(F.coalesce("held", F.lit(0)).alias("held"), "gram").alias("g")
    )
    in_order = ordered.groupBy("node", "which").agg(F.sort_array(F.collect_list("g")).alias("set"))
    size = F.size("set").cast("long")
    shared = F.ceil(size * rule.percent / F.lit(100))  # with any set that links
    rarest = F.slice("set", F.lit(1), (size - shared + 1).cast("int"))
    first = in_order.select("node", F.explode(rarest).alias("g"))
    shown = stage(
        first.select("node", F.col("g.gram").alias("gram")).distinct().join(members, "node"),
        "rare",
    )
    return _across(shown, "gram", rule)


def _rarest_tiles(shown: DataFrame) -> DataFrame:
    """Each node's tiles without the most crowded ones, which no link needs.

    ``shown`` has ``node``, ``tile``, ``size`` and ``sure``. Of the tiles that two linked sets
    share, take the first in the order of size: at least ``sure`` - 1 others come after
    it in either set, so it is not among the last ``sure`` - 1 tiles of either. Tiles that
    ``shown`` leaves out for all nodes count as the first ones.
    """
    band = F.col("tile").bitwiseAND(1)
    of_node = W.partitionBy("node", band)
    crowded_first = of_node.orderBy(F.desc("size"), F.desc("tile"))
    # A node may have several texts; the least number holds for each.
    return (
        shown.withColumn("nth", F.row_number().over(crowded_first))
        .withColumn("least", F.min(F.get("sure", band.cast("int"))).over(of_node))
        .where("nth >= least")
        .drop("nth", "least", "size", "sure")
    )


def _open_tiles(labelled: DataFrame) -> DataFrame:
    """``tile``, ``size`` of the tiles whose members are not in one component."""
    split = labelled.groupBy("tile").agg(
        F.min("component").alias("least"),
        F.max("component").alias("most"),
        F.count(F.lit(1)).alias("size"),
    )
    return split.where("least < most").select("tile", "size")


def _across(shown: DataFrame, key: str, rule: JaccardRule) -> DataFrame:
    """Pairs of rows of different components that show the same key, under the bounds."""
    other = shown.select(
        key,
        F.col("node").alias("v"),
        F.col("component").alias("component2"),
        F.col("n").alias("n2"),
        F.col("brief").alias("brief2"),
    )
    return (
        shown.withColumnRenamed("node", "u")
        .join(other, key)
        .where(
            (F.col("component") < F.col("component2"))
            & _sizes_fit(rule)
            & _bits_fit(rule, "brief")
        )
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )


def jaccard_components(docs: DataFrame, rule: JaccardRule | None = None) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row of ``docs``.

    Needs ``doc_id`` (a whole number) and ``text``; other columns are ignored. Sets
    are the distinct word n-grams of the whole text; two documents link by
    ``rule``; a component's id is its smallest ``doc_id``. A text without words, or
    NULL, has an empty set and links with nothing. Rows that share an id are one
    document with the links of all of them. A row without an id links with nothing
    and has no component.

    1. Equal sets become one node by a 128-bit digest: a group of copies, however
       large, is a minimum per digest.
    2. Every node shows a key per tile of its size band (``tile_keys``). In each tile
       the node that meets most others over all its tiles is the pivot, likely the
       text that the others are copies of: pairs (pivot, member) are as many as
       members. Tiles are counted with map-side minima first; only the members of
       tiles with three nodes or more are listed at all.
    3. Pairs are bounded by bit counts, then settled by exact intersection.
    4. Tiles whose members are not in one component yet pair the members of
       different components, under the same bounds inside the join. Before that, each
       set leaves its most crowded tiles, as far as its links are sure to show in
       others too (``_rarest_tiles``). Where a tile still holds more than ``rule.crowd``,
       its members are paired by their rarest n-grams (``rare_gram_pairs``), as a
       passage that many unlike texts share would pair them all. So no link is lost,
       and no group is expanded into all its pairs.

    Sets themselves are only built again for documents in pairs that pass the
    bounds. N-grams are compared by 64-bit hashes.
    """
    rule = rule or JaccardRule()
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sets = docs.select("doc_id", shingles(F.col("text"), rule.words).alias("set"))
    signed = stage(
        _signed(
            sets.select(
                "doc_id",
                F.size("set").cast("long").alias("n"),
                F.xxhash64("set").alias("d1"),
                F.xxhash64(F.lit(1), "set").alias("d2"),
                "set",
            ),
            rule,
        ),
        "signatures",
    )
    members = signed.where("n > 0 and doc_id is not null")
    classes = stage(
        members.groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "classes"
    )
    ids = stage(members.select("doc_id", "d1", "d2").join(classes, ["d1", "d2"]), "members")
    copies = stage(
        ids.where("doc_id != node").select("doc_id", "d1", "d2").distinct(), "copies"
    )
    nodes = members.join(_sent_if_small(copies, rule), ["doc_id", "d1", "d2"], "left_anti")
    narrow = stage(
        nodes.select(F.col("doc_id").alias("node"), "n", "bits", "brief", "sure").distinct(),
        "nodes",
    )
    shown = nodes.select(F.col("doc_id").alias("node"), F.explode("tiles").alias("tile"))
    met = stage(
        shown.groupBy("tile")
        .agg(F.min("node").alias("u"), F.max("node").alias("v"), F.count(F.lit(1)).alias("size"))
        .where("u < v"),
        "met",
    )
    crowded = met.where("size > 2").select("tile", "size")
    tiled = stage(shown.join(_sent_if_small(crowded, rule), "tile"), "tiles")
    weights = tiled.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = stage(tiled.join(weights, "node").select("tile", "node", "weight"), "weighed")
    central = weighed.groupBy("tile").agg(
        F.max_by("node", F.struct("weight", -F.col("node"))).alias("pivot")
    )
    stars = stage(
        weighed.join(central, "tile")
        .where("node != pivot")
        .select(F.least("pivot", "node").alias("u"), F.greatest("pivot", "node").alias("v"))
        .unionByName(met.where("size = 2").select("u", "v"))
        .distinct(),
        "stars",
    )
    links = stage(_verified(docs, narrow, stars, rule), "links")

    found = connected_components(links)
    labelled = (
        tiled.select("tile", "node")
        .join(found, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    loose = stage(
        _rarest_tiles(
            labelled.join(_open_tiles(labelled), "tile").join(narrow.drop("bits"), "node")
        ),
        "loose",
    )
    loose = loose.join(_open_tiles(loose), "tile")
    few = loose.where(F.col("size") <= rule.crowd).drop("size")
    many = loose.where(F.col("size") > rule.crowd).select("node", "component", "n", "brief")
    across = (
        _across(few, "tile", rule)
        .unionByName(rare_gram_pairs(docs, stage(many.distinct(), "many"), rule))
        .distinct()
        .join(stars, ["u", "v"], "left_anti")
    )
    late = _verified(docs, narrow, across, rule)

    repeated = ids.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    same_id = ids.join(repeated.where("a < b"), "doc_id").select(
        F.col("doc_id").alias("u"), F.col("node").alias("v")
    )
    whole = connected_components(links.unionByName(late).unionByName(same_id))
    placed = (
        classes.join(whole, "node", "left")
        .select("d1", "d2", F.coalesce("component", "node").alias("component"))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return signed.select("doc_id", "n", "d1", "d2").join(placed, ["d1", "d2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, component).otherwise(F.col("doc_id")).alias("component_id"),
    )
