"""Hard negatives by exact inner-product search: clusters of anchors walk shared lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.sources.ship import ship_package
from riskloom.sources.staging import stage

OUTPUT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)
_FAR = 1 << 62  # beyond every score
_FOUND = (
    "anchor long, anchor_id long, place int, other long, other_id long, no_id boolean, score long"
)


@dataclass(frozen=True)
class MiningRule:
    """What to mine, and the sizes of the work's pieces; the latter change no result.

    Vectors become floor(``scale`` * x). An anchor has up to ``positives`` rows of its label
    and for each of them up to ``negatives`` rows of other labels, whose score lies between
    ``low_percent`` and ``high_percent`` of the positive's.

    Centres of clusters are fitted on at most ``sample`` anchors. A cluster's anchors are
    dealt in pages of ``page`` rows, all rows in lists of ``listed`` rows or a megabyte,
    in ``stripes`` at least and ``most_stripes`` at most that work side by side; ``chunk``
    rows of a list are scored at once.
    """

    scale: int = 256
    positives: int = 5
    negatives: int = 5
    low_percent: int = 80
    high_percent: int = 100
    sample: int = 4_096
    centres: int = 64
    page: int = 256
    listed: int = 8_192
    stripes: int = 32
    most_stripes: int = 1_024
    chunk: int = 256


@dataclass(frozen=True)
class _Shape:
    """Vectors' common length, and the kind of number that holds every component."""

    dim: int
    kind: str


def _prepared(rows: DataFrame, is_anchor: Column, scale: int) -> DataFrame:
    missing = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (
        rows.withColumn("_anchor", F.coalesce(is_anchor, F.lit(False)))
        .select(
            F.col("vec_id").cast("long").alias("id"),
            F.col("label").cast("long").alias("label"),
            F.col("_anchor").alias("anchor"),
            F.col("embedding").cast("array<double>").alias("x"),
        )
        .where("label is not null and x is not null")
        .where(~F.exists("x", missing))
        .withColumn("v", F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x)))
        .drop("x")
        .withColumn("row", F.monotonically_increasing_id())
    )


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    length = np.linalg.norm(x, axis=-1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def _centres(anchors: DataFrame, shape: _Shape, rule: MiningRule) -> np.ndarray:
    """Unit centres by spherical k-means on a bounded sample, the first by hash."""
    chosen = anchors.select("v").orderBy(F.xxhash64("row"), "row").limit(rule.sample)
    x = _unit(_matrix(chosen.toArrow()["v"].combine_chunks(), shape.dim))
    k = min(rule.centres, 1 + len(x) // 32)
    centres = x[:k]
    for _ in range(8):
        nearest = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        moved = _unit(sums)
        centres = np.where((moved == 0).all(1, keepdims=True), centres, moved)
    return centres


def _clustered(anchors: DataFrame, centres: np.ndarray, shape: _Shape) -> DataFrame:
    @F.arrow_udf("int")
    def nearest(lists: pa.Array) -> pa.Array:
        x = _unit(_matrix(lists, shape.dim))
        return pa.array((x @ centres.T).argmax(1), pa.int32())

    return anchors.withColumn("cluster", nearest("v"))


def _paged(rows: DataFrame, key: str, most: int, shape: _Shape) -> DataFrame:
    """Pack runs of up to ``most`` rows of one key into one row each; ``rows`` are sorted by key."""
    lists = [c for c in rows.columns if c not in (key, "v")]
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"{key} int", *(f"{c} array<{kinds[c]}>" for c in lists), "vectors binary"])
    size = np.dtype(shape.kind).itemsize * max(shape.dim, 1)
    most = min(most, max(64, (1 << 20) // size))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            cuts = _runs(rest[key].to_numpy(), most)
            for start, end in cuts[:-1]:  # the last run may go on
                yield packed(rest.slice(start, end - start))
            if cuts:
                rest = rest.slice(cuts[-1][0])
        if rest is not None and rest.num_rows:
            for start, end in _runs(rest[key].to_numpy(), most):
                yield packed(rest.slice(start, end - start))

    def packed(run: pa.Table) -> pa.RecordBatch:
        run = run.combine_chunks()
        one = lambda c: pa.ListArray.from_arrays(
            pa.array([0, run.num_rows], pa.int32()), run[c].chunk(0)
        )
        vectors = _matrix(run["v"].chunk(0), shape.dim).astype(shape.kind).tobytes()
        columns = [run[key].chunk(0)[:1], *map(one, lists), pa.array([vectors], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=[key, *lists, "vectors"])

    return rows.select(key, *lists, "v").mapInArrow(pack, schema)


def _runs(keys: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Borders of pieces of equal keys, none longer than ``most``."""
    starts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
    return [
        (at, min(at + most, end))
        for begin, end in zip(starts, starts[1:])
        for at in range(begin, end, most)
    ]


class _Walk:
    """One page of a cluster's anchors on its way through the lists of a stripe.

    Every member has windows of wanted scores and keeps the ``most`` best rows of each. A
    list is sorted once for the page by what no member's inner product can exceed: with
    the angles a of a row and w of the farthest member to the centre, the row's length
    times cos(max(0, a - w)). A member leaves the list where that bound times its own
    length falls below all that its windows still want.
    """

    def __init__(
        self,
        page: dict,
        centres: np.ndarray,
        shape: _Shape,
        rule: MiningRule,
        same: bool,
        most: int,
    ):
        self.ids, self.rows = page["id"], np.array(page["row"], np.int64)
        self.labels = np.array(page["label"], np.int64)
        self.vectors = _rows(page["vectors"], shape)
        self.low = np.array(page["low"], np.int64).reshape(len(self.rows), -1)
        self.high = np.array(page["high"], np.int64).reshape(len(self.rows), -1)
        self.centre = centres[page["cluster"]]
        self.lengths = np.linalg.norm(self.vectors, axis=1)
        cos = np.clip(_unit(self.vectors) @ self.centre, -1, 1)
        self.widest = float(np.arccos(cos).max())
        self.shape, self.rule, self.same, self.most = shape, rule, same, most
        self.wants = np.where(self.low <= self.high, self.low, _FAR)  # by member and window
        self.scored = 0  # inner products so far
        self.found = np.zeros((0, 6), np.int64)  # member, window, -score, no_id, id, row

    def through(self, page: dict) -> None:
        vectors = _rows(page["vectors"], self.shape)
        lengths = np.linalg.norm(vectors, axis=1)
        angle = np.arccos(np.clip(_unit(vectors) @ self.centre, -1, 1))
        bound = lengths * np.cos(np.maximum(angle - self.widest, 0))
        order = np.argsort(-bound, kind="stable")
        ids = np.array([0 if i is None else i for i in page["other_id"]], np.int64)
        no_id = np.array([i is None for i in page["other_id"]], np.int64)
        labels, rows = np.array(page["other_label"], np.int64), np.array(page["other"], np.int64)
        widest = float(self.lengths.max(initial=0) * lengths.max(initial=0))
        if widest >= 1 << 62:
            raise OverflowError("inner products do not fit into 64 bits")
        exact = float if widest < 1 << 52 else np.int64
        mine, theirs = self.vectors.astype(exact), vectors.astype(exact)
        for start in range(0, len(order), self.rule.chunk):
            reach = self.lengths * bound[order[start]]
            reach += 1e-6 + 1e-9 * np.abs(reach)  # rounding must not hide a row
            walking = np.flatnonzero(self.wants.min(1) <= reach)
            if not walking.size:
                return
            part = order[start : start + self.rule.chunk]
            scores = (mine[walking] @ theirs[part].T).astype(np.int64)
            self.scored += scores.size
            fits = (labels[part] == self.labels[walking, None]) == self.same
            fits &= rows[part] != self.rows[walking, None]
            for w in range(self.wants.shape[1]):
                wanted = fits & (scores >= self.wants[walking, w, None])
                wanted &= scores <= self.high[walking, w, None]
                m, c = np.nonzero(wanted)
                if m.size:
                    at = part[c]
                    member, window = walking[m], np.full(m.size, w)
                    entries = [member, window, -scores[m, c], no_id[at], ids[at], rows[at]]
                    self.found = np.vstack([self.found, np.column_stack(entries)])
            self._keep_best()

    def _keep_best(self) -> None:
        found = self.found[np.lexsort(self.found.T[::-1])]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
        starts = np.flatnonzero(new)
        nth = np.arange(len(found)) - np.repeat(starts, np.diff(np.append(starts, len(found))))
        self.found = found[nth < self.most]
        last = found[nth == self.most - 1]
        self.wants[last[:, 0], last[:, 1]] = -last[:, 2]

    def result(self) -> pa.RecordBatch:
        m, w, score, no_id, other_id, other = self.found.T
        columns = [
            pa.array(self.rows[m], pa.int64()),
            pa.array([self.ids[i] for i in m], pa.int64()),
            pa.array(w, pa.int32()),
            pa.array(other, pa.int64()),
            pa.array(other_id, pa.int64(), mask=no_id > 0),
            pa.array(no_id > 0, pa.bool_()),
            pa.array(-score, pa.int64()),
        ]
        names = [field.split()[0] for field in _FOUND.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names=names)


def _rows(vectors: bytes, shape: _Shape) -> np.ndarray:
    n = len(vectors) // max(1, np.dtype(shape.kind).itemsize * shape.dim)
    return np.frombuffer(vectors, shape.kind).reshape(n, shape.dim).astype(np.int64)


def _walked(
    pages: DataFrame, lists: DataFrame, n_stripes: int, start: Callable[[dict], _Walk]
) -> DataFrame:
    """All pages through all lists; a page's turns in one stripe carry its best rows on."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, name = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if current is None or name != (row["stripe"], row["row"][0]):
                    if current is not None:
                        yield current.result()
                    current, name = start(row), (row["stripe"], row["row"][0])
                current.through(row | {"vectors": row["other_vectors"]})
        if current is not None:
            yield current.result()

    every = F.explode(F.sequence(F.lit(0), F.lit(n_stripes - 1))).alias("stripe")
    # A merge join reads a page's lists one after the other.
    met = pages.select("*", every).join(lists.hint("merge"), "stripe")
    return met.mapInArrow(walk, _FOUND)


def mine_hard_negatives(
    rows: DataFrame, is_anchor: Column, rule: MiningRule | None = None
) -> DataFrame:
    """Each anchor's nearest rows of its label, and for each the hard rows of other labels.

    Needs ``vec_id`` (integer), ``label`` (integer; number other labels first) and
    ``embedding`` (array of numbers); ``is_anchor`` says which rows are anchors and may use
    any column. Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``; see :class:`MiningRule`. A score is the integer inner product with
    the anchor, higher ones first, ties by smaller ``vec_id``. An anchor is not its own
    positive; positives without a fitting negative give no row.

    Rows with a NULL label, vector or component, or one that is not finite, take no part.
    A vector that is shorter than the longest counts as filled up with 0. Rows with the
    same id are rows of their own, each an anchor if it fits; of a tie between them any is
    taken. Rows without an id are last of their ties. Without rows or anchors there are no
    rows. Scores must fit into 62 bits; else an OverflowError says so.

    Search is exact at every size. Anchors are clustered; each page of a cluster walks
    lists of all rows, sorted once for the page by an angular upper bound, and every anchor
    stops where that bound certifies its result (:class:`_Walk`). First all positives are
    found, then, with their scores as windows, the negatives. Rows are dealt once, to
    stripes; pages go to every stripe, so no task holds more than a page and a list and
    equal vectors are spread like any others. At most ``positives`` x ``negatives`` rows of
    an anchor leave each stripe.
    """
    rule = rule or MiningRule()
    spark = rows.sparkSession
    ship_package(spark)
    prepared = stage(_prepared(rows, is_anchor, rule.scale), "vectors")
    facts = prepared.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("anchor").alias("anchors"),
        F.max(F.size("v")).alias("dim"),
        F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("most"),
    ).first()
    if not facts["anchors"]:
        return _nothing(spark)
    most = facts["most"] or 0
    shape = _Shape(
        facts["dim"], "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    )
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(shape.dim) - F.size("v")))
    prepared = prepared.withColumn("v", filled)
    n_stripes = min(max(-(-facts["n"] // rule.listed), rule.stripes), rule.most_stripes)
    dealt = (
        prepared.withColumn("stripe", F.pmod(F.xxhash64("row"), F.lit(n_stripes)).cast("int"))
        .withColumnsRenamed({"id": "other_id", "label": "other_label", "row": "other"})
        .drop("anchor")
        .repartition(n_stripes, "stripe")
        .sortWithinPartitions("stripe")
    )
    lists = stage(_paged(dealt, "stripe", rule.listed, shape), "lists")
    lists = lists.withColumnRenamed("vectors", "other_vectors")
    anchors = prepared.where("anchor").drop("anchor")
    centres = _centres(anchors, shape, rule)
    anchors = stage(_clustered(anchors, centres, shape), "anchors")

    def found(members: DataFrame, same: bool, best: int) -> DataFrame:
        dealt = members.repartitionByRange("cluster", "row")
        pages = _paged(dealt.sortWithinPartitions("cluster", "row"), "cluster", rule.page, shape)
        start = lambda page: _Walk(page, centres, shape, rule, same, best)
        by_score = (F.desc("score"), "no_id", "other_id", "other")
        nth = F.row_number().over(W.partitionBy("anchor", "place").orderBy(*by_score))
        walked = _walked(pages, lists, n_stripes, start)
        return walked.withColumn("nth", nth).where(F.col("nth") <= best)

    whole = lambda x: F.array(F.lit(x).cast("long"))
    members = anchors.withColumns({"low": whole(-_FAR), "high": whole(_FAR)})
    positives = stage(found(members, True, rule.positives), "positives")
    score, nth = F.col("score"), F.col("nth")
    percent = lambda p: F.col("score").cast("decimal(20,0)") * p / 100
    window = lambda nth, low, high: F.struct(
        nth.alias("nth"), low.cast("long").alias("low"), high.cast("long").alias("high")
    )
    borders = window(nth, F.ceil(percent(rule.low_percent)), F.floor(percent(rule.high_percent)))
    empty = F.array_repeat(window(F.lit(0), F.lit(1), F.lit(0)), rule.positives - F.size("w"))
    windows = (
        positives.groupBy("anchor")
        .agg(F.array_sort(F.collect_list(borders)).alias("w"))
        .withColumn("w", F.concat("w", empty))  # as many windows for every member of a page
        .select(
            F.col("anchor").alias("row"), F.col("w.low").alias("low"), F.col("w.high").alias("high")
        )
    )
    negatives = found(anchors.join(windows, "row"), False, rule.negatives)
    pairs = positives.select(
        "anchor",
        (F.col("nth") - 1).alias("place"),
        F.col("other_id").alias("positive_id"),
        score.alias("positive_score"),
    )
    return negatives.join(pairs, ["anchor", "place"]).select(
        "anchor_id",
        "positive_id",
        F.col("nth").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], OUTPUT)
