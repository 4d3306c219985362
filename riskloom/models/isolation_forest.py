"""Isolation forest (Liu, Ting, Zhou 2008).

Each tree sees about ``max_samples`` users, so the fit moves trees x samples
rows whatever the size of the table, and builds the trees in parallel.

All chance comes from MD5 digests of seed, tree and user or node, so the same forest
grows in any engine and on any number of tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.params import RiskParams

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"
)
_EULER = 0.5772156649
_DIGITS = 13  # hexadecimal digits of a uniform number; doubles hold them exactly
#: Decimals by which values of a feature differ; smaller differences are rounding errors.
DECIMALS = 9


def mean_path(size: np.ndarray | int) -> np.ndarray:
    """Average path length of an unsuccessful search among ``size`` rows."""
    size = np.asarray(size, dtype=float)
    harmonic = np.log(np.maximum(size - 1, 1)) + _EULER
    long = 2.0 * harmonic - 2.0 * (size - 1) / np.maximum(size, 1)
    return np.where(size > 2, long, np.where(size == 2, 1.0, 0.0))


def sample_for_trees(scaled: DataFrame, users: int, params: RiskParams) -> DataFrame:
    """(tree, order, row) for the rows each tree may use.

    A row joins a tree with probability p, just above max_samples / users. Trees
    are cut into blocks of at most 1/p trees; one hash per (row, block) decides
    which tree of the block, if any, takes the row. A large table needs a single
    block, so the cost is one hash per row and only taken rows are moved.
    """
    trees = params.forest.trees
    psi = min(params.forest.max_samples, users)
    p = min(1.0, (psi + 4.0 * math.sqrt(psi)) / users)
    block = max(1, min(trees, int(1.0 / p)))
    blocks = -(-trees // block)
    digest = F.md5(F.concat_ws(":", F.lit(str(params.seed)), "user_id", "_block"))
    number = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long")
    uniform = number * F.lit(2.0 ** (-4 * _DIGITS))
    return (
        scaled.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumn("_draw", uniform / p)
        .where(F.col("_draw") < block)
        .withColumn("tree", (F.col("_block") * block + F.floor("_draw")).cast("int"))
        .where(F.col("tree") < trees)
        .withColumn("order", F.col("_draw") - F.floor("_draw"))
        .drop("_block", "_draw")
    )


def draws(seed: int, tree: int, path: str) -> tuple[float, float]:
    """Two uniform numbers for the node that is reached by ``path``, 0 to the left, 1 to the right."""
    digest = hashlib.md5(f"{seed}:{tree}:{path}".encode()).hexdigest()
    digits = digest[:_DIGITS], digest[_DIGITS : 2 * _DIGITS]
    first, second = (int(d, 16) * 2.0 ** (-4 * _DIGITS) for d in digits)
    return first, second


def grow(
    data: np.ndarray, draw: Callable[[str], tuple[float, float]], max_depth: int
) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, size, depth); leaves have feature -1.

    Nodes are numbered in the order of their paths. ``draw`` gives a path's feature, among
    those that differ in the node, and the place of the cut in the feature's range.
    """
    nodes: list[list] = []
    todo = [(np.arange(len(data)), "", -1)]
    while todo:
        rows, path, parent = todo.pop()
        me = len(nodes)
        if parent >= 0:
            nodes[parent][3 + int(path[-1])] = me
        node = [me, -1, 0.0, -1, -1, len(rows), len(path)]
        nodes.append(node)
        if len(path) >= max_depth or len(rows) < 2:
            continue
        part = data[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(low < high)
        if not len(usable):
            continue
        which, where = draw(path)
        feature = int(usable[int(which * len(usable))])
        cut = float(low[feature] + where * (high[feature] - low[feature]))
        goes_left = part[:, feature] <= cut
        node[1], node[2] = feature, cut
        todo.append((rows[~goes_left], path + "1", me))
        todo.append((rows[goes_left], path + "0", me))
    return [tuple(n) for n in nodes]


def fit(scaled: DataFrame, columns: list[str], users: int, params: RiskParams) -> DataFrame:
    """Node table of the forest; see ``NODE_SCHEMA``."""
    psi = min(params.forest.max_samples, users)
    max_depth = math.ceil(math.log2(max(psi, 2)))
    seed = params.seed

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        chosen = rows.nsmallest(psi, ["order", "user_id"]).sort_values("user_id")
        draw = partial(draws, seed, tree)
        nodes = grow(chosen[columns].to_numpy(float), draw, max_depth)
        out = pd.DataFrame(
            nodes, columns=["node", "feature", "threshold", "left", "right", "size", "depth"]
        )
        out.insert(0, "tree", tree)
        return out

    known = scaled.select("user_id", *(F.round(c, DECIMALS).alias(c) for c in columns))
    sampled = sample_for_trees(known, users, params)
    # Few bytes but much work per tree: fixed partitions keep the trees spread out.
    parallel = min(params.forest.trees, max(8, scaled.sparkSession.sparkContext.defaultParallelism))
    return sampled.repartition(parallel, "tree").groupBy("tree").applyInPandas(build, NODE_SCHEMA)


def compile_scorer(nodes: pd.DataFrame, psi: int) -> Callable[[np.ndarray], np.ndarray]:
    """Vectorised ``score_samples`` over flat node arrays; leaves point to themselves."""
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    first = nodes.groupby("tree").head(1).index.to_numpy()
    base = np.repeat(first, np.diff(np.append(first, len(nodes))))
    leaf = nodes["feature"].to_numpy() < 0
    here = np.arange(len(nodes))
    feature = np.where(leaf, 0, nodes["feature"].to_numpy())
    threshold = np.where(leaf, np.inf, nodes["threshold"].to_numpy())
    child = np.stack(
        [
            np.where(leaf, here, base + nodes["right"].to_numpy()),
            np.where(leaf, here, base + nodes["left"].to_numpy()),
        ],
        axis=1,
    ).ravel()
    length = nodes["depth"].to_numpy() + mean_path(nodes["size"].to_numpy())
    steps = int(nodes["depth"].max())
    norm = max(float(mean_path(psi)), 1e-12)

    def score(data: np.ndarray) -> np.ndarray:
        out = np.empty(len(data))
        for start in range(0, len(data), 1024):
            chunk = data[start : start + 1024]
            row = np.arange(len(chunk)) * chunk.shape[1]
            flat = chunk.ravel()
            at = np.broadcast_to(first[:, None], (len(first), len(chunk)))
            for _ in range(steps):
                low = flat[row + feature[at]] <= threshold[at]
                at = child[2 * at + low]
            out[start : start + 1024] = -np.exp2(-length[at].mean(axis=0) / norm)
        return out

    return score
