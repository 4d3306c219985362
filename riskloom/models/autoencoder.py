"""Autoencoder: a small dense network trained to reproduce its input.

Training is data-parallel (Zinkevich et al. 2010): every shard runs some local
epochs of Adam (Kingma & Ba 2015) from the common weights, then weights and
Adam moments are averaged over all users. What leaves a shard has the size of
the network, never of the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from riskloom.models.arrays import sum_over_shards
from riskloom.params import AutoencoderParams, RiskParams


def layer_sizes(features: int, params: AutoencoderParams) -> list[int]:
    return [features, *params.hidden, features]


def unpack(flat: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, bias) views of each layer of a flat vector."""
    layers, at = [], 0
    for rows, cols in zip(sizes, sizes[1:]):
        w = flat[at : at + rows * cols].reshape(rows, cols)
        at += rows * cols
        layers.append((w, flat[at : at + cols]))
        at += cols
    return layers


def initial(sizes: list[int], seed: int) -> np.ndarray:
    """Glorot-uniform start."""
    rng = np.random.default_rng(seed)
    parts = []
    for rows, cols in zip(sizes, sizes[1:]):
        bound = np.sqrt(6.0 / (rows + cols))
        parts.append(rng.uniform(-bound, bound, rows * cols + cols))
    return np.concatenate(parts)


def forward(data: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Activations of every layer, the input first: relu inside, identity at the end."""
    out = [data]
    for i, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        out.append(z if i == len(layers) - 1 else np.maximum(z, 0.0))
    return out


def loss_and_gradient(
    data: np.ndarray, flat: np.ndarray, sizes: list[int], l2: float
) -> tuple[float, np.ndarray]:
    """Half the mean squared error, and the gradient Adam follows."""
    layers = unpack(flat, sizes)
    acts = forward(data, layers)
    delta = acts[-1] - data
    loss = 0.5 * float(np.mean(delta * delta))
    gradient = np.empty_like(flat)
    slots = unpack(gradient, sizes)
    for i in range(len(layers) - 1, -1, -1):
        w = layers[i][0]
        slots[i][0][...] = (acts[i].T @ delta + l2 * w) / len(data)
        slots[i][1][...] = delta.mean(axis=0)
        if i:
            delta = (delta @ w.T) * (acts[i] > 0)
    return loss, gradient


@dataclass(frozen=True)
class AutoencoderModel:
    sizes: list[int]
    flat: np.ndarray
    loss: float = float("nan")
    epochs: int = 0

    def error(self, data: np.ndarray) -> np.ndarray:
        """Mean squared reconstruction error per row."""
        rebuilt = forward(data, unpack(self.flat, self.sizes))[-1]
        return np.mean((data - rebuilt) ** 2, axis=1)


def train_locally(
    data: np.ndarray,
    state: np.ndarray,
    sizes: list[int],
    params: AutoencoderParams,
    batch: int,
    epochs: int,
    steps_done: int,
    rng: np.random.Generator,
) -> tuple[np.ndarray, np.ndarray]:
    """Adam from ``state`` (weights, first and second moments, stacked)."""
    flat, first, second = state.copy()
    losses = np.zeros(epochs)
    step = steps_done
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        for start in range(0, len(data), batch):
            rows = data[order[start : start + batch]]
            loss, gradient = loss_and_gradient(rows, flat, sizes, params.l2)
            losses[epoch] += loss * len(rows) / len(data)
            step += 1
            first += 0.1 * (gradient - first)
            second += 0.001 * (gradient * gradient - second)
            rate = params.learning_rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            flat -= rate * first / (np.sqrt(second) + 1e-8)
    return np.stack([flat, first, second]), losses


def fit(
    shards: DataFrame, features: int, users: int, shard_count: int, params: RiskParams
) -> AutoencoderModel:
    """``shards`` comes from :func:`riskloom.models.arrays.sharded`."""
    ae = params.autoencoder
    if ae.activation != "relu":
        raise ValueError(f"unsupported activation: {ae.activation}")
    sizes = layer_sizes(features, ae)
    start = initial(sizes, params.seed)
    state = np.stack([start, np.zeros_like(start), np.zeros_like(start)])
    rows_per_shard = -(-users // shard_count)
    steps_per_epoch = -(-rows_per_shard // ae.batch)
    context = shards.sparkSession.sparkContext
    best, stale, epoch = np.inf, 0, 0
    while epoch < ae.max_epochs and stale <= ae.patience:
        count = min(ae.local_epochs, ae.max_epochs - epoch)
        shared = context.broadcast(state)
        done, seed = epoch * steps_per_epoch, params.seed

        def local(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
            from pyspark import TaskContext

            parts = list(blocks)  # one shard, at most about rows_per_shard rows
            if not parts:
                return None
            data = np.concatenate(parts)
            rng = np.random.default_rng([seed, done, TaskContext.get().partitionId()])
            trained, losses = train_locally(
                data, shared.value, sizes, ae, ae.batch, count, done, rng
            )
            return len(data) * np.concatenate([[1.0], losses, trained.ravel()])

        total = sum_over_shards(shards, shard_count, local)
        shared.unpersist()
        mean = total[1:] / total[0]
        state = mean[count:].reshape(state.shape)
        for loss in mean[:count]:
            stale = stale + 1 if loss > best - ae.tolerance else 0
            best = min(best, loss)
        epoch += count
    return AutoencoderModel(sizes, state[0], float(best), epoch)
