"""Every tunable of the engine in one immutable value.

Functions take a ``RiskParams`` argument; nothing is read from module globals.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any


@dataclass(frozen=True)
class RiskWeights:
    # Default weight of each term of the raw risk.
    if_score: float = 0.30
    svm_score: float = 0.25
    ae_score: float = 0.15
    sensitive_total: float = 0.20
    failed_total: float = 0.10

    def items(self) -> list[tuple[str, float]]:
        return [(name, getattr(self, name)) for name in self.__dataclass_fields__]


@dataclass(frozen=True)
class ForestParams:
    trees: int = 200
    contamination: float = 0.05
    max_samples: int = 256


@dataclass(frozen=True)
class SvmParams:
    kernel: str = "rbf"
    nu: float = 0.05
    gamma: float | str = "scale"
    #: Landmark users spanning the kernel space; exact when it covers all users.
    landmarks: int = 256
    max_passes: int = 120
    #: "count" multiplies decision values by nu * n, "mean" leaves them as averages.
    scale: str = "count"


@dataclass(frozen=True)
class AutoencoderParams:
    hidden: tuple[int, ...] = (32, 16, 8, 16, 32)
    activation: str = "relu"
    max_epochs: int = 500
    learning_rate: float = 0.001
    l2: float = 1e-4
    #: Rows of a shard's local training batch.
    batch: int = 50
    tolerance: float = 1e-4
    patience: int = 10
    #: Epochs each shard runs between two averaging rounds.
    local_epochs: int = 20


@dataclass(frozen=True)
class RiskParams:
    seed: int = 42
    weights: RiskWeights = field(default_factory=RiskWeights)
    critical: float = 75
    high: float = 50
    medium: float = 25
    forest: ForestParams = field(default_factory=ForestParams)
    svm: SvmParams = field(default_factory=SvmParams)
    autoencoder: AutoencoderParams = field(default_factory=AutoencoderParams)
    #: Users per replay batch and seconds between micro-batches.
    batch_size: int = 10
    interval_seconds: int = 5
    #: Users hash into as many shards as hold at most about ``rows_per_shard`` of them,
    #: but never fewer than ``min_shards``. The number follows from the user count, not
    #: from the cores, so a fit repeats on any cluster size. ``shards`` sets it directly.
    shards: int | None = None
    min_shards: int = 8
    rows_per_shard: int = 100_000

    def shard_count(self, users: int) -> int:
        return self.shards or max(self.min_shards, -(-users // self.rows_per_shard))

    @classmethod
    def from_env(cls, env: Mapping[str, str]) -> RiskParams:
        """Defaults overridden by settings; an unreadable number keeps its default."""
        # Fixed values below: the names of the settings.
        base = cls()

        def get(key: str, cast: Callable[[str], Any], default: Any) -> Any:
            try:
                return cast(env[key])
            except (KeyError, ValueError):
                return default

        gamma = env.get("SVM_GAMMA", base.svm.gamma)
        try:
            gamma = float(gamma)
        except ValueError:
            pass
        w, f, s, a = base.weights, base.forest, base.svm, base.autoencoder
        return replace(
            base,
            seed=get("SEED", int, base.seed),
            weights=RiskWeights(
                if_score=get("WEIGHT_IF_SCORE", float, w.if_score),
                svm_score=get("WEIGHT_SVM_SCORE", float, w.svm_score),
                ae_score=get("WEIGHT_AE_SCORE", float, w.ae_score),
                sensitive_total=get("WEIGHT_SENSITIVE_TOTAL", float, w.sensitive_total),
                failed_total=get("WEIGHT_FAILED_TOTAL", float, w.failed_total),
            ),
            critical=get("RISK_CRIT_THRESHOLD", int, base.critical),
            high=get("RISK_HIGH_THRESHOLD", int, base.high),
            medium=get("RISK_MEDIUM_THRESHOLD", int, base.medium),
            forest=replace(
                f,
                trees=get("IF_N_ESTIMATORS", int, f.trees),
                contamination=get("IF_CONTAMINATION", float, f.contamination),
            ),
            svm=replace(
                s,
                kernel=env.get("SVM_KERNEL", s.kernel),
                nu=get("SVM_NU", float, s.nu),
                gamma=gamma,
            ),
            autoencoder=replace(
                a,
                max_epochs=get("AE_MAX_ITER", int, a.max_epochs),
                learning_rate=get("AE_LEARNING_RATE", float, a.learning_rate),
            ),
        )
