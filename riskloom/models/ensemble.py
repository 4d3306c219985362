"""The three models together: fit, store, load and score."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.ordering import exact_quantile
from riskloom.models import autoencoder, isolation_forest, one_class_svm
from riskloom.models.arrays import sharded, to_matrix
from riskloom.models.autoencoder import AutoencoderModel
from riskloom.models.one_class_svm import SvmModel
from riskloom.operators.scaling import apply_scaler, fit_scaler, scaler_lookup
from riskloom.params import RiskParams
from riskloom.schemas import MODEL_SCORES, require_features
from riskloom.sources.staging import stage
from riskloom.sources.tables import delete_path, stored_table, write_table

Scaler = dict[str, tuple[float, float]]


@dataclass(frozen=True)
class ForestModel:
    nodes: pd.DataFrame  # at most trees x (2 x max_samples - 1) rows
    psi: int
    offset: float


@dataclass(frozen=True)
class Models:
    """Fitted models; an absent one scores 0. All have sizes set by the parameters."""

    scaler: Scaler
    forest: ForestModel | None = None
    svm: SvmModel | None = None
    autoencoder: AutoencoderModel | None = None


def _scorers(models: Models) -> dict[str, Callable[[np.ndarray], np.ndarray]]:
    out: dict[str, Callable[[np.ndarray], np.ndarray]] = {}
    if models.forest is not None:
        forest = isolation_forest.compile_scorer(models.forest.nodes, models.forest.psi)
        out["if_score"] = lambda x: -forest(x)
    if models.svm is not None:
        out["svm_score"] = lambda x: -models.svm.decision(x)
    if models.autoencoder is not None:
        out["ae_score"] = models.autoencoder.error
    return out


def score_scaled(scaled: DataFrame, models: Models) -> DataFrame:
    """Add ``if_score`` (-score_samples), ``svm_score`` and ``ae_score`` to scaled rows.

    One Arrow pass computes all three; the models travel as one broadcast.
    """
    columns = list(models.scaler)
    require_features(scaled.columns, columns)
    shared = scaled.sparkSession.sparkContext.broadcast(models)
    names = scaled.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = _scorers(shared.value)
        for batch in batches:
            data = to_matrix(batch, columns)
            scores = [
                pa.array(scorers[c](data) if c in scorers else np.zeros(len(data)))
                for c in MODEL_SCORES
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *scores], names=[*names, *MODEL_SCORES]
            )

    schema = T.StructType([*scaled.schema, *(T.StructField(c, T.DoubleType()) for c in MODEL_SCORES)])
    return scaled.mapInArrow(run, schema)


def _fit_forest(
    scaled: DataFrame, columns: list[str], users: int, scaler: Scaler, params: RiskParams
) -> ForestModel:
    psi = min(params.forest.max_samples, users)
    nodes = isolation_forest.fit(scaled, columns, users, params).toPandas()
    model = ForestModel(nodes, psi, 0.0)
    trained = stage(
        score_scaled(scaled, Models(scaler, forest=model)).select((-F.col("if_score")).alias("s")),
        "forest-scores",
    )
    return replace(model, offset=exact_quantile(trained, "s", params.forest.contamination))


def _fit_svm(
    scaled: DataFrame, data: DataFrame, users: int, shards: int, scaler: Scaler, params: RiskParams
) -> SvmModel:
    model = one_class_svm.fit(data, users, shards, params)
    projection = replace(model, rho=0.0, scale=1.0)
    scored = score_scaled(scaled, Models(scaler, svm=projection))
    projected = stage(scored.select((-F.col("svm_score")).alias("s")), "svm-scores")
    return replace(model, rho=exact_quantile(projected, "s", params.svm.nu))


def fit_models(
    features: DataFrame,
    params: RiskParams,
    which: tuple[str, ...] = ("forest", "svm", "autoencoder"),
) -> tuple[Models, DataFrame]:
    """Fit the scaler and the chosen models on raw features.

    Returns the models and the scaled features as a staged table, which the
    iterative fits read from one partition per shard.
    """
    require_features(features.columns)
    features = stage(features, "features")
    scaler = scaler_lookup(fit_scaler(features))
    columns = list(scaler)
    scaled = stage(apply_scaler(features, scaler), "scaled")
    users = scaled.count()
    if not users:
        raise ValueError("cannot fit models without users")
    shards = params.shard_count(users)
    found: dict[str, object] = {}
    if "forest" in which:
        found["forest"] = _fit_forest(scaled, columns, users, scaler, params)
    if "svm" in which or "autoencoder" in which:
        data = sharded(scaled, columns, shards)
        if "svm" in which:
            found["svm"] = _fit_svm(scaled, data, users, shards, scaler, params)
        if "autoencoder" in which:
            found["autoencoder"] = autoencoder.fit(data, len(columns), users, shards, params)
        data.unpersist()
    return Models(scaler, **found), scaled


def score_raw(features: DataFrame, models: Models, mode: str = "stream") -> DataFrame:
    """Model scores of raw feature rows, with the totals the risk formula uses.

    ``mode="batch"``: scaled totals, forest score relative to its offset.
    ``mode="stream"``: raw totals, forest score as it is.
    """
    if mode not in ("batch", "stream"):
        raise ValueError(f"unknown mode: {mode}")
    require_features(features.columns, list(models.scaler))
    if mode == "batch":
        return with_offset(score_scaled(apply_scaler(features, models.scaler), models), models)
    totals = ["sensitive_total", "failed_total"]
    kept = features.withColumns({f"_{c}": F.col(c) for c in totals})
    scored = score_scaled(apply_scaler(kept, models.scaler), models)
    columns = ["user_id", *MODEL_SCORES]
    role = ["role"] if "role" in features.columns else []
    return scored.select(
        *columns, *(F.col(f"_{c}").cast("long").alias(c) for c in totals), *role
    )


def with_offset(scored: DataFrame, models: Models) -> DataFrame:
    """Turn -score_samples into -decision_function."""
    if models.forest is None:
        return scored
    return scored.withColumn("if_score", F.col("if_score") + F.lit(models.forest.offset))


# Model tables ---------------------------------------------------------------


_MANIFEST = "manifest"
_TABLES = ("scaler", "iforest_nodes", "iforest_meta", "ocsvm_landmarks", "ocsvm_meta", "autoencoder")


def _content(table: DataFrame) -> DataFrame:
    """Number of rows, and a digest of them in any order."""
    whole = F.xxhash64(*table.columns)
    return table.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(whole).alias("digest"))


def _write_manifest(spark: SparkSession, folder: str, tables: list[str]) -> None:
    contents = [
        _content(spark.read.parquet(f"{folder}/{name}")).withColumn("table", F.lit(name))
        for name in tables
    ]
    whole = reduce(DataFrame.unionByName, contents).select("table", "rows", "digest")
    write_table(whole.coalesce(1), f"{folder}/{_MANIFEST}")  # a row per table


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """``table``, ``rows`` and ``digest`` of each table of the stored set of models.

    A set is what one :func:`save_models` wrote, whole: anything else is refused.
    """
    listed = stored_table(spark, f"{folder}/{_MANIFEST}")
    if listed is None:
        raise FileNotFoundError(f"no trained models in {folder}")
    for name, rows, digest in listed.select("table", "rows", "digest").collect():
        table = stored_table(spark, f"{folder}/{name}")
        if table is None or tuple(_content(table).first()) != (rows, digest):
            raise ValueError(f"{folder}: {name} is not of the stored set of models")
    return listed


def save_models(spark: SparkSession, models: Models, folder: str) -> None:
    """Write each model as Parquet tables below ``folder``, and last the list of them.

    Until then the folder holds no set of models; tables of an older one go.
    """
    written: list[str] = []
    for name in (_MANIFEST, *_TABLES):
        delete_path(spark, f"{folder}/{name}")

    def store(table: DataFrame, name: str) -> None:
        write_table(table, f"{folder}/{name}")
        written.append(name)

    def write(rows: list[tuple], schema: str, name: str) -> None:
        store(spark.createDataFrame(rows, schema).coalesce(1), name)

    write(
        [(i, c, m, s) for i, (c, (m, s)) in enumerate(models.scaler.items())],
        "position int, feature string, mean double, std double",
        "scaler",
    )
    if models.forest is not None:
        f = models.forest
        nodes = spark.createDataFrame(f.nodes, isolation_forest.NODE_SCHEMA)
        store(nodes.coalesce(1), "iforest_nodes")
        write([(f.psi, f.offset)], "psi int, offset double", "iforest_meta")
    if models.svm is not None:
        s = models.svm
        write(
            [(i, p.tolist(), float(w)) for i, (p, w) in enumerate(zip(s.landmarks, s.weights))],
            "landmark int, point array<double>, weight double",
            "ocsvm_landmarks",
        )
        write(
            [(float(s.rho), float(s.gamma), float(s.scale))], "rho double, gamma double, scale double", "ocsvm_meta"
        )
    if models.autoencoder is not None:
        a = models.autoencoder
        write(
            [
                (i, w.shape[0], w.shape[1], w.ravel().tolist(), b.tolist())
                for i, (w, b) in enumerate(autoencoder.unpack(a.flat, a.sizes))
            ],
            "layer int, inputs int, outputs int, weights array<double>, bias array<double>",
            "autoencoder",
        )
    _write_manifest(spark, folder, written)


def load_models(spark: SparkSession, folder: str) -> Models:
    """Read the stored set of models; an absent model is warned about, no set is an error."""
    listed = {r["table"] for r in inventory(spark, folder).collect()}

    def rows(name: str, order: str | None = None) -> list | None:
        if name not in listed:
            return None
        table = spark.read.parquet(f"{folder}/{name}")
        return (table.orderBy(order) if order else table).collect()

    found: dict[str, object] = {}
    meta = rows("iforest_meta")
    if meta:
        nodes = spark.read.parquet(f"{folder}/iforest_nodes").toPandas()
        found["forest"] = ForestModel(nodes, meta[0]["psi"], meta[0]["offset"])
    meta, points = rows("ocsvm_meta"), rows("ocsvm_landmarks", "landmark")
    if meta and points:
        found["svm"] = SvmModel(
            np.array([p["point"] for p in points]),
            np.array([p["weight"] for p in points]),
            meta[0]["rho"],
            meta[0]["gamma"],
            meta[0]["scale"],
        )
    layers = rows("autoencoder", "layer")
    if layers:
        flat = np.concatenate([np.array([*r["weights"], *r["bias"]]) for r in layers])
        sizes = [layers[0]["inputs"], *(r["outputs"] for r in layers)]
        found["autoencoder"] = AutoencoderModel(sizes, flat)
    if not found:
        raise FileNotFoundError(f"no trained models in {folder}")
    for name in ("forest", "svm", "autoencoder"):
        if name not in found:
            warnings.warn(f"model {name} not found in {folder}; its score is 0", stacklevel=2)
    scaler = rows("scaler", "position")
    if scaler is None:
        raise FileNotFoundError(f"no scaler in {folder}")
    return Models({r["feature"]: (r["mean"], r["std"]) for r in scaler}, **found)
