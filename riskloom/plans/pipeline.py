"""The batch pipeline: activity log in, scored users out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskloom.models.ensemble import (
    Models,
    fit_models,
    save_models,
    score_raw,
    score_scaled,
    with_offset,
)
from riskloom.operators.features import risk_totals, user_features
from riskloom.operators.risk import ranked, with_levels, with_raw_risk
from riskloom.params import RiskParams
from riskloom.schemas import FEATURE_COLS, MODEL_SCORES
from riskloom.sources.staging import stage
from riskloom.sources.tables import write_table


def rules_only_raw(activity: DataFrame, params: RiskParams) -> DataFrame:
    """Raw risk from the rule signals alone: no model score counts as 0."""
    return with_raw_risk(risk_totals(activity), params)


def rules_only_scored(activity: DataFrame, params: RiskParams) -> DataFrame:
    """Scores and levels of :func:`rules_only_raw`.

    The raw risks are staged: the activity is read once for both the range and
    the scores.
    """
    return with_levels(stage(rules_only_raw(activity, params), "raw-risk"), params)


def score_batch(scaled: DataFrame, models: Models, params: RiskParams) -> DataFrame:
    """Scored table of the batch pipeline from scaled features."""
    scored = with_offset(score_scaled(scaled, models), models)
    raw = stage(with_raw_risk(scored, params), "raw-risk")
    return ranked(
        with_levels(raw, params).select(
            *FEATURE_COLS,
            "user_id",
            "role",
            *MODEL_SCORES,
            "risk_score_raw",
            "risk_score",
            "risk_level",
        )
    )


def run_batch(
    activity: DataFrame,
    params: RiskParams | None = None,
    model_dir: str | None = None,
    features_path: str | None = None,
    scored_path: str | None = None,
) -> DataFrame:
    """Features, model fits, scores and levels; optionally stores each product."""
    params = params or RiskParams()
    models, scaled = fit_models(user_features(activity), params)
    spark = activity.sparkSession
    if model_dir:
        save_models(spark, models, model_dir)
    if features_path:
        write_table(scaled.select(*FEATURE_COLS, "user_id", "role"), features_path)
    scored = score_batch(scaled, models, params)
    if scored_path:
        write_table(scored, scored_path)
    return scored


def score_requests(features: DataFrame, models: Models, params: RiskParams) -> DataFrame:
    """Model scores and raw risk of any feature rows: no normalisation, no level."""
    scored = with_raw_risk(score_raw(features, models, mode="stream"), params)
    return scored.select("user_id", *MODEL_SCORES, "risk_score_raw")
