"""User-behaviour risk scoring on Spark DataFrames."""

from riskloom.params import RiskParams
from riskloom.schemas import ACTIVITY_SCHEMA, FEATURE_COLS

__all__ = ["ACTIVITY_SCHEMA", "FEATURE_COLS", "RiskParams"]
