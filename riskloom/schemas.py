"""Fixed schemas: the engine never infers types from data."""

from pyspark.sql import types as T

# Column names and order of the activity log.
ACTIVITY_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("login_hour", T.IntegerType()),
        T.StructField("files_accessed", T.LongType()),
        T.StructField("failed_logins", T.LongType()),
        T.StructField("sensitive_files", T.LongType()),
        T.StructField("emails_sent", T.LongType()),
        T.StructField("usb_usage", T.IntegerType()),
        T.StructField("after_hours", T.LongType()),
        T.StructField("vpn_connections", T.IntegerType()),
    ]
)

# The columns the engine uses of the raw events and of the customer dimension.
EVENT_SCHEMA = "ts timestamp_ntz, user_id long, event_type string, value double"
CUSTOMER_SCHEMA = "c_custkey long, c_acctbal double, c_mktsegment string"

# Names and order of the 18 behaviour features.
FEATURE_COLS = [
    "login_mean",
    "login_std",
    "files_mean",
    "files_max",
    "files_std",
    "failed_total",
    "sensitive_total",
    "emails_mean",
    "emails_max",
    "usb_total",
    "after_hours_mean",
    "after_hours_max",
    "vpn_total",
    "sensitive_ratio",
    "failed_login_rate",
    "usb_rate",
    "vpn_rate",
    "weekend_activity_ratio",
]

# The behaviour axes of a user profile, in display order.
PROFILE_AXES = [
    "login_mean",
    "login_std",
    "files_mean",
    "files_max",
    "sensitive_total",
    "failed_total",
    "emails_mean",
    "after_hours_mean",
    "usb_total",
    "vpn_total",
]

# Score column of each model, and the report name of each risk term.
MODEL_SCORES = ["if_score", "svm_score", "ae_score"]
FACTOR_NAMES = {
    "if_score": "Isolation Forest",
    "svm_score": "One-Class SVM",
    "ae_score": "Autoencoder",
    "sensitive_total": "Sensitive Files",
    "failed_total": "Failed Logins",
}
RISK_LEVELS = ["Critical", "High", "Medium", "Low"]


def require_features(columns: list[str], wanted: list[str] | None = None) -> None:
    """Raise an error naming the feature columns that are absent."""
    missing = [c for c in (wanted or FEATURE_COLS) if c not in columns]
    if missing:
        raise ValueError(f"missing feature column(s): {', '.join(missing)}")
