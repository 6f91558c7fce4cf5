"""Feed schemas. Landing files carry text; the typed schemas are what silver yields."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


AUTH_RAW = _text(
    "event_id", "account_id", "ts", "device_id", "device_is_new", "ip_geo", "geo_is_new",
    "auth_result", "failed_attempts_1h", "mfa_used", "ato_label",
)
TXN_RAW = _text(
    "txn_id", "account_id", "ts", "amount", "mcc", "merchant_country", "channel",
    "pan_token", "decision", "fraud_label",
)
ACCOUNTS_RAW = _text(
    "account_id", "open_date", "credit_limit", "segment", "home_geo", "email", "pan_token",
)
RAW = {"auth": AUTH_RAW, "txn": TXN_RAW, "accounts": ACCOUNTS_RAW}

# (raw column, silver column, silver type) per feed
CASTS = {
    "auth": [
        ("event_id", "event_id", "string"),
        ("account_id", "account_id", "string"),
        ("ts", "event_ts", "timestamp"),
        ("device_id", "device_id", "string"),
        ("device_is_new", "device_is_new", "int"),
        ("ip_geo", "ip_geo", "string"),
        ("geo_is_new", "geo_is_new", "int"),
        ("auth_result", "auth_result", "string"),
        ("failed_attempts_1h", "failed_attempts_1h", "int"),
        ("mfa_used", "mfa_used", "int"),
        ("ato_label", "ato_label", "int"),
    ],
    "txn": [
        ("txn_id", "txn_id", "string"),
        ("account_id", "account_id", "string"),
        ("ts", "txn_ts", "timestamp"),
        ("amount", "amount", "double"),
        ("mcc", "mcc", "string"),
        ("merchant_country", "merchant_country", "string"),
        ("channel", "channel", "string"),
        ("pan_token", "pan_token", "string"),
        ("decision", "decision", "string"),
        ("fraud_label", "fraud_label", "int"),
    ],
    "accounts": [
        ("account_id", "account_id", "string"),
        ("open_date", "open_date", "date"),
        ("credit_limit", "credit_limit", "double"),
        ("segment", "segment", "string"),
        ("home_geo", "home_geo", "string"),
        ("email", "email", "string"),
        ("pan_token", "pan_token", "string"),
    ],
}

GOLD_COLUMNS = [
    "txn_id", "account_id", "txn_ts", "amount", "mcc", "channel", "decision", "fraud_label",
    "minutes_since_new_device_login", "geo_mismatch_flag", "failed_logins_1h",
    "recent_ato_label", "device_is_new", "segment", "reason_codes",
]
SERVING_COLUMNS = [
    "account_id", "txn_id", "risk_score", "reason_codes", "amount", "txn_ts", "model_version",
]
FEATURES = [
    "amount", "minutes_since_new_device_login", "geo_mismatch_flag", "failed_logins_1h",
    "recent_ato_label", "device_is_new",
]

MODEL_CARD = T.StructType([
    T.StructField("model_version", T.StringType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("feature_importances", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("demo_txn_id", T.StringType()),
    T.StructField("demo_account_id", T.StringType()),
    T.StructField("demo_risk_score", T.DoubleType()),
    T.StructField("demo_feature_values", T.MapType(T.StringType(), T.DoubleType())),
])
