"""Table schemas and fixed values of the transaction risk domain."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and types of the tables below.
TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_time", T.TimestampNTZType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("location_lat", T.DoubleType()),
        T.StructField("location_lon", T.DoubleType()),
        T.StructField("is_fraud", T.IntegerType()),
    ]
)

SCORED_REPORT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("fraud_probability", T.DoubleType()),
        T.StructField("risk_score", T.IntegerType()),
        T.StructField("risk_level", T.StringType()),
        T.StructField("recommended_action", T.StringType()),
    ]
)

MODEL_COMPARISON = T.StructType(
    [T.StructField("model", T.StringType())]
    + [T.StructField(m, T.DoubleType()) for m in ("precision", "recall", "f1", "roc_auc", "pr_auc")]
)

REQUESTS = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("new_device", T.IntegerType()),
        T.StructField("transactions_last_1h", T.DoubleType()),
        T.StructField("transactions_last_24h", T.DoubleType()),
        T.StructField("cust_running_avg_amount", T.DoubleType()),
        T.StructField("location_change", T.DoubleType()),
    ]
)

LABEL = "is_fraud"
CATEGORICAL = ("merchant_category", "payment_type", "device")

# The numeric model inputs, in model order.
NUMERIC_FEATURES = (
    "amount",
    "log_amount",
    "hour",
    "day_of_week",
    "is_weekend",
    "is_night",
    "cust_running_avg_amount",
    "amount_vs_customer_avg",
    "transactions_last_24h",
    "transactions_last_1h",
    "new_device",
    "location_change",
)

# Level thresholds on the probability, and the action shown for each level.
MEDIUM_FROM = 0.30
HIGH_FROM = 0.70
ACTIONS = {
    "LOW": "Approve",
    "MEDIUM": "Additional verification (OTP / step-up auth)",
    "HIGH": "Flag for manual review / hold transaction",
}

# Decision threshold of the classifiers, significance level, ratio guard.
DECISION_THRESHOLD = 0.5
SIGNIFICANCE = 0.05
RATIO_EPSILON = 1e-6

# Shares of the chronological split.
TRAIN_SHARE = 0.70
VALIDATION_SHARE = 0.15
