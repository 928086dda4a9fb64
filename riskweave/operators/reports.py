"""Grouped rate reports and rankings over the transactions table.

Each is one partial aggregation before a shuffle of group rows, so a group holding most of the
table costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.scalar import percent
from riskweave.schema import LABEL


def total_transactions(txns: DataFrame) -> DataFrame:
    return txns.agg(F.count("*").alias("total"))


def fraud_vs_legit(txns: DataFrame) -> DataFrame:
    """Row count and share of each class; the total is a scalar subquery over the class counts."""
    per_class = txns.groupBy(LABEL).agg(F.count("*").alias("count"))
    total = per_class.agg(F.sum("count")).scalar()
    return per_class.withColumn("pct", percent(F.col("count"), total, 3))


def rate_report(
    txns: DataFrame, key: str | Column, name: str | None = None, average: bool = False, by_key: bool = False
) -> DataFrame:
    """Transactions, fraud count and fraud rate per key, highest rate first unless ``by_key``."""
    column = F.col(key) if isinstance(key, str) else key
    name = name or key
    measures = [F.count("*").alias("transactions"), F.sum(LABEL).alias("fraud_count")]
    if average:
        measures.append(F.round(F.avg("amount"), 2).alias("avg_amount"))
    grouped = txns.groupBy(column.alias(name)).agg(*measures)
    report = grouped.withColumn("fraud_rate_pct", percent(F.col("fraud_count"), F.col("transactions"), 3))
    order = [F.col(name)] if by_key else [F.col("fraud_rate_pct").desc_nulls_last(), F.col(name)]
    return report.orderBy(*order)


def fraud_by_payment_type(txns: DataFrame) -> DataFrame:
    return rate_report(txns, "payment_type")


def fraud_by_merchant_category(txns: DataFrame) -> DataFrame:
    return rate_report(txns, "merchant_category", average=True)


def fraud_by_hour(txns: DataFrame) -> DataFrame:
    return rate_report(txns, F.hour("transaction_time"), "hour", by_key=True)


def top_risky_devices(txns: DataFrame) -> DataFrame:
    return rate_report(txns, "device")


def high_value_fraud(txns: DataFrame, limit: int = 10) -> DataFrame:
    """The largest fraudulent transactions; planned as a per-task top-k, never a full sort."""
    columns = ["transaction_id", "customer_id", "amount", "merchant_category", "payment_type"]
    largest = [F.col("amount").desc_nulls_last(), F.col("transaction_id")]
    return txns.filter(F.col(LABEL) == 1).select(*columns).orderBy(*largest).limit(limit)


def velocity_customers(txns: DataFrame, more_than: int = 40) -> DataFrame:
    """Customers with unusually many transactions."""
    per_customer = txns.groupBy("customer_id").agg(
        F.count("*").alias("txn_count"), F.sum(LABEL).alias("fraud_count")
    )
    busy = per_customer.filter(F.col("txn_count") > more_than)
    return busy.orderBy(F.col("txn_count").desc(), "customer_id")


REPORTS = {
    "total_transactions": total_transactions,
    "fraud_vs_legit": fraud_vs_legit,
    "fraud_by_payment_type": fraud_by_payment_type,
    "fraud_by_merchant_category": fraud_by_merchant_category,
    "fraud_by_hour": fraud_by_hour,
    "top_risky_devices": top_risky_devices,
    "high_value_fraud": high_value_fraud,
    "velocity_customers": velocity_customers,
}


def run_reports(txns: DataFrame) -> dict[str, DataFrame]:
    """All named reports, lazily."""
    return {name: report(txns) for name, report in REPORTS.items()}
