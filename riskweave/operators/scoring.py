"""Probability to risk score, level and action; the scored report and its monitoring views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.scalar import percent, round_half_even
from riskweave.schema import ACTIONS, HIGH_FROM, LABEL, MEDIUM_FROM, SCORED_REPORT

PROBABILITY = "fraud_probability"
# Columns of the monitoring view.
MONITOR_COLUMNS = (
    "transaction_id",
    "customer_id",
    "amount",
    "merchant_category",
    PROBABILITY,
    "risk_score",
    "risk_level",
    "recommended_action",
)
DEFAULT_LEVELS = ("HIGH", "MEDIUM")


def risk_score(probability: Column) -> Column:
    return round_half_even(probability * 100).cast("int")


def risk_level(probability: Column, medium_from: float = MEDIUM_FROM, high_from: float = HIGH_FROM) -> Column:
    """Level of the unrounded probability; a missing probability has no level."""
    known = F.nanvl(probability, F.lit(None).cast("double"))
    return F.when(known >= high_from, "HIGH").when(known >= medium_from, "MEDIUM").when(known < medium_from, "LOW")


def recommended_action(level: Column) -> Column:
    pairs = [F.lit(text) for pair in ACTIONS.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), level)


def with_risk(df: DataFrame, medium_from: float = MEDIUM_FROM, high_from: float = HIGH_FROM) -> DataFrame:
    """Add ``risk_score``, ``risk_level`` and ``recommended_action`` to a frame with probabilities."""
    probability = F.nanvl(F.col(PROBABILITY), F.lit(None).cast("double"))
    return (
        df.withColumn("risk_score", risk_score(probability))
        .withColumn("risk_level", risk_level(probability, medium_from, high_from))
        .withColumn("recommended_action", recommended_action(F.col("risk_level")))
    )


def scored_report(scored: DataFrame) -> DataFrame:
    """The report columns of scored transactions; ordering is left to ``by_risk`` or the sink."""
    return with_risk(scored).select(*SCORED_REPORT.fieldNames())


def by_risk(report: DataFrame) -> DataFrame:
    """Highest risk first; ties fall back to the id, so hot scores still spread over sort ranges."""
    return report.orderBy(F.col("risk_score").desc_nulls_last(), "transaction_id")


def top_risk(report: DataFrame, limit: int = 10) -> DataFrame:
    return by_risk(report).limit(limit)


def riskiest_row(scored: DataFrame, score: str = PROBABILITY) -> DataFrame:
    """The row with the highest score, the first id on ties."""
    return scored.orderBy(F.col(score).desc_nulls_last(), "transaction_id").limit(1)


def write_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Sink of the scored report, globally ordered by risk across its files."""
    writer = by_risk(report).write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def level_distribution(report: DataFrame) -> DataFrame:
    return report.groupBy("risk_level").agg(F.count("*").alias("count"))


def level_share(report: DataFrame) -> DataFrame:
    per_level = level_distribution(report)
    return per_level.withColumn("share", F.col("count").cast("double") / per_level.agg(F.sum("count")).scalar())


def kpis(report: DataFrame) -> DataFrame:
    """Totals of the report in one aggregation."""
    return report.agg(
        F.count("*").alias("total_transactions"),
        F.sum(LABEL).alias("fraud_transactions"),
        percent(F.sum(LABEL), F.count(LABEL), 2).alias("fraud_rate_pct"),
        F.count_if(F.col("risk_level") == "HIGH").alias("high_risk_flagged"),
    )


def risk_by_merchant(report: DataFrame) -> DataFrame:
    return report.groupBy("merchant_category", "risk_level").agg(F.count("*").alias("count"))


def monitor(report: DataFrame, levels: Sequence[str] = DEFAULT_LEVELS) -> DataFrame:
    """Rows of the chosen levels, highest risk first; choosing no level shows all rows."""
    chosen = report.filter(F.col("risk_level").isin(*levels)) if levels else report
    return by_risk(chosen.select(*MONITOR_COLUMNS))
