"""Hypothesis tests: the sums run as Spark aggregations, only the final few numbers reach the driver."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.scalar import ratio
from riskweave.functions.tails import chi_square_tail, exact_rank_sum, two_sided_normal
from riskweave.operators.ordered import running_totals
from riskweave.operators.profile import crosstab
from riskweave.schema import LABEL, SIGNIFICANCE


def mann_whitney(txns: DataFrame, value: str = "amount") -> DataFrame:
    """U of the positive class, the tie term, and z with tie and continuity correction.

    Equal values are collapsed to one row first, so the order only covers distinct values.
    """
    labelled = txns.filter(F.col(LABEL).isNotNull() & F.col(value).isNotNull())
    per_value = labelled.groupBy(value).agg(F.sum(LABEL).alias("pos"), F.sum(1 - F.col(LABEL)).alias("neg"))
    placed = running_totals(per_value, value, ["pos", "neg"])
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tied = pos + neg
    sums = placed.agg(
        F.max("total_pos").alias("n_fraud"),
        F.max("total_neg").alias("n_legit"),
        F.sum(pos * (F.col("before_neg").cast("double") + neg / 2)).alias("u_statistic"),
        F.sum(tied * tied * tied - tied).alias("tie_term"),
    )
    n1, n2 = F.col("n_fraud").cast("double"), F.col("n_legit").cast("double")
    n, u = n1 + n2, F.col("u_statistic")
    spread = F.sqrt(n1 * n2 / 12 * (n + 1 - ratio(F.col("tie_term"), n * (n - 1))))
    larger = F.greatest(u, n1 * n2 - u)
    return sums.withColumn("z", ratio(larger - n1 * n2 / 2 - 0.5, spread))


def chi_square(txns: DataFrame, key: str = "payment_type") -> DataFrame:
    """Independence of ``key`` and the label, with the 2x2 continuity correction where it applies."""
    table = crosstab(txns, key)
    cells = table.select((F.col("legit") + F.col("fraud")).alias("size"), "fraud").filter("size > 0")
    size, fraud = F.sum("size"), F.sum("fraud")
    classes = F.when((fraud > 0) & (fraud < size), 2).otherwise(1)
    totals = cells.agg(
        F.struct(
            ratio(fraud, size).alias("share"), ((F.count("*") - 1) * (classes - 1)).cast("int").alias("dof")
        )
    )
    # the cells are one row per category; their totals are one scalar subquery next to them
    parts = cells.withColumn("totals", totals.scalar()).select("size", "fraud", "totals.*")
    dof = F.col("dof")
    gap = F.abs(F.col("fraud") - F.col("size") * F.col("share"))
    gap = F.when(dof == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
    part = F.coalesce(
        ratio(gap * gap, F.col("size") * F.col("share") * (1 - F.col("share"))), F.lit(0.0)
    )
    return parts.agg(F.sum(part).alias("chi2"), F.max(dof).alias("dof"))


def correlation(txns: DataFrame) -> DataFrame:
    """Pearson correlation of the hour of day with the label."""
    return txns.agg(F.corr(F.hour("transaction_time").cast("double"), F.col(LABEL).cast("double")).alias("corr"))


def mann_whitney_p(row) -> float | None:
    """p-value of a ``mann_whitney`` row: exact for a small sample without ties, else the normal tail."""
    n1, n2 = row["n_fraud"], row["n_legit"]
    if not n1 or not n2:
        return None
    if min(n1, n2) <= 8 and row["tie_term"] == 0:
        return exact_rank_sum(row["u_statistic"], n1, n2)
    return None if row["z"] is None or math.isnan(row["z"]) else two_sided_normal(row["z"])


def hypothesis_results(txns: DataFrame) -> DataFrame:
    """Statistic, p-value and decision of each test, one row per test."""
    spark = txns.sparkSession
    ranks, table = mann_whitney(txns).first(), chi_square(txns).first()
    chi_p = None if table["chi2"] is None else chi_square_tail(table["chi2"], table["dof"])
    results = [
        ("mann_whitney_amount", ranks["u_statistic"], mann_whitney_p(ranks)),
        ("chi_square_payment_type", table["chi2"], chi_p),
    ]
    frame = spark.createDataFrame(results, "test string, statistic double, p_value double")
    return frame.withColumn("reject", F.col("p_value") < SIGNIFICANCE)
