"""Profiling tables: shape, nulls, class balance, distribution of amounts, rate curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.ordered import quantiles
from riskweave.schema import LABEL

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column: one pass over all columns, then one wide row turned long."""
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], list(df.columns), "column_name", "null_count")


def class_balance(txns: DataFrame) -> DataFrame:
    """Count and fraction of each non-null class."""
    per_class = txns.filter(F.col(LABEL).isNotNull()).groupBy(LABEL).agg(F.count("*").alias("count"))
    total = per_class.agg(F.sum("count")).scalar()
    return per_class.withColumn("fraction", F.col("count").cast("double") / total)


def describe_amount(txns: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum as (statistic, value) rows.

    Here and below, ``accuracy`` asks for sketched quantiles (``ordered.quantiles``); without it they are exact.
    """
    moments = txns.agg(
        F.count("amount").cast("double").alias("count"),
        F.avg("amount").alias("mean"),
        F.stddev_samp("amount").alias("std"),
        F.min("amount").alias("min"),
        F.max("amount").alias("max"),
    )
    points = quantiles(txns, "amount", {"25%": 0.25, "50%": 0.5, "75%": 0.75}, accuracy=accuracy)
    return _long(moments).unionByName(_long(points))


def _long(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "statistic", "value")


def amount_by_class(txns: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Mean, median, sample deviation and quartiles of the amount per class."""
    labelled = txns.filter(F.col(LABEL).isNotNull())
    moments = labelled.groupBy(LABEL).agg(F.avg("amount").alias("mean"), F.stddev_samp("amount").alias("std"))
    return moments.join(quantiles(labelled, "amount", QUARTILES, [LABEL], accuracy), LABEL)


def boxplot_amount(txns: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Quartiles and whiskers per class; a whisker is the outermost value within 1.5 box heights."""
    amounts = txns.filter(F.col(LABEL).isNotNull()).select(LABEL, "amount")
    # one row per class
    fenced = amounts.join(F.broadcast(quantiles(amounts, "amount", QUARTILES, [LABEL], accuracy)), LABEL)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    amount = F.col("amount")
    return fenced.groupBy(LABEL, "q1", "median", "q3").agg(
        F.least(F.min(F.when(amount >= F.col("q1") - reach, amount)), F.col("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(amount <= F.col("q3") + reach, amount)), F.col("q3")).alias("whisker_high"),
    )


def fraud_rate_curve(txns: DataFrame, key: str | Column, name: str) -> DataFrame:
    """Unrounded fraud percentage per non-null key."""
    keyed = txns.select((F.col(key) if isinstance(key, str) else key).alias(name), LABEL)
    return keyed.filter(F.col(name).isNotNull()).groupBy(name).agg((F.avg(LABEL) * 100).alias("fraud_rate_pct"))


def fraud_rate_by_hour(txns: DataFrame) -> DataFrame:
    return fraud_rate_curve(txns, F.hour("transaction_time"), "hour").orderBy("hour")


def fraud_rate_by_merchant(txns: DataFrame) -> DataFrame:
    curve = fraud_rate_curve(txns, "merchant_category", "merchant_category")
    return curve.orderBy(F.col("fraud_rate_pct").desc(), "merchant_category")


def crosstab(txns: DataFrame, key: str = "payment_type") -> DataFrame:
    """Counts of each class per key."""
    keyed = txns.filter(F.col(key).isNotNull())
    return keyed.groupBy(key).agg(
        F.count_if(F.col(LABEL) == 0).alias("legit"), F.count_if(F.col(LABEL) == 1).alias("fraud")
    )


def global_median(txns: DataFrame, accuracy: int | None = None) -> DataFrame:
    return quantiles(txns, "amount", {"median_amount": 0.5}, accuracy=accuracy)
