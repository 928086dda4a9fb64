"""Exact classification metrics on (label, score) frames.

Rows with equal scores are summed first; running totals over the descending distinct scores then
give every curve point. ``by`` evaluates several models in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.scalar import ratio, ratio_or_zero
from riskweave.operators.ordered import running_totals
from riskweave.schema import DECISION_THRESHOLD, LABEL

SCORE = "score"
METRICS = ("precision", "recall", "f1", "roc_auc", "pr_auc")


def confusion_matrix(
    scored: DataFrame, by: Sequence[str] = (), threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    actual, flagged = F.col(LABEL) == 1, F.col(SCORE) >= threshold
    return scored.groupBy(*by).agg(
        F.count_if(~actual & ~flagged).alias("true_negative"),
        F.count_if(~actual & flagged).alias("false_positive"),
        F.count_if(actual & ~flagged).alias("false_negative"),
        F.count_if(actual & flagged).alias("true_positive"),
    )


def precision_recall_f1(
    scored: DataFrame, by: Sequence[str] = (), threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    return _rates(confusion_matrix(scored, by, threshold), by)


def _rates(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Zero wherever the denominator is zero."""
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    return counts.select(
        *by,
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def ranking(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: class counts at it, above it (``before_``) and overall (``total_``).

    The per-score counts are written once, so every metric below reuses one pass over the scored rows.
    """
    per_score = (
        scored.filter(F.col(LABEL).isNotNull() & F.col(SCORE).isNotNull())
        .groupBy(*by, SCORE)
        .agg(F.sum(LABEL).alias("pos"), F.sum(1 - F.col(LABEL)).alias("neg"))
    )
    return ranked_counts(per_score, by)


def ranked_counts(per_score: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``ranking`` of rows that are counted already: one row (by, score, pos, neg) per distinct score."""
    return running_totals(per_score, SCORE, ["pos", "neg"], by, descending=True)


def areas(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC area by ranks with half credit for ties, and average precision as a step sum."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    above, hits = F.col("before_pos").cast("double"), (F.col("before_pos") + F.col("pos")).cast("double")
    flagged = hits + F.col("before_neg") + F.col("neg")
    won = F.sum(neg * (above * 2 + pos)).alias("won")
    stepped = F.sum(pos * hits / flagged).alias("stepped")
    sums = ranked.groupBy(*by).agg(
        won, stepped, F.max("total_pos").cast("double").alias("p"), F.max("total_neg").cast("double").alias("n")
    )
    return sums.select(
        *by,
        ratio(F.col("won"), F.col("p") * F.col("n") * 2).alias("roc_auc"),
        ratio_or_zero(F.col("stepped"), F.col("p")).alias("pr_auc"),
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    return areas(ranking(scored)).select("roc_auc")


def average_precision(scored: DataFrame) -> DataFrame:
    return areas(ranking(scored)).select("pr_auc")


def roc_curve(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(fpr, tpr, threshold) for every distinct score, with the origin at a null threshold."""
    points = ranked.select(
        *by,
        ratio(F.col("before_neg") + F.col("neg"), F.col("total_neg")).alias("fpr"),
        ratio(F.col("before_pos") + F.col("pos"), F.col("total_pos")).alias("tpr"),
        F.col(SCORE).alias("threshold"),
    )
    return points.unionByName(_end(ranked, by, fpr=0.0, tpr=0.0))


def pr_curve(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(precision, recall, threshold) for every distinct score, ending at (1, 0) with a null threshold."""
    hits = F.col("before_pos") + F.col("pos")
    points = ranked.select(
        *by,
        ratio(hits, hits + F.col("before_neg") + F.col("neg")).alias("precision"),
        ratio(hits, F.col("total_pos")).alias("recall"),
        F.col(SCORE).alias("threshold"),
    )
    return points.unionByName(_end(ranked, by, precision=1.0, recall=0.0))


def _end(ranked: DataFrame, by: Sequence[str], **values: float) -> DataFrame:
    groups = ranked.select(*by).distinct() if by else ranked.sparkSession.range(1).select()
    return groups.select(
        *by, *[F.lit(v).alias(k) for k, v in values.items()], F.lit(None).cast("double").alias("threshold")
    )


def compare_models(scored: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """One row per ``model`` with precision, recall, F1, ROC area and average precision.

    Everything is read off the per-score counts, so the models score their rows once.
    """
    by = ["model"]
    ranked = ranking(scored, by)
    return rates_at(ranked, by, threshold).join(areas(ranked, by), by).select("model", *METRICS)


def rates_at(ranked: DataFrame, by: Sequence[str], threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Precision, recall and F1 per group, off the counts per distinct score."""
    flagged = F.col(SCORE) >= threshold
    counts = ranked.groupBy(*by).agg(
        F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("true_positive"),
        F.sum(F.when(flagged, F.col("neg")).otherwise(0)).alias("false_positive"),
        F.sum(F.when(~flagged, F.col("pos")).otherwise(0)).alias("false_negative"),
    )
    return _rates(counts, by)


def stack_scores(scored: DataFrame, models: Sequence[str]) -> DataFrame:
    """Turn one score column per model into rows of (model, label, score)."""
    return scored.select(LABEL, *models).unpivot([LABEL], list(models), "model", SCORE)


def metrics_long(comparison: DataFrame) -> DataFrame:
    return comparison.unpivot(["model"], list(METRICS), "metric", "value")
