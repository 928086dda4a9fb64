"""The end-to-end run: features, split, training, comparison, scored report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.encode import Encoding, Scaling, fit_encoding_shares, moment_columns, scaling_of, weights_of
from riskweave.operators.features import features_of, median_amount, sliced_rows
from riskweave.operators.metrics import compare_models, confusion_matrix, pr_curve, ranking, roc_curve, stack_scores
from riskweave.operators.models import BOOSTED, KINDS, RiskModel, train_models
from riskweave.operators.scoring import PROBABILITY, level_distribution, scored_report, top_risk, write_report
from riskweave.operators.split import SPLIT, Cuts, chronological_cuts, split_summary, with_split
from riskweave.schema import MODEL_COMPARISON, SCORED_REPORT
from riskweave.sources.transactions import keyed_rows, rejected_rows


@dataclass(frozen=True)
class Fitted:
    """What the writing of the features has gathered: cut keys, category lists, and scaling and class weights of the training rows."""

    cuts: Cuts
    fill_value: float | None
    encoding: Encoding
    scaling: Scaling
    weights: dict[str, float | None]


def write_and_fit(txns: DataFrame, path: str, slices: int | None = None, fill_from_all: bool = False) -> tuple[DataFrame, Fitted]:
    """Build the features once and write them by split part, fitting what later stages need on the way.

    ``txns`` is read once. Its written slices give the time range, the cuts, the stand-in average and the category counts, each
    from a column or two; moments and class sizes come from the written training features. Nothing is observed by the writing
    jobs: a session that holds observations cannot go out with a task, which some models' transforms need. The stand-in
    average comes from the training part, so no later amount reaches a feature, unless it is to come from all rows.
    """
    usable = keyed_rows(txns)
    rows = sliced_rows(usable, slices)
    cuts = chronological_cuts(rows)
    in_train = cuts.column() == "train"
    fill = median_amount(rows if fill_from_all else rows.filter(in_train))
    encoding, shares = fit_encoding_shares(rows.filter(in_train))
    features = with_split(features_of(rows, usable.columns, fill, slices), cuts)
    features.write.mode("overwrite").partitionBy(SPLIT).parquet(path)
    table = txns.sparkSession.read.schema(features.schema).parquet(path)
    moments = part(table, "train").agg(*moment_columns(encoding.numeric)).first()
    fitted = Fitted(cuts, fill, encoding, scaling_of(moments, encoding.numeric, shares), weights_of(moments["positives"], moments["negatives"]))
    return table, fitted


def write_features(txns: DataFrame, path: str, slices: int | None = None) -> DataFrame:
    return write_and_fit(txns, path, slices)[0]


def part(features: DataFrame, name: str) -> DataFrame:
    return features.filter(F.col(SPLIT) == name)


def score_all(models: Mapping[str, RiskModel], rows: DataFrame) -> DataFrame:
    """(model, label, score) of every model on the same rows, which are read once for all models."""
    scored = rows
    for name, model in models.items():
        scored = model.score(scored).withColumnRenamed(PROBABILITY, name)
    return stack_scores(scored, list(models))


def compare(models: Mapping[str, RiskModel], rows: DataFrame) -> DataFrame:
    return compare_models(score_all(models, rows))


def curves(stacked: DataFrame) -> dict[str, DataFrame]:
    """What the plots of each model show, by name of its folder."""
    ranked = ranking(stacked, ["model"])
    return {
        "roc_points": roc_curve(ranked, ["model"]),
        "pr_points": pr_curve(ranked, ["model"]),
        "confusion": confusion_matrix(stacked, ["model"]),
    }


def write_comparison(comparison: DataFrame, path: str, fmt: str = "csv") -> None:
    comparison.coalesce(1).write.mode("overwrite").format(fmt).option("header", True).save(path)


def read_report(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A missing report is an error from the reader, not an empty table."""
    return spark.read.schema(SCORED_REPORT).format(fmt).option("header", True).load(path)


def read_comparison(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return spark.read.schema(MODEL_COMPARISON).format(fmt).option("header", True).load(path)


@dataclass(frozen=True)
class Run:
    features: DataFrame
    models: dict[str, RiskModel]
    comparison: DataFrame
    report: DataFrame


def run(
    txns: DataFrame,
    folder: str,
    kinds: Iterable[str] = KINDS,
    settings: Mapping[str, Mapping] | None = None,
    report_model: str = BOOSTED,
) -> Run:
    """Train and compare the models, and write everything under ``folder``: features and the sizes of their parts, rows
    set aside and their number, models, comparison, curves and confusion matrices, report, its levels and riskiest rows."""
    spark = txns.sparkSession

    def write(name: str, frame: DataFrame) -> None:
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")

    write("rejected_rows", rejected_rows(txns))
    write("rejected_count", spark.read.schema(txns.schema).parquet(f"{folder}/rejected_rows").agg(F.count("*").alias("rejected")))
    features, fitted = write_and_fit(txns, f"{folder}/features")
    write("split_summary", split_summary(features))
    models = train_models(part(features, "train"), kinds, settings, fitted.encoding, fitted.scaling, fitted.weights)
    for kind, model in models.items():
        model.save(spark, f"{folder}/models/{kind}")
    test = part(features, "test")
    write("test_scores", score_all(models, test))
    stacked = spark.read.parquet(f"{folder}/test_scores")
    write_comparison(compare_models(stacked), f"{folder}/model_comparison")
    for name, frame in curves(stacked).items():
        write(name, frame)
    write_report(scored_report(models[report_model].score(test)), f"{folder}/scored_transactions")
    report = read_report(spark, f"{folder}/scored_transactions")
    write("level_distribution", level_distribution(report))
    write("top_risk", top_risk(report))
    return Run(
        features,
        models,
        read_comparison(spark, f"{folder}/model_comparison"),
        read_report(spark, f"{folder}/scored_transactions"),
    )
