"""Registered queries: each reads whole tables from a folder and returns a DataFrame.

Doubles that come out of sums are rounded here, because the order of summation differs between runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.scalar import percent, round_half_even
from riskweave.operators import encode, explain, features, hypothesis, metrics, models, profile, reports
from riskweave.operators import requests as req
from riskweave.operators import scoring, trees
from riskweave.operators.ordered import quantiles, rank_errors
from riskweave.operators.split import SPLIT, split_summary, with_split
from riskweave.plans import workflow
from riskweave.schema import LABEL, NUMERIC_FEATURES
from riskweave.session import new_path
from riskweave.sources.events import requests_from_events, transactions_from_events
from riskweave.sources.transactions import load_table, map_columns, read_csv, write_csv
from riskweave.streaming import history
from riskweave.streaming.scoring import read_answers, start_scoring, start_scoring_apart

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Every customer of the test tables has more than 40 rows; this threshold selects some of them.
BUSY_CUSTOMER = 70

# A fixed linear scorer, so that attributions can be checked in SQL.
LINEAR_WEIGHTS = {
    "amount": 0.01,
    "is_night": 1.5,
    "transactions_last_24h": -0.125,
    "new_device": 1.0,
    "location_change": 0.05,
}

# Fixed boosted trees on the inputs below, so that attributions and rounds can be checked in SQL: (weight, nodes) per tree, a
# node being (prediction, cover, left, right, input, threshold) or, for a leaf, (prediction, cover).
TREE_INPUTS = ("amount", "is_night", "transactions_last_24h", "new_device")
TREES = [
    (1.0, [(0.0, 1000, 1, 2, 0, 50.0), (0.0, 700, 3, 4, 1, 0.5), (0.0, 300, 5, 6, 3, 0.5),
           (-0.75, 560), (0.25, 140), (-0.25, 225), (0.875, 75)]),
    (0.5, [(0.0, 1000, 1, 2, 2, 1.0), (0.0, 600, 3, 4, 0, 20.0), (0.0, 400, 5, 6, 0, 120.0),
           (-0.5, 240), (0.125, 360), (0.25, 300), (1.0, 100)]),
    (0.25, [(0.0, 1000, 1, 2, 0, 80.0), (-0.375, 800), (0.0, 200, 3, 4, 0, 200.0),
            (0.0, 150, 5, 6, 1, 0.5), (0.75, 50), (0.125, 120), (0.625, 30)]),
]


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(events(spark, sf_dir))


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def card_points():
    cents = F.round(F.col("amount") * 100).cast("long")
    return (cents - cents % 4) / 4


def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions with a fixed score built from integers: amount, night hours and device novelty."""
    history = features.add_history(transactions(spark, sf_dir), ["new_device"])
    night = F.hour("transaction_time").between(0, 5).cast("int")
    points = card_points() + 1500 * night + 1000 * F.col("new_device")
    return history.withColumn("score", F.least(F.lit(10000), points) / F.lit(10000.0))


def card_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored_report(scorecard(spark, sf_dir).withColumnRenamed("score", "fraud_probability"))


# --- reports -------------------------------------------------------------------------------------


@register
def scan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir)


@register
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions written as CSV text and parsed again."""
    path = new_path(spark, "csv")
    write_csv(transactions(spark, sf_dir), path)
    return read_csv(spark, path)


@register
def load_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.total_transactions(load_table(transactions(spark, sf_dir), view=True)).select(
        F.col("total").alias("rows_loaded")
    )


@register
def load_table_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table after a part of the transactions, and then all of them, were loaded into it."""
    txns, path = transactions(spark, sf_dir), new_path(spark, "stored")
    name = f"stored_{path.rpartition('-')[2]}"
    load_table(txns.filter("amount < 20"), name, path=path)
    return load_table(txns, name, path=path)


@register
def map_foreign_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return map_columns(
        orders,
        {
            "transaction_id": "concat('ORD', o_orderkey)",
            "customer_id": "o_custkey",
            "amount": "o_totalprice",
            "transaction_time": "o_orderdate",
            "payment_type": "lower(o_orderpriority)",
            "is_fraud": "case when o_orderstatus = 'F' then 1 else 0 end",
        },
    )


def _report(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(transactions(spark, sf_dir))


for _name, _build in reports.REPORTS.items():
    if _name != "velocity_customers":
        _report(_name, _build)
_report("velocity_customers", lambda t: reports.velocity_customers(t, BUSY_CUSTOMER))

# --- profile and tests ---------------------------------------------------------------------------

_report("profile_shape", profile.shape)
_report("profile_nulls", profile.null_counts)
_report("class_balance", profile.class_balance)
_report("describe_amount", lambda t: rounded(profile.describe_amount(t), 8, "value"))
_report("amount_by_class", lambda t: rounded(profile.amount_by_class(t), 8, "mean", "median", "std", "q1", "q3"))
_report(
    "boxplot_amount",
    lambda t: rounded(profile.boxplot_amount(t), 8, "median", "q1", "q3", "whisker_low", "whisker_high"),
)
_report("fraud_rate_hour_curve", lambda t: rounded(profile.fraud_rate_by_hour(t), 9, "fraud_rate_pct"))
_report("fraud_rate_merchant", lambda t: rounded(profile.fraud_rate_by_merchant(t), 9, "fraud_rate_pct"))
_report("crosstab_payment", profile.crosstab)
_report("global_median", profile.global_median)
_report("mannwhitney", lambda t: rounded(hypothesis.mann_whitney(t), 9, "z"))
_report("chi_square", lambda t: rounded(hypothesis.chi_square(t), 9, "chi2"))
_report(
    "chi_square_p",
    lambda t: rounded(
        hypothesis.hypothesis_results(t).filter("test = 'chi_square_payment_type'").select("p_value", "reject"), 9, "p_value"
    ),
)
_report("corr_hour_fraud", lambda t: rounded(hypothesis.correlation(t), 9, "corr"))
_report(
    "hypothesis_results",
    lambda t: rounded(rounded(hypothesis.hypothesis_results(t), 6, "statistic"), 7, "p_value"),
)

# One row in a thousand: the rank of a sketched quartile may be off by that share of its class, and a row.
SKETCH_ACCURACY = 1000


@register
def sketched_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles per class out of mergeable sketches, held against exact ranks."""
    txns = transactions(spark, sf_dir)
    found = quantiles(txns, "amount", profile.QUARTILES, [LABEL], SKETCH_ACCURACY)
    errors = rank_errors(txns, "amount", found, profile.QUARTILES, [LABEL])
    within = (F.col("rank_error") <= 1 / F.lit(SKETCH_ACCURACY) + 1 / F.col("rows")).alias("within")
    return errors.select(LABEL, "quantile", "rows", within)

# --- features ------------------------------------------------------------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build_features(transactions(spark, sf_dir))


def _feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features written once, for queries that first fit something on them and then apply it."""
    path = new_path(spark, "features")
    built = _features(spark, sf_dir)
    built.write.parquet(path)
    return spark.read.schema(built.schema).parquet(path)


@register
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = features.time_features(transactions(spark, sf_dir))
    names = ("hour", "day_of_week", "is_weekend", "is_night", "log_amount")
    return rounded(timed.select("transaction_id", *names), 6, "log_amount")


@register
def rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-up, half-even and percentage rounding, on eighths so that ties really occur."""
    cents = F.round(F.col("amount") * 100).cast("long")
    eighth = cents.cast("double") / F.lit(8.0)
    return transactions(spark, sf_dir).select(
        "transaction_id",
        F.round(eighth, 2).alias("half_up"),
        round_half_even(eighth, 2).alias("half_even"),
        percent(cents % 97, F.lit(128), 3).alias("pct"),
    )


@register
def feat_running_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns = transactions(spark, sf_dir)
    filled = features.with_ratio(features.add_history(txns, ["running_avg"]), features.median_amount(txns))
    return rounded(filled.select("transaction_id", "cust_running_avg_amount"), 8, "cust_running_avg_amount")


@register
def feat_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = features.add_history(transactions(spark, sf_dir), ["last_24h", "last_1h"])
    return counted.select(
        "transaction_id",
        F.col("last_24h").alias("transactions_last_24h"),
        F.col("last_1h").alias("transactions_last_1h"),
    )


@register
def feat_new_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_history(transactions(spark, sf_dir), ["new_device"]).select("transaction_id", "new_device")


@register
def feat_location_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = features.add_history(transactions(spark, sf_dir), ["location_change"])
    return rounded(moved.select("transaction_id", "location_change"), 6, "location_change")


@register
def feat_amount_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns = transactions(spark, sf_dir)
    filled = features.with_ratio(features.add_history(txns, ["running_avg"]), features.median_amount(txns))
    return rounded(filled.select("transaction_id", "amount_vs_customer_avg"), 6, "amount_vs_customer_avg")


@register
def build_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = rounded(_features(spark, sf_dir), 8, "cust_running_avg_amount")
    return rounded(built, 6, "log_amount", "amount_vs_customer_avg", "location_change")


@register
def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history features of the transactions arriving as a stream, stopped half way and started again."""
    txns = transactions(spark, sf_dir)
    own = history.history_session(spark)
    inbox, output, progress = (new_path(spark, name) for name in ("arriving", "history", "progress"))
    day = F.dayofmonth("transaction_time")
    for arrives in (txns.filter(day <= 15), txns.filter(day > 15).unionByName(history.closing_row(spark))):
        arrives.write.mode("append").parquet(inbox)
        history.start_history(history.read_transactions(own, inbox), output, progress, available_now=True).awaitTermination()
    answered = spark.read.parquet(output).withColumnsRenamed({c: f"transactions_{c}" for c in features.LOOKBACK})
    return rounded(rounded(answered.drop("customer_id", "transaction_time"), 8, "running_avg"), 6, "location_change")


# --- split and encoding --------------------------------------------------------------------------


@register
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split(transactions(spark, sf_dir)).select("transaction_id", SPLIT)


_report("split_summary", lambda t: rounded(split_summary(with_split(t)), 9, "fraud_rate"))


def _train(rows: DataFrame) -> DataFrame:
    return with_split(rows).filter(F.col(SPLIT) == "train").drop(SPLIT)


@register
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns = transactions(spark, sf_dir)
    return encode.one_hot(txns, encode.fit_encoding(_train(txns)))


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, workflow.Fitted]:
    return workflow.write_and_fit(transactions(spark, sf_dir), new_path(spark, "features"), fill_from_all=True)


@register
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, fitted = _fitted(spark, sf_dir)
    matrix = encode.feature_matrix(table, fitted.encoding)
    matrix = rounded(matrix, 8, "cust_running_avg_amount")
    return rounded(matrix, 6, "log_amount", "amount_vs_customer_avg", "location_change")


@register
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, on the scale of the training rows."""
    table, fitted = _fitted(spark, sf_dir)
    scaled = encode.standardize(table, fitted.scaling, NUMERIC_FEATURES)
    return rounded(scaled, 6, *NUMERIC_FEATURES)


@register
def fitted_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation of every model input, gathered from the written features."""
    _, fitted = _fitted(spark, sf_dir)
    rows = [(n, fitted.scaling.means[n], fitted.scaling.deviations[n]) for n in fitted.encoding.names]
    return rounded(spark.createDataFrame(rows, "feature string, mean double, deviation double"), 6, "mean", "deviation")


@register
def sparse_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inputs as sparse vectors by a category table: which indicators are set, and the amount, read off the vectors."""
    txns = transactions(spark, sf_dir)
    numeric = ("amount", "location_lat")
    encoded = encode.encode_sparse(txns, encode.fit_dictionary(_train(txns), numeric=numeric))
    values = vector_to_array("features")
    marked = F.transform(values, lambda x, i: F.when((i >= len(numeric)) & (x == 1.0), i))
    places = F.array_join(F.array_compact(marked), ",").alias("places")
    return encoded.select("transaction_id", F.size(values).alias("inputs"), values[0].alias("amount"), places)



_report("class_weights", lambda t: encode.class_weights(_train(t)))

# --- metrics -------------------------------------------------------------------------------------


def _on_card(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(scorecard(spark, sf_dir).select("transaction_id", LABEL, "score"))


_on_card("confusion_matrix", metrics.confusion_matrix)
_on_card("precision_recall_f1", metrics.precision_recall_f1)
_on_card("roc_auc", lambda s: rounded(metrics.roc_auc(s), 9, "roc_auc"))
_on_card("average_precision", lambda s: rounded(metrics.average_precision(s), 9, "pr_auc"))
_on_card("roc_curve", lambda s: metrics.roc_curve(metrics.ranking(s)))
_on_card("pr_curve", lambda s: metrics.pr_curve(metrics.ranking(s)))


def _two_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = scorecard(spark, sf_dir).withColumnRenamed("score", "scorecard")
    both = card.withColumn("amount_only", F.least(F.lit(10000), card_points()) / F.lit(10000.0))
    return metrics.compare_models(metrics.stack_scores(both, ["scorecard", "amount_only"]))


@register
def metrics_two_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_two_scores(spark, sf_dir), 9, *metrics.METRICS)


@register
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.metrics_long(_two_scores(spark, sf_dir)), 9, "value")


# --- scoring and views ---------------------------------------------------------------------------


def _on_report(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(card_report(spark, sf_dir))


@register
def risk_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card_report(spark, sf_dir).select(
        "transaction_id", "fraud_probability", "risk_score", "risk_level", "recommended_action"
    )


@register
def scored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report over the chronological test part, highest risk first."""
    scored = scorecard(spark, sf_dir).withColumnRenamed("score", "fraud_probability")
    cuts = workflow.chronological_cuts(transactions(spark, sf_dir))
    return scoring.by_risk(scoring.scored_report(with_split(scored, cuts).filter(F.col(SPLIT) == "test")))


_on_report("risk_level_distribution", scoring.level_distribution)
_on_report("top_risk", scoring.top_risk)
_on_card("argmax_row", lambda s: scoring.riskiest_row(s, "score"))
_on_report("dashboard_kpis", scoring.kpis)
_on_report("risk_by_merchant", scoring.risk_by_merchant)
_on_report("risk_level_share", scoring.level_share)
_on_report("monitor_default", scoring.monitor)
_on_report("monitor_all", lambda r: scoring.monitor(r, ()))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_events(events(spark, sf_dir))


@register
def request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = req.validate(_requests(spark, sf_dir))
    return checked.select("request_id", "valid", F.array_join("errors", ",").alias("errors"))


@register
def request_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [*req.DEFAULTS, "cust_running_avg_amount"]
    return req.with_defaults(_requests(spark, sf_dir)).select("request_id", *names)


@register
def request_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = req.accepted(req.validate(_requests(spark, sf_dir)))
    built = req.request_features(valid).select("request_id", *NUMERIC_FEATURES)
    return rounded(built, 6, "log_amount", "amount_vs_customer_avg")


@register
def request_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoding = encode.fit_encoding(transactions(spark, sf_dir))
    encoded = req.encode_requests(req.accepted(req.validate(_requests(spark, sf_dir))), encoding)
    return rounded(encoded, 6, "log_amount", "amount_vs_customer_avg")


@register
def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = req.request_features(req.accepted(req.validate(_requests(spark, sf_dir))))
    points = card_points() + 1500 * F.col("is_night") + 1000 * F.col("new_device")
    return req.respond(built.withColumn("fraud_probability", F.least(F.lit(10000), points) / F.lit(10000.0)))


class Scorecard:
    """The fixed scorecard where a trained model would stand."""

    def score(self, df: DataFrame) -> DataFrame:
        points = card_points() + 1500 * F.col("is_night") + 1000 * F.col("new_device")
        return df.withColumn("fraud_probability", F.least(F.lit(10000), points) / F.lit(10000.0))


@register
def score_stream_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request table as a stream through the scorecard: the responses of valid requests that the sink received."""
    return _streamed(spark, sf_dir, Scorecard()).filter(F.size("errors") == 0).drop("errors")


def _apart(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Responses and rejects of the request table as a stream through the scorecard."""
    arriving = spark.readStream.schema(events(spark, sf_dir).schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    folders = [new_path(spark, name) for name in ("responses", "rejects", "progress")]
    start_scoring_apart(requests_from_events(arriving), Scorecard(), *folders, available_now=True).awaitTermination()
    return read_answers(spark, folders[0]), read_answers(spark, folders[1])


@register
def stream_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _apart(spark, sf_dir)[0]


@register
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _apart(spark, sf_dir)[1].withColumn("errors", F.array_join("errors", ","))


@register
def report_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard's report as CSV text, read again."""
    path = new_path(spark, "report-csv")
    scoring.write_report(card_report(spark, sf_dir), path, "csv")
    return workflow.read_report(spark, path, "csv")


@register
def report_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard's report through its sink and its reader."""
    path = new_path(spark, "report")
    scoring.write_report(card_report(spark, sf_dir), path)
    return workflow.read_report(spark, path)


@register
def comparison_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison of two scores through its sink and its reader."""
    path = new_path(spark, "comparison")
    workflow.write_comparison(_two_scores(spark, sf_dir), path)
    return rounded(workflow.read_comparison(spark, path), 9, *metrics.METRICS)


# --- linear attributions -------------------------------------------------------------------------


def _linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = _feature_table(spark, sf_dir)
    means = encode.fit_scaling(built, list(LINEAR_WEIGHTS)).means
    margin = sum(F.lit(w) * F.col(n).cast("double") for n, w in LINEAR_WEIGHTS.items())
    attributed = explain.linear_attributions(
        built.withColumn("margin", margin), LINEAR_WEIGHTS, means, ("transaction_id", "margin")
    )
    return attributed


@register
def linear_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_linear(spark, sf_dir).drop("margin"), 8, *LINEAR_WEIGHTS)


@register
def linear_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    importance = explain.linear_importance(_linear(spark, sf_dir), list(LINEAR_WEIGHTS))
    return rounded(importance, 12, "mean_abs_attribution")


@register
def linear_explain_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = explain.linear_explain_top(_linear(spark, sf_dir), list(LINEAR_WEIGHTS), "margin")
    return rounded(top, 8, "attribution")


# --- models --------------------------------------------------------------------------------------

_TRAINED: dict[tuple, tuple[dict[str, models.RiskModel], DataFrame]] = {}


def trained(
    spark: SparkSession, sf_dir: str, kinds: Iterable[str] = models.KINDS
) -> tuple[dict[str, models.RiskModel], DataFrame]:
    """Full-size models and feature table of one session and folder: each is trained once, by the first query that needs it.

    A folder whose files have changed since is another one.
    """
    files = events(spark, sf_dir).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    version = files.agg(F.bit_xor(F.xxhash64(*files.columns)), F.count("*")).first()
    key = (spark.sparkContext.applicationId, sf_dir, tuple(version))
    if key not in _TRAINED:
        _TRAINED[key] = ({}, workflow.write_features(transactions(spark, sf_dir), new_path(spark, "features")))
    fitted, table = _TRAINED[key]
    if missing := [k for k in kinds if k not in fitted]:
        fitted |= models.train_models(workflow.part(table, "train"), missing)
    return {k: fitted[k] for k in kinds}, table


def _scores(name: str, kind: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fitted, table = trained(spark, sf_dir, [kind])
        scored = fitted[kind].score(workflow.part(table, "test"))
        return scored.select("transaction_id", LABEL, "fraud_probability")

    QUERIES[name] = query


_scores("logreg_scores", models.LOGISTIC)
_scores("rf_scores", models.FOREST)
_scores("gbt_scores", models.BOOSTED)


@register
def logreg_small_design(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression on two flags: a design with so few distinct rows that SQL can solve it too."""
    parts = with_split(_feature_table(spark, sf_dir))
    train, test = (parts.filter(F.col(SPLIT) == name) for name in ("train", "test"))
    encoding = encode.Encoding(("is_night", "new_device"), ())
    model = models.train_models(train, [models.LOGISTIC], {models.LOGISTIC: {"tol": 1e-12}}, encoding)[models.LOGISTIC]
    return rounded(model.score(test).select("transaction_id", LABEL, "fraud_probability"), 6, "fraud_probability")


@register
def validation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, table = trained(spark, sf_dir)
    return workflow.compare(fitted, workflow.part(table, "validation"))


@register
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, table = trained(spark, sf_dir)
    return workflow.compare(fitted, workflow.part(table, "test"))


def _attributed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    fitted, table = trained(spark, sf_dir, [models.BOOSTED])
    model = fitted[models.BOOSTED]
    return explain.tree_attributions(model, workflow.part(table, "test")), model.encoding.names


@register
def tree_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributed, names = _attributed(spark, sf_dir)
    parts = [F.col(explain.ATTRIBUTIONS)[i].alias(n) for i, n in enumerate(names)]
    return attributed.select("transaction_id", "base_value", *parts)


@register
def attribution_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.attribution_importance(*_attributed(spark, sf_dir))


@register
def attribution_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.attribution_long(*_attributed(spark, sf_dir))


@register
def explain_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, table = trained(spark, sf_dir, [models.BOOSTED])
    return explain.explain_riskiest(fitted[models.BOOSTED], workflow.part(table, "test"))


@register
def round_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boosted model's ranking metrics on the validation rows after each of its rounds."""
    fitted, table = trained(spark, sf_dir, [models.BOOSTED])
    model = fitted[models.BOOSTED]
    rows = trees.model_inputs(model, workflow.part(table, "validation"), [LABEL])
    return trees.round_metrics(rows, trees.Forest.of_model(model, spark))


def _fixed_trees(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, trees.Forest]:
    """Inputs of all transactions for the fixed trees, and the trees read back from their folder."""
    nodes = [
        (t, i, float(n[0]), float(n[1]), *(n[2:5] if len(n) > 2 else (-1, -1, -1)), n[5] if len(n) > 2 else 0.0)
        for t, (_, tree) in enumerate(TREES)
        for i, n in enumerate(tree)
    ]
    path = new_path(spark, "fixed-trees")
    columns = [field.split()[0] for field in trees.NODES.split(", ")]
    trees.Forest(pd.DataFrame(nodes, columns=columns), tuple(w for w, _ in TREES), TREE_INPUTS).write(spark, path)
    inputs = F.array(*[F.col(c).cast("double") for c in TREE_INPUTS]).alias(trees.INPUTS)
    part = F.when(F.dayofmonth("transaction_time") <= 20, "early").otherwise("late").alias("part")
    return _features(spark, sf_dir).select("transaction_id", LABEL, part, inputs), trees.Forest.read(spark, path)


@register
def fixed_round_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the fixed trees after each round, of two groups of rows."""
    rows, forest = _fixed_trees(spark, sf_dir)
    return rounded(trees.round_metrics(rows, forest, ["part"]), 9, *metrics.METRICS)


def _fixed_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, forest = _fixed_trees(spark, sf_dir)
    return explain.forest_probability(explain.forest_attributions(rows, forest))


@register
def fixed_tree_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _fixed_attributions(spark, sf_dir)
    parts = [F.round(F.col(explain.ATTRIBUTIONS)[i], 9).alias(n) for i, n in enumerate(TREE_INPUTS)]
    return found.select("transaction_id", F.round("base_value", 9).alias("base_value"), *parts)


@register
def fixed_attribution_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.attribution_importance(_fixed_attributions(spark, sf_dir), TREE_INPUTS), 9, "mean_abs_attribution")


@register
def fixed_attribution_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.attribution_long(_fixed_attributions(spark, sf_dir), TREE_INPUTS), 9, "attribution")


@register
def fixed_explain_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The riskiest transaction under the fixed trees, explained."""
    found = rounded(_fixed_attributions(spark, sf_dir), 9, "fraud_probability")
    top = scoring.riskiest_row(found)
    keep = ("transaction_id", LABEL, "fraud_probability")
    parts = rounded(explain.attribution_long(top, TREE_INPUTS, keep), 9, "attribution")
    return explain.top_features(parts)


def _streamed(spark: SparkSession, sf_dir: str, model) -> DataFrame:
    schema = events(spark, sf_dir).schema
    arriving = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    output = new_path(spark, "responses")
    tasks = spark.sparkContext.defaultParallelism
    start_scoring(requests_from_events(arriving), model, output, new_path(spark, "progress"), True, tasks=tasks).awaitTermination()
    return spark.read.parquet(output)


@register
def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request table as a stream, scored until its end; returns what the sink received."""
    fitted, _ = trained(spark, sf_dir, [models.BOOSTED])
    return _streamed(spark, sf_dir, fitted[models.BOOSTED]).withColumn("errors", F.array_join("errors", ","))
