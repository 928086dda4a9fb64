"""Command line for ``spark-submit``: one stage per call, results written under ``--out``.

    python -m riskweave load     --transactions data.csv --out out
    python -m riskweave reports  --out out
    python -m riskweave profile  --out out
    python -m riskweave train    --out out
    python -m riskweave explain  --out out
    python -m riskweave monitor  --out out
    python -m riskweave score    --requests requests/ --out out
    python -m riskweave stream   --requests requests/ --out out

``load`` parses the text once; the stages after it read the loaded table, or what ``--transactions`` names.
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import explain, hypothesis, profile, reports, scoring
from riskweave.operators import requests as req
from riskweave.operators.metrics import metrics_long
from riskweave.operators.models import BOOSTED, KINDS, RiskModel
from riskweave.plans import workflow
from riskweave.sources import transactions as src
from riskweave.streaming.scoring import read_requests, score_requests, start_scoring_apart

PROFILE = {
    "shape": profile.shape,
    "null_counts": profile.null_counts,
    "class_balance": profile.class_balance,
    "describe_amount": profile.describe_amount,
    "amount_by_class": profile.amount_by_class,
    "boxplot_amount": profile.boxplot_amount,
    "fraud_rate_by_hour": profile.fraud_rate_by_hour,
    "fraud_rate_by_merchant": profile.fraud_rate_by_merchant,
    "crosstab_payment": profile.crosstab,
    "hypothesis_results": hypothesis.hypothesis_results,
    "correlation": hypothesis.correlation,
}


def _write(frames: dict[str, DataFrame], folder: str) -> None:
    for name, frame in frames.items():
        frame.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def _transactions(spark: SparkSession, path: str) -> DataFrame:
    return src.read_csv(spark, path) if path.endswith(".csv") else src.read_parquet(spark, path)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="riskweave", description=__doc__.splitlines()[0])
    stages = ("load", "reports", "profile", "train", "explain", "monitor", "score", "stream")
    parser.add_argument("stage", choices=stages)
    parser.add_argument("--transactions", help="CSV file with a header, or a parquet table")
    parser.add_argument("--requests", help="folder of JSON lines")
    parser.add_argument("--out", required=True, help="folder shared by all executors")
    parser.add_argument("--model", choices=KINDS, default=BOOSTED)
    parser.add_argument("--levels", nargs="*", default=list(scoring.DEFAULT_LEVELS))
    args = parser.parse_args(arguments)
    spark, out = SparkSession.builder.appName(f"riskweave {args.stage}").getOrCreate(), args.out

    if args.stage == "load" and not args.transactions:
        parser.error("--transactions is needed for this stage")
    loaded = f"{out}/transactions"
    table = args.transactions or loaded

    def transactions() -> DataFrame:
        try:
            return _transactions(spark, table)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return parser.error(f"there is no table in {table}: run load first, or name one with --transactions")

    if args.stage in ("score", "stream") and not args.requests:
        parser.error("--requests is needed for this stage")

    if args.stage == "load":
        transactions().write.mode("overwrite").parquet(loaded)
    elif args.stage == "reports":
        _write(reports.run_reports(transactions()), f"{out}/reports")
    elif args.stage == "profile":
        txns = transactions()
        _write({name: build(txns) for name, build in PROFILE.items()}, f"{out}/profile")
    elif args.stage == "train":
        workflow.run(transactions(), out, report_model=args.model)
    elif args.stage == "explain":
        model = RiskModel.load(spark, f"{out}/models/{BOOSTED}")
        test = workflow.part(spark.read.parquet(f"{out}/features"), "test")
        attributed = explain.tree_attributions(model, test)
        attributed.write.mode("overwrite").parquet(f"{out}/attributions")
        written = spark.read.parquet(f"{out}/attributions")
        names = model.encoding.names
        _write(
            {
                "importance": explain.attribution_importance(written, names),
                "riskiest": explain.explain_riskiest(model, test),
            },
            f"{out}/explain",
        )
    elif args.stage == "monitor":
        report = workflow.read_report(spark, f"{out}/scored_transactions")
        comparison = workflow.read_comparison(spark, f"{out}/model_comparison")
        _write(
            {
                "kpis": scoring.kpis(report),
                "risk_by_merchant": scoring.risk_by_merchant(report),
                "level_share": scoring.level_share(report),
                "transactions": scoring.monitor(report, args.levels),
                "metrics": metrics_long(comparison),
            },
            f"{out}/monitor",
        )
    else:
        model = RiskModel.load(spark, f"{out}/models/{args.model}")
        if args.stage == "score":
            requests = req.typed(spark.read.schema(req.AS_TEXT).json(args.requests))
            score_requests(requests, model).write.mode("overwrite").parquet(f"{out}/responses")
            rejects = spark.read.parquet(f"{out}/responses").filter(F.size("errors") > 0).select(req.REQUEST_ID, "errors")
            rejects.write.mode("overwrite").parquet(f"{out}/rejected")
        else:
            arriving = read_requests(spark, args.requests)
            start_scoring_apart(arriving, model, f"{out}/stream", f"{out}/stream_rejected", f"{out}/progress").awaitTermination()


if __name__ == "__main__":
    main()
