import math

import pytest
from pyspark.sql import functions as F

from riskweave.operators import requests as rq
from riskweave.operators import scoring as s
from riskweave.operators.encode import Encoding
from riskweave.schema import NUMERIC_FEATURES, REQUESTS


def _report(spark, probabilities):
    rows = [(f"T{i}", i, 1.0, "m", "p", i % 2, p) for i, p in enumerate(probabilities)]
    schema = "transaction_id string, customer_id bigint, amount double, merchant_category string, payment_type string, is_fraud int, fraud_probability double"
    return s.scored_report(spark.createDataFrame(rows, schema))


def test_thresholds(spark):
    cases = {
        0.005: (0, "LOW"), 0.015: (2, "LOW"), 0.295: (30, "LOW"), 0.30: (30, "MEDIUM"), 0.695: (70, "MEDIUM"),
        0.70: (70, "HIGH"), 0.125: (12, "LOW"), 1.0: (100, "HIGH"),
    }
    rows = {r["fraud_probability"]: r for r in _report(spark, list(cases)).collect()}
    for p, (score, level) in cases.items():
        # half-even on the double product, as Python rounds it
        assert rows[p]["risk_score"] == round(p * 100), p
        assert rows[p]["risk_level"] == level
        assert score == rows[p]["risk_score"]
    assert rows[0.70]["recommended_action"] == "Flag for manual review / hold transaction"
    assert rows[0.30]["recommended_action"] == "Additional verification (OTP / step-up auth)"
    assert rows[0.005]["recommended_action"] == "Approve"


def test_missing_probability_has_no_level(spark):
    for row in _report(spark, [math.nan, None]).collect():
        assert (row["risk_score"], row["risk_level"], row["recommended_action"]) == (None, None, None)


def test_views(spark):
    report = _report(spark, [0.1, 0.2, 0.4, 0.9, 0.9])
    assert [r["transaction_id"] for r in s.by_risk(report).collect()] == ["T3", "T4", "T2", "T1", "T0"]
    assert [r["transaction_id"] for r in s.top_risk(report, 2).collect()] == ["T3", "T4"]
    assert s.monitor(report).count() == 3
    assert s.monitor(report, ()).count() == 5
    assert s.monitor(report, ("LOW",)).columns == list(s.MONITOR_COLUMNS)
    assert tuple(s.kpis(report).first()) == (5, 2, 40.0, 2)
    assert {r["risk_level"]: r["share"] for r in s.level_share(report).collect()} == {"LOW": 0.4, "MEDIUM": 0.2, "HIGH": 0.4}
    assert s.riskiest_row(report).first()["transaction_id"] == "T3"


def test_report_sink_is_sorted_across_files(spark, tmp_path):
    report = _report(spark, [i * 37 % 101 / 101 for i in range(400)])
    s.write_report(report, str(tmp_path / "r"), "csv")
    back = spark.read.option("header", True).schema(report.schema).csv(str(tmp_path / "r"))
    parts = back.withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id())
    rows = parts.orderBy("file", "at").collect()
    assert len(rows) == 400
    assert [r["risk_score"] for r in rows] == sorted((r["risk_score"] for r in rows), reverse=True)


def test_own_thresholds(spark):
    df = _report(spark, [0.2]).select("fraud_probability")
    assert s.with_risk(df, medium_from=0.1, high_from=0.2).first()["risk_level"] == "HIGH"


SAMPLE = {
    "request_id": "sample", "amount": 8500.0, "hour": 2, "day_of_week": 5, "merchant_category": "electronics",
    "payment_type": "credit_card", "device": "web_chrome", "new_device": 1, "transactions_last_1h": 8.0,
    "transactions_last_24h": 12.0, "cust_running_avg_amount": 1500.0,
}


def _requests(spark, *rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in REQUESTS) for r in rows], REQUESTS)


def test_each_rule(spark):
    broken = {
        "amount_required": {"amount": None},
        "amount_positive": {"amount": 0.0},
        "hour_range": {"hour": 24},
        "day_of_week_range": {"day_of_week": -1},
        "new_device_range": {"new_device": 2},
    }
    rows = [{**SAMPLE, "request_id": rule, **change} for rule, change in broken.items()]
    checked = rq.validate(_requests(spark, SAMPLE, *rows))
    assert {r["request_id"]: r["errors"] for r in rq.rejected(checked).collect()} == {k: [k] for k in broken}
    assert [r["request_id"] for r in rq.accepted(checked).collect()] == ["sample"]


def test_absent_optional_fields_are_valid_and_defaulted(spark):
    df = _requests(spark, {"request_id": "a", "amount": 20.0}, {"request_id": "b"})
    assert rq.validate(df).filter("valid").count() == 1
    rows = {r["request_id"]: r for r in rq.request_features(df).collect()}
    want = {
        "amount": 20.0, "log_amount": math.log1p(20), "hour": 12, "day_of_week": 0, "is_weekend": 0, "is_night": 0,
        "cust_running_avg_amount": 20.0, "amount_vs_customer_avg": 20 / (20 + 1e-6), "transactions_last_24h": 1.0,
        "transactions_last_1h": 0.0, "new_device": 0, "location_change": 0.0,
    }
    assert {n: rows["a"][n] for n in NUMERIC_FEATURES} == pytest.approx(want)
    assert rows["b"]["cust_running_avg_amount"] == 1.0


def test_sample_request(spark):
    encoding = Encoding(NUMERIC_FEATURES, (("merchant_category", ("electronics", "fashion")), ("payment_type", ("upi",)), ("device", ("pos_terminal", "web_chrome"))))
    row = rq.encode_requests(_requests(spark, SAMPLE), encoding).first()
    assert (row["is_weekend"], row["is_night"], row["location_change"]) == (1, 1, 0.0)
    assert row["amount_vs_customer_avg"] == pytest.approx(8500 / (1500 + 1e-6))
    assert (row["merchant_category_fashion"], row["device_web_chrome"]) == (0.0, 1.0)


def test_response_rounds_only_what_is_shown(spark):
    df = spark.createDataFrame([("a", 0.299996), ("b", 0.12345)], "request_id string, fraud_probability double")
    rows = {r["request_id"]: tuple(r)[1:4] for r in rq.respond(df).collect()}
    assert rows == {"a": (0.3, 30, "LOW"), "b": (0.1234, 12, "LOW")}


def test_ill_typed_request_fields_are_refused(spark, tmp_path):
    from riskweave.operators import requests as q

    lines = [
        '{"request_id": "a", "amount": 5, "hour": "2", "day_of_week": 3.0, "new_device": true}',
        '{"request_id": "b", "amount": 5, "hour": 2.5}',
        '{"request_id": "c", "amount": 5, "day_of_week": "monday", "transactions_last_1h": "many"}',
        '{"request_id": "d", "amount": "lots"}',
        '{"request_id": "e", "hour": 24}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "in"))
    typed = q.typed(spark.read.schema(q.AS_TEXT).json(str(tmp_path / "in")))
    found = {r["request_id"]: r for r in q.validate(typed).collect()}
    assert {k: r["errors"] for k, r in found.items()} == {
        "a": [],
        "b": ["hour_type"],
        "c": ["day_of_week_type", "transactions_last_1h_type"],
        "d": ["amount_type"],
        "e": ["amount_required", "hour_range"],
    }
    assert (found["a"]["hour"], found["a"]["day_of_week"], found["a"]["new_device"]) == (2, 3, 1)
