"""The shape of physical plans: what is shuffled, pruned, and kept out of Python."""

import re

import pytest

import __spark_entry__ as contract
from riskweave.operators import features, reports, scoring
from riskweave.operators.split import with_split
from riskweave.schema import TRANSACTIONS

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plan") / "transactions")
    contract.queries()["scan_transactions"](spark, SMALL).write.parquet(path)
    return spark.read.schema(TRANSACTIONS).parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_shuffle_once(table):
    text = plan(features.build_features(table))
    assert re.findall(r"Exchange (\w+)\((\w+)", text) == [("hashpartitioning", "customer_id")]
    # the raw columns cross the shuffle, nothing derived from them
    assert text.count("+- Sort ") == 2


def test_reports_read_only_their_columns(table):
    text = plan(reports.fraud_by_payment_type(table))
    assert "ReadSchema: struct<payment_type:string,is_fraud:int>" in text
    assert "partial_count" in text


def test_top_k_does_not_sort_everything(table):
    text = plan(reports.high_value_fraud(table))
    assert "TakeOrderedAndProject" in text
    assert "EqualTo(is_fraud,1)" in text


def test_split_moves_no_rows(table):
    assert "Exchange" not in plan(with_split(table))


def test_split_search_pushes_its_time_filter(spark, table):
    from riskweave.operators.ordered import _between

    text = plan(table.withColumnRenamed("transaction_time", "t").filter(_between(1_700_000_000_000_000, 1_700_000_000_000_001)))
    assert "GreaterThanOrEqual(transaction_time,2023-11-14T22:13:20)" in text


def test_no_single_task_window_over_rows(spark, table):
    for df in (features.build_features(table), with_split(table), scoring.by_risk(contract.queries()["risk_scoring"](spark, SMALL))):
        assert "SinglePartition" not in plan(df)
