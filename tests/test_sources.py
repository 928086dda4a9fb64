import datetime as dt

import pytest

from riskweave.operators import features, reports
from riskweave.operators.encode import Encoding
from riskweave.plans import workflow
from riskweave.schema import TRANSACTIONS
from riskweave.session import new_path, shared_folder
from riskweave.sources import transactions as src


def test_csv_round_trip_keeps_microseconds(spark, make, tmp_path):
    df = make([{"transaction_time": dt.datetime(2025, 3, 4, 5, 6, 7, 123456)}, {"amount": None, "device": None}])
    src.write_csv(df, str(tmp_path / "t"))
    back = src.read_csv(spark, str(tmp_path / "t"))
    assert back.schema == TRANSACTIONS
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_with_space_between_date_and_time(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text(
        ",".join(TRANSACTIONS.fieldNames())
        + "\nTXN100000,10001,12.5,2025-01-02 03:04:05,grocery,upi,web_chrome,10.1234,70.5678,0\n"
        + "TXN100001,,12.5,2025-01-02 03:04:05,,,,,,1\n"
        + "TXN100002,10001,NaN,2025-01-02 03:04:06,,,,,,1\n"
    )
    df = src.read_csv(spark, str(file))
    assert df.filter("transaction_id = 'TXN100000'").first()["transaction_time"] == dt.datetime(2025, 1, 2, 3, 4, 5)
    assert [r["transaction_id"] for r in src.rejected_rows(df).collect()] == ["TXN100001"]
    assert src.keyed_rows(df).count() == 2
    assert df.filter("amount is null").first()["transaction_id"] == "TXN100002"


def test_load_table_replaces(spark, make):
    assert src.load_table(make([{}, {}]), "loaded", view=True).count() == 2
    assert src.load_table(make([{}]), "loaded", view=True).count() == 1


def test_load_catalog_table_replaces(spark, make, tmp_path):
    spark.sql(f"create database if not exists scratch location '{tmp_path}'")
    try:
        assert src.load_table(make([{}, {}]), "scratch.transactions").count() == 2
        loaded = src.load_table(make([{}, {}, {}]), "scratch.transactions")
        assert reports.total_transactions(loaded).first()["total"] == 3
    finally:
        spark.sql("drop database scratch cascade")


def test_map_columns(spark):
    foreign = spark.createDataFrame([("a", "7", "1.5", "2025-01-01 00:00:00")], "k string, c string, v string, at string")
    mapped = src.map_columns(
        foreign, {"transaction_id": "k", "customer_id": "c", "amount": "v", "transaction_time": "at"}
    )
    assert [(f.name, f.dataType) for f in mapped.schema] == [(f.name, f.dataType) for f in TRANSACTIONS]
    row = mapped.first()
    assert (row["customer_id"], row["amount"], row["device"]) == (7, 1.5, None)
    with pytest.raises(ValueError, match="missing required"):
        src.map_columns(foreign, {"transaction_id": "k"})
    with pytest.raises(ValueError, match="unknown target"):
        src.map_columns(foreign, {"transaction_id": "k", "customer_id": "c", "amount": "v", "transaction_time": "at", "x": "k"})


def test_feature_table_sink_prunes_parts(spark, make, tmp_path):
    table = workflow.write_features(make([{} for _ in range(20)]), str(tmp_path / "f"))
    assert {r["split"]: r["count"] for r in table.groupBy("split").count().collect()} == {
        "train": 14, "validation": 3, "test": 3,
    }
    plan = workflow.part(table, "test")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert set(features.build_features(make([{}])).columns) <= set(table.columns)


def test_manifest_round_trip(spark, tmp_path):
    encoding = Encoding(("amount",), (("device", ("a", "b'c", 'd"e')),))
    encoding.save(spark, str(tmp_path / "m"))
    assert Encoding.load(spark, str(tmp_path / "m")) == encoding


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == named if named else folder
    assert spark.sparkContext.getCheckpointDir() is not None
    first, second = new_path(spark, "x"), new_path(spark, "x")
    assert first != second and first.startswith(folder)


def test_nan_is_missing_in_every_reader(spark, make, tmp_path):
    from riskweave.operators.features import add_history

    make([{"amount": a} for a in (10.0, float("nan"), 30.0, 40.0)]).write.parquet(str(tmp_path / "t"))
    rows = src.read_parquet(spark, str(tmp_path / "t"))
    mapped = src.map_columns(spark.read.parquet(str(tmp_path / "t")), {c: c for c in rows.columns})
    for df in (rows, mapped):
        history = add_history(df, ["running_avg", "last_24h"]).orderBy("transaction_id").collect()
        assert [r["amount"] for r in history] == [10.0, None, 30.0, 40.0]
        assert [r["running_avg"] for r in history] == [None, 10.0, 10.0, 20.0]
        assert [r["last_24h"] for r in history] == [0.0, 1.0, 1.0, 2.0]
