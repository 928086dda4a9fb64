import datetime as dt

import numpy as np
import pytest

from riskweave.operators import encode as e


def test_drop_first_and_order(make):
    df = make(
        [
            {"merchant_category": "b", "payment_type": "y", "device": "d"},
            {"merchant_category": "a", "payment_type": None, "device": "d"},
            {"merchant_category": "c", "payment_type": "x", "device": "d"},
        ]
    )
    encoding = e.fit_encoding(df)
    assert encoding.names[12:] == ["merchant_category_b", "merchant_category_c", "payment_type_y"]
    rows = {r["transaction_id"]: tuple(r)[1:] for r in e.one_hot(df, encoding).collect()}
    assert rows == {"T00000": (1, 0, 1), "T00001": (0, 0, 0), "T00002": (0, 1, 0)}


def test_unseen_and_missing_categories(make):
    encoding = e.Encoding(("amount",), (("merchant_category", ("a", "b")), ("device", ())))
    df = make([{"merchant_category": "new"}, {"merchant_category": None, "device": None}, {"merchant_category": "b", "device": None}])
    assert [tuple(r)[1:] for r in e.feature_matrix(df, encoding).orderBy("transaction_id").collect()] == [(10, 0), (10, 0), (10, 1)]
    assert [r[0] for r in df.orderBy("transaction_id").select(encoding.unseen()).collect()] == [True, False, False]


def test_too_many_categories_are_refused(make, monkeypatch):
    monkeypatch.setattr(e, "MAX_CATEGORIES", 3)
    with pytest.raises(ValueError, match="more than 3 categories"):
        e.fit_encoding(make([{"device": f"d{i}"} for i in range(9)]))


def test_standardize_uses_population_deviation(make):
    df = make([{"amount": a, "location_lat": 5.0} for a in (1.0, 2.0, 6.0)])
    scaling = e.fit_scaling(df, ["amount", "location_lat"])
    rows = e.standardize(df, scaling, ["amount", "location_lat"]).orderBy("transaction_id").collect()
    want = (np.array([1, 2, 6]) - 3) / np.std([1, 2, 6])
    assert [r["amount"] for r in rows] == pytest.approx(want.tolist())
    assert [r["location_lat"] for r in rows] == [0.0, 0.0, 0.0]


def test_class_weights(make):
    row = e.class_weights(make([{"is_fraud": int(i < 2)} for i in range(10)])).first()
    assert (row["weight_positive"], row["weight_negative"], row["scale_pos_weight"]) == (2.5, 0.625, 4.0)
    none = e.class_weights(make([{"transaction_time": dt.datetime(2025, 1, 1)}])).first()
    assert (none["weight_positive"], none["weight_negative"], none["scale_pos_weight"]) == (None, 0.5, 1.0)


def test_scaling_of_categories_that_differ_in_case_or_hold_a_backtick(make):
    df = make([{"payment_type": v} for v in ("UPI", "upi", "a`b", "upi")])
    encoding = e.fit_encoding(df, ["payment_type"], ["amount"])
    scaling = e.fit_scaling(e.feature_matrix(df, encoding), encoding.names)
    assert scaling.means == {"amount": 10.0, "payment_type_a`b": 0.25, "payment_type_upi": 0.5}
    assert len(e.standardize(e.feature_matrix(df, encoding), scaling, encoding.names).collect()) == 4


def test_sparse_vectors_equal_the_matrix(make, spark, tmp_path):
    df = make(
        [{"merchant_category": c, "payment_type": p, "device": d, "amount": float(i)} for i, (c, p, d) in enumerate(
            [("b", "y", "d"), ("a", None, "d"), ("c", "x", "d"), ("c", "y", None), ("new", "x", "e"), (None, None, None)]
        )]
    )
    seen = df.filter("coalesce(merchant_category, '') <> 'new'")
    numeric = ["amount", "location_lat"]
    encoding = e.fit_encoding(seen, numeric=numeric)
    dictionary = e.fit_dictionary(seen, numeric=numeric)
    dictionary.save(spark, str(tmp_path / "d"))
    for d in (dictionary, e.Dictionary.load(spark, str(tmp_path / "d"))):
        rows = {r["transaction_id"]: r["features"].toArray().tolist() for r in e.encode_sparse(df, d).collect()}
        assert rows == {r[0]: list(r[1:]) for r in map(tuple, e.feature_matrix(df, encoding).collect())}
    # columns without categories, or with one, have no place
    none = e.fit_dictionary(df.filter("false"), numeric=numeric)
    assert [len(r["features"]) for r in e.encode_sparse(df, none).collect()] == [2] * 6


def test_a_million_categories(spark):
    rows = spark.range(1_100_000).selectExpr("concat('T', id) as transaction_id", "cast(id as double) as amount", "concat('c', lpad(id % 1000000, 7, '0')) as device")
    dictionary = e.fit_dictionary(rows, ["device"], ["amount"])
    assert dictionary.sizes == (("device", 1_000_000),)
    found = e.encode_sparse(rows.filter("id % 100000 = 17 or id % 1000000 = 0"), dictionary)
    for r in found.collect():
        number = int(r["transaction_id"][1:]) % 1_000_000
        wanted = {0: float(r["transaction_id"][1:])} | ({number: 1.0} if number else {})
        assert r["features"].size == 1_000_000
        assert {i: v for i, v in zip(r["features"].indices.tolist(), r["features"].values.tolist(), strict=True) if v} == {i: v for i, v in wanted.items() if v}


def test_moments_gathered_while_writing(spark, tmp_path):
    from riskweave.plans import workflow
    from riskweave.sources.events import transactions_from_events

    txns = transactions_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    # several slices: sampling their boundaries must not count rows twice
    table, fitted = workflow.write_and_fit(txns.repartition(3), str(tmp_path / "f"), slices=5)
    train = workflow.part(table, "train")
    encoding = e.fit_encoding(train)
    assert fitted.encoding == encoding
    plain = e.fit_scaling(train.select(*encoding.columns()), encoding.names)
    assert fitted.scaling.means == pytest.approx(plain.means) and fitted.scaling.deviations == pytest.approx(plain.deviations)
    assert fitted.weights == pytest.approx(e.class_weights(train).first().asDict())
    assert {r["split"]: r["count"] for r in table.groupBy("split").count().collect()} == {"train": 700, "validation": 150, "test": 150}
