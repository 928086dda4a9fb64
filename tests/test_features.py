import datetime as dt
import random

import pandas as pd
import pytest
from brute import history
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from riskweave.operators import features as fe
from riskweave.operators.ordered import slice_by
from riskweave.sources.events import transactions_from_events

DAY = dt.datetime(2025, 1, 1)


def at(**kw):
    return DAY + dt.timedelta(**kw)


def by_id(df):
    return {r["transaction_id"]: r.asDict() for r in df.collect()}


def check(df, slices):
    rows = [r.asDict() for r in df.collect()]
    expected = history(rows)
    got = by_id(fe.add_history(df, slices=slices))
    assert len(got) == len(rows) == fe.add_history(df, slices=slices).count()
    for key, want in expected.items():
        for name, value in want.items():
            if value is None:
                assert got[key][name] is None, (key, name)
            else:
                assert got[key][name] == pytest.approx(value, abs=1e-9), (key, name)


# several slices cut customers apart, one does not
@pytest.mark.parametrize("slices", [1, 3])
def test_counts_with_ties(make, slices):
    times = [at(), at(hours=10), at(hours=10), at(hours=10), at(days=1), at(days=1, hours=10), at(days=1, hours=10, seconds=1)]
    df = make([{"transaction_time": t} for t in times])
    got = by_id(fe.add_history(df, slices=slices))
    assert [got[f"T{i:05d}"]["last_24h"] for i in range(7)] == [0, 1, 1, 1, 4, 4, 2]
    check(df, slices)


@pytest.mark.parametrize("slices", [1, 4])
def test_window_edges(make, slices):
    times = [at(), at(microseconds=-1), at(hours=23), at(hours=24)]
    got = by_id(fe.add_history(make([{"transaction_time": t} for t in times]), slices=slices))
    # exactly 24 hours earlier counts, one microsecond more does not
    assert got["T00003"]["last_24h"] == 2
    assert got["T00003"]["last_1h"] == 1


@pytest.mark.parametrize("slices", [1, 4])
def test_null_values(make, slices):
    df = make(
        [
            {"amount": None, "device": None},
            {"amount": 4.0, "device": None},
            {"amount": None, "merchant_category": None},
            {"amount": 8.0, "location_lat": 13.0, "location_lon": 74.0},
            {"amount": 1.0, "customer_id": 2},
        ]
    )
    check(df, slices)


@pytest.mark.parametrize("slices", [1, 30])
def test_random_rows(make, slices):
    rng = random.Random(5)
    rows = [
        {
            # one customer holds most rows, times repeat often
            "customer_id": rng.choice([1, 1, 1, 2, 3]),
            "transaction_time": at(minutes=rng.randrange(0, 4000, 20)),
            "amount": rng.choice([None, *[round(rng.uniform(1, 90), 2) for _ in range(6)]]),
            "device": rng.choice("abcdefgh"),
            "location_lat": rng.uniform(8, 35),
            "location_lon": rng.uniform(68, 90),
        }
        for _ in range(300)
    ]
    check(make(rows), slices)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 2), st.integers(0, 50), st.sampled_from("ab"), st.integers(1, 9)),
        min_size=1,
        max_size=25,
    )
)
def test_any_rows(make, rows):
    df = make(
        [
            {"customer_id": c, "transaction_time": at(hours=h), "device": d, "amount": float(a)}
            for c, h, d, a in rows
        ]
    )
    check(df, 1)


def test_any_number_of_slices_gives_the_same_bits(spark):
    txns = transactions_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    # cents, thirds and large amounts: sums of doubles would differ with the order
    amount = F.when(F.col("amount") > 50, F.col("amount") * 1e6 / 3).otherwise(F.col("amount"))
    txns = txns.withColumn("amount", amount).select(*txns.columns).cache()
    wanted = fe.build_features(txns, slices=1).orderBy("transaction_id").toPandas()
    for slices in (7, 50):
        found = fe.build_features(txns, slices=slices).orderBy("transaction_id").toPandas()
        pd.testing.assert_frame_equal(wanted, found, check_exact=True)
    txns.unpersist()


def test_no_task_holds_a_large_customer(spark):
    # one customer has nearly all rows: its slices are of like size, and only it goes on from one to the next
    rows = spark.range(20_000).selectExpr(
        "concat('T', id) as transaction_id", "if(id % 100 = 0, id, 7L) as customer_id", "cast(id % 9 as double) as amount",
        "timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as transaction_time",
    )
    sliced = slice_by(rows, fe.CUSTOMER, fe.TIME, fe.ID, slices=10)
    sizes = [r["count"] for r in sliced.groupBy("slice_no").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 4_000
    assert [r.customer_id for r in fe.spanning_customers(sliced).collect()] == [7]


def test_later_rows_change_nothing_earlier(spark):
    txns = transactions_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    cut = "transaction_time < timestamp_ntz'2024-01-15 00:00:00'"
    whole = fe.build_features(txns, fill_value=30.0).filter(cut)
    past = fe.build_features(txns.filter(cut), fill_value=30.0)
    changed = fe.build_features(
        txns.selectExpr("* except (amount)", f"if({cut}, amount, amount * 100) as amount").select(*txns.columns),
        fill_value=30.0,
    ).filter(cut)
    assert whole.exceptAll(past).count() == past.exceptAll(whole).count() == 0
    assert whole.exceptAll(changed).count() == 0


def test_fill_value_and_ratio(make):
    df = make([{"amount": 5.0}, {"amount": 7.0}, {"amount": 30.0, "customer_id": 2}])
    got = by_id(fe.build_features(df))
    assert got["T00000"]["cust_running_avg_amount"] == got["T00002"]["cust_running_avg_amount"] == 7.0
    assert got["T00001"]["amount_vs_customer_avg"] == pytest.approx(7 / (5 + 1e-6))
    assert by_id(fe.build_features(df, fill_value=1.0))["T00000"]["cust_running_avg_amount"] == 1.0


def test_time_features(make):
    saturday, monday = dt.datetime(2025, 1, 4, 5, 59), dt.datetime(2025, 1, 6, 6, 0)
    rows = by_id(
        fe.time_features(make([{"transaction_time": t, "amount": 0.0} for t in (saturday, monday, None)]))
    )
    names = ("hour", "day_of_week", "is_weekend", "is_night", "log_amount")
    assert [rows["T00000"][n] for n in names] == [5, 5, 1, 1, 0.0]
    assert [rows["T00001"][n] for n in names] == [6, 0, 0, 0, 0.0]
    assert [rows["T00002"][n] for n in names] == [None, None, 0, 0, 0.0]


def test_session_time_zone_does_not_matter(spark, make):
    # a clock change in this zone would stretch a day if times were read as local
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = make([{"transaction_time": dt.datetime(2025, 3, 30, h)} for h in (0, 1, 2, 3, 4)])
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        check(df, 1)
        check(df, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_missing_device_is_no_new_one(make):
    df = make([{"device": d} for d in (None, None, "a", "a", None, "b")])
    for slices in (1, 4):
        rows = fe.add_history(df, ["new_device"], slices).orderBy("transaction_id").collect()
        assert [r["new_device"] for r in rows] == [0, 0, 1, 0, 0, 1]
