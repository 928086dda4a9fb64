import datetime as dt
import random

import numpy as np
import pytest

from riskweave.operators import ordered as o
from riskweave.operators.split import Cuts, chronological_cuts, split_summary, with_split


def test_running_totals_match_a_plain_sum(spark):
    rng = random.Random(1)
    rows = [(g, v, rng.randrange(5), 1) for g in ("a", "b") for v in rng.sample(range(1000), 300)]
    df = spark.createDataFrame(rows, "g string, v int, x int, one int")
    for descending in (False, True):
        got = o.running_totals(df, "v", ["x", "one"], ["g"], descending).collect()
        assert len(got) == len(rows)
        for r in got:
            earlier = [q for q in rows if q[0] == r["g"] and (q[1] > r["v"] if descending else q[1] < r["v"])]
            assert (r["before_x"], r["before_one"]) == (sum(q[2] for q in earlier), len(earlier))
            assert r["total_one"] == 300


def test_quantiles_match_linear_interpolation(spark):
    rng = random.Random(2)
    data = {"a": [rng.choice([1.5, 2.0, 2.0, 9.25, rng.random()]) for _ in range(501)], "b": [3.0], "c": [1.0, 2.0]}
    rows = [(g, v) for g, values in data.items() for v in values] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    points = {"low": 0.0, "q1": 0.25, "mid": 0.5, "p99": 0.99, "high": 1.0}
    got = {r["g"]: r for r in o.quantiles(df, "v", points, ["g"]).collect()}
    for g, values in data.items():
        assert [got[g][n] for n in points] == pytest.approx(np.quantile(values, list(points.values())).tolist())


@pytest.mark.parametrize("finish_rows", [200_000, 10, 1])
def test_keys_at_ranks_with_heavy_ties(make, finish_rows):
    rng = random.Random(3)
    start = dt.datetime(2025, 1, 1)
    # a third of all rows share one instant
    times = [start + dt.timedelta(days=5) if rng.random() < 0.34 else start + dt.timedelta(seconds=rng.randrange(10**6)) for _ in range(240)]
    df = make([{"transaction_time": t} for t in times])
    rows = sorted((t, f"T{i:05d}") for i, t in enumerate(times))
    ranks = [0, 1, 100, 168, 200, 239]
    n, low, high = o.span(df)
    got = o.keys_at_ranks(df, ranks, (low, high), finish_rows=finish_rows)
    assert n == 240
    assert {r: k[1] for r, k in got.items()} == {r: rows[r][1] for r in ranks}


@pytest.mark.parametrize("finish_rows", [200_000, 1])
def test_split_is_chronological_and_exact(make, finish_rows):
    rng = random.Random(4)
    times = [dt.datetime(2025, 1, 1) + dt.timedelta(hours=rng.randrange(40)) for _ in range(107)]
    df = make([{"transaction_time": t, "customer_id": i % 5} for i, t in enumerate(times)])
    rows = with_split(df, chronological_cuts(df, finish_rows=finish_rows)).collect()
    ordered = sorted(rows, key=lambda r: (r["transaction_time"], r["transaction_id"]))
    n = len(rows)
    want = ["train"] * int(n * 0.70) + ["validation"] * (int(n * (0.70 + 0.15)) - int(n * 0.70))
    want += ["test"] * (n - len(want))
    assert [r["split"] for r in ordered] == want


def test_split_of_tiny_and_empty_tables(make):
    assert [r["split"] for r in with_split(make([{}])).collect()] == ["test"]
    assert with_split(make([])).count() == 0
    assert with_split(make([{}]), Cuts(None, None)).first()["split"] == "train"
    summary = {r["split"]: r["fraud_rate"] for r in split_summary(with_split(make([{"is_fraud": 1}, {}]))).collect()}
    assert summary == {"train": 1.0, "test": 0.0} or summary == {"train": 1.0, "validation": 0.0}


def test_micros(spark):
    from riskweave.functions.scalar import micros

    df = spark.sql("select timestamp_ntz'1969-12-31 23:59:59.999999' a, timestamp_ntz'2025-03-30 02:30:00.000001' b")
    row = df.select(micros(df["a"]), micros(df["b"])).first()
    epoch = dt.datetime(1970, 1, 1)
    assert row[0] == -1
    assert row[1] == (dt.datetime(2025, 3, 30, 2, 30, 0, 1) - epoch) // dt.timedelta(microseconds=1)


@pytest.mark.parametrize("accuracy", [20, 500])
def test_sketched_quantiles_stay_within_their_rank_error(spark, accuracy):
    # many repeated values, two groups of unlike size, nulls
    rows = spark.range(30_000).selectExpr("id % 7 = 0 as g", "if(id % 11 = 0, null, cast((id * 7919) % 1000 as double)) as v")
    asked = {"low": 0.1, "mid": 0.5, "high": 0.99}
    found = o.quantiles(rows, "v", asked, ["g"], accuracy)
    errors = o.rank_errors(rows, "v", found, asked, ["g"]).collect()
    assert len(errors) == 6
    assert all(e["rank_error"] <= 1 / accuracy + 1 / e["rows"] for e in errors)


def test_sketch_of_more_accuracy_than_rows_is_exact(spark):
    rows = spark.range(501).selectExpr("cast(id as double) as v")
    assert o.quantiles(rows, "v", {"m": 0.5}, accuracy=10_000).first()["m"] == 250.0
    assert o.quantiles(rows.limit(0), "v", {"m": 0.5}, accuracy=100).first()["m"] is None


def test_rank_error_is_measured_from_the_nearest_of_equal_values(spark):
    rows = spark.createDataFrame([(1.0,)] * 5 + [(2.0,)] * 5, "v double")
    found = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    errors = {r["quantile"]: r["rank_error"] for r in o.rank_errors(rows, "v", found, {"a": 0.2, "b": 0.2}).collect()}
    assert errors == {"a": 0.0, "b": pytest.approx(0.4)}
