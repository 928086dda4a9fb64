"""History features of a stream against those of the table."""

import datetime as dt
import random

import pytest
from conftest import SMALL_DIR
from pyspark.sql import functions as F

from riskweave.operators import features as fe
from riskweave.sources.events import transactions_from_events
from riskweave.streaming import history

DAY = dt.datetime(2025, 1, 1)


@pytest.fixture
def replay(spark, tmp_path):
    """Runs the stream once per batch of rows, each time from its checkpoint; returns what the sink holds."""
    own = history.history_session(spark)
    inbox, output, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))

    def run(*batches, delay="1 hour", close=True):
        dropped = 0
        last = len(batches) - 1
        for i, rows in enumerate(batches):
            rows = rows.unionByName(history.closing_row(spark)) if close and i == last else rows
            rows.coalesce(1).write.mode("append").parquet(inbox)
            query = history.start_history(history.read_transactions(own, inbox), output, progress, delay, available_now=True)
            query.awaitTermination()
            dropped += sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
        return spark.read.parquet(output), dropped

    return run


def same(found, table, columns=fe.HISTORY):
    wanted = fe.add_history(table).select("transaction_id", *columns)
    found = found.select("transaction_id", *columns)
    return found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0


def test_replay_equals_the_table_bit_for_bit(spark, replay):
    txns = transactions_from_events(spark.read.parquet(f"{SMALL_DIR}/events.parquet"))
    day = F.dayofmonth("transaction_time")
    found, dropped = replay(txns.filter(day <= 9), txns.filter((day > 9) & (day <= 20)), txns.filter(day > 20))
    assert dropped == 0 and found.count() == 1000
    assert same(found, txns)


def test_ties_nulls_and_disorder(make, replay):
    rng = random.Random(3)
    rows = [
        {
            "customer_id": rng.choice([1, 1, 2]),
            "transaction_time": DAY + dt.timedelta(minutes=rng.randrange(0, 4000, 20)),
            "amount": rng.choice([None, 5.0, 7.25, 1 / 3]),
            "device": rng.choice([None, "a", "b", "c"]),
            "location_lat": rng.choice([None, 10.0, 12.5]),
        }
        for _ in range(120)
    ]
    rows.sort(key=lambda r: r["transaction_time"] + dt.timedelta(minutes=rng.randrange(0, 110)))
    df = make(rows)
    number = F.substring("transaction_id", 2, 5).cast("int")
    # the rows come up to two hours out of order
    found, dropped = replay(df.filter(number < 40), df.filter((number >= 40) & (number < 80)), df.filter(number >= 80), delay="2 hours")
    assert dropped == 0
    assert same(found, df)


def test_rows_behind_the_watermark_are_dropped_and_counted(make, replay):
    first = make([{"transaction_time": DAY + dt.timedelta(hours=h)} for h in (0, 10)])
    late = make([{"transaction_id": "late", "transaction_time": DAY + dt.timedelta(hours=2)}, {"transaction_id": "on time", "transaction_time": DAY + dt.timedelta(hours=9, minutes=30)}])
    found, dropped = replay(first, late)
    assert dropped == 1
    assert {r.transaction_id: r.last_24h for r in found.collect()} == {"T00000": 0, "on time": 1, "T00001": 2}


def test_rows_wait_until_nothing_earlier_can_come(make, replay):
    df = make([{"transaction_time": DAY + dt.timedelta(minutes=m)} for m in (0, 30, 59, 60, 90)])
    found, _ = replay(df, close=False)
    # an hour behind the last row
    assert {r.transaction_id for r in found.collect()} == {"T00000", "T00001"}


def test_counts_of_a_silent_customer_expire(make, replay, spark, tmp_path):
    quiet = make([{"customer_id": 9}])
    busy = make([{"transaction_id": f"B{i}", "customer_id": 1, "transaction_time": DAY + dt.timedelta(days=i)} for i in range(4)])
    found, _ = replay(quiet, busy, make([{"transaction_id": "C", "customer_id": 1, "transaction_time": DAY + dt.timedelta(days=9)}]), close=False)
    assert found.filter("customer_id = 9").count() == 1
    state = spark.read.format("statestore").option("path", str(tmp_path / "progress")).option("stateVarName", "recent").load()
    kept = {r["key"]["customer_id"] for r in state.select("key").collect()}
    assert 9 not in kept


def test_rows_without_a_key_are_not_answered(make, replay):
    found, _ = replay(make([{"customer_id": None}, {"transaction_time": None}, {"transaction_id": None}, {}]))
    assert [r.transaction_id for r in found.collect()] == ["T00003"]


class Kept:
    """A customer's state in memory, with the number of calls; every call of the real one is a round trip."""

    def __init__(self, value=None):
        self.value, self.calls = value, 0

    def __getattr__(self, name):
        self.calls += 1
        return {
            "get": lambda: self.value,
            "put": lambda rows: setattr(self, "value", rows),
            "update": lambda row: setattr(self, "value", row),
            "clear": lambda: setattr(self, "value", []),
            "appendList": lambda rows: setattr(self, "value", self.value + rows),
            "registerTimer": lambda at: None,
            "keys": lambda: iter([(d,) for d in self.value]),
            "containsKey": lambda key: key[0] in self.value,
            "updateValue": lambda key, _: self.value.add(key[0]),
        }[name]


@pytest.mark.parametrize(("limit", "most"), [(500, (9, 6)), (2, (9, 10))])
def test_few_round_trips_per_customer(monkeypatch, limit, most):
    monkeypatch.setattr(history, "KEPT_DEVICES", limit)
    state = history.CustomerHistory()
    state.waiting, state.recent, state.last, state.devices, state.handle = Kept([]), Kept([]), Kept(), Kept(set()), Kept()
    parts = (state.waiting, state.recent, state.last, state.devices, state.handle)

    def answered(devices, start):
        state.waiting.value = [(start + i, f"T{i}", 5.0, d, 1.0, 1.0) for i, d in enumerate(devices)]
        for p in parts:
            p.calls = 0
        clock = type("Clock", (), {"getCurrentWatermarkInMs": staticmethod(lambda: start // 1000 + 10)})
        found = list(state.handleExpiredTimer((7,), clock, None))[0]
        return found["new_device"].tolist(), sum(p.calls for p in parts)

    first, calls = answered(["a", "b", "c", "a"], history.DAY)
    assert first == [1, 1, 1, 0] and calls <= most[0]
    # three days on, the counts have expired
    again, calls = answered(["c", "a", None, "b", "a"], 4 * history.DAY)
    assert again == [0, 0, 0, 0, 0] and calls <= most[1] + 2
    assert answered(["d", "a"], 8 * history.DAY)[0] == [1, 0]


def test_missing_values_wait_as_none():
    import pandas as pd

    state = history.CustomerHistory()
    state.waiting, state.handle = Kept([]), Kept()
    rows = pd.DataFrame({"time_us": [5, 6], "transaction_id": ["a", "b"], "amount": [1.5, float("nan")], "device": ["x", None], "location_lat": [None, 2.0], "location_lon": [1.0, None]})
    state.handleInputRows((7,), iter([rows]), None)
    assert state.waiting.value == [(5, "a", 1.5, "x", None, 1.0), (6, "b", None, None, 2.0, None)]
