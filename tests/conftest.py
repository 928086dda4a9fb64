from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskweave.schema import TRANSACTIONS
from riskweave.session import local_session

SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", cores=8, shuffle_partitions=4)


@pytest.fixture
def make(spark):
    """Transactions from short rows; anything left out gets a plain value."""

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            base = {
                "transaction_id": f"T{i:05d}",
                "customer_id": 1,
                "amount": 10.0,
                "transaction_time": dt.datetime(2025, 1, 1) + dt.timedelta(minutes=i),
                "merchant_category": "grocery",
                "payment_type": "upi",
                "device": "web_chrome",
                "location_lat": 10.0,
                "location_lon": 70.0,
                "is_fraud": 0,
            }
            full.append(tuple({**base, **row}[f.name] for f in TRANSACTIONS))
        return spark.createDataFrame(full, TRANSACTIONS)

    return build


@pytest.fixture
def scored(spark):
    """(label, score) frame."""

    def build(pairs):
        return spark.createDataFrame([(int(y), None if s is None else float(s)) for y, s in pairs], "is_fraud int, score double")

    return build
