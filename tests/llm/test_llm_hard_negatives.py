import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.llm import hard_negatives as h

SCHEMA = "vec_id long, label int, embedding array<float>"
ANCHOR = "vec_id % 10 = 0"


def brute(rows, positives=5, negatives=10):
    """Every anchor against every row, as rows: copies are rows of their own."""
    used = [
        (i, label, [int(np.floor(256 * float(x))) for x in v])
        for i, label, v in rows
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    last = float("inf")
    for a, (anchor, label, own) in enumerate(used):
        if anchor is None or anchor % 10:
            continue
        scored = [
            (-sum(x * y for x, y in zip(own, v, strict=False)), last if i is None else i, lab, i)
            for b, (i, lab, v) in enumerate(used)
            if b != a
        ]
        scored.sort(key=lambda s: s[:2])
        for p in [s for s in scored if s[2] == label][:positives]:
            fitting = [s for s in scored if s[2] != label and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]]
            out += [(anchor, p[3], r, s[3], -p[0], -s[0]) for r, s in enumerate(fitting[:negatives], 1)]
    return sorted(out, key=str)


def vectors(n, width=20, seed=1, labels=4, scale=0.5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, width)) * scale
    return [(i, int(i * 7 % labels), (centre[i * 7 % labels] * 0.6 + rng.normal(size=width) * scale).astype(np.float32).tolist()) for i in range(n)]


def mined(spark, rows, schema=SCHEMA):
    return sorted(map(tuple, h.mine(spark.createDataFrame(rows, schema), F.expr(ANCHOR)).collect()), key=str)


@pytest.fixture
def small_cells(monkeypatch):
    for name, value in {"LEAST_ROWS": 16, "PART_ROWS": 32, "BLOCK_ANCHORS": 3, "TABLED": 2, "LOOKED_UP": 5}.items():
        monkeypatch.setattr(h, name, value)


def test_equals_brute_force_over_many_cells(spark, small_cells):
    rows = vectors(300)
    want = brute(rows)
    assert len(want) > 300 and mined(spark, rows) == want


def test_scores_are_inner_products():
    rng = np.random.default_rng(2)
    values = rng.integers(-(2**11), 2**11, (50, 24))
    planes = h.packed(values, 12)
    assert (h.unpacked(planes) == values).all()
    assert (h.scores(planes, h.subset_sums(values[:7], np.int64)) == values @ values[:7].T).all()
    # a table holds every subset's sum
    table = h.subset_sums(values[:1], np.int64)[0, :, 0]
    assert table[0b10000101] == values[0, 0] + values[0, 2] + values[0, 7]


def test_ties_copies_and_odd_rows(spark, small_cells):
    rows = vectors(60, width=3, scale=0.02)  # few different scores
    rows += [rows[10], rows[10], rows[20], rows[31], (40, 2, rows[40][2])]
    rows += [(None, 1, rows[3][2]), (100, None, rows[4][2]), (110, 1, None), (120, 1, [0.1, None, 0.2]), (130, 1, [float("nan"), 0.1, 0.2])]
    rows += [(140, 1, [float("inf"), 0.1, 0.2]), (150, 1, [0.3]), (160, 2, []), (-170, 1, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5])]
    assert mined(spark, rows) == brute(rows)


def test_a_hot_vector_is_counted_once(spark):
    rows = vectors(30) + [(20, 3, [0.5] * 20)] * 400 + [(41, 0, [0.4] * 20)] * 300
    found = mined(spark, rows)
    assert found == brute(rows)
    assert sum(r[0] == 20 for r in found) >= 400


def test_large_components(spark):
    rows = [(i, label, [x * 4000.0 for x in v]) for i, label, v in vectors(60)]
    assert mined(spark, rows, "vec_id long, label int, embedding array<double>") == brute(rows)
    with pytest.raises(ValueError, match="too large"):
        mined(spark, [(10, 1, [1e30, 1.0])])


def test_no_rows_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert h.mine(empty, F.expr(ANCHOR)).collect() == []
    assert h.mine(empty, F.expr(ANCHOR)).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = vectors(80)
    plain = spark.createDataFrame(rows, SCHEMA)
    clashing = plain.select("*", *[F.lit("x").alias(c) for c in ("row", "part", "block", "n", "rank", "planes", "score", "slice_no")])
    assert sorted(map(tuple, h.mine(clashing, F.expr(ANCHOR)).collect()), key=str) == brute(rows)
    assert isinstance(h.mine(plain, F.col("vec_id") == -5).toPandas(), pd.DataFrame)
