import random

import pytest
from brute import auc, average_precision

from riskweave.operators import metrics as m
from riskweave.operators.hypothesis import mann_whitney

RNG = random.Random(7)
TIED = [(int(RNG.random() < 0.3), RNG.choice([0.1, 0.2, 0.5, 0.5, 0.8, 0.9])) for _ in range(200)]
SPREAD = [(int(RNG.random() < 0.2), RNG.random()) for _ in range(300)]


@pytest.mark.parametrize("pairs", [TIED, SPREAD])
def test_areas(scored, pairs):
    row = m.areas(m.ranking(scored(pairs))).first()
    assert row["roc_auc"] == pytest.approx(auc(pairs), abs=1e-12)
    assert row["pr_auc"] == pytest.approx(average_precision(pairs), abs=1e-12)


def test_reversed_scores_mirror_the_area(scored):
    ahead = m.roc_auc(scored(TIED)).first()["roc_auc"]
    back = m.roc_auc(scored([(y, -s) for y, s in TIED])).first()["roc_auc"]
    assert back == pytest.approx(1 - ahead, abs=1e-12)


def test_area_is_the_normalised_rank_statistic(scored):
    row = mann_whitney(scored(TIED), "score").first()
    n1, n2 = row["n_fraud"], row["n_legit"]
    assert m.roc_auc(scored(TIED)).first()["roc_auc"] == pytest.approx(row["u_statistic"] / (n1 * n2), abs=1e-12)
    other = mann_whitney(scored([(1 - y, s) for y, s in TIED]), "score").first()
    assert row["u_statistic"] + other["u_statistic"] == n1 * n2


def test_one_class_only(scored):
    zeros, ones = scored([(0, 0.2), (0, 0.7)]), scored([(1, 0.2), (1, 0.7)])
    assert tuple(m.precision_recall_f1(zeros).first()) == (0.0, 0.0, 0.0)
    assert tuple(m.precision_recall_f1(ones).first()) == (1.0, 0.5, pytest.approx(2 / 3))
    assert tuple(m.areas(m.ranking(zeros)).first()) == (None, 0.0)
    assert tuple(m.areas(m.ranking(ones)).first()) == (None, 1.0)


def test_threshold_is_inclusive(scored):
    row = m.confusion_matrix(scored([(1, 0.5), (0, 0.5), (1, 0.49), (0, 0.1)])).first()
    assert tuple(row) == (1, 1, 1, 1)


def test_curves_start_and_end(scored):
    ranked = m.ranking(scored(TIED))
    roc = sorted(m.roc_curve(ranked).collect(), key=lambda r: (r["fpr"], r["tpr"]))
    assert tuple(roc[0]) == (0.0, 0.0, None)
    assert tuple(roc[-1])[:2] == (1.0, 1.0)
    area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(roc, roc[1:]))
    assert area == pytest.approx(auc(TIED), abs=1e-12)
    points = m.pr_curve(ranked).collect()
    assert (1.0, 0.0, None) in [tuple(p) for p in points]
    assert max(p["recall"] for p in points) == 1.0


def test_compare_models_equals_single_metrics(spark, scored):
    rows = [(y, s, round(1 - s, 3)) for y, s in SPREAD]
    frame = spark.createDataFrame(rows, "is_fraud int, a double, b double")
    table = {r["model"]: r for r in m.compare_models(m.stack_scores(frame, ["a", "b"])).collect()}
    for name, i in (("a", 1), ("b", 2)):
        pairs = [(r[0], r[i]) for r in rows]
        single = m.precision_recall_f1(scored(pairs)).first()
        assert [table[name][c] for c in ("precision", "recall", "f1")] == pytest.approx(list(single))
        assert table[name]["roc_auc"] == pytest.approx(auc(pairs), abs=1e-12)
        assert table[name]["pr_auc"] == pytest.approx(average_precision(pairs), abs=1e-12)
    long_form = m.metrics_long(m.compare_models(m.stack_scores(frame, ["a", "b"])))
    assert long_form.count() == 10


def test_curves_by_model(spark):
    frame = spark.createDataFrame([(y, s, s) for y, s in TIED], "is_fraud int, a double, b double")
    stacked = m.stack_scores(frame, ["a", "b"])
    counts = {r["model"]: r["count"] for r in m.roc_curve(m.ranking(stacked, ["model"]), ["model"]).groupBy("model").count().collect()}
    assert counts == {"a": 6, "b": 6}
