import json
import random
import threading

import numpy as np
import pytest
from brute import shapley, tree_value
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.operators import explain as x
from riskweave.operators import metrics
from riskweave.operators import models as m
from riskweave.operators import requests as rq
from riskweave.operators import trees
from riskweave.operators.scoring import PROBABILITY
from riskweave.plans import catalog, workflow
from riskweave.schema import LABEL, REQUESTS
from riskweave.sources.events import requests_from_events, transactions_from_events
from riskweave.streaming import scoring as stream

SMALL = {
    m.LOGISTIC: {},
    m.FOREST: {"numTrees": 8, "maxDepth": 4},
    m.BOOSTED: {"maxIter": 4, "maxDepth": 3},
}
EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run"))
    txns = transactions_from_events(spark.read.parquet(EVENTS))
    return workflow.run(txns, folder, settings=SMALL), folder


def test_run_writes_everything(spark, fitted):
    run, folder = fitted
    assert {r["model"] for r in run.comparison.collect()} == set(m.KINDS)
    for row in run.comparison.collect():
        assert all(row[c] is None or 0 <= row[c] <= 1 for c in row.asDict() if c != "model")
    test = workflow.part(run.features, "test")
    assert run.report.count() == test.count() == 150
    # probability, label and amount of a report row belong to the same transaction
    again = run.models[m.BOOSTED].score(test)
    pairs = run.report.alias("r").join(again.alias("a"), "transaction_id")
    assert pairs.filter("r.is_fraud = a.is_fraud and r.amount = a.amount and abs(r.fraud_probability - a.fraud_probability) < 1e-12").count() == 150
    assert set(workflow.read_report(spark, f"{folder}/scored_transactions").columns) == set(run.report.columns)


def test_missing_report_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        workflow.read_report(spark, str(tmp_path / "nothing")).count()


@pytest.mark.parametrize("kind", m.KINDS)
def test_saved_model_scores_the_same(spark, fitted, kind):
    run, folder = fitted
    test = workflow.part(run.features, "test")
    loaded = m.RiskModel.load(spark, f"{folder}/models/{kind}")
    assert loaded.encoding.names == run.models[kind].encoding.names
    a = {r["transaction_id"]: r[PROBABILITY] for r in run.models[kind].score(test).collect()}
    b = {r["transaction_id"]: r[PROBABILITY] for r in loaded.score(test).collect()}
    assert a == b and all(0 <= p <= 1 for p in a.values())


def test_logistic_matches_newton(spark, fitted):
    """Summed weighted loss plus half the squared weights, solved directly."""
    run, _ = fitted
    train = workflow.part(run.features, "train")
    model = run.models[m.LOGISTIC]
    rows = model.assemble(train).select(vector_to_array("features").alias("v"), "is_fraud").toPandas()
    v, y = np.stack(rows["v"]), rows["is_fraud"].to_numpy(float)
    n, p = len(y), y.sum()
    weight = np.where(y == 1, n / (2 * p), n / (2 * (n - p)))
    design = np.c_[np.ones(n), v]
    beta, penalty = np.zeros(design.shape[1]), np.diag([0.0] + [1.0] * v.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-design @ beta))
        slope = design.T @ (weight * (q - y)) + penalty @ beta
        curve = (design * (weight * q * (1 - q))[:, None]).T @ design + penalty
        beta = beta - np.linalg.solve(curve, slope)
    assert model.classifier.coefficients.toArray() == pytest.approx(beta[1:], abs=2e-3)
    assert v.mean(axis=0) == pytest.approx(np.zeros(v.shape[1]), abs=1e-9)
    assert np.isin(np.round(v.std(axis=0), 9), [0.0, 1.0]).all()


def test_registered_queries_train_at_full_size(spark, monkeypatch, fitted):
    run, _ = fitted
    asked = []

    def train(rows, kinds=m.KINDS, settings=None, encoding=None):
        asked.extend((k, {**m.SETTINGS[k], **(settings or {}).get(k, {})}) for k in kinds)
        return {k: run.models[k] for k in kinds}

    monkeypatch.setattr(catalog, "_TRAINED", {})
    monkeypatch.setattr(m, "train_models", train)
    catalog.QUERIES["rf_scores"](spark, "/root/testdata/sf0.001")
    catalog.QUERIES["validation_metrics"](spark, "/root/testdata/sf0.001")
    # no model twice, none smaller than the library's
    assert sorted(asked, key=str) == sorted(m.SETTINGS.items(), key=str)
    sizes = {k: (s.get("numTrees"), s["maxIter"] if "maxIter" in s else None, s.get("maxDepth")) for k, s in asked}
    assert sizes == {m.LOGISTIC: (None, 1000, None), m.FOREST: (300, None, 12), m.BOOSTED: (None, 400, 6)}


def test_models_are_fitted_at_the_same_time(fitted, monkeypatch):
    run, _ = fitted
    together, estimator = threading.Barrier(3, timeout=60), m._estimator

    def met(kind, rows, settings):
        together.wait()
        return estimator(kind, rows, settings)

    monkeypatch.setattr(m, "_estimator", met)
    again = m.train_models(workflow.part(run.features, "train"), settings=SMALL)
    assert list(again) == list(m.KINDS) and all(again[k].kind == k for k in again)


@pytest.mark.parametrize("kind", [m.FOREST, m.BOOSTED])
def test_trees_read_vectors_that_are_assembled_already(make, monkeypatch, kind):
    """A boosted round reads all of its rows again, so only the weight is left to compute there."""
    from riskweave.operators.features import build_features

    train = build_features(make([{"is_fraud": i % 2, "amount": 10.0 + i} for i in range(40)]))
    estimator, asked = m._estimator, []

    class Seen:
        def __init__(self, *args):
            self.own = estimator(*args)

        def fit(self, inputs):
            asked.append(inputs._jdf.queryExecution().optimizedPlan().toString().partition("InMemoryRelation"))
            return self.own.fit(inputs)

    monkeypatch.setattr(m, "_estimator", Seen)
    m.train_models(train, [kind], SMALL)
    ((read, kept, _),) = asked
    assert kept and "UDF" not in read and "input_0" not in read


def test_training_needs_both_classes(make):
    from riskweave.operators.features import build_features

    with pytest.raises(ValueError, match="both classes"):
        m.train_models(build_features(make([{}, {}])), [m.LOGISTIC])


def test_weights_raise_recall(spark):
    """With rare positives an unweighted fit flags almost nothing."""
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        bad = int(rng.random() < 0.05)
        rows.append((f"T{i}", rng.gauss(1.2 * bad, 1), bad))
    df = spark.createDataFrame(rows, "transaction_id string, signal double, is_fraud int")
    encoding = m.Encoding(("signal",), ())
    weighted = m.train_models(df, [m.LOGISTIC], encoding=encoding)[m.LOGISTIC]
    plain = m.LogisticRegression(featuresCol="features", labelCol="is_fraud").fit(weighted.assemble(df))
    found = weighted.score(df).filter(f"is_fraud = 1 and {PROBABILITY} >= 0.5").count()
    assert found > plain.transform(weighted.assemble(df)).filter("is_fraud = 1 and prediction = 1").count()


# --- attributions --------------------------------------------------------------------------------


def _margins(model, rows):
    """Log odds of every row. A boosted model's raw prediction is half of it."""
    out = model.classifier.transform(model.assemble(rows))
    raw = vector_to_array(F.col("rawPrediction"))[1] * (2 if model.kind == m.BOOSTED else 1)
    return {r["transaction_id"]: r["margin"] for r in out.select("transaction_id", raw.alias("margin")).collect()}


def test_attributions_add_up_to_the_margin(fitted):
    run, _ = fitted
    test = workflow.part(run.features, "test")
    model = run.models[m.BOOSTED]
    margins = _margins(model, test)
    rows = x.tree_attributions(model, test).collect()
    assert len(rows) == 150
    for r in rows:
        assert sum(r["attributions"]) + r["base_value"] == pytest.approx(margins[r["transaction_id"]], abs=1e-9)


def test_attributions_are_shapley_values(fitted):
    run, _ = fitted
    model = run.models[m.BOOSTED]
    nodes = trees.Forest.of_model(model, run.features.sparkSession).nodes
    used = sorted(nodes[nodes["left"] >= 0]["feature"].unique())
    short = {f: i for i, f in enumerate(used)}
    tables = [
        {
            n["node"]: {**n, "feature": short.get(n["feature"])}
            for n in table.to_dict("records")
        }
        for _, table in nodes.groupby("tree")
    ]
    weights = model.classifier.treeWeights
    for r in x.tree_attributions(model, workflow.part(run.features, "test")).limit(3).collect():
        inputs = [r["inputs"][f] for f in used]
        want = np.zeros(len(used))
        base = 0.0
        for tree, w in zip(tables, weights, strict=True):
            parts = sorted({n["feature"] for n in tree.values() if n["left"] >= 0})
            local = {f: i for i, f in enumerate(parts)}
            small = {k: {**n, "feature": local.get(n["feature"])} for k, n in tree.items()}
            got = shapley(small, [inputs[f] for f in parts], len(parts))
            for f, value in zip(parts, got, strict=True):
                want[f] += 2 * w * value
            base += 2 * w * tree_value(small, 0, [], set())
        assert [r["attributions"][f] for f in used] == pytest.approx(want.tolist(), abs=1e-9)
        assert r["base_value"] == pytest.approx(base)


def test_tabulated_and_direct_parts_agree():
    rng = np.random.default_rng(3)
    boxes = []
    for _ in range(17):
        low = rng.normal(size=5) - 1
        named = tuple(int(f) for f in rng.permutation(6)[:5])
        boxes.append(x.Leaf(named, tuple(low), tuple(low + 3 * rng.random(5)), rng.random(5) * 0.9 + 0.05, rng.normal()))
    leaves = x.Leaves([*boxes, x.Leaf((), (), (), np.array([]), 2.0)], 0.0, 6)
    rows = rng.normal(size=(100, 6))
    # 100 rows exceed the 32 patterns of five slots, single rows do not
    one_by_one = np.concatenate([x.attribute(leaves, rows[i : i + 1]) for i in range(100)])
    assert x.attribute(leaves, rows) == pytest.approx(one_by_one, abs=1e-12)


def test_importance_and_explanation(fitted):
    run, _ = fitted
    model, test = run.models[m.BOOSTED], workflow.part(run.features, "test")
    attributed = x.tree_attributions(model, test)
    names = model.encoding.names
    long_form = x.attribution_long(attributed, names)
    assert long_form.count() == 150 * len(names)
    by_rows = {r["feature"]: r["mean_abs_attribution"] for r in x.importance(long_form).collect()}
    wide = [tuple(r) for r in x.attribution_importance(attributed, names).collect()]
    assert by_rows == pytest.approx(dict(wide))
    assert [v for _, v in wide] == sorted(by_rows.values(), reverse=True)
    top = x.explain_riskiest(model, test).collect()
    best = max(r[PROBABILITY] for r in model.score(test).collect())
    assert len(top) == 8 and {r[PROBABILITY] for r in top} == {best}
    strengths = [abs(r["attribution"]) for r in top]
    assert strengths == sorted(strengths, reverse=True)


def test_linear_attributions_of_the_logistic_model(fitted):
    run, _ = fitted
    model, test = run.models[m.LOGISTIC], workflow.part(run.features, "test")
    weights, means = x.logistic_weights(model)
    wide = test.select("transaction_id", *model.encoding.columns())
    margins = _margins(model, test)
    for r in x.linear_attributions(wide, weights, means).collect():
        total = sum(r[n] for n in weights) + model.classifier.intercept
        assert total == pytest.approx(margins[r["transaction_id"]], abs=1e-9)


# --- streaming -----------------------------------------------------------------------------------


def test_stream_equals_batch_and_resumes(spark, fitted, tmp_path):
    run, _ = fitted
    model = run.models[m.LOGISTIC]
    requests = requests_from_events(spark.read.parquet(EVENTS))
    incoming, output, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    halves = [requests.filter("cast(substr(request_id, 4) as int) < 500"), requests.filter("cast(substr(request_id, 4) as int) >= 500")]
    for half in halves:
        # the second start picks up the new files only
        half.coalesce(1).write.mode("append").json(incoming)
        arriving = stream.read_requests(spark, incoming)
        stream.start_scoring(arriving, model, output, progress, available_now=True).awaitTermination()
    got = sorted(spark.read.parquet(output).collect())
    want = sorted(stream.score_requests(requests, model).collect())
    assert len(got) == 1000
    assert got == want
    assert any(r["errors"] for r in got)
    assert all((r["risk_level"] is None) == bool(r["errors"]) for r in got)


def test_forest_scores_requests_with_gaps(spark, fitted):
    run, _ = fitted
    row = {"request_id": "a", "amount": 12.0, "merchant_category": "never seen"}
    df = spark.createDataFrame([tuple(row.get(f.name) for f in REQUESTS)], REQUESTS)
    answer = rq.respond(run.models[m.FOREST].score(rq.request_features(df))).first()
    assert set(json.loads(spark.createDataFrame([answer]).toJSON().first())) == {"request_id", PROBABILITY, "risk_score", "risk_level", "recommended_action"}
    assert 0 <= answer[PROBABILITY] <= 1


def test_nan_goes_right_in_attributions():
    import pandas as pd

    nodes = pd.DataFrame(
        [(0, 0, 0.0, 4.0, 1, 2, 0, 0.5), (0, 1, -0.5, 2.0, -1, -1, -1, 0.0), (0, 2, 1.0, 2.0, -1, -1, -1, 0.0)],
        columns=["tree", "node", "prediction", "cover", "left", "right", "feature", "threshold"],
    )
    leaves = x.collect_leaves(trees.Forest(nodes, (1.0,), ("x",)))
    parts = x.attribute(leaves, np.array([[np.nan], [0.0], [1.0]]))
    assert (leaves.base + parts.sum(1)).tolist() == pytest.approx([2.0, -1.0, 2.0])


def test_last_round_equals_the_model_and_rounds_can_be_chosen(fitted):
    run, _ = fitted
    model, rows = run.models[m.BOOSTED], workflow.part(run.features, "validation")
    forest = trees.Forest.of_model(model, rows.sparkSession)
    inputs = trees.model_inputs(model, rows, [LABEL])
    found = {r["round"]: r.asDict() for r in trees.round_metrics(inputs, forest).collect()}
    assert sorted(found) == list(range(1, len(forest.weights) + 1))
    whole = workflow.compare({m.BOOSTED: model}, rows).first().asDict()
    last = found[len(forest.weights)]
    assert [last[c] for c in metrics.METRICS] == pytest.approx([whole[c] for c in metrics.METRICS])
    few = trees.round_metrics(inputs, forest, rounds=[1, len(forest.weights)]).collect()
    assert {r["round"]: r["roc_auc"] for r in few} == pytest.approx({n: found[n]["roc_auc"] for n in (1, len(forest.weights))})
    # a grid of scores bounds the counts
    coarse = trees.round_counts(inputs, forest, digits=1).groupBy("round").count().collect()
    assert max(r["count"] for r in coarse) <= 11


def test_forest_round_trip(spark, fitted, tmp_path):
    run, _ = fitted
    forest = trees.Forest.of_model(run.models[m.BOOSTED], spark)
    forest.write(spark, str(tmp_path / "t"))
    back = trees.Forest.read(spark, str(tmp_path / "t"))
    assert (back.weights, back.names) == (forest.weights, forest.names)
    assert back.nodes.equals(forest.nodes.astype(back.nodes.dtypes))
