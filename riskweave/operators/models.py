"""Training, storing and applying the three classifiers with Spark ML."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from riskweave.operators.encode import Encoding, Scaling, class_weights, fit_encoding, fit_scaling
from riskweave.operators.scoring import PROBABILITY
from riskweave.schema import LABEL
from riskweave.session import new_path, shared_folder

LOGISTIC, FOREST, BOOSTED = "LogisticRegression", "RandomForest", "GradientBoostedTrees"
KINDS = (LOGISTIC, FOREST, BOOSTED)
FEATURES = "features"
WEIGHT = "row_weight"

# For speed, without effect on the trees: more nodes of a level are split in one pass. A forest's rows keep their nodes
# between levels; a boosted round has one shallow tree, where walking down again is cheaper than a new node table per level.
_PASSES = {"maxMemoryInMB": 512}

# Training settings of the full-size models.
SETTINGS = {
    LOGISTIC: {"maxIter": 1000},
    FOREST: {"numTrees": 300, "maxDepth": 12, "minInstancesPerNode": 5, "seed": 42, "cacheNodeIds": True, **_PASSES},
    BOOSTED: {
        "maxIter": 400,
        "maxDepth": 6,
        "stepSize": 0.05,
        "subsamplingRate": 0.8,
        "featureSubsetStrategy": "0.8",
        "minInstancesPerNode": 3,
        "seed": 42,
        "cacheNodeIds": False,
        **_PASSES,
    },
}

_LOADERS = {
    LOGISTIC: LogisticRegressionModel,
    FOREST: RandomForestClassificationModel,
    BOOSTED: GBTClassificationModel,
}


@dataclass(frozen=True)
class RiskModel:
    """A fitted classifier with the encoding (and scaling) its inputs need."""

    kind: str
    encoding: Encoding
    scaling: Scaling | None
    classifier: Model

    def assemble(self, df: DataFrame) -> DataFrame:
        # a missing number becomes NaN here instead of failing the whole job
        return _assemble(df, self.encoding, self.scaling, "keep")

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``fraud_probability``; works on batches and streams alike."""
        out = self.classifier.transform(self.assemble(df))
        probability = vector_to_array(F.col("probability"))[1]
        return out.select(*df.columns, probability.alias(PROBABILITY))

    def save(self, spark: SparkSession, path: str) -> None:
        self.classifier.write().overwrite().save(f"{path}/classifier")
        self.encoding.save(spark, f"{path}/manifest")
        scaling = None if self.scaling is None else [self.scaling.means, self.scaling.deviations]
        text = json.dumps({"kind": self.kind, "scaling": scaling})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> RiskModel:
        raw = json.loads(spark.read.text(f"{path}/model", wholetext=True).first()["value"])
        return RiskModel(
            raw["kind"],
            Encoding.load(spark, f"{path}/manifest"),
            None if raw["scaling"] is None else Scaling(*raw["scaling"]),
            _LOADERS[raw["kind"]].load(f"{path}/classifier"),
        )


def _assemble(df: DataFrame, encoding: Encoding, scaling: Scaling | None, invalid: str = "error") -> DataFrame:
    """Add the feature vector in manifest order; the input columns stay as they are."""
    inputs = [f"input_{i}" for i in range(len(encoding.names))]
    columns = list(encoding.columns())
    if scaling is not None:
        columns = [
            (c - F.lit(scaling.means[n])) / F.lit(scaling.deviations[n])
            for n, c in zip(encoding.names, columns, strict=True)
        ]
    wide = df.select("*", *[c.alias(i) for i, c in zip(inputs, columns, strict=True)])
    assembler = VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid=invalid)
    return assembler.transform(wide).drop(*inputs)


def _row_weight(kind: str, sizes: Mapping[str, float]) -> Column:
    positive = F.col(LABEL) == 1
    if kind == BOOSTED:
        return F.when(positive, F.lit(sizes["scale_pos_weight"])).otherwise(F.lit(1.0))
    return F.when(positive, F.lit(sizes["weight_positive"])).otherwise(F.lit(sizes["weight_negative"]))


def _estimator(kind: str, rows: int, settings: Mapping):
    columns = {"featuresCol": FEATURES, "labelCol": LABEL, "weightCol": WEIGHT}
    if kind == LOGISTIC:
        # the averaged weighted loss with strength 1/n equals a summed loss with unit inverse strength
        return LogisticRegression(**columns, standardization=False, regParam=1.0 / rows, **settings)
    if kind == FOREST:
        return RandomForestClassifier(**columns, featureSubsetStrategy="sqrt", **settings)
    return GBTClassifier(**columns, **settings)


def _without_summary(kind: str, model: Model, spark: SparkSession) -> Model:
    """The model as it is when loaded. A training summary holds on to the session, which then goes out with every task,
    and which cannot go out at all once it has observed metrics."""
    if not getattr(model, "hasSummary", False):
        return model
    path = new_path(spark, "model")
    model.write().save(path)
    return _LOADERS[kind].load(path)


def train_models(
    train: DataFrame,
    kinds: Iterable[str] = KINDS,
    settings: Mapping[str, Mapping] | None = None,
    encoding: Encoding | None = None,
    scaling: Scaling | None = None,
    weights: Mapping[str, float] | None = None,
) -> dict[str, RiskModel]:
    """Fit the classifiers on one feature table, all at the same time.

    The needed columns are kept across the fits, and for trees their vectors too: every boosted round reads all rows
    again, and assembling them there took a third of its CPU time. Lost blocks are rebuilt from the feature table.
    Settings override the full-size ones by key. What is known of the rows already
    (``workflow.write_and_fit``) is not fitted again.
    """
    shared_folder(train.sparkSession)
    encoding = encoding or fit_encoding(train)
    needed = [*encoding.numeric, *[c for c, _ in encoding.categories], LABEL]
    rows = train.select(*needed).persist(StorageLevel.MEMORY_AND_DISK)
    vectors = _assemble(rows, encoding, None).select(FEATURES, LABEL)
    kinds = list(kinds)
    try:
        sizes = weights or class_weights(rows).first()
        if not sizes["positives"] or not sizes["negatives"]:
            raise ValueError("training needs rows of both classes")
        if {FOREST, BOOSTED} & set(kinds):
            vectors.persist(StorageLevel.MEMORY_AND_DISK)

        def fit(kind: str) -> RiskModel:
            own = None
            if kind == LOGISTIC:
                own = scaling or fit_scaling(rows.select(*encoding.columns()), encoding.names)
            chosen = {**SETTINGS[kind], **(settings or {}).get(kind, {})}
            inputs = (_assemble(rows, encoding, own) if kind == LOGISTIC else vectors).select(
                FEATURES, F.col(LABEL).cast("double").alias(LABEL), _row_weight(kind, sizes).alias(WEIGHT)
            )
            model = _without_summary(kind, _estimator(kind, sizes["positives"] + sizes["negatives"], chosen).fit(inputs), train.sparkSession)
            return RiskModel(kind, encoding, own, model)

        with ThreadPoolExecutor(max(1, len(kinds))) as pool:
            return dict(zip(kinds, pool.map(inheritable_thread_target(train.sparkSession)(fit), kinds), strict=True))
    finally:
        vectors.unpersist()
        rows.unpersist()
