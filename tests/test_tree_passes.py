"""How boosted trees are passed over: without a table of node ids, which costs more than it saves and changes no tree."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskweave.operators import models


def test_boosting_keeps_no_node_table_and_has_the_same_trees(spark):
    settings = models.SETTINGS[models.BOOSTED]
    assert not settings["cacheNodeIds"]
    rows = spark.range(0, 600, 1, 3).select(
        F.array(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(50)).cast("double") for i in range(4)]).alias("x"),
        (F.pmod(F.xxhash64("id", F.lit(0)), F.lit(50)) + F.pmod(F.xxhash64("id", F.lit(9)), F.lit(20)) > 45).cast("double").alias(models.LABEL),
    )
    inputs = rows.select(array_to_vector("x").alias(models.FEATURES), models.LABEL, F.lit(1.0).alias(models.WEIGHT))
    short = {**settings, "maxIter": 4, "maxDepth": 4}
    plain, cached = (models._estimator(models.BOOSTED, 600, {**short, "cacheNodeIds": c}).fit(inputs) for c in (False, True))
    assert plain.toDebugString.splitlines()[1:] == cached.toDebugString.splitlines()[1:]
    assert plain.totalNumNodes > 4
