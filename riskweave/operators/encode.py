"""Model inputs: drop-first indicator columns, ordered feature list, standardisation, class weights."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.scalar import ratio
from riskweave.operators.ordered import running_totals
from riskweave.schema import CATEGORICAL, LABEL, NUMERIC_FEATURES
from riskweave.session import cut_lineage

# A column per category only makes sense for short lists; longer ones take sparse vectors (``encode_sparse``).
MAX_CATEGORIES = 10_000


@dataclass(frozen=True)
class Encoding:
    """Fitted category lists; fixes the names and the order of all model inputs."""

    numeric: tuple[str, ...]
    categories: tuple[tuple[str, tuple[str, ...]], ...]

    def indicators(self) -> list[tuple[str, str, str]]:
        """(feature name, source column, value), without the first value of each column."""
        return [(f"{c}_{v}", c, v) for c, values in self.categories for v in values[1:]]

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *[name for name, _, _ in self.indicators()]]

    def columns(self) -> list[Column]:
        """Inputs in order, as doubles; a null or unlisted category has zeros everywhere."""
        numeric = [F.col(n).cast("double").alias(n) for n in self.numeric]
        return numeric + [
            F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(name)
            for name, c, v in self.indicators()
        ]

    def unseen(self) -> Column:
        """True where some category was not in the fitted lists."""
        flags = [
            F.col(c).isNotNull() & ~F.col(c).isin(*values) if values else F.col(c).isNotNull()
            for c, values in self.categories
        ]
        result = F.lit(False)
        for flag in flags:
            result = result | flag
        return result

    def to_json(self) -> str:
        return json.dumps({"features": self.names, "numeric": self.numeric, "categories": self.categories})

    @staticmethod
    def from_json(text: str) -> Encoding:
        raw = json.loads(text)
        return Encoding(tuple(raw["numeric"]), tuple((c, tuple(v)) for c, v in raw["categories"]))

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the feature manifest next to a model, in the file system the model uses."""
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Encoding:
        return Encoding.from_json(spark.read.text(path, wholetext=True).first()["value"])


def fit_encoding(
    df: DataFrame, categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC_FEATURES
) -> Encoding:
    """Sorted distinct non-null values per column, found in one pass with map-side distinct."""
    return fit_encoding_shares(df, categorical, numeric)[0]


def category_counts(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """(column, value, n) of the non-null values, in one pass with map-side sums."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in categorical])
    listed = df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("value").isNotNull())
    return listed.groupBy("column", "value").agg(F.count("*").alias("n"))


def fit_encoding_shares(
    df: DataFrame, categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC_FEATURES
) -> tuple[Encoding, dict[str, int]]:
    """The encoding, and how many rows have each indicator set."""
    found = category_counts(df, categorical).limit(MAX_CATEGORIES + 1).collect()
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories in {list(categorical)}: use encode_sparse")
    counts = {(r["column"], r["value"]): r["n"] for r in found}
    values = {c: sorted(v for column, v in counts if column == c) for c in categorical}
    encoding = Encoding(tuple(numeric), tuple((c, tuple(values[c])) for c in categorical))
    return encoding, {name: counts[c, v] for name, c, v in encoding.indicators()}


def one_hot(df: DataFrame, encoding: Encoding, keep: Sequence[str] = ("transaction_id",)) -> DataFrame:
    names = {name for name, _, _ in encoding.indicators()}
    columns = dict(zip(encoding.names, encoding.columns(), strict=True))
    return df.select(*keep, *[c.cast("int").alias(n) for n, c in columns.items() if n in names])


def feature_matrix(df: DataFrame, encoding: Encoding, keep: Sequence[str] = ("transaction_id",)) -> DataFrame:
    return df.select(*keep, *encoding.columns())


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation per feature; a constant feature keeps scale 1."""

    means: dict[str, float]
    deviations: dict[str, float]

    def apply(self, name: str, column: str | None = None) -> Column:
        return (F.col(column or name).cast("double") - F.lit(self.means[name])) / F.lit(self.deviations[name])


def fit_scaling(df: DataFrame, names: Sequence[str]) -> Scaling:
    """All moments in one aggregation; only the two numbers per feature reach the driver.

    ``df`` has the features by place: names hold category texts, which may differ in case alone or hold a backtick.
    """
    at = [df.columns.index(n) for n in names]
    inputs = [f"input_{i}" for i in range(len(df.columns))]
    row = df.toDF(*inputs).agg(
        *[F.avg(inputs[j]).alias(f"m{i}") for i, j in enumerate(at)],
        *[F.stddev_pop(inputs[j]).alias(f"s{i}") for i, j in enumerate(at)],
    ).first()
    return Scaling(
        {n: row[f"m{i}"] or 0.0 for i, n in enumerate(names)},
        {n: row[f"s{i}"] or 1.0 for i, n in enumerate(names)},
    )


def moment_columns(names: Sequence[str]) -> list[Column]:
    """Aggregates for ``scaling_of``: moments of the rows, and how many they are by class."""
    picked = [F.col(n).cast("double") for n in names]
    return [
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(picked)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(picked)],
        F.count("*").alias("rows"),
        F.count_if(F.col(LABEL) == 1).alias("positives"),
        F.count_if(F.col(LABEL) == 0).alias("negatives"),
    ]


def scaling_of(moments: Mapping[str, float], names: Sequence[str], shares: Mapping[str, int]) -> Scaling:
    """The scaling of ``names`` out of ``moment_columns``, and of indicators out of the rows that have each of them set."""
    means = {n: moments[f"m{i}"] or 0.0 for i, n in enumerate(names)}
    deviations = {n: moments[f"s{i}"] or 1.0 for i, n in enumerate(names)}
    rows = moments["rows"]
    for n, k in shares.items():
        means[n] = k / rows
        deviations[n] = math.sqrt(k * (rows - k)) / rows or 1.0
    return Scaling(means, deviations)


def weights_of(positives: int, negatives: int) -> dict[str, float | None]:
    """``class_weights`` of known class sizes."""
    n = positives + negatives
    return {
        "positives": positives,
        "negatives": negatives,
        "weight_positive": n / (2 * positives) if positives else None,
        "weight_negative": n / (2 * negatives) if negatives else None,
        "scale_pos_weight": negatives / max(positives, 1),
    }


# --- long category lists -------------------------------------------------------------------------


@dataclass(frozen=True)
class Dictionary:
    """Category lists of any length as a table (column, value, at): ``at`` counts a column's values from 0, in their order.

    Inputs are the numeric features, then per column one place for each value but the first. ``sizes`` has the number of
    values by column. The table stays distributed: nothing here grows with the number of categories but it.
    """

    table: DataFrame
    numeric: tuple[str, ...]
    sizes: tuple[tuple[str, int], ...]

    def begins(self) -> dict[str, int]:
        """Place of each column's first indicator."""
        out, at = {}, len(self.numeric)
        for c, n in self.sizes:
            out[c] = at
            at += max(n - 1, 0)
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        self.table.write.mode("overwrite").parquet(f"{path}/values")
        text = json.dumps({"numeric": self.numeric, "sizes": self.sizes})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/sizes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Dictionary:
        raw = json.loads(spark.read.text(f"{path}/sizes", wholetext=True).first()["value"])
        return Dictionary(spark.read.parquet(f"{path}/values"), tuple(raw["numeric"]), tuple((c, n) for c, n in raw["sizes"]))


def fit_dictionary(df: DataFrame, categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC_FEATURES) -> Dictionary:
    """The same lists as ``fit_encoding``, without its limit: values are ranked over slices, by column."""
    values = category_counts(df, categorical).withColumn("one", F.lit(1).cast("long"))
    ranked = running_totals(values, "value", ["one"], ["column"])
    table = cut_lineage(ranked.select("column", "value", F.col("before_one").alias("at")))
    found = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
    return Dictionary(table, tuple(numeric), tuple((c, found.get(c, 0)) for c in categorical))


def category_places(df: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Add ``<column>_at``: the place of each row's indicator among the inputs; null where a row has none set.

    Each column is looked up by a join, which adaptive execution broadcasts while the list is small and splits where a
    category is hot.
    """
    out = df
    for c, begin in dictionary.begins().items():
        listed = dictionary.table.filter((F.col("column") == c) & (F.col("at") > 0))
        listed = listed.select(F.col("value").alias(c), (F.col("at") - 1 + begin).cast("int").alias(f"{c}_at"))
        out = out.join(listed, c, "left")
    return out.select(*df.columns, *[f"{c}_at" for c in dictionary.begins()])


def encode_sparse(df: DataFrame, dictionary: Dictionary, keep: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """``keep`` and ``features``, the inputs as one sparse vector per row; missing and unlisted categories have zeros."""
    placed = category_places(df, dictionary)
    begins, vectors = dictionary.begins(), []
    columns = [F.col(n).cast("double").alias(f"numeric_{i}") for i, n in enumerate(dictionary.numeric)]
    coded = {c: (f"code_{i}", n - 1) for i, (c, n) in enumerate(dictionary.sizes) if n > 1}
    # a row without a category has the number after the last, which the encoder leaves out
    columns += [F.coalesce(F.col(f"{c}_at") - begins[c], F.lit(n)).cast("double").alias(code) for c, (code, n) in coded.items()]
    wide = placed.select(*[F.col(k).alias(f"kept_{i}") for i, k in enumerate(keep)], *columns)
    if coded:
        vectors = [f"{code}_vector" for code, _ in coded.values()]
        encoder = OneHotEncoder(inputCols=[code for code, _ in coded.values()], outputCols=vectors, handleInvalid="keep")
        last = df.sparkSession.createDataFrame([tuple(float(n - 1) for _, n in coded.values())], [code for code, _ in coded.values()])
        wide = encoder.fit(last).transform(wide)
    inputs = [f"numeric_{i}" for i in range(len(dictionary.numeric))] + vectors
    assembled = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep").transform(wide)
    return assembled.select(*[F.col(f"kept_{i}").alias(k) for i, k in enumerate(keep)], "features")


# --- scaling -------------------------------------------------------------------------------------


def standardize(
    df: DataFrame, scaling: Scaling, names: Sequence[str], keep: Sequence[str] = ("transaction_id",)
) -> DataFrame:
    inputs = {n: f"input_{i}" for i, n in enumerate(df.columns)}
    numbered = df.toDF(*inputs.values())
    kept = [F.col(inputs[k]).alias(k) for k in keep]
    return numbered.select(*kept, *[scaling.apply(n, inputs[n]).alias(n) for n in names])


def class_weights(df: DataFrame) -> DataFrame:
    """Balanced class weights ``n / (2 * class size)`` and the negative-to-positive ratio."""
    sizes = df.agg(
        F.count_if(F.col(LABEL) == 1).alias("positives"), F.count_if(F.col(LABEL) == 0).alias("negatives")
    )
    n = F.col("positives") + F.col("negatives")
    return sizes.select(
        "positives",
        "negatives",
        ratio(n, F.col("positives") * 2).alias("weight_positive"),
        ratio(n, F.col("negatives") * 2).alias("weight_negative"),
        ratio(F.col("negatives"), F.greatest(F.col("positives"), F.lit(1))).alias("scale_pos_weight"),
    )
