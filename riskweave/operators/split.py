"""Chronological train / validation / test split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.ordered import FINISH_ROWS, keys_at_ranks, span
from riskweave.schema import LABEL, TRAIN_SHARE, VALIDATION_SHARE

SPLIT = "split"


@dataclass(frozen=True)
class Cuts:
    """First (time, id) of the validation part and of the test part."""

    validation: tuple[str, str] | None
    test: tuple[str, str] | None

    def column(self) -> Column:
        """The part a row belongs to, from literals alone: assigning it moves no rows."""
        part = F.lit("train")
        for key, name in ((self.validation, "validation"), (self.test, "test")):
            if key is not None:
                time, tie = F.lit(key[0]).cast("timestamp_ntz"), F.lit(key[1])
                reached = (F.col("transaction_time") > time) | (
                    (F.col("transaction_time") == time) & (F.col("transaction_id") >= tie)
                )
                part = F.when(reached, F.lit(name)).otherwise(part)
        return part


def chronological_cuts(
    txns: DataFrame,
    train: float = TRAIN_SHARE,
    validation: float = VALIDATION_SHARE,
    finish_rows: int = FINISH_ROWS,
    known: tuple[int, int | None, int | None] | None = None,
) -> Cuts:
    """Exact cut keys: the rows at positions ``int(n * train)`` and ``int(n * (train + validation))``.

    ``known`` is the ``span`` of the rows where it has been gathered already.
    """
    n, low, high = known or span(txns)
    ends = [int(n * train), int(n * (train + validation))]
    keys = keys_at_ranks(txns, [e for e in ends if e < n], (low, high), finish_rows=finish_rows)
    return Cuts(keys.get(ends[0]), keys.get(ends[1]))


def with_split(txns: DataFrame, cuts: Cuts | None = None) -> DataFrame:
    """Add ``split``. The label stays on its own row, so every part keeps its own ids and amounts."""
    cuts = cuts or chronological_cuts(txns)
    return txns.withColumn(SPLIT, cuts.column())


def split_summary(rows: DataFrame) -> DataFrame:
    """Rows and fraud rate of each part."""
    return rows.groupBy(SPLIT).agg(F.count("*").alias("row_count"), F.avg(LABEL).alias("fraud_rate"))
