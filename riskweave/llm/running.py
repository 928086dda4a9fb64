"""Running totals over an order that no single task has to sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.operators.ordered import SLICE, slice_by
from riskweave.session import cut_lineage


def with_starts(df: DataFrame, by: Sequence[str], order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Add ``before_<c>``: the exact total of ``c`` over the rows of the group ordered before this one.

    Rows are range-partitioned along (by, order) and the slice number is written out, so it stays the same when a task
    runs again. A slice starts from the totals of the slices before it; these are one row per slice and group. Rows equal
    in ``order`` share a slice and are told apart arbitrarily: callers make sure that they are interchangeable.
    """
    sliced = slice_by(df, *by, *order)
    per_slice = sliced.groupBy(*by, SLICE).agg(*[F.sum(c).alias(c) for c in sums])
    earlier = W.partitionBy(*by).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    offsets = cut_lineage(
        per_slice.select(
            *[F.col(c).alias(f"of_{c}") for c in by],
            F.col(SLICE).alias("of_slice"),
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"offset_{c}") for c in sums],
        )
    )
    same = F.col(SLICE) == F.col("of_slice")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    inside = W.partitionBy(*by, SLICE).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return sliced.join(offsets, same).select(
        *df.columns, *[(F.col(f"offset_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"before_{c}") for c in sums]
    )
