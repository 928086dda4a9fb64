"""Exact running totals, quantiles and cut points over a global order, without a one-task sort.

The rows are range-partitioned by the order keys, so each partition ("slice") holds one contiguous
stretch of the order however skewed the keys are. Per-slice totals are one row per slice and group;
their running sum gives every slice its starting value, and a window inside the slice does the rest.
The slice number is written out once (reliable checkpoint), because a range partitioning that is
computed again may choose other boundaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.functions.scalar import MICROS_PER_DAY, micros
from riskweave.session import cut_lineage

SLICE = "slice_no"


def slice_by(df: DataFrame, *keys: str | Column, slices: int | None = None) -> DataFrame:
    """Add ``slice_no``: ascending along ``keys``, with equal keys always in the same slice.

    Without a number of slices it is the session's shuffle partitions, which adaptive execution merges
    where they are small.
    """
    ranged = df.repartitionByRange(*keys) if slices is None else df.repartitionByRange(slices, *keys)
    return cut_lineage(ranged.withColumn(SLICE, F.spark_partition_id()))


def add_earlier_totals(sliced: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Add ``before_<c>`` (total over earlier slices of the group) and ``total_<c>`` (whole group).

    The joined side has at most one row per slice plus one per group: callers keep the number of
    groups bounded (classes, models, a customer per slice), so it is safe to broadcast.
    """
    group = W.partitionBy(*by)
    earlier = group.orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    per_slice = sliced.groupBy(*by, SLICE).agg(*[F.sum(c).alias(c) for c in sums])
    offsets = per_slice.select(
        *by,
        SLICE,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums],
        *[F.sum(c).over(group).alias(f"total_{c}") for c in sums],
    )
    return sliced.join(F.broadcast(offsets), [*by, SLICE])


def running_totals(
    df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Add ``before_<c>``, the exact total of ``c`` over all rows of the group ordered before this one,
    and ``total_<c>``. ``df`` holds one row per (``by``, ``order``), so heavy keys are already collapsed.
    """
    key = F.col(order).desc() if descending else F.col(order).asc()
    sliced = slice_by(df, *by, key)
    window = W.partitionBy(*by, SLICE).orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    kept = [c for c in sliced.columns if c != SLICE]
    return add_earlier_totals(sliced, by, sums).select(
        *kept,
        *[(F.col(f"before_{c}") + F.coalesce(F.sum(c).over(window), F.lit(0))).alias(f"before_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
    )


def placed_values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct non-null value with its count ``n`` and the ranks before it, ``before_n``."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    return running_totals(counts, value, ["n"], by)


def interpolated(placed: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, read off the output of ``placed_values``."""

    def at_rank(rank: Column) -> Column:
        covered = (F.col("before_n") <= rank) & (rank < F.col("before_n") + F.col("n"))
        return F.max(F.when(covered, F.col(value).cast("double")))

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("total_n") - 1)

    picks = []
    for name, p in probabilities.items():
        picks += [
            at_rank(F.floor(position(p))).alias(f"{name}_low"),
            at_rank(F.ceil(position(p))).alias(f"{name}_high"),
        ]
    picked = placed.groupBy(*by).agg(F.max("total_n").alias("total_n"), *picks)
    return picked.select(
        *by,
        *[
            (
                F.col(f"{name}_low")
                + (F.col(f"{name}_high") - F.col(f"{name}_low")) * (position(p) - F.floor(position(p)))
            ).alias(name)
            for name, p in probabilities.items()
        ],
    )


def quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = (), accuracy: int | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    Rows are first counted per distinct value; the distinct values are ranked over slices, at every size alike. With an
    ``accuracy`` mergeable sketches are used instead, one pass without ranking: each quantile is then a value of the group
    whose rank is at most ``1 / accuracy`` of the group's rows, and one row, away (see ``rank_errors``).
    """
    if accuracy is not None:
        found = F.approx_percentile(F.col(value).cast("double"), list(probabilities.values()), accuracy)
        sketched = df.groupBy(*by).agg(found.alias("found"))
        return sketched.select(*by, *[F.get("found", F.lit(i)).alias(name) for i, name in enumerate(probabilities)])
    return interpolated(placed_values(df, value, by), value, probabilities, by)


def rank_errors(df: DataFrame, value: str, found: DataFrame, probabilities: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(by, quantile, value, rows, rank_error): how far the rank of each found quantile is from the one asked for.

    The error is a share of the group's rows, by exact ranks; equal values count as the nearest of their ranks.
    """
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("quantile"), F.lit(float(p)).alias("p"), F.col(n).alias("value")) for n, p in probabilities.items()]))
    asked = found.select(*by, asked.alias("asked")).select(*by, "asked.*")
    placed = placed_values(df.withColumn(value, F.col(value).cast("double")), value, by).withColumnRenamed(value, "value")
    target = F.col("p") * F.col("total_n")
    gap = F.greatest(F.col("before_n") + 1 - target, target - F.col("before_n") - F.col("n"), F.lit(0.0))
    joined = placed.join(asked, [*by, "value"])
    return joined.select(*by, "quantile", "value", F.col("total_n").alias("rows"), (gap / F.col("total_n")).alias("rank_error"))


# --- order statistics on (time, id) --------------------------------------------------------------

BINS = 4096
FINISH_ROWS = 200_000


def span(df: DataFrame, time: str = "transaction_time") -> tuple[int, int | None, int | None]:
    """Row count and the first and last microsecond, in one aggregation."""
    row = df.agg(*span_columns(time)).first()
    return row["n"], row["low"], row["high"]


def span_columns(time: str = "transaction_time") -> list[Column]:
    us = micros(F.col(time))
    return [F.count("*").alias("n"), F.min(us).alias("low"), F.max(us).alias("high")]


def keys_at_ranks(
    df: DataFrame,
    ranks: Sequence[int],
    bounds: tuple[int, int],
    time: str = "transaction_time",
    tie: str = "transaction_id",
    finish_rows: int = FINISH_ROWS,
) -> dict[int, tuple[str, str]]:
    """The (time, tie) keys at the given 0-based ranks of the order by ``time, tie``.

    No row moves: each round counts rows per equal-width time bin (at most ``BINS`` counts come back)
    and narrows to the bins holding the ranks, a filter that reaches the scan. Bins of at most
    ``finish_rows`` rows are ranked directly; one instant with more rows than that is ranked over slices.
    """
    keys = df.select(F.col(time).alias("t"), F.col(tie).alias("id"))
    found: dict[int, tuple[str, str]] = {}
    small: list[tuple[int, int, int, list[int]]] = []
    # (first microsecond, last microsecond, rows before it, ranks inside it)
    pending = [(*bounds, 0, sorted(set(ranks)))] if ranks else []
    while pending:
        low, high, before, wanted = pending.pop()
        width = (high - low) // BINS + 1
        offset = micros(F.col("t")) - F.lit(low)
        counts = (
            keys.filter(_between(low, high))
            .groupBy(((offset - offset % F.lit(width)) / F.lit(width)).cast("long").alias("bin"))
            .agg(F.count("*").alias("n"))
            .orderBy("bin")
            .collect()
        )
        for row in counts:
            here = [r for r in wanted if before <= r < before + row["n"]]
            first = low + row["bin"] * width
            last = min(first + width - 1, high)
            if here and row["n"] <= finish_rows:
                small.append((first, last, before, here))
            elif here and first == last:
                found.update(_keys_in_instant(keys.filter(_between(first, last)), before, here))
            elif here:
                pending.append((first, last, before, here))
            before += row["n"]
    if small:
        found.update(_keys_in_small_bins(keys, small))
    return found


def _between(first: int, last: int) -> Column:
    return F.col("t").between(_instant(first), _instant(last))


def _instant(us: int) -> Column:
    """Zone-less timestamp literal; the optimiser folds it, so the comparison still reaches the scan."""
    days, rest = divmod(us, MICROS_PER_DAY)
    seconds, fraction = divmod(rest, 1_000_000)
    return F.expr(
        f"cast(date_from_unix_date({days}) as timestamp_ntz)"
        f" + make_dt_interval(0, 0, 0, cast({seconds}.{fraction:06d} as decimal(18, 6)))"
    )


def _keys_in_small_bins(
    keys: DataFrame, bins: Sequence[tuple[int, int, int, list[int]]]
) -> dict[int, tuple[str, str]]:
    """Rank the rows of a few bins of checked size, one window partition per bin."""
    start, inside = F.lit(None).cast("long"), F.lit(False)
    for first, last, before, _ in bins:
        start = F.when(_between(first, last), F.lit(before)).otherwise(start)
        inside = inside | _between(first, last)
    in_bin = W.partitionBy("start").orderBy("t", "id")
    ranked = keys.filter(inside).withColumn("start", start)
    ranked = ranked.withColumn("rank", F.col("start") + F.row_number().over(in_bin) - 1)
    return _collect_keys(ranked.filter(F.col("rank").isin([r for *_, here in bins for r in here])))


def _keys_in_instant(rows: DataFrame, before: int, wanted: Sequence[int]) -> dict[int, tuple[str, str]]:
    per_id = rows.groupBy("t", "id").agg(F.count("*").alias("n"))
    first = F.col("before_n") + F.lit(before)
    each = F.explode(F.array(*[F.lit(r).cast("long") for r in wanted]))
    placed = running_totals(per_id, "id", ["n"]).withColumn("rank", each)
    return _collect_keys(placed.filter((first <= F.col("rank")) & (F.col("rank") < first + F.col("n"))))


def _collect_keys(hits: DataFrame) -> dict[int, tuple[str, str]]:
    rows = hits.select("rank", F.col("t").cast("string").alias("t"), "id").collect()
    return {r["rank"]: (r["t"], r["id"]) for r in rows}
