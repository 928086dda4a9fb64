"""Leakage-safe transaction features: every history column looks only at earlier rows of its customer.

All rows are range-partitioned along (customer, time, id) into slices and take the same windows inside (customer, slice).
Only a customer at the edge of a slice can continue in the next one, so at most one customer per slice needs more: what its
earlier slices hold (sum and count of amounts, last place, devices seen, counts a day and an hour back) is carried over. No
customer, however large, has to fit one task, and sums are integers, so the number of slices never changes a value.

The 24h and 1h counts are differences of two growing frames, so a row costs the same however many rows its window holds (a
sliding frame would be summed afresh for every row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.functions.scalar import day_of_week, is_night, is_weekend
from riskweave.operators.ordered import SLICE, add_earlier_totals, quantiles, slice_by
from riskweave.schema import RATIO_EPSILON
from riskweave.session import cut_lineage

HISTORY = ("running_avg", "last_24h", "last_1h", "new_device", "location_change")
TIME, ID, CUSTOMER = "transaction_time", "transaction_id", "customer_id"
# window width in hours behind each count column
LOOKBACK = {"last_24h": 24, "last_1h": 1}
# Amounts are summed as whole units and billionths of one, both integers: exact in any order.
PARTS = 1_000_000_000
SUMS = ("amount_units", "amount_parts", "amount_counted")


def time_features(txns: DataFrame) -> DataFrame:
    """Hour, weekday (Monday 0), weekend and night flags, and ``log(1 + amount)``."""
    hour, day = F.hour(TIME), day_of_week(F.col(TIME))
    return txns.select(
        "*",
        hour.alias("hour"),
        day.alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
        is_night(hour).alias("is_night"),
        F.log1p("amount").alias("log_amount"),
    )


def sliced_rows(txns: DataFrame, slices: int | None = None) -> DataFrame:
    """The transactions in slices, written once."""
    units = F.floor("amount")
    summed = {
        "amount_units": F.coalesce(units, F.lit(0)),
        "amount_parts": F.coalesce(F.round((F.col("amount") - units) * PARTS).cast("long"), F.lit(0)),
        "amount_counted": F.col("amount").isNotNull().cast("long"),
    }
    return slice_by(txns.withColumns(summed), CUSTOMER, TIME, ID, slices=slices)


def add_history(txns: DataFrame, columns: Sequence[str] = HISTORY, slices: int | None = None) -> DataFrame:
    """Add the requested history columns; the running average is null where there is no earlier amount.

    Ids are taken to be unique, and rows to have an id, a customer and a time (``keyed_rows``). Without a number of slices
    it is the session's shuffle partitions, merged where they are small. A running average is exact to a billionth.
    """
    return history_of(sliced_rows(txns, slices), txns.columns, columns, slices)


def history_of(rows: DataFrame, kept: Sequence[str], columns: Sequence[str] = HISTORY, slices: int | None = None) -> DataFrame:
    """``kept`` and the history columns of ``sliced_rows``."""
    over = spanning_customers(rows)
    kept = [*kept, *[c for c in HISTORY if c in columns]]
    if not over.take(1):
        return _finished(_inside_slices(rows, columns), columns).select(*kept)
    listed = F.broadcast(over)  # a customer per slice at most
    within = _inside_slices(rows.join(listed, CUSTOMER, "left_anti"), columns)
    across = _carried(rows.join(listed, CUSTOMER, "left_semi"), columns, slices)
    return _finished(within, columns).select(*kept).unionByName(_finished(across, columns).select(*kept))


def spanning_customers(rows: DataFrame) -> DataFrame:
    """The customers with rows in several slices. Such a customer is the first or the last one of each of its slices."""
    edges = rows.groupBy(SLICE).agg(F.array(F.min(CUSTOMER), F.max(CUSTOMER)).alias("edge"))
    edges = edges.select(SLICE, F.explode("edge").alias(CUSTOMER)).distinct()
    return cut_lineage(edges.groupBy(CUSTOMER).agg(F.count("*").alias("n")).filter("n > 1").select(CUSTOMER))


def _place() -> Column:
    return F.struct(F.col("location_lat").alias("lat"), F.col("location_lon").alias("lon"))


def _distance() -> Column:
    north = F.col("location_lat") - F.col("place_before.lat")
    east = F.col("location_lon") - F.col("place_before.lon")
    return F.coalesce(F.sqrt(north * north + east * east), F.lit(0.0))


def _finished(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The history columns out of what the windows gathered."""
    total = F.col("amount_units_before").cast("double") + F.col("amount_parts_before") / F.lit(float(PARTS))
    made = {
        "running_avg": lambda: F.try_divide(total, F.col("amount_counted_before")),
        "location_change": _distance,
        # a missing device is no new one
        "new_device": lambda: (F.col("first_of_device") & F.col("device").isNotNull()).cast("int"),
    }
    out = rows
    for name in columns:
        out = out.withColumn(name, made[name]() if name in made else F.col(name).cast("double"))
    return out


# --- inside a slice ------------------------------------------------------------------------------


def _amounts_before(hours: int) -> Column:
    """Amounts of this customer and slice at or before one microsecond ahead of ``time - hours``."""
    return F.expr(
        f"count(amount) over (partition by {CUSTOMER}, {SLICE} order by {TIME} range between unbounded preceding"
        f" and interval '{hours}:00:00.000001' hour to second preceding)"
    )


def _inside_slices(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What each row's earlier rows in its slice give: sums, place, whether the device is new, and counts."""
    in_order = W.partitionBy(CUSTOMER, SLICE).orderBy(TIME, ID)
    picked = []
    if "new_device" in columns:
        of_device = W.partitionBy(CUSTOMER, SLICE, "device").orderBy(TIME, ID)
        picked.append((F.row_number().over(of_device) == 1).alias("first_of_device"))
    if "running_avg" in columns:
        earlier = in_order.rowsBetween(W.unboundedPreceding, -1)
        picked += [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in SUMS]
    if "location_change" in columns:
        picked.append(F.lag(_place()).over(in_order).alias("place_before"))
        picked.append((F.row_number().over(in_order) == 1).alias("first_of_slice"))
    counted = [c for c in LOOKBACK if c in columns]
    if counted:
        picked += [_amounts_before(0).alias("earlier"), *[_amounts_before(LOOKBACK[c]).alias(f"{c}_ago") for c in counted]]
    out = rows.select("*", *picked)
    return out.withColumns({c: F.col("earlier") - F.col(f"{c}_ago") for c in counted})


# --- customers that go on in another slice -------------------------------------------------------


def _carried(rows: DataFrame, columns: Sequence[str], slices: int | None) -> DataFrame:
    """``_inside_slices`` with what the customer's earlier slices hold."""
    out = _inside_slices(rows, columns)
    per_slice = rows.groupBy(CUSTOMER, SLICE).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max_by(_place(), F.struct(TIME, ID)).alias("place")
    )
    in_order = W.partitionBy(CUSTOMER).orderBy(SLICE)
    earlier = in_order.rowsBetween(W.unboundedPreceding, -1)
    # a row per slice, or two
    carry = per_slice.select(
        CUSTOMER,
        SLICE,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_carried") for c in SUMS],
        F.lag("place").over(in_order).alias("place_carried"),
    )
    out = out.join(carry, [CUSTOMER, SLICE])
    if "running_avg" in columns:
        out = out.withColumns({f"{c}_before": F.col(f"{c}_before") + F.col(f"{c}_carried") for c in SUMS})
    if "location_change" in columns:
        before = F.when(F.col("first_of_slice"), F.col("place_carried")).otherwise(F.col("place_before"))
        out = out.withColumn("place_before", before)
    if "new_device" in columns:
        out = _with_seen_devices(out, rows)
    if set(columns) & set(LOOKBACK):
        out = _with_counts(out, rows, slices)
    return out


def _with_seen_devices(out: DataFrame, rows: DataFrame) -> DataFrame:
    """Of a device's first rows in each slice only the first is new. They are few: one per slice and device."""
    firsts = rows.filter(F.col("device").isNotNull()).groupBy(CUSTOMER, "device", SLICE).agg(F.min(F.struct(TIME, ID)).alias("at"))
    first = firsts.groupBy(CUSTOMER, "device").agg(F.min("at").alias("at"))
    marks = first.select(CUSTOMER, f"at.{TIME}", f"at.{ID}").distinct().withColumn("is_first", F.lit(True))
    joined = out.join(marks, [CUSTOMER, TIME, ID], "left")
    return joined.withColumn("first_of_device", F.col("first_of_device") & F.coalesce("is_first", F.lit(False)))


def _with_counts(out: DataFrame, rows: DataFrame, slices: int | None) -> DataFrame:
    """Counts in [t - w, t) as a difference of running counts at t and at t - w, over all slices.

    Rows are first summed per distinct time. Every distinct time asks three questions (offsets 0 h, 1 h, 24 h), each placed
    on the customer's time line next to the counts; one running total answers all.
    """
    per_time = rows.groupBy(CUSTOMER, TIME).agg(F.sum("amount_counted").alias("n"))
    marks = []
    for hours in (0, *LOOKBACK.values()):
        at = F.col(TIME) - F.expr(f"interval '{hours}' hour")
        own = F.col("n") if hours == 0 else F.lit(0).cast("long")
        marks.append(F.struct(at.alias("at"), own.alias("n"), F.lit(hours).alias("hours")))
    line = per_time.select(CUSTOMER, F.col(TIME).alias("asked"), F.explode(F.array(*marks)).alias("mark"))
    sliced = slice_by(line.select(CUSTOMER, "asked", "mark.*"), CUSTOMER, "at", slices=slices)
    strictly_before = F.expr(
        f"sum(n) over (partition by {CUSTOMER}, {SLICE} order by at range between unbounded preceding"
        " and interval '0:00:00.000001' hour to second preceding)"
    )
    answered = add_earlier_totals(sliced, [CUSTOMER], ["n"]).withColumn(
        "count", F.col("before_n") + F.coalesce(strictly_before, F.lit(0))
    )

    def count_at(hours: int) -> Column:
        return F.max(F.when(F.col("hours") == hours, F.col("count")))

    counts = answered.groupBy(CUSTOMER, F.col("asked").alias(TIME)).agg(
        *[(count_at(0) - count_at(hours)).alias(name) for name, hours in LOOKBACK.items()]
    )
    return out.drop(*LOOKBACK).join(counts, [CUSTOMER, TIME])


# --- the feature table ---------------------------------------------------------------------------


def median_amount(txns: DataFrame) -> float | None:
    """Exact median amount, the stand-in average of a customer without earlier amounts."""
    row = quantiles(txns, "amount", {"median": 0.5}).first()
    return row["median"] if row else None


def with_ratio(history: DataFrame, fill_value: float | None) -> DataFrame:
    """Fill the running average, and relate the amount to it."""
    average = F.coalesce(F.col("running_avg"), F.lit(fill_value).cast("double"))
    return history.withColumn("cust_running_avg_amount", average).withColumn(
        "amount_vs_customer_avg", F.col("amount") / (F.col("cust_running_avg_amount") + RATIO_EPSILON)
    )


def build_features(txns: DataFrame, fill_value: float | None = None, slices: int | None = None) -> DataFrame:
    """All features of every transaction, one row each.

    ``fill_value`` replaces a missing running average; without it the median of all amounts given is
    used. Training passes the median of its own split, so that nothing later leaks in.
    """
    rows = sliced_rows(txns, slices)
    return features_of(rows, txns.columns, median_amount(rows) if fill_value is None else fill_value, slices)


def features_of(rows: DataFrame, kept: Sequence[str], fill_value: float | None, slices: int | None = None) -> DataFrame:
    """``kept`` and all features of ``sliced_rows``."""
    history = history_of(rows, kept, HISTORY, slices)
    # row-local features come last, so the shuffle carries the raw columns only
    return time_features(with_ratio(history, fill_value)).select(
        *kept,
        "hour",
        "day_of_week",
        "is_weekend",
        "is_night",
        "log_amount",
        "cust_running_avg_amount",
        "amount_vs_customer_avg",
        F.col("last_24h").alias("transactions_last_24h"),
        F.col("last_1h").alias("transactions_last_1h"),
        "new_device",
        "location_change",
    )
