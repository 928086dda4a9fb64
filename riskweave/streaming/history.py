"""History features of a stream of transactions: what ``features.add_history`` gives a table, row by row as time goes on.

Each customer has a state: the rows that wait for the watermark, the times of the last 24 hours with their counts, the
devices seen, the last place and the sums. A row waits until no earlier one can arrive, so rows are answered in the order of
(time, id) whatever order they arrive in, and a restarted query goes on from its checkpoint. Rows behind the watermark are
dropped by Spark and counted in the query's progress. Counts older than 24 hours expire, also of customers who fell silent.

The state is per key: a customer's rows between two watermarks are answered by one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskweave.functions.scalar import micros
from riskweave.operators.features import CUSTOMER, HISTORY, ID, LOOKBACK, PARTS, TIME
from riskweave.schema import TRANSACTIONS

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR = 3_600_000_000
DAY = 24 * HOUR
# Kept devices that are read at once, at most; beyond them each device is asked for.
KEPT_DEVICES = 500
# A row of this time ends a replay: it moves the watermark past everything and is not answered itself.
END = "9999-01-01 00:00:00"
WAITING = "time_us long, transaction_id string, amount double, device string, lat double, lon double"
ANSWER = f"{CUSTOMER} long, time_us long, {ID} string, running_avg double, last_24h double, last_1h double, new_device int, location_change double"


class CustomerHistory(StatefulProcessor):
    """One customer's state; answers the waiting rows that the watermark has passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.recent = handle.getListState("recent", "time_us long, n long")
        self.devices = handle.getMapState("devices", "device string", "seen boolean")
        self.last = handle.getValueState("last", "lat double, lon double, units long, parts long, counted long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived: list[tuple] = []
        for part in rows:
            columns = ("time_us", ID, "amount", "device", "location_lat", "location_lon")
            arrived += zip(*([None if x is None or x != x else x for x in part[c].tolist()] for c in columns), strict=True)
        self.waiting.appendList(arrived)
        self._wake(min(r[0] for r in arrived))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.waiting.get(), key=lambda r: (r[0], r[1]))
        ready = [r for r in waiting if r[0] <= passed]
        later = waiting[len(ready) :]
        last = self.last.get()
        # no counts or devices are kept of a customer without an answered row
        recent = list(self.recent.get()) if last else []
        answers = self._answer(key[0], ready, recent, last) if ready else None
        kept = [r for r in recent if r[0] >= passed - DAY]
        for state, had, rows in ((self.waiting, waiting, later), (self.recent, recent, kept)):
            if rows:
                state.put(rows)
            elif had:
                state.clear()
        if later:
            self._wake(later[0][0])
        elif kept:
            self._wake(kept[-1][0] + DAY)  # to let the counts expire
        if answers is not None:
            yield answers

    def _wake(self, time_us: int) -> None:
        self.handle.registerTimer(-(-time_us // 1000))

    def _seen(self, wanted: set[str]) -> dict[str, bool]:
        """Which of the devices the customer had before. One read of a few kept ones tells it mostly, each read is a round trip."""
        seen = dict.fromkeys(wanted, False)
        for i, (device,) in enumerate(self.devices.keys(), 1):
            if device in seen:
                seen[device] = True
            if i == KEPT_DEVICES:
                return {d: known or self.devices.containsKey((d,)) for d, known in seen.items()}
        return seen

    def _answer(self, customer: int, rows: list[tuple], recent: list[tuple], last: tuple | None) -> pd.DataFrame:
        """Answers ``rows`` in order; ``recent`` gets their times."""
        lat, lon, units, parts, counted = last or (None, None, 0, 0, 0)
        times = np.array([t for t, _ in recent] + [r[0] for r in rows], np.int64)
        amounts = np.array([n for _, n in recent] + [int(r[2] is not None) for r in rows], np.int64)
        so_far = np.concatenate([[0], np.cumsum(amounts)])
        at = times[len(recent) :]
        before = so_far[np.searchsorted(times, at, "left")]
        counts = {c: before - so_far[np.searchsorted(times, at - h * HOUR, "left")] for c, h in LOOKBACK.items()}
        devices = {r[3] for r in rows if r[3] is not None}
        known = self._seen(devices) if last and devices else dict.fromkeys(devices, False)
        averages, new, moved = [], [], []
        for i, (_, _, amount, device, here_lat, here_lon) in enumerate(rows):
            averages.append((float(units) + parts / float(PARTS)) / counted if counted else None)
            new.append(int(device is not None and not known[device]))
            if new[-1]:
                known[device] = True
                self.devices.updateValue((device,), (True,))
            gaps = (here_lat, lat, here_lon, lon)
            moved.append(0.0 if None in gaps else math.sqrt((here_lat - lat) * (here_lat - lat) + (here_lon - lon) * (here_lon - lon)))
            lat, lon = here_lat, here_lon
            if amount is not None:
                whole = math.floor(amount)
                units, parts, counted = units + whole, parts + _half_up((amount - whole) * PARTS), counted + 1
        recent += [(int(t), int(n)) for t, n in zip(times[len(recent) :], amounts[len(recent) :], strict=True)]
        self.last.update((lat, lon, units, parts, counted))
        return pd.DataFrame(
            {
                CUSTOMER: customer,
                "time_us": at,
                ID: [r[1] for r in rows],
                "running_avg": pd.Series(averages, dtype="float64"),
                **{c: counts[c].astype(float) for c in LOOKBACK},
                "new_device": np.array(new, np.int32),
                "location_change": moved,
            }
        )


def _half_up(x: float) -> int:
    """Rounds as the batch features do."""
    return math.floor(x + 0.5)


def read_transactions(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Transactions arriving as parquet files in a folder."""
    return spark.readStream.schema(TRANSACTIONS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_history(arriving: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The history columns of every arriving transaction (``TRANSACTIONS``), ``delay`` after its time at the earliest.

    Rows that arrive more than ``delay`` behind the latest time seen are late. Rows without id, customer or time are not
    answered. The session needs the state store that ``history_session`` sets.
    """
    time = F.timestamp_micros(micros(F.col(TIME)))
    # the condition on time keeps the closing row in front of the watermark and out of the state
    keyed = (
        arriving.filter(F.col(CUSTOMER).isNotNull() & F.col(ID).isNotNull() & F.col(TIME).isNotNull())
        .withColumn("event_time", time)
        .withWatermark("event_time", delay)
        .filter(F.col("event_time") < F.timestamp_micros(micros(F.expr(f"timestamp_ntz'{END}'"))))
        .select(CUSTOMER, "event_time", micros(F.col(TIME)).alias("time_us"), ID, "amount", "device", "location_lat", "location_lon")
    )
    answered = keyed.groupBy(CUSTOMER).transformWithStateInPandas(CustomerHistory(), ANSWER, "append", "EventTime")
    instant = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(cast(time_us as decimal(20, 0)) / 1000000 as decimal(18, 6)))")
    return answered.select(ID, CUSTOMER, instant.alias(TIME), *HISTORY)


def history_session(spark: SparkSession) -> SparkSession:
    """A session that shares ``spark``'s context and keeps streaming state in RocksDB."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        if value := spark.conf.get(key, None):
            own.conf.set(key, value)
    own.conf.set(STORE, ROCKSDB)
    return own


def closing_row(spark: SparkSession) -> DataFrame:
    """One row that ends a replay: written after the last file, it lets everything that waits be answered."""
    fields = {ID: F.lit("end"), CUSTOMER: F.lit(0), TIME: F.expr(f"timestamp_ntz'{END}'") + F.expr("interval '1' day")}
    return spark.range(1).select(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TRANSACTIONS])


def start_history(arriving: DataFrame, output: str, checkpoint: str, delay: str = "1 hour", available_now: bool = False, interval: str = "1 minute") -> StreamingQuery:
    """Append the history of arriving transactions to a parquet sink, exactly once per transaction."""
    writer = (
        stream_history(arriving, delay)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
