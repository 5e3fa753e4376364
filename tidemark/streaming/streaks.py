"""Failure streaks as keyed state: one state per dataset in the RocksDB store, read back from there.

State per dataset: the newest run that did not fail, the failed runs after it, and a count of those so old
that no run can come in between any more. Runs may arrive in any order, and more than once, within ``delay``
of the newest; those that come later than that are dropped by the watermark (``alerts.failure_streaks`` keeps a
log instead, without such a bound).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators import alerts
from tidemark.sources import tables
from tidemark.streaming.alerts import _as_alerts

# The processor runs in Python workers, where the package need not be installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: How late a run may be, and after how long without runs a dataset's state is dropped.
DELAY, FORGET_DAYS = "40 days", 400
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAK = "consecutive_failures bigint, latest_run_id string, latest_error string"
DAY_MS = 86_400_000


class Streaks(StatefulProcessor):
    """Folds a dataset's runs into its trailing streak; emits the streak whenever it may have changed."""

    def __init__(self, forget_days: int) -> None:
        self.forget_ms = forget_days * DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "at bigint, run_id string")
        self.failures = handle.getMapState("failures", "at bigint, run_id string", "error string")
        self.settled = handle.getValueState("settled", f"{STREAK}, at bigint")
        self.seen = handle.getValueState("seen", "at bigint")
        self.streak = handle.getValueState("streak", STREAK)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        newest = self.newest.get() if self.newest.exists() else None
        newest = None if newest is None else tuple(newest)
        settled = self.settled.get() if self.settled.exists() else None
        held = {tuple(k): v[0] for k, v in self.failures.iterator()} if self.failures.exists() else {}
        known, last = dict(held), self.seen.get()[0] if self.seen.exists() else 0
        for row in rows:
            place = (row.at, row.run_id)
            last = max(last, row.at)
            if row.status != "failed":
                newest = place if newest is None else max(newest, place)
            elif settled is None or place > (settled[3], settled[1]):
                held[place] = max(held.get(place) or "", row.error or "") or None
        if newest is not None:
            held = {p: e for p, e in held.items() if p > newest}
            if settled is not None and (settled[3], settled[1]) <= newest:
                self.settled.clear()
                settled = None
            self.newest.update(newest)
        for place in known.keys() - held.keys():
            self.failures.removeKey(place)
        for place, error in held.items():
            if place not in known or known[place] != error:
                self.failures.updateValue(place, (error,))
        self.seen.update((last,))
        self._wake(held, last)
        yield self._emit(key, held, settled)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        """Failures behind the watermark become a count; a dataset silent for long is forgotten."""
        now = timerValues.getCurrentWatermarkInMs() * 1000
        last = self.seen.get()[0] if self.seen.exists() else 0
        if now >= last + self.forget_ms * 1000:
            for state in (self.newest, self.failures, self.settled, self.seen, self.streak):
                state.clear()
            return
        held = {tuple(k): v[0] for k, v in self.failures.iterator()} if self.failures.exists() else {}
        settled = self.settled.get() if self.settled.exists() else None
        old = sorted(p for p in held if p[0] < now)
        if old:
            count = (settled[0] if settled else 0) + len(old)
            settled = (count, old[-1][1], held[old[-1]], old[-1][0])
            self.settled.update(settled)
            for place in old:
                self.failures.removeKey(place)
                del held[place]
        self._wake(held, last)
        yield from ()

    def _wake(self, held: dict, last: int) -> None:
        """A timer for the oldest failure and one for silence; those of earlier calls are void."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held:
            self.handle.registerTimer(min(held)[0] // 1000 + 1)
        self.handle.registerTimer(last // 1000 + self.forget_ms)

    def _emit(self, key, held: dict, settled: tuple | None) -> Row:
        count = len(held) + (settled[0] if settled else 0)
        latest = max(held) if held else None
        run_id = latest[1] if latest else settled[1] if settled else None
        error = held[latest] if latest else settled[2] if settled else None
        self.streak.update((count, run_id, error))
        return Row(dataset_id=key[0], consecutive_failures=count, latest_run_id=run_id, latest_error=error)

    def close(self) -> None:
        pass


def failure_streaks(
    runs: DataFrame,
    alerts_path: str,
    checkpoint: str,
    name: str,
    threshold: int = alerts.FAILURE_THRESHOLD,
    delay: str = DELAY,
    forget_days: int = FORGET_DAYS,
) -> StreamingQuery:
    """Alert whenever a dataset's trailing failures have reached the threshold after a micro-batch.

    The session's state store provider is set to RocksDB while the query starts; a query keeps its own.
    """
    spark = runs.sparkSession
    shaped = runs.where("status is not null and started_at is not null and run_id is not null").select(
        "dataset_id", "run_id", "started_at", F.unix_micros("started_at").alias("at"), "status", "error"
    )
    states = (
        shaped.withWatermark("started_at", delay)
        .groupBy("dataset_id")
        .transformWithState(Streaks(forget_days), f"dataset_id string, {STREAK}", "Update", "EventTime")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        reached = batch.where(F.col("consecutive_failures") >= threshold)
        tables.write_batch(_as_alerts(reached), alerts_path, name, batch_id)

    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, PROVIDER)
    try:
        return (
            states.writeStream.queryName(name)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def read_streaks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Streaks as they stand, from the state store: a row per dataset, however long the history."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "streak").load()
    return state.select("key.dataset_id", "value.*").where("consecutive_failures > 0")


def standing_alerts(
    spark: SparkSession, checkpoint: str, alerts_path: str, threshold: int = alerts.FAILURE_THRESHOLD
) -> DataFrame:
    """Raised alerts whose streak still stands, with its present length."""
    raised = tables.read_table(spark, alerts_path, alerts.schemas.ALERT).select("alert_id").distinct()
    stands = read_streaks(spark, checkpoint).where(F.col("consecutive_failures") >= threshold)
    return _as_alerts(stands).join(raised, "alert_id", "left_semi")
