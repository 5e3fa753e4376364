"""Streaming failure streaks and event counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators import alerts
from tidemark.sources import tables
from tidemark.streaming.ingest import run_batches

#: Runs that decide the streaks: the newest that did not fail and the failures after it.
STATE = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
SNAPSHOT_EVERY = 100


def deciding_runs(runs: DataFrame) -> DataFrame:
    """Per dataset the newest run that did not fail and the failed runs after it, each once.

    Reducing parts and then their union gives the same as reducing everything, so order of arrival
    and repeated delivery make no difference.
    """
    key = ["dataset_id", "run_id", "started_at", "status"]
    once = runs.where("status is not null").groupBy(*key).agg(F.max("error").alias("error"))
    place = F.struct("started_at", "run_id")
    newest = once.groupBy("dataset_id").agg(F.max(F.when(F.col("status") != "failed", place)).alias("newest"))
    decides = F.col("newest").isNull() | (place > F.col("newest")) | ((place == F.col("newest")) & (F.col("status") != "failed"))
    return once.join(newest, "dataset_id").where(decides).select(*STATE.fieldNames())


def failure_streaks(
    runs: DataFrame,
    state_path: str,
    alerts_path: str,
    checkpoint: str,
    name: str,
    threshold: int = alerts.FAILURE_THRESHOLD,
    snapshot_every: int = SNAPSHOT_EVERY,
) -> StreamingQuery:
    """Alert when a dataset's trailing failures reach the threshold, across micro-batches.

    State is a log of the runs that decide the streaks, one slice per micro-batch. Every
    ``snapshot_every`` batches the slice holds what decides all datasets, and older slices, told
    by their names, are no longer read. Runs may arrive late, in any order and more than once.
    """
    spark = runs.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        oldest = max(batch_id - 1, 0) // snapshot_every * snapshot_every
        known = _state_slices(spark, state_path, tables.slice_name(name, oldest), tables.slice_name(name, batch_id))
        arrived = batch.select(*STATE.fieldNames())
        whole = batch_id % snapshot_every == 0
        tables.write_batch(deciding_runs(known.unionByName(arrived) if whole else arrived), state_path, name, batch_id)
        touched = known.join(arrived.select("dataset_id").distinct(), "dataset_id", "left_semi")
        reached = alerts.consecutive_failures(deciding_runs(touched.unionByName(arrived)), threshold)
        tables.write_batch(_as_alerts(reached), alerts_path, name, batch_id)

    return run_batches(runs, write, checkpoint, name)


def _state_slices(spark, path: str, first: str, end: str) -> DataFrame:
    """State written from slice ``first`` on and before slice ``end``: a filter on the partition column."""
    if not tables.exists(spark, path):
        return spark.createDataFrame([], STATE)
    sliced = T.StructType([*STATE.fields, T.StructField(tables.BATCH_COLUMN, T.StringType())])
    place = F.col(tables.BATCH_COLUMN)
    return spark.read.schema(sliced).parquet(path).where((place >= first) & (place < end)).drop(tables.BATCH_COLUMN)


def _as_alerts(streaks: DataFrame) -> DataFrame:
    return alerts.as_alerts(
        streaks,
        alerts.CONSECUTIVE_FAILURES,
        "dataset_id",
        F.format_string("%s failed %d times in a row", "dataset_id", "consecutive_failures"),
        ["consecutive_failures", "latest_run_id", "latest_error"],
        ["latest_run_id"],
    )


def read_alerts(spark, alerts_path: str) -> DataFrame:
    """Every alert that was raised, once."""
    return tables.first_by_key(
        tables.read_table(spark, alerts_path, schemas.ALERT), ("alert_id",), ("message",)
    )


def read_streaks(spark, state_path: str) -> DataFrame:
    """Streaks as they stand."""
    return alerts.failure_streaks(deciding_runs(tables.read_table(spark, state_path, STATE)))


def standing_alerts(
    spark, state_path: str, alerts_path: str, threshold: int = alerts.FAILURE_THRESHOLD
) -> DataFrame:
    """Raised alerts whose streak still stands, with its present length."""
    raised = tables.read_table(spark, alerts_path, schemas.ALERT).select("alert_id").distinct()
    stands = read_streaks(spark, state_path).where(F.col("consecutive_failures") >= threshold)
    return _as_alerts(stands).join(raised, "alert_id", "left_semi")


def event_counts(stream: DataFrame, at: str, by: list[str], width: str, delay: str) -> DataFrame:
    """Events per type and window, open windows included once written by ``keep_windows``."""
    return (
        stream.withWatermark(at, delay)
        .groupBy(F.window(at, width), *by)
        .agg(F.count("*").alias("events"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "events")
    )


def append_windows(counts: DataFrame, path: str, checkpoint: str, name: str) -> StreamingQuery:
    return (
        counts.writeStream.queryName(name)
        .format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keep_windows(counts: DataFrame, path: str, checkpoint: str, name: str) -> StreamingQuery:
    """Write the counts that each micro-batch changes, those of windows still open too."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.write_batch(batch, path, name, batch_id)

    return (
        counts.writeStream.queryName(name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def read_windows(spark, path: str, schema) -> DataFrame:
    """Latest count of every window. Counts only grow, so the latest is the greatest."""
    keys = [f.name for f in schema if f.name != "events"]
    return tables.read_table(spark, path, schema).groupBy(*keys).agg(F.max("events").alias("events"))
