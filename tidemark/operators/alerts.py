"""Alert detection over run history and quality results, all datasets in one job."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import keys
from tidemark.operators import runs as R

# Alert types and default limits.
CONSECUTIVE_FAILURES = "consecutive_failures"
FRESHNESS_BREACH = "freshness_breach"
QUALITY_FAILURE = "data_quality_blocking_failure"
DLQ_AGEING = "dlq_ageing"
FAILURE_THRESHOLD = 2
DEFAULT_MAX_LAG = timedelta(hours=48)


def failure_streaks(runs: DataFrame) -> DataFrame:
    """Trailing run of failures per dataset: length, latest run id and its error.

    Two aggregates rather than an ordered window, so no task holds a dataset's whole history:
    the last run that did not fail, then the failures after it.
    """
    place = F.struct("started_at", "run_id")
    last_other = runs.groupBy("dataset_id").agg(
        F.max(F.when(F.col("status") != "failed", place)).alias("last_other")
    )
    failed = runs.where("status = 'failed'").select(
        "dataset_id", place.alias("place"), F.struct("started_at", "run_id", "error").alias("run")
    )
    trailing = failed.join(last_other, "dataset_id").where(
        F.col("last_other").isNull() | (F.col("place") > F.col("last_other"))
    )
    return (
        trailing.groupBy("dataset_id")
        .agg(F.count("*").alias("consecutive_failures"), F.max("run").alias("run"))
        .select(
            "dataset_id",
            "consecutive_failures",
            F.col("run.run_id").alias("latest_run_id"),
            F.col("run.error").alias("latest_error"),
        )
    )


def consecutive_failures(runs: DataFrame, threshold: int = FAILURE_THRESHOLD) -> DataFrame:
    return failure_streaks(runs).where(F.col("consecutive_failures") >= threshold)


def freshness_state(
    runs: DataFrame, datasets: DataFrame, now: datetime, max_lag: timedelta = DEFAULT_MAX_LAG
) -> DataFrame:
    """Every dataset with its latest run and ``breach``: no run, not successful, or too old; else null."""
    latest = R.latest(runs).select(
        "dataset_id",
        F.col("run_id").alias("latest_run_id"),
        F.col("status").alias("latest_status"),
        F.col("finished_at").alias("latest_finished_at"),
    )
    lag = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros("latest_finished_at")) / 1_000_000
    breach = (
        F.when(F.col("latest_run_id").isNull(), "no run")
        .when(F.col("latest_status") != "success", "latest run not successful")
        .when(F.col("lag_seconds") > max_lag.total_seconds(), "too old")
    )
    return (
        datasets.select("dataset_id")
        .join(latest, "dataset_id", "left")
        .withColumn("lag_seconds", F.when(F.col("latest_status") == "success", lag))
        .withColumn("breach", breach)
    )


def freshness_breaches(
    runs: DataFrame, datasets: DataFrame, now: datetime, max_lag: timedelta = DEFAULT_MAX_LAG
) -> DataFrame:
    return freshness_state(runs, datasets, now, max_lag).where("breach is not null")


def quality_failures(results: DataFrame) -> DataFrame:
    """Tables with failing tests and the sorted ids of those tests (bounded by tests per table)."""
    return (
        results.where("status = 'fail'")
        .groupBy("table_name")
        .agg(F.sort_array(F.collect_set("test_id")).alias("failing_test_ids"))
    )


def dlq_ageing(dlq: DataFrame, slo: DataFrame, now: datetime) -> DataFrame:
    """Pending entries older than their dataset's ``max_lag_seconds``."""
    age = F.lit(now).cast("timestamp").cast("long") - F.col("quarantined_at").cast("long")
    pending = dlq.where("status = 'pending'").withColumn("age_seconds", age)
    return pending.join(slo, "dataset_id").where("age_seconds > max_lag_seconds")


def as_alerts(
    found: DataFrame, alert_type: str, dataset: str, message: Column, details: list[str], identity: list[str]
) -> DataFrame:
    """Rows for the alert table. The id follows from what the alert is about, so detecting the
    same condition twice gives the same row and a first-wins insert keeps one."""
    return found.select(
        keys.derived_id(F.lit(alert_type), dataset, *identity).alias("alert_id"),
        F.lit(alert_type).alias("alert_type"),
        F.col(dataset).alias("dataset_id"),
        message.alias("message"),
        F.to_json(F.struct(*details)).alias("details"),
    ).select(*[f.name for f in schemas.ALERT.fields])


def consecutive_failure_alerts(runs: DataFrame, threshold: int = FAILURE_THRESHOLD) -> DataFrame:
    found = consecutive_failures(runs, threshold)
    message = F.format_string("%s failed %d times in a row", "dataset_id", "consecutive_failures")
    details = ["consecutive_failures", "latest_run_id", "latest_error"]
    return as_alerts(found, CONSECUTIVE_FAILURES, "dataset_id", message, details, ["latest_run_id"])


def freshness_alerts(
    runs: DataFrame, datasets: DataFrame, now: datetime, max_lag: timedelta = DEFAULT_MAX_LAG
) -> DataFrame:
    found = freshness_breaches(runs, datasets, now, max_lag)
    message = F.format_string("%s is not fresh: %s", "dataset_id", "breach")
    details = ["latest_run_id", "latest_status", "lag_seconds"]
    return as_alerts(found, FRESHNESS_BREACH, "dataset_id", message, details, ["latest_run_id", "breach"])


def quality_alerts(results: DataFrame) -> DataFrame:
    found = quality_failures(results).withColumn("failing", F.array_join("failing_test_ids", ","))
    message = F.format_string("%d tests failing on %s", F.size("failing_test_ids"), F.col("table_name"))
    return as_alerts(found, QUALITY_FAILURE, "table_name", message, ["failing_test_ids"], ["failing"])


def run_checks(
    runs: DataFrame,
    datasets: DataFrame,
    now: datetime,
    max_lag: timedelta = DEFAULT_MAX_LAG,
    threshold: int = FAILURE_THRESHOLD,
) -> DataFrame:
    """Both run checks for every dataset: ``dataset_id, check_name, passed, description``."""
    streaks = consecutive_failures(runs, threshold).select("dataset_id", "consecutive_failures")
    state = freshness_state(runs, datasets, now, max_lag).join(streaks, "dataset_id", "left")
    failures = F.struct(
        F.lit(CONSECUTIVE_FAILURES).alias("check_name"),
        F.col("consecutive_failures").isNull().alias("passed"),
        F.format_string("%d failures in a row", "consecutive_failures").alias("text"),
    )
    fresh = F.struct(
        F.lit(FRESHNESS_BREACH).alias("check_name"),
        F.col("breach").isNull().alias("passed"),
        F.col("breach").alias("text"),
    )
    return state.select("dataset_id", F.inline(F.array(failures, fresh))).select(
        "dataset_id", "check_name", "passed", F.when(~F.col("passed"), F.col("text")).alias("description")
    )
