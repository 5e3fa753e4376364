"""Run history, quality results and the indicators computed over them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import keys
from tidemark.sources import tables


def run_id(dataset_id: Column | str, started_at: Column | str) -> Column:
    return keys.derived_id(dataset_id, started_at)


def by_id(runs: DataFrame, run_id: str) -> DataFrame:
    return runs.where(F.col("run_id") == run_id)


def history(runs: DataFrame, dataset_id: str) -> DataFrame:
    """Runs of one dataset, oldest first."""
    return with_duration(runs.where(F.col("dataset_id") == dataset_id)).orderBy("started_at", "run_id")


def with_duration(runs: DataFrame) -> DataFrame:
    micros = F.unix_micros("finished_at") - F.unix_micros("started_at")
    return runs.withColumn("duration_seconds", micros / 1_000_000)


def latest(runs: DataFrame, where: Column | None = None) -> DataFrame:
    """Latest run per dataset, reduced on the map side."""
    chosen = runs if where is None else runs.where(where)
    rest = [c for c in chosen.columns if c not in ("dataset_id", "started_at", "run_id")]
    return (
        chosen.groupBy("dataset_id")
        .agg(F.max(F.struct("started_at", "run_id", *rest)).alias("run"))
        .select("dataset_id", "run.*")
    )


def record_quality(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Quality results after an upsert on (test_id, table_name)."""
    return tables.upsert_view(existing, incoming, schemas.QUALITY_RESULT_KEY, ("evaluated_at",))


def quality_result(results: DataFrame, test_id: str, table_name: str) -> DataFrame:
    return results.where((F.col("test_id") == test_id) & (F.col("table_name") == table_name))


def quality_for_table(results: DataFrame, table_name: str) -> DataFrame:
    return results.where(F.col("table_name") == table_name).orderBy("test_id")


def success_rate(runs: DataFrame, days: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Share of successful runs over the trailing ``days`` calendar days, per day.

    Runs are counted per day first; the window then holds one row per day.
    """
    daily = runs.groupBy(*by, F.to_date("started_at").alias("day")).agg(
        F.count("*").alias("runs"), F.count_if(F.col("status") == "success").alias("successes")
    )
    trailing = Window.partitionBy(*by).orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    totals = daily.select(
        *by,
        "day",
        F.sum("runs").over(trailing).alias("runs"),
        F.sum("successes").over(trailing).alias("successes"),
    )
    return totals.withColumn("success_rate", F.round(F.col("successes") / F.col("runs"), 6))


def freshness_adherence(runs: DataFrame, datasets: DataFrame, now: datetime) -> DataFrame:
    """Share of datasets whose latest success is no older than their ``max_lag_seconds``."""
    newest = runs.where("status = 'success'").groupBy("dataset_id").agg(
        F.max("finished_at").alias("finished_at")
    )
    age = F.lit(now).cast("timestamp").cast("long") - F.col("finished_at").cast("long")
    met = F.coalesce(age <= F.col("max_lag_seconds"), F.lit(False))
    return datasets.join(newest, "dataset_id", "left").agg(
        F.count("*").alias("datasets"),
        F.count_if(met).alias("fresh"),
        F.round(F.count_if(met) / F.count("*"), 6).alias("adherence"),
    )


def pass_rate(results: DataFrame) -> DataFrame:
    """Share of quality results that did not fail."""
    ok = F.count_if(F.col("status") != "fail")
    return results.agg(
        F.count("*").alias("tests"), ok.alias("not_failed"), F.round(ok / F.count("*"), 6).alias("pass_rate")
    )


def sampled_datasets(datasets: DataFrame, percent: int) -> DataFrame:
    """A reproducible sample of datasets for reconciliation, chosen by a hash of the id."""
    bucket = F.conv(F.substring(F.md5("dataset_id"), 1, 8), 16, 10).cast("bigint") % 100
    return datasets.where(bucket < percent)
