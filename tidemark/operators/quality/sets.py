"""Set-level rules: aggregates and anti joins that reduce on the map side first.

Each rule works on many batches at once. ``batch`` names the columns that identify one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count; nulls equal each other."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_counts(df: DataFrame, batch: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Number of distinct duplicated keys per batch, batches without any included."""
    per_key = df.groupBy(*batch, *key).agg(F.count("*").alias("n"))
    return per_key.groupBy(*batch).agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"))


def calendar(df: DataFrame, key: Sequence[str], start: Column, stop: Column, step: str, name: str) -> DataFrame:
    """Expected keys: one row per distinct ``key`` and calendar step, unfolded in place."""
    steps = F.sequence(start, stop, F.expr(f"interval {step}"))
    return df.select(*key).distinct().withColumn(name, F.explode(steps))


def missing_keys(expected: DataFrame, actual: DataFrame, key: Sequence[str]) -> DataFrame:
    """Expected keys with no record. Actual keys are made distinct first, so a key with very
    many records reaches the join as one row."""
    return expected.join(actual.select(*key).distinct(), list(key), "left_anti")


def freshness(
    df: DataFrame, batch: Sequence[str], at: Column, now: datetime, max_lag: timedelta
) -> DataFrame:
    """Latest instant per batch and whether its age exceeds ``max_lag`` (strictly)."""
    latest = df.groupBy(*batch).agg(F.max(at).alias("latest"))
    return latest.withColumn("status", freshness_status(F.col("latest"), now, max_lag))


def freshness_status(latest: Column, now: datetime, max_lag: timedelta) -> Column:
    lag = F.lit(now).cast("timestamp") - latest
    return F.when(latest.isNull() | (lag > F.lit(max_lag)), "failed").otherwise("passed")


def dangling(facts: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Fact rows whose key resolves to no dimension row; a null key never resolves."""
    known = dimension.select(F.col(dimension_key).alias(key)).distinct()
    return facts.join(known, key, "left_anti")


def dangling_counts(
    facts: DataFrame, batch: Sequence[str], key: str, dimension: DataFrame, dimension_key: str
) -> DataFrame:
    """Dangling rows per batch. Rows collapse to one per (batch, key) before the anti join, so a
    key that a third of the facts carry is a single row there."""
    per_key = facts.groupBy(*batch, key).agg(F.count("*").alias("n"))
    return dangling(per_key, key, dimension, dimension_key).groupBy(*batch).agg(
        F.sum("n").alias("dangling_rows")
    )


def reconcile(local: DataFrame, source: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Compare (local_count, local_checksum) with (source_count, source_checksum) per batch.

    Skipped when the source reports neither; the checksum counts only when both sides have one.
    """
    joined = local.join(source, list(batch), "left")
    return joined.withColumn(
        "status",
        reconciliation_status(
            F.col("local_count"),
            F.col("source_count"),
            F.col("local_checksum"),
            F.col("source_checksum"),
        ),
    )


def reconciliation_status(
    local_count: Column, source_count: Column, local_checksum: Column, source_checksum: Column
) -> Column:
    differs = F.coalesce(local_count != source_count, F.lit(False)) | F.coalesce(
        local_checksum != source_checksum, F.lit(False)
    )
    return (
        F.when(source_count.isNull() & source_checksum.isNull(), "skipped")
        .when(differs, "failed")
        .otherwise("passed")
    )
