"""Bronze: one row per raw object, loaded once, checksum-gated, with lineage."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import keys
from tidemark.sources import landing

REJECT_MISMATCH = "Checksum mismatch"
REJECT_MISSING = "Raw object missing"


@dataclass(frozen=True)
class BronzeLoad:
    """``rows`` to append and ``rejected`` keys for the dead-letter table."""

    rows: DataFrame
    rejected: DataFrame


def verify_checksum(objects: DataFrame) -> DataFrame:
    """Adds ``actual_sha256`` and ``checksum_ok``, recomputed from the bytes."""
    checked = objects.withColumn("actual_sha256", keys.payload_sha256("payload"))
    matches = F.coalesce(F.col("actual_sha256") == F.col("raw_sha256"), F.lit(False))
    return checked.withColumn("checksum_ok", matches)


def checksum_rejects(checked: DataFrame) -> DataFrame:
    return checked.where(~F.col("checksum_ok")).select(
        "raw_object_key",
        "source_id",
        "dataset_id",
        F.when(F.col("actual_sha256").isNull(), REJECT_MISSING)
        .otherwise(F.format_string(f"{REJECT_MISMATCH}: expected %s, got %s", "raw_sha256", "actual_sha256"))
        .alias("reason"),
    )


def missing_rejects(manifest: DataFrame, objects: DataFrame) -> DataFrame:
    return landing.missing_objects(manifest, objects).select(
        "raw_object_key", "source_id", "dataset_id", F.lit(REJECT_MISSING).alias("reason")
    )


def lineage(objects: DataFrame, code_version: str, ingested_at: datetime) -> DataFrame:
    """Bronze columns; ``ingested_at`` is fixed by the driver so a retried task writes the same row."""
    shaped = objects.select(
        keys.bronze_id("raw_object_key").alias("bronze_id"),
        "source_id",
        "dataset_id",
        "raw_object_key",
        "raw_sha256",
        "retrieved_at",
        F.lit(code_version).alias("code_version"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
        "payload",
    )
    return shaped.select(*[f.name for f in schemas.BRONZE.fields])


def load(
    objects: DataFrame,
    existing: DataFrame,
    code_version: str,
    ingested_at: datetime,
    manifest: DataFrame | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> BronzeLoad:
    """Idempotent load: skip what Bronze already holds, verify the rest, keep one row per key.

    The skip compares 64-character ids only, and a key that is loaded is not judged again.
    ``stage`` stores the verified objects, so that rows and rejects come out of one reading.
    """
    held = existing.select(F.col("bronze_id").alias("held_id"))
    fresh = objects.join(held, keys.bronze_id("raw_object_key") == F.col("held_id"), "left_anti")
    checked = verify_checksum(fresh)
    if stage is not None:
        checked = stage(checked)
    good = checked.where("checksum_ok").drop("actual_sha256", "checksum_ok")
    rows = landing.first_copy(lineage(good, code_version, ingested_at)).select(*existing_columns())
    rejected = checksum_rejects(checked)
    if manifest is not None:
        rejected = rejected.unionByName(missing_rejects(manifest, objects))
    return BronzeLoad(rows, rejected)


def existing_columns() -> list[str]:
    return [f.name for f in schemas.BRONZE.fields]


def by_key(bronze: DataFrame, raw_object_key: str) -> DataFrame:
    return bronze.where(F.col("bronze_id") == keys.bronze_id(F.lit(raw_object_key)))


def by_keys(bronze: DataFrame, wanted: DataFrame) -> DataFrame:
    """Lineage of many objects: an equi join on the id derived from the key."""
    ids = wanted.select(keys.bronze_id("raw_object_key").alias("bronze_id")).distinct()
    return bronze.join(ids, "bronze_id", "left_semi")
