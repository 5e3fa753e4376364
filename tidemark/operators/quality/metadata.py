"""Rules over contracts and dimensions rather than records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.records import without_nulls


def _blank(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name).cast("string"), F.lit(""))) == ""


def semantic_metadata(
    contracts: DataFrame,
    required: Sequence[str] = ("units", "seasonal_adjustment"),
    index_base: str = "index_base",
    has_index_base: str | None = "has_index_base",
) -> DataFrame:
    """Adds ``missing_metadata`` and ``status``; the index base counts only where it is declared."""
    gaps = [F.when(_blank(name), F.lit(name)) for name in required]
    if has_index_base is not None:
        gaps.append(F.when(F.col(has_index_base) & _blank(index_base), F.lit(index_base)))
    found = contracts.withColumn("missing_metadata", without_nulls(gaps))
    return found.withColumn(
        "status", F.when(F.size("missing_metadata") > 0, "failed").otherwise("passed")
    )


def publishable(rows: DataFrame, contracts: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Gate before Gold: rows of datasets whose semantic metadata is complete."""
    complete = semantic_metadata(contracts).where("status = 'passed'").select(key)
    return rows.join(complete, key, "left_semi")


def onboarding_gaps(datasets: DataFrame, contracts: DataFrame, dim_source: DataFrame) -> DataFrame:
    """Datasets that may not be published yet, with what each lacks."""
    contract = contracts.select("dataset_id", F.col("owner").alias("contract_owner"), F.lit(True).alias("has_contract"))
    source = dim_source.select("source_id", "license_url", "trust_tier", F.lit(True).alias("has_source"))
    joined = datasets.select("dataset_id", "source_id").join(contract, "dataset_id", "left").join(source, "source_id", "left")
    gaps = without_nulls(
        [
            F.when(F.col("has_contract").isNull(), "contract"),
            F.when(_blank("contract_owner"), "owner"),
            F.when(F.col("has_source").isNull(), "source"),
            F.when(_blank("license_url"), "license"),
            F.when(_blank("trust_tier"), "trust_tier"),
        ]
    )
    return joined.select("dataset_id", "source_id", gaps.alias("gaps")).where(F.size("gaps") > 0)
