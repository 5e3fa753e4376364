"""Table tests: each reports a count of failing rows or keys; zero means the test passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.quality import sets


def column_tests(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """``not_null`` and ``accepted_values`` tests of one table in a single aggregate."""
    tests = {f"not_null_{table}_{c}": F.col(c).isNull() for c in not_null}
    for column, values in (accepted or {}).items():
        tests[f"accepted_values_{table}_{column}"] = ~F.col(column).isin(*values)
    totals = df.agg(*[F.count_if(bad).alias(name) for name, bad in tests.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("test_id"), F.col(n).alias("failed_rows")) for n in tests])
    return totals.select(F.inline(rows)).select("test_id", F.lit(table).alias("table_name"), "failed_rows")


def unique_test(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of repeated values; nulls are the not-null test's business."""
    repeated = sets.duplicate_keys(df.where(F.col(column).isNotNull()), [column])
    return repeated.agg(F.count("*").alias("failed_rows")).select(
        F.lit(f"unique_{table}_{column}").alias("test_id"), F.lit(table).alias("table_name"), "failed_rows"
    )


def primary_key_test(observations: DataFrame) -> DataFrame:
    """Keys of the observation table that occur more than once."""
    return sets.duplicate_keys(observations, schemas.OBSERVATION_KEY)


def time_fields_test(observations: DataFrame) -> DataFrame:
    """Rows whose period collapsed to a day or that were processed before they were retrieved."""
    return observations.where(
        (F.col("period_start") == F.col("period_end"))
        | (F.col("processed_at") < F.col("retrieved_at"))
    ).select(*schemas.OBSERVATION_KEY)


def observation_tests(observations: DataFrame) -> DataFrame:
    required = [f.name for f in schemas.OBSERVATION.fields if not f.nullable]
    return column_tests(
        observations,
        "fact_economic_observation",
        not_null=required,
        accepted={"seasonal_adjustment": schemas.SEASONAL_ADJUSTMENTS},
    )


def kpi_tests(kpis: DataFrame) -> DataFrame:
    return column_tests(
        kpis, "fact_economic_kpi", not_null=("indicator_id", "geo_code", "period", "value")
    )


def seed_tests(dim_source: DataFrame, dim_indicator: DataFrame, dataset_map: DataFrame) -> DataFrame:
    parts = [
        column_tests(
            dim_source, "dim_source", ["source_id"], {"trust_tier": schemas.TRUST_TIERS}
        ),
        unique_test(dim_source, "dim_source", "source_id"),
        column_tests(
            dim_indicator,
            "dim_indicator",
            ["indicator_id"],
            {"seasonal_adjustment": schemas.SEASONAL_ADJUSTMENTS},
        ),
        unique_test(dim_indicator, "dim_indicator", "indicator_id"),
        column_tests(
            dataset_map, "dataset_indicator_map", ["dataset_id", "indicator_id", "geo_code"]
        ),
        unique_test(dataset_map, "dataset_indicator_map", "dataset_id"),
    ]
    return reduce(DataFrame.unionByName, parts)
