"""CSV export that carries the source's attribution with every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_attribution(df: DataFrame, dim_source: DataFrame) -> DataFrame:
    """Publisher, licence and attribution columns; the publisher stands in for a blank text."""
    source = dim_source.select(
        "source_id",
        "publisher",
        "license_url",
        F.coalesce("attribution_text", F.concat(F.lit("Source: "), "publisher")).alias("attribution"),
    )
    return df.join(source, "source_id", "left")


def export_csv(df: DataFrame, dim_source: DataFrame, path: str) -> None:
    with_attribution(df, dim_source).write.mode("overwrite").option("header", True).csv(path)
