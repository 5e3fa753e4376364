"""Dimension seeds: CSV files with a header, or the built-in starter rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Fixed schema, so the file is never scanned for inference; blanks become null."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, schemas.DIM_SOURCE)


def read_indicators(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, schemas.DIM_INDICATOR)


def read_dataset_map(spark: SparkSession, path: str) -> DataFrame:
    return read_seed(spark, path, schemas.DATASET_INDICATOR_MAP)


# Starter rows of the three seeds.
STARTER_SOURCE = {
    "source_id": "fred",
    "publisher": "Federal Reserve Bank of St. Louis",
    "trust_tier": "official",
}
STARTER_INDICATOR = {
    "indicator_id": "cpi_us",
    "name": "Consumer Price Index for All Urban Consumers",
    "unit": "index_1982_84_100",
    "seasonal_adjustment": "sa",
}
STARTER_MAP = {
    "dataset_id": "fred_cpiaucsl",
    "source_id": "fred",
    "indicator_id": "cpi_us",
    "geo_code": "US",
    "frequency": "monthly",
}


def starter_frames(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dim_source, dim_indicator, dataset_indicator_map) with one row each."""
    return (
        small_frame(spark, [STARTER_SOURCE], schemas.DIM_SOURCE),
        small_frame(spark, [STARTER_INDICATOR], schemas.DIM_INDICATOR),
        small_frame(spark, [STARTER_MAP], schemas.DATASET_INDICATOR_MAP),
    )


def small_frame(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Driver-held reference rows as a relation whose size the optimiser knows.

    Arrow input becomes a LocalRelation with exact statistics, so Spark itself decides whether
    a join may broadcast it; no hint is given anywhere in the package.
    """
    columns = {f.name: [row.get(f.name) for row in rows] for f in schema.fields}
    arrow = pa.schema([pa.field(f.name, _arrow_type(f.dataType)) for f in schema.fields])
    return spark.createDataFrame(pa.table(columns, schema=arrow))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    return {
        "string": pa.string(),
        "int": pa.int32(),
        "bigint": pa.int64(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "date": pa.date32(),
        "timestamp": pa.timestamp("us", tz="UTC"),
    }[kind.simpleString()]
