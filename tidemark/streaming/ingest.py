"""Streaming ingest: landed objects become Bronze rows exactly once."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators import bronze
from tidemark.sources import landing, tables

# Columns of Spark's binaryFile source.
BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def object_files(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """Stream of landed files; each trigger takes a bounded number of them."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(f"{root.rstrip('/')}/raw")
    )
    return landing.from_binary_files(files)


def object_table(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """Stream of a Parquet landing table."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def run_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, name: str
) -> StreamingQuery:
    """Process what is available in micro-batches and stop; call again to go on from there."""
    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def to_bronze(
    objects: DataFrame, bronze_path: str, rejected_path: str, code_version: str, checkpoint: str, name: str
) -> StreamingQuery:
    """Checksum gate and once-only load per micro-batch.

    The stored ids a batch is compared with leave out its own slice, so a batch that is tried
    again computes and replaces the same slice.
    """
    spark = objects.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = tables.other_batches(spark, bronze_path, schemas.BRONZE, name, batch_id)
        loaded = bronze.load(batch, stored, code_version, datetime.now(timezone.utc))
        tables.write_batch(loaded.rows, bronze_path, name, batch_id)
        tables.write_batch(loaded.rejected, rejected_path, name, batch_id)

    return run_batches(objects, write, checkpoint, name)


def deduplicate(stream: DataFrame, key: list[str], at: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of the first; state is bounded by it.

    Repeats that arrive later still meet the stored ids in ``to_bronze``.
    """
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(key)
