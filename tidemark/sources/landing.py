"""Raw landing zone: untouched payload files under content-addressed keys."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import keys
from tidemark.sources import tables

# ``land_files`` writes from Python workers, where the package need not be installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes that one fetched batch holds before it is handed on, and that one task should fetch.
BATCH_BYTES, TASK_BYTES = 32 << 20, 256 << 20


def read_landed(
    spark: SparkSession,
    root: str,
    sources: Iterable[str] | None = None,
    dates: Iterable[str] | None = None,
) -> DataFrame:
    """Objects under ``root`` with lineage read from their path and the exact bytes.

    ``sources`` and ``dates`` become path globs, so only those directories are listed and read.
    """
    source_glob = _glob(sources)
    date_glob = _glob(dates)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .load(f"{root.rstrip('/')}/raw/{source_glob}/*/date={date_glob}")
    )
    return from_binary_files(files)


def _glob(values: Iterable[str] | None) -> str:
    return "*" if values is None else "{" + ",".join(sorted(values)) + "}"


def from_binary_files(files: DataFrame) -> DataFrame:
    """Shape of a raw object from the columns of the binaryFile source (batch or stream)."""
    part = keys.key_parts("path")
    return files.where(F.col("path").rlike(keys.KEY_PATTERN + "$")).select(
        F.regexp_extract("path", keys.KEY_PATTERN, 0).alias("raw_object_key"),
        part["source_id"].alias("source_id"),
        part["dataset_id"].alias("dataset_id"),
        part["raw_sha256"].alias("raw_sha256"),
        F.col("modificationTime").alias("retrieved_at"),
        F.col("content").alias("payload"),
    )


def landed_keys(spark: SparkSession, root: str) -> DataFrame:
    """Keys only: the content column is pruned, so no file is opened."""
    return read_landed(spark, root).select("raw_object_key")


def listed(spark: SparkSession, root: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Names, sizes and times of landed files; the content is not selected, so no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .load(f"{root.rstrip('/')}/raw/*/*/date={_glob(dates)}")
    )
    part = keys.key_parts("path")
    return files.where(F.col("path").rlike(keys.KEY_PATTERN + "$")).select(
        F.regexp_extract("path", keys.KEY_PATTERN, 0).alias("raw_object_key"),
        "path",
        part["source_id"].alias("source_id"),
        part["dataset_id"].alias("dataset_id"),
        part["raw_sha256"].alias("raw_sha256"),
        F.col("modificationTime").alias("retrieved_at"),
        "length",
    )


def retrievals(manifest: DataFrame) -> DataFrame:
    """When each object was first retrieved: the earliest row of the manifest wins."""
    return manifest.groupBy("raw_object_key").agg(F.min("retrieved_at").alias("first_retrieved"))


def winners(names: DataFrame, held: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """One name per key that is not ``held``, with the manifest's retrieval time where it has one.

    Only names are compared and shuffled; files that are not new are never opened.
    """
    fresh = names.join(held.select("raw_object_key"), "raw_object_key", "left_anti")
    if manifest is not None:
        fresh = fresh.join(retrievals(manifest), "raw_object_key", "left").withColumn(
            "retrieved_at", F.coalesce("first_retrieved", "retrieved_at")
        )
    return first_copy(fresh.select(*schemas.OBJECT_NAME.fieldNames())).select(*schemas.OBJECT_NAME.fieldNames())


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a Hadoop path, and the path inside it."""
    if path.startswith(("/", "file:")):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    scheme, _, rest = path.partition("://")
    authority, _, inside = rest.partition("/")
    filesystem, base = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return filesystem, f"{base.rstrip('/')}/{inside}"


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The named files' bytes, a bounded number of them at a time; a file that is gone gives null."""
    for batch in batches:
        paths, begin, held, size = batch.column("path").to_pylist(), 0, [], 0
        for i, path in enumerate(paths):
            filesystem, inside = _filesystem(path)
            try:
                with filesystem.open_input_stream(inside) as source:
                    held.append(source.read())
            except FileNotFoundError:
                held.append(None)
            size += len(held[-1] or b"")
            if size >= BATCH_BYTES or i + 1 == len(paths):
                part = batch.slice(begin, len(held))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(held, pa.binary())], [*batch.schema.names, "payload"]
                )
                begin, held, size = i + 1, [], 0


def fetch(names: DataFrame) -> DataFrame:
    """Read the named files in the executors, each once and where it is needed.

    Names are dealt by source, dataset and as many parts as their sizes ask for, so bytes are neither
    shuffled nor sorted, and one hot dataset is spread over many tasks.
    """
    sizes = names.groupBy("source_id", "dataset_id").agg(F.sum("length").alias("_bytes"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_bytes") / TASK_BYTES))
    dealt = names.join(sizes, ["source_id", "dataset_id"]).withColumn(
        "_part", F.pmod(F.xxhash64("raw_object_key"), parts)
    )
    width = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = dealt.repartition(width, "source_id", "dataset_id", "_part").select(*names.columns)
    schema = ", ".join(f"`{n}` {t}" for n, t in spread.dtypes) + ", payload binary"
    return spread.mapInArrow(_fetched, schema)


def address(payloads: DataFrame) -> DataFrame:
    """Give (source_id, dataset_id, retrieved_at, payload) rows their checksum and object key."""
    return payloads.withColumn("raw_sha256", keys.payload_sha256("payload")).withColumn(
        "raw_object_key", keys.object_key("source_id", "dataset_id", "retrieved_at", "raw_sha256")
    )


def first_copy(objects: DataFrame, order: str = "retrieved_at") -> DataFrame:
    """One row per key, the earliest; copies collapse on the map side before the shuffle."""
    others = [c for c in objects.columns if c not in ("raw_object_key", order)]
    first = F.min(F.struct(order, *others)).alias("first")
    return objects.groupBy("raw_object_key").agg(first).select("raw_object_key", "first.*")


def new_objects(objects: DataFrame, landed: DataFrame) -> DataFrame:
    """Write-once rule: objects whose key has not landed, one row per key."""
    return first_copy(objects.join(landed.select("raw_object_key"), "raw_object_key", "left_anti"))


def already_landed(objects: DataFrame, landed: DataFrame) -> DataFrame:
    """Existence probe for many keys at once."""
    return objects.join(landed.select("raw_object_key"), "raw_object_key", "left_semi")


def missing_objects(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest rows whose object is not in the landing zone."""
    return manifest.join(landed.select("raw_object_key"), "raw_object_key", "left_anti")


def object_at(objects: DataFrame, key: str | Column) -> DataFrame:
    return objects.where(F.col("raw_object_key") == key)


OBJECT_COLUMNS = (
    "raw_object_key",
    "source_id",
    "dataset_id",
    "raw_sha256",
    "retrieved_at",
    "payload",
)


def land_table(objects: DataFrame, landed: DataFrame, path: str) -> None:
    """Append new objects to a Parquet landing table, for payloads too small to be files each."""
    fresh = new_objects(objects.select(*OBJECT_COLUMNS), landed).select(*OBJECT_COLUMNS)
    tables.append(fresh, path, ("source_id", "dataset_id"))


def land(objects: DataFrame, root: str, manifest_path: str, label: str) -> None:
    """Land files with a manifest of when each was retrieved.

    The manifest is written first: a run that dies in between leaves rows without a file, which no
    load reads, but never a file whose retrieval time is lost.
    """
    tables.append_slice(objects.select("raw_object_key", "retrieved_at"), manifest_path, label)
    land_files(objects, root)


def land_files(objects: DataFrame, root: str) -> None:
    """Write each payload to its key under ``root`` unless it is there.

    Runs in the executors. A file appears under its name only when complete and its name is its
    content, so a repeated task writes nothing new.
    """

    def put(rows: Iterator[Row]) -> None:
        filesystem, base = pafs.FileSystem.from_uri(root)
        for row in rows:
            target = f"{base.rstrip('/')}/{row.raw_object_key}"
            if filesystem.get_file_info(target).type != pafs.FileType.NotFound:
                continue
            folder, _, name = target.rpartition("/")
            filesystem.create_dir(folder, recursive=True)
            partial = f"{folder}/.{name}.partial"
            with filesystem.open_output_stream(partial) as out:
                out.write(row.payload)
            filesystem.move(partial, target)

    objects.select("raw_object_key", "payload").foreachPartition(put)
