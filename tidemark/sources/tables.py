"""Parquet tables without a table format: full rebuilds, append logs and views over them.

Spark's Parquet tables take no MERGE. An upsert is therefore an append to a log plus a
"latest row per key" view, an insert-if-absent is an anti join plus an append, and a guarded
update is a log of state changes. Every write is one Spark job with the normal commit protocol,
so a lost executor or a retried task cannot leave half a table or a row twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COLUMN = "write_batch"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table directory is there (a listing call on the driver, no data is read)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file that says that something is under way."""
    fs, target = _hadoop(spark, path)
    fs.create(target, True).close()


def unmark(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, False)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame of its schema before the first write."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = (), slices_only: bool = False) -> None:
    """Full rebuild of a table, or with ``slices_only`` of just the slices present in ``df``.

    With ``partition_by``, a rebalance exchange gathers each slice into few files and splits a
    slice that is too large for one task.
    """
    mode = "dynamic" if slices_only else "static"
    writer = _rebalanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


POINTER, VERSION = "_current", "version"


def replace(df: DataFrame, path: str, partition_by: str, slices_only: bool = False) -> None:
    """Replace a table, or with ``slices_only`` the slices present in ``df``, without a moment in which
    readers find less than a whole table.

    Rows go to a directory of their own, then a pointer file that lists the directories in force is
    switched by one rename. A run that dies before the rename leaves the old table as it was. The version
    before stays for readers that have begun; older directories are removed.
    """
    spark = df.sparkSession
    fs, root = _hadoop(spark, path)
    before = _pointed(spark, path)
    version = f"{VERSION}={uuid.uuid4().hex}"
    target = f"{path}/{version}"
    _rebalanced(df, [partition_by]).write.partitionBy(partition_by).parquet(target)
    if slices_only and before:
        made = {d.rpartition("/")[2] for d in _slices(spark, path, [version])}
        kept = [d for d in _slices(spark, path, before) if d.rpartition("/")[2] not in made]
        current = [*kept, version]
    else:
        current = [version]
    _point(spark, path, current)
    used = {d.partition("/")[0] for d in (*current, *before)}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{VERSION}=") and name not in used:
            fs.delete(status.getPath(), True)


def read_replaced(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table in force, or an empty frame of its schema before the first write."""
    current = _pointed(spark, path)
    paths = [f"{path}/{d}" for d in _slices(spark, path, current)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*schema.fieldNames())


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _slices(spark: SparkSession, path: str, directories: Sequence[str]) -> list[str]:
    """Partition directories under the listed ones (a version, or one slice of a version)."""
    out = []
    for directory in directories:
        if "/" in directory:
            out.append(directory)
            continue
        fs, target = _hadoop(spark, f"{path}/{directory}")
        names = sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())
        out += [f"{directory}/{n}" for n in names]
    return out


def _pointed(spark: SparkSession, path: str) -> list[str]:
    """Directories that the pointer file lists."""
    fs, target = _hadoop(spark, f"{path}/{POINTER}")
    if not fs.exists(target):
        return []
    stream = fs.open(target)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text.split("\n")


def _point(spark: SparkSession, path: str, directories: Sequence[str]) -> None:
    """Write the pointer beside its place and move it there; the move replaces the old one at once."""
    fs, part = _hadoop(spark, f"{path}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(part, True)
    try:
        out.write(bytearray("\n".join(directories).encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(part.toUri() if part.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context.rename(fs.makeQualified(part), fs.makeQualified(hadoop.Path(f"{path}/{POINTER}")), options)


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result to shared storage and go on from there.

    Used where several steps start from one expensive projection: it is computed once, and a lost
    executor costs a re-read of the stored columns instead of the whole computation.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = True) -> None:
    """Audit append: one row per attempt, never keyed by content."""
    writer = (_rebalanced(df, partition_by) if rebalance else df).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_slice(df: DataFrame, path: str, label: str) -> None:
    """Append to a log that streaming queries write too: every row is in a slice, so readers see all."""
    df.withColumn(BATCH_COLUMN, F.lit(label)).write.mode("append").partitionBy(BATCH_COLUMN).parquet(path)


def write_batch(df: DataFrame, path: str, query: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write one micro-batch into its own slice; a retry of the batch replaces the same slice.

    ``query`` names the streaming query (one name per checkpoint), so queries do not share slices. With
    ``partition_by`` the table is partitioned by those columns first, and the slice lies in each of them.
    """
    (
        _rebalanced(df, partition_by)
        .withColumn(BATCH_COLUMN, F.lit(slice_name(query, batch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, BATCH_COLUMN)
        .parquet(path)
    )


def slice_name(query: str, batch_id: int) -> str:
    return f"{query}-{batch_id:012d}"


def other_batches(
    spark: SparkSession, path: str, schema: T.StructType, query: str, batch_id: int
) -> DataFrame:
    """The table without the slice a batch is about to write: what was stored before it."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    sliced = T.StructType([*schema.fields, T.StructField(BATCH_COLUMN, T.StringType())])
    rows = spark.read.schema(sliced).parquet(path)
    return rows.where(F.col(BATCH_COLUMN) != slice_name(query, batch_id)).drop(BATCH_COLUMN)


def latest_by_key(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write wins: the greatest row per key in ``order``; the rest of the row breaks ties."""
    return _one_per_key(log, key, order, F.max)


def first_by_key(log: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First write wins."""
    return _one_per_key(log, key, order, F.min)


def _one_per_key(log: DataFrame, key: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """An aggregate rather than a window: each task keeps one row per key before the shuffle."""
    rest = [c for c in log.columns if c not in (*key, *order)]
    picked = pick(F.struct(*order, *rest)).alias("row")
    chosen = log.groupBy(*key).agg(picked).select(*key, "row.*")
    return chosen.select(*log.columns)


def insert_absent(
    incoming: DataFrame, existing: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows of ``incoming`` to append: first per key, and only keys not stored yet."""
    return first_by_key(incoming, key, order).join(existing.select(*key), list(key), "left_anti")


def upsert_view(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """State after an upsert: an incoming row replaces all non-key columns of a stored one."""
    both = existing.withColumn("_arrival", F.lit(0)).unionByName(
        incoming.withColumn("_arrival", F.lit(1))
    )
    return latest_by_key(both, key, ("_arrival", *order)).drop("_arrival")


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    schema: T.StructType,
    time_column: str | Column,
    where: Column | None = None,
) -> None:
    """Merge small files into a ``year=/month=/day=`` layout at ``target``.

    Rebalancing by day lets AQE pick file counts by size: small days merge, big days split.
    Re-running over the same input replaces the same days.
    """
    moment = F.col(time_column) if isinstance(time_column, str) else time_column
    rows = spark.read.schema(schema).parquet(path)
    rows = rows if where is None else rows.where(where)
    rows = rows.withColumns(
        {"year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)}
    )
    rebuild(rows, target, ("year", "month", "day"), slices_only=True)
