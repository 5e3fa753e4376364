"""Helpers shared by the operators: reading the given tables, cutting lineage, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# Rows of a few plain columns that may be broadcast; above it the join is shuffled.
BROADCAST_ROWS = 200_000
# Rows of a few plain columns in one file of a stored table.
FILE_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, no lineage behind it.

    ``rows``: about how many narrow rows there are at most. Their files then go by it, with one for each core at
    least, and not by the partitions of the shuffle before: on a local disk Hadoop starts a process for each file.
    """
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a stored table of narrow rows for broadcast if its counted size allows it."""
    counted = df.count() if rows is None else rows
    return F.broadcast(df) if counted <= BROADCAST_ROWS else df


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the deployer has set them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def without(docs: DataFrame, gone: DataFrame, on: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` whose values of the ``on`` expressions are not among the columns of ``gone`` that they
    are named for; nulls are equal. Columns of ``docs`` stay as they are, whatever they are called."""
    names = {k: free(docs, f"gone_{k}") for k in on}
    named = stored(gone.select(*(F.col(k).alias(n) for k, n in names.items())).distinct(), "gone")
    same = F.lit(True)
    for k, value in on.items():
        same = same & value.eqNullSafe(F.col(names[k]))
    return docs.join(small(named), same, "left_anti")
