"""Reconciliation by commutative checksums, and the search for the keys that make two sides differ.

A record's fingerprint is taken over the text of its declared fields; sums of fingerprints do not depend on order,
so they combine before any shuffle and can be compared at every grain. A mismatch is located from the coarse
to the fine: batches, then buckets of keys, then the keys of differing buckets alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import DataContract
from tidemark.functions import keys
from tidemark.functions import records as R

#: Bits of the key's hash that name a bucket, from level to level.
LEVELS = (6, 12, 20)


def fingerprint(contract: DataContract) -> Column:
    """Of an unpacked record: its declared fields as text, absent and null fields alike."""
    return keys.row_fingerprint(*[R.field(name).text for name in sorted(contract.schema)])


def checksums(records: DataFrame, contract: DataContract) -> DataFrame:
    """(batch_id, source_count, source_checksum): what the delivering side states about its batches."""
    printed = R.unpack(records, contract.schema).select("batch_id", fingerprint(contract).alias("fingerprint"))
    return printed.groupBy("batch_id").agg(
        F.count("*").alias("source_count"), F.sum("fingerprint").cast("string").alias("source_checksum")
    )


def per_key(records: DataFrame, contract: DataContract) -> DataFrame:
    """(batch_id, the primary key, place, n, checksum) per key; ``place`` is the key's hash."""
    key = list(contract.primary_key)
    opened = R.unpack(records, [*contract.schema, *key])
    narrow = opened.select("batch_id", *[R.field(k).text.alias(k) for k in key], fingerprint(contract).alias("fingerprint"))
    summed = narrow.groupBy("batch_id", *key).agg(F.count("*").alias("n"), F.sum("fingerprint").alias("checksum"))
    return summed.withColumn("place", F.xxhash64(*key))


def _sums(rows: DataFrame, bits: int | None) -> DataFrame:
    bucket = F.lit(0).cast("long") if bits is None else F.pmod(F.col("place"), F.lit(1 << bits)).cast("long")
    return rows.groupBy("batch_id", bucket.alias("bucket")).agg(
        F.sum("n").alias("n"), F.sum("checksum").alias("checksum")
    )


def differing(here: DataFrame, there: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of (on, n, checksum) that only one side has or that differ, with both sides' counts."""
    sides = here.select(*on, F.col("n").alias("n_here"), F.col("checksum").alias("sum_here"), *_blank("there")).unionByName(
        there.select(*on, F.col("n").alias("n_there"), F.col("checksum").alias("sum_there"), *_blank("here"))
    )
    both = sides.groupBy(*on).agg(*[F.max(f"{x}_{s}").alias(f"{x}_{s}") for s in ("here", "there") for x in ("n", "sum")])
    same = F.col("n_here").eqNullSafe(F.col("n_there")) & F.col("sum_here").eqNullSafe(F.col("sum_there"))
    return both.where(~same)


def _blank(side: str) -> list[Column]:
    return [F.lit(None).cast("long").alias(f"n_{side}"), F.lit(None).cast("decimal(38,0)").alias(f"sum_{side}")]


def locate(
    here: DataFrame,
    there: DataFrame,
    contract: DataContract,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """Keys on which two deliveries of the same batches differ: (batch_id, key, problem, n_here, n_there).

    Sums per batch are compared first. Of the batches that differ the sums per bucket are, level by level, and
    only the keys of the buckets left over meet key by key; so almost all rows are compared by a sum. ``stage``
    stores the sums per key, which every level reads.
    """
    key = list(contract.primary_key)
    sides = [per_key(x, contract) for x in (here, there)]
    if stage is not None:
        sides = [stage(x) for x in sides]
    for bits in (None, *levels):
        found = differing(_sums(sides[0], bits), _sums(sides[1], bits), ["batch_id", "bucket"])
        found = found.select("batch_id", F.col("bucket").alias("_bucket"))
        bucket = F.lit(0).cast("long") if bits is None else F.pmod(F.col("place"), F.lit(1 << bits)).cast("long")
        sides = [
            x.withColumn("_bucket", bucket).join(found, ["batch_id", "_bucket"], "left_semi").drop("_bucket") for x in sides
        ]
    rows = differing(sides[0], sides[1], ["batch_id", *key])
    problem = F.when(F.col("n_here").isNull(), "missing here").when(F.col("n_there").isNull(), "missing there").otherwise("differs")
    return rows.select("batch_id", *key, problem.alias("problem"), "n_here", "n_there")
